"""Raw and landing files: reading, lineage, conforming, writing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fabspark.functions import columns as C
from fabspark.functions import schemas


def read_raw_csv(spark: SparkSession, path: str, sensors: Sequence[str],
                 extra: Sequence[T.StructField] = (), mode: str = "FAILFAST") -> DataFrame:
    """Raw baseline with typed time; the text ``NaN`` becomes NULL like an empty cell.

    A number or time that cannot be read is an error; with ``mode="PERMISSIVE"`` it becomes NULL.
    """
    schema = T.StructType([*schemas.raw_schema(sensors).fields, *extra])
    df = (spark.read.schema(schema).option("header", True).option("mode", mode)
          .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(path))
    gaps = {f.name for f in schema.fields if isinstance(f.dataType, T.DoubleType)}
    return df.select(*[
        F.when(~F.isnan(C.col(c)), C.col(c)).alias(c) if c in gaps else C.col(c) for c in df.columns])


def read_landing(spark: SparkSession, paths: Sequence[str], base: str,
                 schema: T.StructType) -> DataFrame:
    """Landing files with their path keys as strings, whatever the keys look like.

    The schema names the keys as strings, which stops Spark from guessing numbers
    (``month=01`` stays ``01``).
    """
    return spark.read.schema(schema).option("basePath", base).parquet(*paths)


def read_paths(spark: SparkSession, listed: str, base: str, schema: T.StructType) -> DataFrame:
    """As ``read_landing`` for a comma-separated list of files."""
    return read_landing(spark, [p.strip() for p in listed.split(",") if p.strip()], base, schema)


def with_source_file(df: DataFrame) -> DataFrame:
    """The file each row came from; use right after the read."""
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Column order and types of the table; a missing non-null column is an error."""
    return df.to(schema)


def with_ingest_meta(df: DataFrame, version: str) -> DataFrame:
    return df.withColumns({
        "ingestion_timestamp": F.current_timestamp().cast("timestamp_ntz"),
        "pipeline_version": F.lit(version)})


PATH_KEYS = ("line_id", "year", "month", "day")


def write_landing(df: DataFrame, base: str, mode: str = "append") -> None:
    """Write a batch under line and generation day.

    The rebalance hint gathers the rows of a (line, day) but splits a large one
    over several tasks by size, so there are few files and no hot task.
    """
    g = F.col("generation_timestamp")
    out = df.withColumns({"year": F.date_format(g, "yyyy"), "month": F.date_format(g, "MM"),
                          "day": F.date_format(g, "dd")})
    (out.hint("rebalance", *PATH_KEYS).write.mode(mode).partitionBy(*PATH_KEYS).parquet(base))
