"""Tables: append to bronze, rebuild silver and gold, ad hoc SQL."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from fabspark.sources.files import conform


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{at}")


def append_bronze(df: DataFrame, table: str, location: str | None = None) -> None:
    """Create the table from the first batch; later batches must fit its schema."""
    spark = df.sparkSession
    if "." in table:
        ensure_database(spark, table.split(".")[0], location)
    if spark.catalog.tableExists(table):
        df = conform(df, spark.table(table).schema)
    df.write.mode("append").format("parquet").saveAsTable(table)


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the stream that owns a checkpoint; it stays the same over restarts from that checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def batch_path(path: str, run: str, batch_id: int) -> str:
    return f"{path}/run={run}/batch_id={batch_id}"


def overwrite_batch(df: DataFrame, path: str, run: str, batch_id: int) -> None:
    """Write one batch of a stream; a replayed batch replaces itself, and only itself: another stream into the
    same table has another run id."""
    df.write.mode("overwrite").parquet(batch_path(path, run, batch_id))


def materialize(df: DataFrame, table: str, partition_by: Sequence[str] = (),
                location: str | None = None) -> DataFrame:
    """Rebuild a table in full, optionally partitioned."""
    spark = df.sparkSession
    if "." in table:
        ensure_database(spark, table.split(".")[0], location)
    if partition_by:
        w = df.hint("rebalance", *partition_by).write.partitionBy(*partition_by)
    else:
        w = df.write
    w = w.mode("overwrite").format("parquet")
    w.saveAsTable(table)
    return spark.table(table)


def sql(spark: SparkSession, text: str, **views: DataFrame) -> DataFrame:
    """Ad hoc SQL over tables and the given frames as views."""
    return spark.sql(text, **views)
