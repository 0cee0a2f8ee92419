"""Bronze to silver: typing, status, missing readings, screening."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabspark import constants as K
from fabspark.functions import columns as C

PLAIN = ("line_id", "tester_id", "shift", "lot_id")


def stage(bronze: DataFrame, sensors: Sequence[str], key: Column | None = None) -> DataFrame:
    """One typed row per wafer: key, time, status, label, missing readings, sensors.

    ``key`` defaults to the hash of the test time and the source file.
    """
    if key is None:
        key = C.surrogate_key(C.key_text(F.col("Time"), timestamp=True),
                              C.key_text(F.col("source_file")))
    used = {"Time", "Pass/Fail", "observation_id", "ingestion_timestamp", "pipeline_version",
            *PLAIN, *sensors}
    label = C.col("Pass/Fail")
    lineage = [(a, b) for a, b in (("ingestion_timestamp", "bronze_ingested_at"),
                                   ("pipeline_version", "bronze_pipeline_version"))
               if a in bronze.columns]
    return bronze.select(
        key.alias("observation_id"),
        F.col("Time").cast("timestamp_ntz").alias("process_timestamp"),
        C.wafer_status(label).alias("wafer_status"),
        label.cast("long").alias("label_numeric"),
        C.missing_count(sensors).alias("missing_sensor_count"),
        *[F.col(c) for c in PLAIN],
        *[C.ident(c) for c in bronze.columns if c not in used],
        *[C.ident(s) for s in sensors],
        *[F.col(a).alias(b) for a, b in lineage])


def reporting(staged: DataFrame, max_missing: int = K.MAX_MISSING) -> DataFrame:
    return staged.filter(F.col("missing_sensor_count") < max_missing)


def quarantine(staged: DataFrame, max_missing: int = K.MAX_MISSING) -> DataFrame:
    return staged.filter(F.col("missing_sensor_count") >= max_missing).select(
        "observation_id", "line_id", "shift", "tester_id", "lot_id", "process_timestamp",
        "missing_sensor_count", F.lit(K.QUARANTINE_REASON).alias("quarantine_reason"))


def with_audit(df: DataFrame, stamp: str, version: str | None = None,
               version_column: str = "processing_logic") -> DataFrame:
    """Add the time of computation and, if given, the version of the logic."""
    df = df.withColumn(stamp, F.current_timestamp())
    return df if version is None else df.withColumn(version_column, F.lit(version))


def for_lines(df: DataFrame, lines: str | Iterable[str] | None) -> DataFrame:
    """Keep one line, several, or all (None)."""
    if lines is None:
        return df
    return df.filter(F.col("line_id").isin([lines] if isinstance(lines, str) else list(lines)))


def failing(df: DataFrame) -> DataFrame:
    return df.filter(F.col("wafer_status") == "Fail")


def select_sensors(df: DataFrame, sensors: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*[C.ident(c) for c in (*keep, *sensors)])
