"""Event log, event messages, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabspark.functions import schemas
from fabspark.operators.windows import trailing


def log_event(rows: DataFrame, path: str) -> None:
    """Append rows of the event log."""
    rows.to(schemas.EVENT_LOG).write.mode("append").parquet(path)


def events_window(events: DataFrame, hours: int, line: str | None = None,
                  now: Column | None = None) -> DataFrame:
    """Events of the last hours before ``now`` (by default the newest event), newest first."""
    if now is None:
        e = trailing(events, "ts", f"'{hours}' HOUR")
    else:
        e = events.filter(F.col("ts") >= now - F.expr(f"INTERVAL '{int(hours)}' HOUR"))
    if line is not None:
        e = e.filter(F.col("line_id") == line)
    return e.orderBy(F.desc("ts"), F.desc("id"))


def event_summary(events: DataFrame, batch: str = "BATCH", fault: str = "FAULT") -> DataFrame:
    is_batch = F.col("event_type") == batch
    return events.agg(F.count_if(is_batch).alias("batches"),
                      F.count_if(F.col("event_type") == fault).alias("faults"),
                      F.countDistinct(F.when(is_batch, F.col("line_id"))).alias("active_lines"))


def batches_per_line(events: DataFrame, batch: str = "BATCH") -> DataFrame:
    return events.filter(F.col("event_type") == batch).groupBy("line_id").agg(
        F.count(F.lit(1)).alias("batches"))


def decode_events(messages: DataFrame, text: str = "value") -> DataFrame:
    """Decoded JSON messages with their text as ``message``; what cannot be read is NULL.

    The scheme is stripped off the file path, so one file has one name.
    """
    raw = F.col(text).cast("string")
    e = messages.select(raw.alias("message"), F.from_json(raw, schemas.EVENT_MESSAGE).alias("e")).select("message", "e.*")
    return e.withColumn("file_path", F.nullif(F.trim(F.regexp_replace("file_path", "^s3a?://", "")), F.lit("")))


def parse_events(messages: DataFrame, text: str = "value") -> DataFrame:
    """Messages that name a file."""
    return decode_events(messages, text).filter(F.col("file_path").isNotNull()).drop("message")


def rejected_events(messages: DataFrame, text: str = "value") -> DataFrame:
    """The text of messages that are no JSON or name no file."""
    return decode_events(messages, text).filter(F.col("file_path").isNull()).select("message")


def latest_batch(df: DataFrame, line: str | None = None, offset: int = 0,
                 file: str = "source_file") -> DataFrame:
    """Rows of the newest batch file of one line, or of every line; ``offset`` looks back.

    Only (line, file) names are ranked; rows are then picked by a semi-join with
    the one file per line.
    """
    if line is not None:
        df = df.filter(F.col("line_id") == line)
    w = Window.partitionBy("line_id").orderBy(F.desc(file))
    files = df.select("line_id", file).distinct().withColumn("_rn", F.row_number().over(w)).filter(
        F.col("_rn") == offset + 1).drop("_rn")
    return df.join(files, ["line_id", file], "left_semi")


def batch_details(batch: DataFrame) -> DataFrame:
    """Per line: rows, generation time and active drift (equal within a batch)."""
    return batch.groupBy("line_id").agg(
        F.count(F.lit(1)).alias("wafers"), F.max("generation_timestamp").alias("generated_at"),
        F.max("applied_drift_features").alias("active_drift"))
