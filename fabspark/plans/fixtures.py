"""Driver tables seen as wafer data.

The `events` table becomes wafer observations with five sensors, three lines and
three shifts. Sensor 158 is constant where present, 511 and 424 have gaps, so
zero spread, missing readings and quarantine all occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SENSORS = ["s59", "s103", "s511", "s424", "s158"]
MAX_MISSING = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_of(user: str = "user_id"):
    m = F.col(user) % 3
    return F.when(m == 0, "LINE_A").when(m == 1, "LINE_B").otherwise("LINE_C")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide observations, one row per event, in the column names of bronze."""
    m = F.col("user_id") % 3
    k = F.regexp_extract("props", '"k": ([0-9]+)', 1).cast("double")
    value = F.col("value")
    hour = F.hour("ts")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("observation_id"),
        F.col("ts").alias("Time"),
        line_of().alias("line_id"),
        F.when(m == 0, "TST-01").when(m == 1, "TST-02").otherwise("TST-03").alias("tester_id"),
        F.when((hour >= 6) & (hour < 14), "Day").when((hour >= 14) & (hour < 22), "Swing")
        .otherwise("Night").alias("shift"),
        F.concat(F.lit("LOT-"), F.lpad(F.col("user_id").cast("string"), 5, "0")).alias("lot_id"),
        F.when(F.col("event_type") == "error", 1).when(F.col("event_type") == "signup", 0)
        .otherwise(-1).cast("long").alias("Pass/Fail"),
        value.alias("s59"),
        k.alias("s103"),
        F.when(F.col("event_id") % 11 != 0, value * k).alias("s511"),
        F.when(F.col("event_id") % 7 != 0, k - value / 10).alias("s424"),
        F.when(F.col("event_id") % 2 != 0, F.lit(5.0)).alias("s158"),
    )


def batched(df: DataFrame, ts: str = "Time") -> DataFrame:
    """Add the batch file each observation would have come in: one per line and hour."""
    return df.withColumn("source_file", F.concat(
        F.lit("line_id="), F.col("line_id"), F.lit("/batch_"), F.date_format(ts, "yyyyMMddHH"),
        F.lit(".parquet")))


def embedding_sensors(spark: SparkSession, sf_dir: str, dims: int | None = None) -> DataFrame:
    """Vectors as wide rows, one sensor column per element."""
    df = table(spark, sf_dir, "embeddings")
    if dims is None:
        dims = df.select(F.max(F.size("embedding"))).first()[0]
    return df.select("vec_id", "label",
                     *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i:03d}")
                       for i in range(dims)])
