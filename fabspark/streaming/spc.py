"""Run rules on a stream, equal to the table result for readings in order.

The rules look back thirteen readings. That history is kept as a small table per
micro-batch: the last readings of every series. A micro-batch is judged together
with it by the same block-wise operator as the table, so a series that holds
most of a batch is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fabspark.operators import spc
from fabspark.operators.ordering import join_on
from fabspark.session import drop_path, scratch, settled
from fabspark.sources.tables import batch_path, overwrite_batch, run_id
from fabspark.streaming.intake import exists, start

KEPT = spc.REACH


def judge(long: DataFrame, limits: DataFrame, root: str, batch_id: int,
          block_rows: int | None = None, run: str = "0") -> None:
    """One micro-batch: violations, late readings and the history for the next batch.

    Readings at or before the last accepted one of their series are late: they go
    to ``late`` and are not judged. All outputs of a batch are written under its
    id, so a replay gives the same files.
    """
    spark = long.sparkSession
    with scratch(spark):
        _judge(long, limits, root, batch_id, block_rows, run)
    if batch_id > 1:
        # A replay reads the history of the batch before it, nothing older.
        drop_path(spark, batch_path(f"{root}/history", run, batch_id - 2))


def _history(long: DataFrame, root: str, run: str, batch_id: int) -> DataFrame | None:
    """The last readings before a batch: of the batch before it, or of all earlier streams for a stream's first."""
    spark = long.sparkSession
    if batch_id > 0:
        return spark.read.schema(long.schema).parquet(batch_path(f"{root}/history", run, batch_id - 1))
    if not exists(spark, f"{root}/history"):
        return None
    old = spark.read.schema(T.StructType([*long.schema.fields, T.StructField("run", T.StringType())])) \
        .parquet(f"{root}/history").filter(F.col("run") != run).select(*long.columns).distinct()
    return _last_rows(old)


def _last_rows(rows: DataFrame) -> DataFrame:
    back = Window.partitionBy(*spc.SERIES).orderBy(*[F.desc(c) for c in spc.TIME])
    return rows.withColumn("_rn", F.row_number().over(back)).filter(F.col("_rn") <= KEPT).drop("_rn")


def _judge(long: DataFrame, limits: DataFrame, root: str, batch_id: int, block_rows: int | None, run: str) -> None:
    long = long.filter(F.col("val").isNotNull())
    fresh = long
    old = _history(long, root, run, batch_id)
    if old is not None:
        old = settled(old, "history")
        # One row per series.
        last = old.groupBy(*spc.SERIES).agg(F.max(F.struct(*spc.TIME)).alias("_last"))
        marked = settled(join_on(long, last, spc.SERIES, "left").withColumn(
            "_late", F.coalesce(F.struct(*spc.TIME) <= F.col("_last"), F.lit(False))).drop("_last"), "batch")
        overwrite_batch(marked.filter("_late").drop("_late"), f"{root}/late", run, batch_id)
        fresh = marked.filter(~F.col("_late")).drop("_late")
    rows = fresh.withColumn("_new", F.lit(True))
    if old is not None:
        rows = rows.unionByName(old.withColumn("_new", F.lit(False)))
    ends = spc.rule_ends(spc.spc_points(rows, limits), block_rows).filter(F.col("_own") & F.col("_new"))
    overwrite_batch(spc.violation_rows(ends), f"{root}/violations", run, batch_id)
    overwrite_batch(_last_rows(rows.drop("_new")), f"{root}/history", run, batch_id)


def stream_spc(stream_long: DataFrame, limits: DataFrame, root: str, checkpoint: str,
               every: str | None = None, block_rows: int | None = None) -> StreamingQuery:
    """Judge a stream of long readings against frozen limits."""
    def work(batch: DataFrame, batch_id: int) -> None:
        judge(batch, limits, root, batch_id, block_rows, run_id(batch.sparkSession, checkpoint))

    return start(stream_long, work, checkpoint, every)
