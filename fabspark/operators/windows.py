"""Trailing windows, rolling means, latest rows, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabspark.operators.ordering import join_on


def trailing(df: DataFrame, ts: str, interval: str, by: Sequence[str] | None = None) -> DataFrame:
    """Rows within ``interval`` of the latest ``ts``, of each group or of the whole table.

    The whole-table anchor is one value and goes into the plan as a literal, so it
    prunes partitions and reaches the scan. Group anchors are one row per group,
    aggregated in the plan and joined as their size at run time allows; nothing is
    written. The filter also carries the earliest anchor as a literal for the scan.
    """
    span = F.expr(f"INTERVAL {interval}")
    if by is None:
        last = df.agg(F.max(ts).cast("string")).first()[0]
        return df.filter(F.lit(False)) if last is None else df.filter(F.col(ts) >= _lit(df, ts, last) - span)
    anchors = df.groupBy(*by).agg(F.max(ts).alias("_last"))
    first = anchors.agg(F.min("_last").cast("string")).first()[0]
    if first is None:
        return df.filter(F.lit(False))
    recent = df.filter(F.col(ts) >= _lit(df, ts, first) - span).dropna(subset=list(by))
    return (join_on(recent, anchors, list(by))
            .filter(F.col(ts) >= F.col("_last") - span).drop("_last"))


def _lit(df: DataFrame, ts: str, value: str) -> Column:
    """Literal from text, which does not depend on the time zone of the driver process."""
    return F.lit(value).cast(df.schema[ts].dataType)


def rolling_mean(df: DataFrame, value: str, order: Sequence[str | Column], by: Sequence[str] = (),
                 rows: int = 7, name: str = "rolling") -> DataFrame:
    """Mean over the last ``rows`` rows (not days), fewer at the start.

    Meant for daily aggregates: one row per day and group.
    """
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(-(rows - 1), 0)
    return df.withColumn(name, F.avg(value).over(w))


def top_k(df: DataFrame, order: Sequence[str | Column], k: int) -> DataFrame:
    """First ``k`` rows in a total order."""
    return df.orderBy(*order).limit(k)


def latest_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each group in ``order``; ranked per task before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn <= 1").drop("_rn")
