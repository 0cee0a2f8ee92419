"""Exact percentiles and ranks without holding a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabspark.operators.ordering import positions


def value_counts(long: DataFrame, by: Sequence[str], value: str = "val") -> DataFrame:
    """Rows per distinct value; counted in every task before the shuffle."""
    return (long.filter(F.col(value).isNotNull() & ~F.isnan(value)).groupBy(*by, value)
            .agg(F.count(F.lit(1)).alias("_n")))


def percentiles(long: DataFrame, by: Sequence[str], shares: dict[str, float],
                value: str = "val") -> DataFrame:
    """Linear-interpolated percentiles per group, exact at any group size.

    Distinct values are placed by running count; the one or two values around
    each wanted rank are then picked by a plain aggregate. Adds ``n``.
    """
    placed = positions(value_counts(long, by, value), by, [value], totals={"_upto": "_n"})
    n, upto, v = F.col("series__upto"), F.col("_upto"), F.col(value)
    start = upto - F.col("_n")
    picks, outs = [], []
    for name, q in shares.items():
        at = F.lit(q) * (n - 1)
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            picks.append(F.max(F.when((start <= rank) & (rank < upto), v)).alias(f"_{name}_{side}"))
        frac = F.lit(q) * (F.col("n") - 1) - F.floor(F.lit(q) * (F.col("n") - 1))
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        outs.append((lo + (hi - lo) * frac).alias(name))
    return placed.groupBy(*by).agg(F.max(n).alias("n"), *picks).select(*by, "n", *outs)


def average_ranks(counts: DataFrame, by: Sequence[str], value: str = "val") -> DataFrame:
    """Mean rank of each distinct value (ties share it), and the group size.

    ``counts`` has one row per distinct value with its number of rows ``_n``.
    """
    placed = positions(counts, by, [value], totals={"_upto": "_n"})
    rank = F.col("_upto") - F.col("_n") + (F.col("_n") + 1) / 2
    return placed.select(*by, value, "_n", rank.alias("avg_rank"), F.col("series__upto").alias("n"))
