"""Bounded samples and heads of tables, without a sort of the whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_RANGE = 1 << 40


def by_hash(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """At most ``n`` rows: those whose key has the smallest hash.

    A count sets how much of the hash's range is looked at, so little more than
    ``n`` rows reach the task that cuts them, however many the table has.
    """
    place = F.pmod(F.xxhash64(F.lit(seed), F.col(f"`{key}`")), F.lit(_RANGE))
    share = min(1.0, (1.1 * n + 1000) / max(df.count(), 1))
    return df.where(place < int(share * _RANGE)).orderBy(place, F.col(f"`{key}`")).limit(n)


def head(df: DataFrame, count: str, n: int) -> DataFrame:
    """Rows of the largest counts (longs of 1 or more), at most ``n``; rows of nearly equal counts are all in or all out.

    Counts are put on a logarithmic scale of at most some thousand steps, whose sizes are read.
    """
    step = F.floor(F.log2(F.col(count).cast("double")) * 32)
    sizes = {r[0]: r[1] for r in df.groupBy(step.alias("s")).agg(F.count("*")).collect()}
    total, least = 0, None
    for s in sorted(sizes, reverse=True):
        total += sizes[s]
        if total > n:
            break
        least = s
    return df.where(F.lit(False)) if least is None else df.where(step >= least)
