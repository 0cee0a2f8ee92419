"""Order-dependent work on series of any length.

A window over ``partitionBy(series).orderBy(time)`` puts a whole series into one
task. The operators here cut every series into consecutive pieces first, so a
series holding a third of all rows is spread like the rest, and stay exact:

* ``positions``   row number, running totals and next value in a series;
* ``with_context``  equal-sized blocks plus the few neighbouring rows that a
  short frame needs at the block edges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabspark.session import settled

BLOCK_ROWS = 250_000


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match too; keeps the key columns of ``left``."""
    r = right.select([F.col(k).alias(f"_r_{k}") for k in keys]
                     + [F.col(f"`{c}`") for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
              totals: Mapping[str, str] | None = None, following: str | None = None) -> DataFrame:
    """Add ``seq`` (1-based place of the row in its series) and ``series_rows``.

    ``order`` must be total within a series (end it with a key column).
    ``totals`` maps new column -> summed column and adds, per row, the running
    sum up to and including the row, plus ``series_<new column>``.
    ``following`` names a column whose value in the next row of the series is
    added as ``next_<column>``.

    Rows are range-partitioned on (series, order). The result of that cut is
    written once, because the cut points come from a sample and must be the same
    wherever the rows are read; each row keeps its place in its own piece. What
    remains is one small row per (series, piece) whose running counts turn local
    places into global ones.
    """
    totals = dict(totals or {})
    keys = list(keys)
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    cut = settled(
        df.repartitionByRange(*[F.col(k) for k in keys], *order)
        .sortWithinPartitions(*[F.col(k) for k in keys], *order)
        .withColumn("_at", F.monotonically_increasing_id()), "cut")
    cut = cut.withColumn("_part", F.shiftright("_at", 33))

    aggs = [F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")]
    aggs += [F.sum(c).alias(f"_sum_{n}") for n, c in totals.items()]
    if following:
        aggs.append(F.min_by(following, "_at").alias("_head"))
    pieces = cut.groupBy(*keys, "_part").agg(*aggs)
    line = Window.partitionBy(*keys).orderBy("_part")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    cols = [F.col(k) for k in keys] + [
        F.col("_part"), F.col("_first"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_prior"),
        F.sum("_rows").over(whole).alias("series_rows")]
    for n in totals:
        cols += [F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_prior_{n}"),
                 F.sum(f"_sum_{n}").over(whole).alias(f"series_{n}")]
    if following:
        cols.append(F.lead("_head").over(line).alias("_next_head"))
    pieces = settled(pieces.select(*cols), "pieces")

    out = join_on(cut, pieces, [*keys, "_part"])
    out = out.withColumn("seq", F.col("_prior") + F.col("_at") - F.col("_first") + 1)
    local = Window.partitionBy(*keys, "_part").orderBy("_at")
    upto = local.rowsBetween(Window.unboundedPreceding, 0)
    for n, c in totals.items():
        out = out.withColumn(n, F.col(f"_prior_{n}") + F.sum(c).over(upto))
    if following:
        out = out.withColumn(f"next_{following}",
                             F.coalesce(F.lead(following).over(local), F.col("_next_head")))
    return out.drop("_at", "_part", "_first", "_prior", "_next_head",
                    *[f"_prior_{n}" for n in totals])


def with_context(df: DataFrame, before: int, after: int = 0,
                 block_rows: int | None = None) -> DataFrame:
    """Cut series into blocks of ``block_rows`` rows by ``seq``, with borders.

    Adds ``_blk`` and ``_own``. A row belongs to one block (``_own``); the last
    ``before`` rows of a block are copied into the next one and the first
    ``after`` rows into the one ahead, where ``_own`` is false. Frames that reach
    no further than that give the same value as over the whole series for every
    row with ``_own``.
    """
    size = block_rows or BLOCK_ROWS
    if size < max(before, after):
        raise ValueError("a block must be at least as long as its borders")
    blk = F.expr(f"(seq - 1) DIV {int(size)}")
    at = (F.col("seq") - 1) % size
    targets = [blk]
    if before:
        targets.append(F.when(at >= size - before, blk + 1))
    if after:
        targets.append(F.when((at < after) & (blk > 0), blk - 1))
    return (df.withColumn("_home", blk)
            .withColumn("_blk", F.explode(F.array(*targets))).filter(F.col("_blk").isNotNull())
            .withColumn("_own", F.col("_blk") == F.col("_home"))
            .drop("_home"))
