"""Data augmentation: drift injection, jitter, replay, sampling, enrichment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabspark.functions import columns as C
from fabspark.session import settled


def sigma_shift(df: DataFrame, shifts: Mapping[str, float], reference: DataFrame | None = None) -> DataFrame:
    """Add ``k`` global standard deviations to each named sensor; NULL stays NULL.

    The spread is taken from ``reference`` (the baseline), by default ``df``.
    """
    named = [s for s in shifts if s in df.columns]
    if not named:
        return df
    # One row of scalars.
    sd = (reference if reference is not None else df).agg(*[C.spread(C.col(s)) for s in named]).first()
    return df.withColumns({s: C.col(s) + F.lit(d).cast("double") * F.lit(float(shifts[s]))
                           for s, d in zip(named, sd)})


def _uniform(*parts: str) -> str:
    """Even number in (0, 1), the same for the same parts on every run."""
    return f"((CAST(shiftrightunsigned(xxhash64({', '.join(parts)}), 11) AS DOUBLE) + 0.5D) / {float(2 ** 53)}D)"


def _normal(key: str, name: str, seed: int) -> str:
    parts = (C.ident(key), C.text(name), str(int(seed)))
    return f"(sqrt(-2.0D * ln({_uniform(*parts, C.text('u'))})) * cos(2.0D * pi() * {_uniform(*parts, C.text('v'))}))"


def jitter(df: DataFrame, sensors: Sequence[str], variance: float, key: str, ts: str = "Time",
           seed: int = 0) -> DataFrame:
    """Add noise of ``variance`` times the spread of the sensor on that day.

    The noise is a function of key, sensor and seed, so a rerun or a retried task
    gives the same rows. Gaps stay gaps; a day without spread gets no noise.
    """
    if variance <= 0:
        return df
    day = F.to_date(ts)
    cells = F.posexplode(C.array_of([f"CAST({C.ident(s)} AS DOUBLE)" for s in sensors])).alias("_i", "_v")
    spread = df.select(day.alias("_day"), cells).groupBy("_day", "_i").agg(
        F.coalesce(C.spread(F.col("_v")), F.lit(0.0)).alias("_sd"))
    # One row per day, with one number per sensor.
    spread = settled(spread.groupBy("_day").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_i", "_sd"))), lambda x: x["_sd"]).alias("_sds")), "days")
    out = df.withColumn("_day", day).join(spread, "_day", "left")
    at = {s: i for i, s in enumerate(sensors)}
    return out.selectExpr(*[
        f"{C.ident(c)} + {_normal(key, c, seed)} * get(_sds, {at[c]}) * {float(variance)!r}D AS {C.ident(c)}"
        if c in at else C.ident(c) for c in df.columns])


def day_index(df: DataFrame, ts: str = "Time") -> DataFrame:
    """Dates of the table, numbered from 0 (one row per calendar day)."""
    days = df.select(F.to_date(ts).alias("block_date")).distinct().filter("block_date IS NOT NULL")
    return days.withColumn("day_no", F.row_number().over(Window.orderBy("block_date")) - 1)


def replay(df: DataFrame, start: int, blocks: int, ts: str = "Time", years: int = 0) -> DataFrame:
    """Rows of ``blocks`` consecutive days from day ``start`` on, wrapping round the table.

    Adds ``block`` (0, 1, ...). Every time the pointer passes the last day the
    dates move on by a year; that already holds for the block that ends a pass.
    """
    days = settled(day_index(df, ts), "day_index")
    n = days.count()
    if n == 0 or blocks <= 0:
        return df.withColumn("block", F.lit(0).cast("long")).limit(0)
    pointer = F.lit(start % n) + F.col("id")
    order = df.sparkSession.range(blocks).select(
        F.col("id").alias("block"), (pointer % n).alias("day_no"),
        (F.floor((pointer + 1) / n) + years).cast("int").alias("_years"))
    plan = settled(order.join(days, "day_no").select("block", "_years", "block_date"), "replay")
    out = df.withColumn("block_date", F.to_date(ts)).join(plan, "block_date")
    moved = F.col(ts) + F.make_ym_interval(F.col("_years"), F.lit(0))
    return out.withColumn(ts, moved).drop("block_date", "_years")


def sample_n(df: DataFrame, n: int, key: str, ts: str = "Time", seed: int = 0) -> DataFrame:
    """Repeatable sample of at most ``n`` rows, in time order."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    return df.orderBy(h, key).limit(n).orderBy(ts, key)


@dataclass(frozen=True)
class LineSetup:
    """Settings of one production line."""

    line_id: str
    tester_id: str = ""
    lot_counter: int = 0
    drift: Mapping[str, float] = field(default_factory=dict)

    @property
    def lot_id(self) -> str:
        return f"{self.line_id}-LOT-{self.lot_counter:05d}"


def enrich_batch(df: DataFrame, line: LineSetup, generated_at: Column | None = None,
                 ts: str = "Time") -> DataFrame:
    """Stamp a batch with line, tester, lot, flags and drift; the shift is that of its first wafer."""
    first = df.agg(F.min(ts).cast("string")).first()[0]
    shift = C.shift_of(F.lit(first).cast(df.schema[ts].dataType))
    return df.withColumns({
        "line_id": F.lit(line.line_id), "tester_id": F.lit(line.tester_id), "shift": shift,
        "lot_id": F.lit(line.lot_id), "is_synthetic": F.lit(True),
        "generation_timestamp": generated_at if generated_at is not None else F.current_timestamp(),
        "applied_drift_features": F.lit(json.dumps(dict(line.drift)))})
