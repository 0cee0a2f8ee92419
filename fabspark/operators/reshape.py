"""Wide to long, pivots, decompositions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabspark import constants as K
from fabspark.functions import columns as C


def to_long(df: DataFrame, sensors: Sequence[str], keys: Sequence[str],
            prefix: str = "") -> DataFrame:
    """One row per (row, sensor); one scan, only the named sensors are read.

    ``prefix`` is cut off the column names to give ``sensor_id``. The readings go
    into one array that is then inlined: with 590 sensors that runs many times
    faster than ``unpivot``, which plans one projection per sensor.
    """
    cells = C.array_of([
        f"named_struct('sensor_id', {C.text(s.removeprefix(prefix))}, 'val', CAST({C.ident(s)} AS DOUBLE))"
        for s in sensors])
    return df.select(*[C.col(k) for k in keys], F.inline(cells))


def yield_pivot(shift: DataFrame, shifts: Sequence[str] = ("Day", "Swing", "Night")) -> DataFrame:
    """Yield per line, one column per shift."""
    tested = [F.sum(F.when(F.col("shift") == s, F.col("wafers_tested"))) for s in shifts]
    passed = [F.sum(F.when(F.col("shift") == s, F.col("passed_wafers"))) for s in shifts]
    return shift.groupBy("line_id").agg(
        *[C.ratio(p, t, 100).alias(s) for s, p, t in zip(shifts, passed, tested)])


def health_pivot(counts: DataFrame, dates: Sequence) -> DataFrame:
    """Violations per sensor with one column per given date, worst sensor first."""
    by_day = [F.coalesce(F.sum(F.when(F.col("process_date") == F.lit(d), F.col("violation_count"))),
                         F.lit(0)).alias(str(d)) for d in dates]
    total = F.sum(F.when(F.col("process_date").isin(list(dates)), F.col("violation_count")))
    out = counts.groupBy("sensor_id").agg(F.coalesce(total, F.lit(0)).alias("total"), *by_day)
    return out.orderBy(F.desc("total"), "sensor_id")


def apq_long(oee: DataFrame) -> DataFrame:
    """Availability, performance and quality as rows."""
    return oee.select(
        "line_id",
        F.col("availability_pct").alias("Availability"),
        F.col("performance_pct").alias("Performance"),
        F.col("quality_pct").alias("Quality"),
    ).unpivot(["line_id"], ["Availability", "Performance", "Quality"], "component", "value")


def waterfall(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """From input wafers over losses to final yield, for all lines or per group."""
    t = daily.groupBy(*by).agg(
        F.sum("total_wafers_tested").alias("tested"), F.sum("quarantined_wafers").alias("quar"),
        F.sum("passed_wafers").alias("passed"), F.sum("failed_wafers").alias("failed"))
    amounts = [F.col("tested") + F.col("quar"), -F.col("quar"), -F.col("failed"), F.col("passed")]
    steps = F.array(*[
        F.struct(F.lit(i + 1).alias("step_no"), F.lit(n).alias("step"), F.lit(m).alias("measure"),
                 a.cast("long").alias("wafers"))
        for i, ((n, m), a) in enumerate(zip(K.WATERFALL_STEPS, amounts))])
    return t.select(*by, F.inline(steps))
