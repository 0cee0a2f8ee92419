"""Yield, shift and equipment-effectiveness tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabspark import constants as K
from fabspark.functions import columns as C


def _counts(reporting: DataFrame, quarantine: DataFrame, keys: Sequence[str],
            keep_quarantine_only: bool, extra_cols: Sequence[str] = (), extra_aggs=()) -> DataFrame:
    """Tested and quarantined wafers per group in one aggregation.

    Both inputs are stacked and grouped once, which takes one shuffle of partial
    counts where a join of two aggregates would take two. Groups without tested
    wafers go, as a left join from the tested side would have it; quarantined rows
    with a NULL key match nothing there either.
    """
    day = F.to_date("process_timestamp").alias("process_date")
    plain = [k for k in keys if k != "process_date"]
    status = F.col("wafer_status")
    tested = reporting.select(
        day, *plain, F.col("observation_id").isNotNull().cast("long").alias("t"),
        F.lit(1).cast("long").alias("r"), F.lit(0).cast("long").alias("q"),
        F.when(status == "Pass", 1).otherwise(0).cast("long").alias("p"),
        F.when(status == "Fail", 1).otherwise(0).cast("long").alias("f"), *extra_cols)
    zero = F.lit(0).cast("long")
    held = quarantine.select(day, *plain, zero.alias("t"), zero.alias("r"),
                             F.lit(1).cast("long").alias("q"), zero.alias("p"), zero.alias("f"))
    if not keep_quarantine_only:
        held = held.dropna(subset=list(keys))
    out = tested.unionByName(held, allowMissingColumns=True).groupBy(*keys).agg(
        F.sum("t").alias("tested"), F.sum("r").alias("_rows"), F.sum("q").alias("quar"),
        F.sum("p").alias("passed"), F.sum("f").alias("failed"), *extra_aggs)
    if not keep_quarantine_only:
        out = out.filter(F.col("_rows") > 0)
    return out.drop("_rows")


def daily_yield(reporting: DataFrame, quarantine: DataFrame,
                keep_quarantine_only: bool = False) -> DataFrame:
    """Yield and defect rate per day and line."""
    c = _counts(reporting, quarantine, ["process_date", "line_id"], keep_quarantine_only)
    return c.select(
        "process_date", "line_id", F.col("tested").alias("total_wafers_tested"),
        F.col("quar").alias("quarantined_wafers"), F.col("passed").alias("passed_wafers"),
        F.col("failed").alias("failed_wafers"),
        C.ratio(F.col("passed"), F.col("tested"), 100, 2).alias("yield_percentage"),
        C.ratio(F.col("failed"), F.col("tested"), 1_000_000, 0).alias("ppm_defective"))


def shift_metrics(reporting: DataFrame, quarantine: DataFrame,
                  keep_quarantine_only: bool = False) -> DataFrame:
    """Yield, defects, scrap, lots and missing readings per day, line, tester and shift."""
    keys = ["process_date", "line_id", "tester_id", "shift"]
    c = _counts(reporting, quarantine, keys, keep_quarantine_only,
                [F.col("lot_id"), F.col("missing_sensor_count")],
                [F.countDistinct("lot_id").alias("lots"),
                 F.avg("missing_sensor_count").alias("missing")])
    tested, quar = F.col("tested"), F.col("quar")
    return c.select(
        *keys, tested.alias("wafers_tested"), F.col("passed").alias("passed_wafers"),
        F.col("failed").alias("failed_wafers"), quar.alias("quarantined_wafers"),
        F.col("lots").alias("lots_processed"),
        C.ratio(F.col("passed"), tested, 100, 2).alias("yield_pct"),
        C.ratio(F.col("failed"), tested, 1_000_000, 0).alias("ppm_defective"),
        C.scrap_rate(quar, tested).alias("scrap_rate_pct"),
        C.rounded(F.col("missing"), 2).alias("avg_missing_sensors"),
        C.shift_order(F.col("shift")).alias("shift_order"))


def oee(shift: DataFrame, shifts_per_day: float = K.SHIFTS_PER_DAY,
        wafers_per_day: float = K.WAFERS_PER_DAY) -> DataFrame:
    """Availability, performance, quality and their product per day, line and tester.

    The product is taken of the rounded percentages.
    """
    keys = ["process_date", "line_id", "tester_id"]
    d = shift.groupBy(*keys).agg(
        F.countDistinct("shift").alias("shifts_with_data"),
        F.sum("wafers_tested").alias("total_wafers_tested"),
        F.sum("passed_wafers").alias("total_passed"),
        F.sum("failed_wafers").alias("total_failed"),
        F.sum("quarantined_wafers").alias("total_quarantined"),
        F.sum("lots_processed").alias("total_lots"))

    def share(c: str, of: float):
        full = F.try_divide(F.col(c).cast("double"), F.lit(float(of)))
        return C.rounded(C.least_or_null(full, F.lit(1.0)) * 100, 2)

    d = d.withColumns({
        "availability_pct": share("shifts_with_data", shifts_per_day),
        "performance_pct": share("total_wafers_tested", wafers_per_day),
        "quality_pct": C.ratio(F.col("total_passed"), F.col("total_wafers_tested"), 100, 2)})
    product = (F.col("availability_pct") / 100.0 * (F.col("performance_pct") / 100.0)
               * (F.col("quality_pct") / 100.0) * 100.0)
    return d.withColumns({"oee_pct": C.rounded(product, 2), "oee_classification": C.oee_class(product)})
