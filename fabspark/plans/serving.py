"""Datasets behind the dashboards, built from the gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fabspark.functions import columns as C
from fabspark.operators.staging import for_lines
from fabspark.operators.windows import latest_per_group, rolling_mean, top_k, trailing


def _sums(df: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(*[F.sum(n).alias(n) for n in names])


def _rates(df: DataFrame, tested: str = "total_wafers_tested", passed: str = "passed_wafers",
           failed: str = "failed_wafers") -> DataFrame:
    return df.withColumns({
        "yield_percentage": C.ratio(F.col(passed), F.col(tested), 100),
        "ppm_defective": C.ratio(F.col(failed), F.col(tested), 1_000_000)})


DAILY = ("total_wafers_tested", "quarantined_wafers", "passed_wafers", "failed_wafers")


# Factory overview

def headline(daily: DataFrame) -> DataFrame:
    """Totals of the newest day and the one before, newest first."""
    recent = trailing(daily, "process_date", "'1' DAY")
    return _rates(_sums(recent, ["process_date"], DAILY)).drop("quarantined_wafers").orderBy(
        F.desc("process_date"))


def kpi_delta(kpis: DataFrame) -> DataFrame:
    """Change of yield (points) and defect rate (percent, 0 from a zero) to the previous row."""
    w = Window.orderBy("process_date")
    y, d = F.col("yield_percentage"), F.col("ppm_defective")
    py, pd_ = F.lag(y).over(w), F.lag(d).over(w)
    return kpis.withColumns({
        "yield_delta": C.rounded(y - py, 2),
        "dppm_delta": C.rounded(F.when(pd_ != 0, (d - pd_) * 100 / pd_).when(pd_ == 0, 0.0), 2)})


def yield_trend(daily: DataFrame, days: int = 30) -> DataFrame:
    """Newest ``days`` production days over all lines."""
    t = _rates(_sums(daily, ["process_date"], ("total_wafers_tested", "passed_wafers", "failed_wafers")))
    return top_k(t.drop("passed_wafers", "failed_wafers"), [F.desc("process_date")], days)


def trend_chart(daily: DataFrame, days: int = 30) -> DataFrame:
    """The trend with its seven-row mean and colour band."""
    t = rolling_mean(yield_trend(daily, days), "yield_percentage", ["process_date"],
                     name="yield_rolling_7d")
    return t.withColumn("dppm_band", C.dppm_band(F.col("ppm_defective")))


def latest_day(daily: DataFrame, days: int = 30) -> DataFrame:
    """Latest production date and the mean of the daily yields shown in the trend."""
    return yield_trend(daily, days).agg(F.max("process_date").alias("latest_date"),
                                        F.avg("yield_percentage").alias("mean_yield"))


def active_alarms(violations: DataFrame, hours: int = 24, k: int = 10) -> DataFrame:
    """Most frequent (sensor, rule) of the last hours."""
    recent = trailing(violations, "process_timestamp", f"'{hours}' HOUR")
    a = recent.groupBy("sensor_id", "rule_name").agg(
        F.count(F.lit(1)).alias("alarm_count"), F.max("process_timestamp").alias("last_seen"))
    return top_k(a, [F.desc("alarm_count"), "sensor_id", "rule_name"], k)


def quarantine_rate(shift: DataFrame) -> DataFrame:
    """Share of quarantined wafers in the input of the newest day."""
    return trailing(shift, "process_date", "'0' DAY").agg(
        F.sum("quarantined_wafers").alias("total_quarantined"),
        F.sum(F.col("wafers_tested") + F.col("quarantined_wafers")).alias("total_input"),
    ).withColumn("quarantine_pct", C.ratio(F.col("total_quarantined"), F.col("total_input"), 100, 2))


def oee_latest(oee: DataFrame) -> DataFrame:
    return trailing(oee, "process_date", "'0' DAY").select(
        "line_id", "tester_id", "oee_pct", "availability_pct", "performance_pct", "quality_pct")


# Yield analytics

def daily_kpis(daily: DataFrame, days: int, lines=None) -> DataFrame:
    """Rates per day and line within ``days`` of each line's newest day."""
    recent = trailing(for_lines(daily, lines), "process_date", f"'{days}' DAY", ["line_id"])
    return _rates(_sums(recent, ["process_date", "line_id"], DAILY))


def shift_window(shift: DataFrame, days: int, lines=None) -> DataFrame:
    return trailing(for_lines(shift, lines), "process_date", f"'{days}' DAY", ["line_id"]).select(
        "process_date", "line_id", "tester_id", "shift", "shift_order", "wafers_tested", "passed_wafers",
        "failed_wafers", "quarantined_wafers", "yield_pct", "ppm_defective", "scrap_rate_pct")


def calendar(daily: DataFrame, days: int, lines=None) -> DataFrame:
    """Factory yield per day with its place in a week-by-weekday calendar."""
    recent = trailing(for_lines(daily, lines), "process_date", f"'{days}' DAY", ["line_id"])
    c = _rates(_sums(recent, ["process_date"], DAILY))
    return c.select("process_date", "yield_percentage", "total_wafers_tested",
                    C.iso_week(F.col("process_date")).alias("week"),
                    C.weekday(F.col("process_date")).alias("dow"))


def period_totals(daily: DataFrame, days: int, by: Sequence[str] = (), lines=None) -> DataFrame:
    """Yield and defect rate of the whole period: ratios of sums, not means of ratios.

    Without ``by`` the period ends at the newest day of the factory; per line it
    ends at the newest day of that line.
    """
    recent = trailing(for_lines(daily, lines), "process_date", f"'{days}' DAY", ["line_id"])
    if not by:
        recent = trailing(recent, "process_date", f"'{days}' DAY")
    return _rates(_sums(recent, by, DAILY))


def factory_days(daily: DataFrame, days: int) -> DataFrame:
    """Factory totals per day of the period with the seven-row mean yield."""
    recent = trailing(trailing(daily, "process_date", f"'{days}' DAY", ["line_id"]),
                      "process_date", f"'{days}' DAY")
    return rolling_mean(_rates(_sums(recent, ["process_date"], DAILY)), "yield_percentage",
                        ["process_date"], name="yield_rolling_7d")


def line_days(daily: DataFrame, days: int) -> DataFrame:
    return rolling_mean(daily_kpis(daily, days), "yield_percentage", ["process_date"], ["line_id"],
                        name="rolling_yield")


def yield_by(shift: DataFrame, keys: Sequence[str]) -> DataFrame:
    t = shift.groupBy(*keys).agg(F.sum("passed_wafers").alias("passed"), F.sum("wafers_tested").alias("tested"))
    return t.withColumn("yield_pct", C.ratio(F.col("passed"), F.col("tested"), 100))


def yield_by_all(shift: DataFrame) -> DataFrame:
    """Yield by line, by shift and by both, in one aggregation."""
    line, sh = F.col("line_id"), F.col("shift")
    t = shift.groupingSets([[line], [sh], [line, sh]], line, sh).agg(
        F.sum("passed_wafers").alias("passed"), F.sum("wafers_tested").alias("tested"),
        F.grouping_id().cast("int").alias("g"))
    level = F.when(F.col("g") == 0, "line x shift").when(F.col("g") == 1, "line").otherwise("shift")
    return t.select(level.alias("level"), "line_id", "shift", "passed", "tested",
                    C.ratio(F.col("passed"), F.col("tested"), 100).alias("yield_pct"))


# Failure analysis

def recent_shifts(shift: DataFrame, rows: int = 200) -> DataFrame:
    """Newest shift rows, ties at the cut settled by the full key."""
    return top_k(shift.select("line_id", "tester_id", "shift", "process_date", "wafers_tested",
                              "failed_wafers", "yield_pct", "ppm_defective"),
                 [F.desc("process_date"), "line_id", "tester_id", "shift"], rows)


def failure_by(shift: DataFrame, keys: Sequence[str]) -> DataFrame:
    t = shift.groupBy(*keys).agg(F.sum("failed_wafers").alias("failed"), F.sum("wafers_tested").alias("tested"))
    return t.withColumns({"ppm": C.clipped_ratio(F.col("failed"), F.col("tested"), 1e6),
                          "fail_rate": C.clipped_ratio(F.col("failed"), F.col("tested"), 100)})


def dppm_trend(shift: DataFrame) -> DataFrame:
    """Daily defect rate per line and its seven-row mean."""
    d = shift.groupBy("process_date", "line_id").agg(
        F.sum("failed_wafers").alias("daily_failed"), F.sum("wafers_tested").alias("daily_tested"))
    d = d.withColumn("ppm_defective", C.clipped_ratio(F.col("daily_failed"), F.col("daily_tested"), 1e6))
    return rolling_mean(d, "ppm_defective", ["process_date"], ["line_id"], name="ppm_smoothed")


# Control-chart pages

def violation_log(violations: DataFrame, hours: int, lines=None) -> DataFrame:
    """Violations within ``hours`` of the newest one of their line and sensor."""
    v = trailing(for_lines(violations, lines), "process_timestamp", f"'{hours}' HOUR",
                 ["line_id", "sensor_id"])
    return v.groupBy("sensor_id", "rule_name", "rule_number", "line_id", "shift").agg(
        F.count(F.lit(1)).alias("count"), F.max("z_score").alias("max_z"),
        F.max("process_timestamp").alias("last_seen"))


def rule_summary(log: DataFrame) -> DataFrame:
    return log.groupBy("rule_number", "rule_name").agg(
        F.sum("count").alias("occurrences"), F.countDistinct("sensor_id").alias("sensors"),
    ).withColumn("severity", C.severity(F.col("rule_number")))


def health_matrix(violations: DataFrame, days: int = 14, lines=None) -> DataFrame:
    """Violations per sensor and day, long form."""
    v = trailing(for_lines(violations, lines), "process_timestamp", f"'{days}' DAY",
                 ["line_id", "sensor_id"])
    return v.groupBy("sensor_id", F.to_date("process_timestamp").alias("process_date")).agg(
        F.count(F.lit(1)).alias("violation_count"))


def sensor_totals(matrix: DataFrame) -> DataFrame:
    t = matrix.groupBy("sensor_id").agg(F.sum("violation_count").alias("total"))
    return t.withColumn("band", C.violation_band(F.col("total")))


# Equipment page

def oee_window(oee: DataFrame, days: int, lines=None) -> DataFrame:
    return trailing(for_lines(oee, lines), "process_date", f"'{days}' DAY", ["line_id"]).select(
        "process_date", "line_id", "tester_id", "oee_pct", "availability_pct", "performance_pct",
        "quality_pct", "oee_classification", "total_wafers_tested", "total_passed", "total_failed",
        "total_lots")


def oee_snapshot(oee: DataFrame) -> DataFrame:
    """Newest row of each line."""
    return latest_per_group(oee, ["line_id"], [F.desc("process_date"), F.asc("tester_id")])
