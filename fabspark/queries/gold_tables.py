"""Yield, shift and OEE tables and the datasets served from them (groups D, E, F, I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fabspark.functions import columns as C
from fabspark.operators import windows, yields
from fabspark.operators.staging import failing
from fabspark.plans import fixtures as X
from fabspark.plans import serving as S
from fabspark.queries.common import cols, r, rounded
from fabspark.queries.registry import gold, query, quarantine, silver, with_

RATES = """sum(passed_wafers)::DOUBLE / sum(total_wafers_tested) * 100 AS yield_percentage,
  sum(failed_wafers)::DOUBLE / sum(total_wafers_tested) * 1000000 AS ppm_defective"""


def sums(*names):
    return ", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}" for n in names)


ALL4 = sums("total_wafers_tested", "quarantined_wafers", "passed_wafers", "failed_wafers")
NEAR = "process_date >= max(process_date) OVER (PARTITION BY line_id) - INTERVAL {n} DAY"


@query("d1_join_quarantine_daily", with_("daily", body="""SELECT process_date, line_id, total_wafers_tested,
  quarantined_wafers FROM daily"""))
def d1(spark, sf):
    return yields.daily_yield(silver(spark, sf), quarantine(spark, sf)).select(
        "process_date", "line_id", "total_wafers_tested", "quarantined_wafers")


@query("d2_join_quarantine_shift", with_("shifts", body="""SELECT process_date, line_id, tester_id, shift,
  quarantined_wafers FROM shifts"""))
def d2(spark, sf):
    return yields.shift_metrics(silver(spark, sf), quarantine(spark, sf)).select(
        "process_date", "line_id", "tester_id", "shift", "quarantined_wafers")


@query("d6_trailing_by_line", with_("silver", body="""SELECT line_id, count(*) AS wafers, min(process_timestamp) AS first_ts,
  max(process_timestamp) AS last_ts FROM (SELECT * FROM silver QUALIFY process_timestamp >=
  max(process_timestamp) OVER (PARTITION BY line_id) - INTERVAL 7 DAY) GROUP BY line_id"""))
def d6(spark, sf):
    t = windows.trailing(silver(spark, sf), "process_timestamp", "'7' DAY", ["line_id"])
    return t.groupBy("line_id").agg(F.count(F.lit(1)).alias("wafers"), F.min("process_timestamp").alias("first_ts"),
                                    F.max("process_timestamp").alias("last_ts"))


@query("d7_trailing_global", with_("silver", body="""SELECT observation_id, process_timestamp FROM silver
  WHERE process_timestamp >= (SELECT max(process_timestamp) FROM silver) - INTERVAL 24 HOUR"""))
def d7(spark, sf):
    return windows.trailing(silver(spark, sf), "process_timestamp", "'24' HOUR").select(
        "observation_id", "process_timestamp")


@query("e1_daily_yield", with_("daily", body="SELECT * FROM daily"))
def e1(spark, sf):
    return yields.daily_yield(silver(spark, sf), quarantine(spark, sf))


@query("e1_daily_yield_keep_all", with_("silver", "quar", body="""
  SELECT process_date, line_id, CAST(sum(t) AS BIGINT) AS total_wafers_tested, CAST(sum(1 - t) AS BIGINT) AS quarantined_wafers
  FROM (SELECT process_timestamp::DATE AS process_date, line_id, 1 AS t FROM silver
        UNION ALL SELECT process_timestamp::DATE, line_id, 0 FROM quar) GROUP BY ALL"""))
def e1_keep(spark, sf):
    return yields.daily_yield(silver(spark, sf), quarantine(spark, sf), keep_quarantine_only=True).select(
        "process_date", "line_id", "total_wafers_tested", "quarantined_wafers")


@query("e2_quarantine_counts", with_("quar", body="""SELECT process_timestamp::DATE AS process_date, line_id, tester_id, shift,
  count(*) AS quarantined_wafers FROM quar GROUP BY ALL"""))
def e2(spark, sf):
    return quarantine(spark, sf).groupBy(
        F.to_date("process_timestamp").alias("process_date"), "line_id", "tester_id", "shift").agg(
        F.count(F.lit(1)).alias("quarantined_wafers"))


@query("e3_null_safe_ratio", with_("silver", body="""SELECT lot_id,
  round(count(*) FILTER (WHERE label_numeric = 1)::DOUBLE / nullif(count(*) FILTER (WHERE label_numeric = -1), 0) * 100, 2) AS fail_per_pass
  FROM silver GROUP BY lot_id"""))
def e3(spark, sf):
    return silver(spark, sf).groupBy("lot_id").agg(
        F.count_if(F.col("label_numeric") == 1).alias("f"), F.count_if(F.col("label_numeric") == -1).alias("p")).select(
        "lot_id", C.ratio(F.col("f"), F.col("p"), 100, 2).alias("fail_per_pass"))


@query("e4_scrap_rate", with_("shifts", body="""SELECT line_id, shift, round(sum(quarantined_wafers)::DOUBLE
  / sum(wafers_tested + quarantined_wafers) * 100, 2) AS scrap_rate_pct FROM shifts GROUP BY ALL"""))
def e4(spark, sf):
    s = gold(spark, sf, "shifts").groupBy("line_id", "shift").agg(
        F.sum("quarantined_wafers").alias("q"), F.sum("wafers_tested").alias("t"))
    return s.select("line_id", "shift", C.scrap_rate(F.col("q"), F.col("t")).alias("scrap_rate_pct"))


@query("e5_shift_metrics", with_("shifts", body="SELECT * FROM shifts"))
def e5(spark, sf):
    return yields.shift_metrics(silver(spark, sf), quarantine(spark, sf))


@query("e6_line_day_rollup", with_("oee", body="""SELECT process_date, line_id, tester_id, shifts_with_data,
  total_wafers_tested, total_passed, total_failed, total_quarantined, total_lots FROM oee"""))
def e6(spark, sf):
    return yields.oee(yields.shift_metrics(silver(spark, sf), quarantine(spark, sf))).select(
        "process_date", "line_id", "tester_id", "shifts_with_data", "total_wafers_tested", "total_passed",
        "total_failed", "total_quarantined", "total_lots")


@query("e7_oee", with_("oee", body="SELECT * EXCLUDE (p) FROM oee"))
def e7(spark, sf):
    return yields.oee(yields.shift_metrics(silver(spark, sf), quarantine(spark, sf)))


@query("e7_oee_own_targets", with_("oee", body="""SELECT process_date, line_id, tester_id,
  round(least(shifts_with_data / 3.0::DOUBLE, 1.0::DOUBLE) * 100, 2) AS availability_pct,
  round(least(total_wafers_tested / 200.0::DOUBLE, 1.0::DOUBLE) * 100, 2) AS performance_pct FROM oee"""))
def e7_targets(spark, sf):
    return yields.oee(gold(spark, sf, "shifts"), 3, 200).select(
        "process_date", "line_id", "tester_id", "availability_pct", "performance_pct")


HEAD = f"""SELECT process_date, {sums("total_wafers_tested", "passed_wafers", "failed_wafers")}, {RATES} FROM daily
  WHERE process_date >= (SELECT max(process_date) FROM daily) - INTERVAL 1 DAY GROUP BY process_date"""


@query("e8_headline", with_("daily", body=HEAD))
def e8(spark, sf):
    return S.headline(gold(spark, sf, "daily"))


TREND = f"""SELECT process_date, {RATES}, {sums("total_wafers_tested")} FROM daily GROUP BY process_date
  ORDER BY process_date DESC LIMIT 30"""


@query("e9_yield_trend", with_("daily", body=TREND))
def e9(spark, sf):
    return S.yield_trend(gold(spark, sf, "daily"))


@query("e10_active_alarms", with_("viol", body="""SELECT sensor_id, rule_name, count(*) AS alarm_count,
  max(process_timestamp) AS last_seen FROM viol
  WHERE process_timestamp >= (SELECT max(process_timestamp) FROM viol) - INTERVAL 24 HOUR
  GROUP BY ALL ORDER BY alarm_count DESC, sensor_id, rule_name LIMIT 10"""))
def e10(spark, sf):
    return S.active_alarms(gold(spark, sf, "violations"))


@query("e11_quarantine_rate", with_("shifts", body="""SELECT *, round(total_quarantined::DOUBLE / total_input * 100, 2) AS quarantine_pct
  FROM (SELECT CAST(sum(quarantined_wafers) AS BIGINT) AS total_quarantined,
          CAST(sum(wafers_tested + quarantined_wafers) AS BIGINT) AS total_input
        FROM shifts WHERE process_date = (SELECT max(process_date) FROM shifts))"""))
def e11(spark, sf):
    return S.quarantine_rate(gold(spark, sf, "shifts"))


@query("e12_oee_latest", with_("oee", body="""SELECT line_id, tester_id, oee_pct, availability_pct, performance_pct, quality_pct
  FROM oee WHERE process_date = (SELECT max(process_date) FROM oee)"""))
def e12(spark, sf):
    return S.oee_latest(gold(spark, sf, "oee"))


@query("e13_daily_kpis", with_("daily", body=f"""SELECT process_date, line_id, {ALL4}, {RATES}
  FROM (SELECT * FROM daily QUALIFY {NEAR.format(n=14)}) GROUP BY ALL"""))
def e13(spark, sf):
    return S.daily_kpis(gold(spark, sf, "daily"), 14)


SHIFT_COLS = """process_date, line_id, tester_id, shift, shift_order, wafers_tested, passed_wafers, failed_wafers,
  quarantined_wafers, yield_pct, ppm_defective, scrap_rate_pct"""


@query("e14_shift_window", with_("shifts", body=f"""SELECT {SHIFT_COLS} FROM shifts
  WHERE line_id IN ('LINE_A', 'LINE_C') QUALIFY {NEAR.format(n=7)}"""))
def e14(spark, sf):
    return S.shift_window(gold(spark, sf, "shifts"), 7, ["LINE_A", "LINE_C"])


@query("e15_calendar", with_("daily", body=f"""SELECT process_date,
  sum(passed_wafers)::DOUBLE / sum(total_wafers_tested) * 100 AS yield_percentage, {sums("total_wafers_tested")},
  CAST(week(process_date) AS INTEGER) AS week, CAST(isodow(process_date) - 1 AS INTEGER) AS dow
  FROM (SELECT * FROM daily QUALIFY {NEAR.format(n=30)}) GROUP BY process_date"""))
def e15(spark, sf):
    return S.calendar(gold(spark, sf, "daily"), 30)


@query("e16_period_totals", with_("daily", body=f"""SELECT {ALL4}, {RATES} FROM (SELECT * FROM daily QUALIFY {NEAR.format(n=14)})
  WHERE process_date >= (SELECT max(process_date) FROM daily) - INTERVAL 14 DAY"""))
def e16(spark, sf):
    return S.period_totals(gold(spark, sf, "daily"), 14)


@query("e16_period_totals_by_line", with_("daily", body=f"""SELECT line_id, {ALL4}, {RATES}
  FROM (SELECT * FROM daily QUALIFY {NEAR.format(n=14)}) GROUP BY line_id"""))
def e16_line(spark, sf):
    return S.period_totals(gold(spark, sf, "daily"), 14, ["line_id"])


@query("e17_yield_by", with_("shifts", body="""SELECT CASE grouping_id(line_id, shift) WHEN 0 THEN 'line x shift' WHEN 1 THEN 'line'
  ELSE 'shift' END AS level, line_id, shift, CAST(sum(passed_wafers) AS BIGINT) AS passed, CAST(sum(wafers_tested) AS BIGINT) AS tested,
  sum(passed_wafers)::DOUBLE / sum(wafers_tested) * 100 AS yield_pct
  FROM shifts GROUP BY GROUPING SETS ((line_id), (shift), (line_id, shift))"""))
def e17(spark, sf):
    return S.yield_by_all(gold(spark, sf, "shifts"))


@query("e18_failure_by", with_("shifts", body="""SELECT line_id, shift, CAST(sum(failed_wafers) AS BIGINT) AS failed,
  CAST(sum(wafers_tested) AS BIGINT) AS tested, sum(failed_wafers)::DOUBLE / greatest(sum(wafers_tested), 1) * 1000000 AS ppm,
  sum(failed_wafers)::DOUBLE / greatest(sum(wafers_tested), 1) * 100 AS fail_rate
  FROM shifts GROUP BY ALL"""))
def e18(spark, sf):
    return S.failure_by(gold(spark, sf, "shifts"), ["line_id", "shift"])


LOG = """SELECT sensor_id, rule_name, rule_number, line_id, shift, count(*) AS count, max(z_score) AS max_z,
  max(process_timestamp) AS last_seen FROM (SELECT * FROM viol QUALIFY process_timestamp >=
    max(process_timestamp) OVER (PARTITION BY line_id, sensor_id) - INTERVAL 72 HOUR) GROUP BY ALL"""


@query("e19_violation_log", with_("viol", body=LOG))
def e19(spark, sf):
    return S.violation_log(gold(spark, sf, "violations"), 72)


@query("e20_rule_summary", with_("viol", body=f"""SELECT rule_number, rule_name, CAST(sum(count) AS BIGINT) AS occurrences,
  count(DISTINCT sensor_id) AS sensors, ['alarm', 'warn', 'warn', 'ok', 'ok'][rule_number] AS severity
  FROM ({LOG}) GROUP BY ALL"""))
def e20(spark, sf):
    return S.rule_summary(S.violation_log(gold(spark, sf, "violations"), 72))


MATRIX = """SELECT sensor_id, process_timestamp::DATE AS process_date, count(*) AS violation_count
  FROM (SELECT * FROM viol QUALIFY process_timestamp >=
    max(process_timestamp) OVER (PARTITION BY line_id, sensor_id) - INTERVAL 14 DAY) GROUP BY ALL"""


@query("e21_health_matrix", with_("viol", body=MATRIX))
def e21(spark, sf):
    return S.health_matrix(gold(spark, sf, "violations"))


@query("e21_sensor_totals", with_("viol", body=f"""SELECT sensor_id, CAST(sum(violation_count) AS BIGINT) AS total,
  CASE WHEN sum(violation_count) > 10 THEN 'red' WHEN sum(violation_count) > 3 THEN 'amber' ELSE 'teal' END AS band
  FROM ({MATRIX}) GROUP BY sensor_id"""))
def e21_totals(spark, sf):
    return S.sensor_totals(S.health_matrix(gold(spark, sf, "violations")))


@query("e22_oee_window", with_("oee", body=f"""SELECT process_date, line_id, tester_id, oee_pct, availability_pct, performance_pct,
  quality_pct, oee_classification, total_wafers_tested, total_passed, total_failed, total_lots FROM oee
  QUALIFY {NEAR.format(n=7)}"""))
def e22(spark, sf):
    return S.oee_window(gold(spark, sf, "oee"), 7)


@query("e23_oee_snapshot", with_("oee", body="""SELECT * EXCLUDE (p) FROM oee
  QUALIFY row_number() OVER (PARTITION BY line_id ORDER BY process_date DESC, tester_id) = 1"""))
def e23(spark, sf):
    return S.oee_snapshot(gold(spark, sf, "oee"))


TREND_DAY = """SELECT process_date, line_id, CAST(sum(failed_wafers) AS BIGINT) AS daily_failed,
  CAST(sum(wafers_tested) AS BIGINT) AS daily_tested,
  sum(failed_wafers)::DOUBLE / greatest(sum(wafers_tested), 1) * 1000000 AS ppm_defective FROM shifts GROUP BY ALL"""


@query("e26_dppm_trend", with_("shifts", body=f"""SELECT {r('ppm_smoothed')} FROM (SELECT *, avg(ppm_defective) OVER (
  PARTITION BY line_id ORDER BY process_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ppm_smoothed FROM ({TREND_DAY}))"""))
def e26(spark, sf):
    return S.dppm_trend(gold(spark, sf, "shifts")).withColumn("ppm_smoothed", F.round("ppm_smoothed", 6))


@query("e27_latest_day", with_("daily", body=f"""SELECT max(process_date) AS latest_date, round(avg(yield_percentage), 6) AS mean_yield
  FROM ({TREND})"""))
def e27(spark, sf):
    return rounded(S.latest_day(gold(spark, sf, "daily")))


ROLL = "avg(yield_percentage) OVER ({p} ORDER BY process_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"


@query("f7_rolling_mean_factory", with_("daily", body=f"""SELECT process_date, {cols('yield_rolling_7d')}
  FROM (SELECT process_date, {ROLL.format(p='')} AS yield_rolling_7d FROM (SELECT process_date, {RATES} FROM daily
    WHERE process_date >= (SELECT max(process_date) FROM daily) - INTERVAL 30 DAY GROUP BY process_date))"""))
def f7(spark, sf):
    return S.factory_days(gold(spark, sf, "daily"), 30).select(
        "process_date", F.round("yield_rolling_7d", 6).alias("yield_rolling_7d"))


@query("f7_rolling_mean_by_line", with_("daily", body=f"""SELECT process_date, line_id, round({ROLL.format(p='PARTITION BY line_id')}, 6) AS rolling_yield
  FROM (SELECT process_date, line_id, {RATES} FROM (SELECT * FROM daily QUALIFY {NEAR.format(n=20)}) GROUP BY ALL)"""))
def f7_line(spark, sf):
    return S.line_days(gold(spark, sf, "daily"), 20).select(
        "process_date", "line_id", F.round("rolling_yield", 6).alias("rolling_yield"))


@query("f7_trend_chart", with_("daily", body=f"""SELECT *, round({ROLL.format(p='')}, 6) AS yield_rolling_7d,
  CASE WHEN ppm_defective > 10000 THEN 'red' WHEN ppm_defective > 5000 THEN 'amber' ELSE 'teal' END AS dppm_band FROM ({TREND})"""))
def f7_chart(spark, sf):
    t = S.trend_chart(gold(spark, sf, "daily"))
    return t.withColumn("yield_rolling_7d", F.round("yield_rolling_7d", 6))


@query("f8_kpi_delta", with_("daily", body=f"""SELECT *, round(yield_percentage - lag(yield_percentage) OVER (ORDER BY process_date), 2) AS yield_delta,
  round((ppm_defective - lag(ppm_defective) OVER (ORDER BY process_date)) * 100 / lag(ppm_defective) OVER (ORDER BY process_date), 2) AS dppm_delta
  FROM ({HEAD})"""))
def f8(spark, sf):
    return S.kpi_delta(S.headline(gold(spark, sf, "daily")))


@query("i1_multi_key_sort", with_("shifts", body=f"SELECT {SHIFT_COLS} FROM shifts QUALIFY {NEAR.format(n=14)}"))
def i1(spark, sf):
    return S.shift_window(gold(spark, sf, "shifts"), 14).orderBy(
        F.col("process_date").desc_nulls_last(), F.col("line_id").asc_nulls_last(),
        F.col("shift_order").asc_nulls_last())


@query("i2_top_k_shift_rows", with_("shifts", body="""SELECT line_id, tester_id, shift, process_date, wafers_tested, failed_wafers,
  yield_pct, ppm_defective FROM shifts ORDER BY process_date DESC, line_id, tester_id, shift LIMIT 200"""))
def i2(spark, sf):
    return S.recent_shifts(gold(spark, sf, "shifts"))


@query("i3_time_order_after_filter", with_("silver", body="""SELECT observation_id, process_timestamp, s59 FROM silver
  WHERE label_numeric = 1 ORDER BY process_timestamp DESC, observation_id DESC LIMIT 500"""))
def i3(spark, sf):
    newest = windows.top_k(failing(silver(spark, sf)), [F.desc("process_timestamp"), F.desc("observation_id")], 500)
    return newest.orderBy("process_timestamp", "observation_id").select("observation_id", "process_timestamp", "s59")
