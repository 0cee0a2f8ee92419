"""Row-local work and reshaping (groups B and C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fabspark.functions import columns as C
from fabspark.operators import reshape, staging
from fabspark.plans import fixtures as X
from fabspark.plans import serving
from fabspark.queries.common import r, rounded
from fabspark.queries.gold_tables import MATRIX
from fabspark.queries.registry import gold, long, query, quarantine, silver, staged, with_


@query("b1_surrogate_key", with_("bronze", body="""SELECT observation_id AS event_id,
  md5(strftime(process_timestamp, '%Y-%m-%d %H:%M:%S.%f') || '-line_id=' || line_id || '/batch_'
      || strftime(process_timestamp, '%Y%m%d%H') || '.parquet') AS observation_id FROM bronze"""))
def surrogate_key(spark, sf):
    b = X.batched(X.bronze(spark, sf))
    key = C.surrogate_key(C.key_text(F.col("Time"), timestamp=True), C.key_text(F.col("source_file")))
    return b.select(F.col("observation_id").alias("event_id"), key.alias("observation_id"))


@query("b2_timestamp_typing", "SELECT event_id, ts AS process_timestamp FROM events")
def timestamp_typing(spark, sf):
    text = X.bronze(spark, sf).withColumn("Time", F.date_format("Time", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return staging.stage(text, X.SENSORS, key=F.col("observation_id")).select(
        F.col("observation_id").alias("event_id"), "process_timestamp")


@query("b3_wafer_status", with_("staged", body="SELECT observation_id, label_numeric, wafer_status FROM staged"))
def wafer_status(spark, sf):
    return staged(spark, sf).select("observation_id", "label_numeric", "wafer_status")


@query("b4_missing_count", with_("staged", body="SELECT observation_id, missing_sensor_count FROM staged"))
def missing_count(spark, sf):
    return staged(spark, sf).select("observation_id", "missing_sensor_count")


@query("b5_star_except", with_("staged", body="SELECT * EXCLUDE (shift, lot_id, tester_id) FROM staged"))
def star_except(spark, sf):
    return staged(spark, sf).drop("shift", "lot_id", "tester_id")


@query("b6_lineage_renames", with_("bronze", body="""SELECT observation_id, CAST('1.0' AS VARCHAR)
  AS bronze_pipeline_version FROM bronze"""))
def lineage_renames(spark, sf):
    b = X.bronze(spark, sf).withColumn("pipeline_version", F.lit("1.0"))
    return staging.stage(b, X.SENSORS, key=F.col("observation_id")).select(
        "observation_id", "bronze_pipeline_version")


@query("b7_reporting", with_("silver", body="SELECT * FROM silver"))
def reporting(spark, sf):
    return silver(spark, sf)


@query("b8_quarantine", with_("quar", body="""SELECT observation_id, line_id, shift, tester_id, lot_id,
  process_timestamp, missing_sensor_count, 'CRITICAL_NULL_THRESHOLD_EXCEEDED' AS quarantine_reason FROM quar"""))
def quarantined(spark, sf):
    return quarantine(spark, sf)


@query("b9_day_bucket", with_("staged", body="""SELECT CAST(process_timestamp AS DATE) AS process_date,
  count(*) AS wafers FROM staged GROUP BY 1"""))
def day_bucket(spark, sf):
    return staged(spark, sf).groupBy(F.to_date("process_timestamp").alias("process_date")).agg(
        F.count(F.lit(1)).alias("wafers"))


@query("b10_line_filter", with_("silver", body="""SELECT observation_id, line_id FROM silver
  WHERE line_id <> 'LINE_C'"""))
def line_filter(spark, sf):
    return staging.for_lines(silver(spark, sf), ["LINE_A", "LINE_B"]).select("observation_id", "line_id")


@query("b11_status_filter", with_("silver", body="""SELECT observation_id, s511 FROM silver
  WHERE label_numeric = 1 AND s511 IS NOT NULL"""))
def status_filter(spark, sf):
    return staging.failing(silver(spark, sf)).filter(F.col("s511").isNotNull()).select("observation_id", "s511")


@query("b12_audit_columns", with_("silver", body="""SELECT observation_id, 'dbt_reporting_v1' AS processing_logic,
  true AS stamped FROM silver"""))
def audit_columns(spark, sf):
    a = staging.with_audit(silver(spark, sf), "silver_created_at", "dbt_reporting_v1")
    return a.select("observation_id", "processing_logic", F.col("silver_created_at").isNotNull().alias("stamped"))


@query("b13_shift_of", "SELECT event_id, CASE WHEN hour(ts) < 6 OR hour(ts) >= 22 THEN 'Night' "
       "WHEN hour(ts) < 14 THEN 'Day' ELSE 'Swing' END AS shift FROM events")
def shift_of(spark, sf):
    return X.table(spark, sf, "events").select("event_id", C.shift_of(F.col("ts")).alias("shift"))


@query("b14_shift_order", with_("staged", body="""SELECT shift, CAST(CASE shift WHEN 'Day' THEN 1 WHEN 'Swing' THEN 2
  WHEN 'Night' THEN 3 ELSE 4 END AS INTEGER) AS shift_order, count(*) AS wafers FROM staged GROUP BY ALL"""))
def shift_order(spark, sf):
    return staged(spark, sf).groupBy("shift", C.shift_order(F.col("shift")).alias("shift_order")).agg(
        F.count(F.lit(1)).alias("wafers"))


@query("b15_select_sensors", with_("silver", body="SELECT wafer_status, s424, s59 FROM silver"))
def select_sensors(spark, sf):
    return staging.select_sensors(silver(spark, sf), ["s424", "s59"], ["wafer_status"])


@query("b16_oee_class", with_("silver", body="""SELECT observation_id, CASE WHEN s103 >= 85 THEN 'World Class'
  WHEN s103 >= 65 THEN 'Good' WHEN s103 >= 50 THEN 'Average' ELSE 'Poor' END AS class FROM silver"""))
def oee_class(spark, sf):
    return silver(spark, sf).select("observation_id", C.oee_class(F.col("s103")).alias("class"))


@query("b17_capability_class", with_("silver", body="""SELECT observation_id, CASE WHEN s59 / 50 >= 1.33::DOUBLE
  THEN 'Capable' WHEN s59 / 50 >= 1 THEN 'Marginal' ELSE 'Incapable' END AS class FROM silver"""))
def capability_class(spark, sf):
    return silver(spark, sf).select("observation_id", C.capability_class(F.col("s59") / 50).alias("class"))


@query("b18_effect", with_("silver", body="""SELECT observation_id, CASE WHEN abs(s424) / 100 >= 0.3::DOUBLE
  THEN 'Strong' WHEN abs(s424) / 100 >= 0.1::DOUBLE THEN 'Moderate' ELSE 'Weak' END AS strength,
  CASE WHEN s424 > 0 THEN 'Higher reading → more failures' WHEN s424 < 0 THEN 'Higher reading → fewer failures'
  ELSE 'No association' END AS direction FROM silver"""))
def effect(spark, sf):
    e = F.col("s424") / 100
    return silver(spark, sf).select("observation_id", C.effect_strength(e).alias("strength"),
                                    C.effect_direction(e).alias("direction"))


@query("b19_severity", with_("viol", body="""SELECT sensor_id, rule_number, ['alarm', 'warn', 'warn', 'ok', 'ok'][rule_number]
  AS severity, count(*) AS n FROM viol GROUP BY ALL"""))
def severity(spark, sf):
    return gold(spark, sf, "violations").groupBy(
        "sensor_id", "rule_number", C.severity(F.col("rule_number")).alias("severity")).agg(
        F.count(F.lit(1)).alias("n"))


@query("b20_bands", with_("daily", body="""SELECT process_date, line_id, CASE WHEN ppm_defective > 10000 THEN 'red'
  WHEN ppm_defective > 5000 THEN 'amber' ELSE 'teal' END AS dppm_band, CASE WHEN failed_wafers > 10 THEN 'red'
  WHEN failed_wafers > 3 THEN 'amber' ELSE 'teal' END AS count_band FROM daily"""))
def bands(spark, sf):
    return gold(spark, sf, "daily").select(
        "process_date", "line_id", C.dppm_band(F.col("ppm_defective")).alias("dppm_band"),
        C.violation_band(F.col("failed_wafers")).alias("count_band"))


@query("b21_calendar_parts", """SELECT event_id, CAST(week(ts) AS INTEGER) AS week,
  CAST(isodow(ts) - 1 AS INTEGER) AS dow, CAST(month(ts) AS INTEGER) AS month, CAST(hour(ts) AS INTEGER) AS hour,
  strftime(ts, '%m-%d') AS month_day FROM events""")
def calendar_parts(spark, sf):
    t = F.col("ts")
    return X.table(spark, sf, "events").select(
        "event_id", C.iso_week(t).alias("week"), C.weekday(t).alias("dow"), F.month(t).alias("month"),
        F.hour(t).alias("hour"), C.month_day(t).alias("month_day"))


@query("b23_binary_label", with_("silver", body="""SELECT observation_id, CAST(CASE label_numeric WHEN -1 THEN 0
  WHEN 1 THEN 1 END AS INTEGER) AS label FROM silver"""))
def binary_label(spark, sf):
    return silver(spark, sf).select("observation_id", C.binary_label(F.col("label_numeric")).alias("label"))


@query("c1_to_long", with_("silver", body="""
  SELECT observation_id, u.sensor_id, u.val FROM silver,
    unnest([{'sensor_id': '59', 'val': s59}, {'sensor_id': '103', 'val': s103}, {'sensor_id': '511', 'val': s511},
            {'sensor_id': '424', 'val': s424}, {'sensor_id': '158', 'val': s158}]) t(u)"""))
def to_long(spark, sf):
    return long(spark, sf, ["observation_id"])


@query("c2_yield_pivot", with_("shifts", body="""
  SELECT line_id, sum(passed_wafers) FILTER (WHERE shift = 'Day')::DOUBLE / sum(wafers_tested) FILTER (WHERE shift = 'Day') * 100 AS "Day",
    sum(passed_wafers) FILTER (WHERE shift = 'Swing')::DOUBLE / sum(wafers_tested) FILTER (WHERE shift = 'Swing') * 100 AS "Swing",
    sum(passed_wafers) FILTER (WHERE shift = 'Night')::DOUBLE / sum(wafers_tested) FILTER (WHERE shift = 'Night') * 100 AS "Night"
  FROM shifts GROUP BY line_id"""))
def yield_pivot(spark, sf):
    return reshape.yield_pivot(gold(spark, sf, "shifts"))


#: Fourteen trailing days touch at most fifteen calendar days; columns are numbered, oldest first, as names must be fixed.
MATRIX_DAYS = [f"d{n:02d}" for n in range(1, 16)]


@query("c3_health_matrix_wide", with_("viol", body="SELECT sensor_id, CAST(sum(violation_count) AS BIGINT) AS total, " + ", ".join(
    f"CAST(coalesce(sum(violation_count) FILTER (WHERE n = {n}), 0) AS BIGINT) AS {d}" for n, d in enumerate(MATRIX_DAYS, 1))
    + f" FROM (SELECT *, dense_rank() OVER (ORDER BY process_date) AS n FROM ({MATRIX})) GROUP BY sensor_id"))
def health_matrix_wide(spark, sf):
    m = serving.health_matrix(gold(spark, sf, "violations"), 14)
    days = sorted(d[0] for d in m.select("process_date").distinct().collect())  # as many as the window has
    wide = reshape.health_pivot(m, days)
    return wide.select("sensor_id", "total", *(F.col(f"`{days[n]}`").alias(d) if n < len(days) else F.lit(0).cast("long").alias(d)
                                               for n, d in enumerate(MATRIX_DAYS)))


@query("c5_apq_long", with_("oee", body="""SELECT line_id, u.component, u.value FROM (
    SELECT * FROM oee QUALIFY row_number() OVER (PARTITION BY line_id ORDER BY process_date DESC, tester_id) = 1),
  unnest([{'component': 'Availability', 'value': availability_pct}, {'component': 'Performance', 'value': performance_pct},
          {'component': 'Quality', 'value': quality_pct}]) t(u)"""))
def apq_long(spark, sf):
    return reshape.apq_long(serving.oee_snapshot(gold(spark, sf, "oee")))


_FALL = """unnest([{{'step_no': 1, 'step': 'Input wafers', 'measure': 'absolute', 'wafers': t + q}},
   {{'step_no': 2, 'step': 'Quarantined (data quality)', 'measure': 'relative', 'wafers': -q}},
   {{'step_no': 3, 'step': 'Failed (process)', 'measure': 'relative', 'wafers': -f}},
   {{'step_no': 4, 'step': 'Final yield', 'measure': 'total', 'wafers': p}}]) x(u)"""
_SUMS = """CAST(sum(total_wafers_tested) AS BIGINT) AS t, CAST(sum(quarantined_wafers) AS BIGINT) AS q,
   CAST(sum(failed_wafers) AS BIGINT) AS f, CAST(sum(passed_wafers) AS BIGINT) AS p"""


@query("c6_waterfall", with_("daily", body=f"""SELECT u.step_no, u.step, u.measure, u.wafers
  FROM (SELECT {_SUMS} FROM daily), {_FALL.format()}"""))
def waterfall(spark, sf):
    return reshape.waterfall(gold(spark, sf, "daily"))


@query("c6_waterfall_by_line", with_("daily", body=f"""SELECT line_id, u.step_no, u.step, u.measure, u.wafers
  FROM (SELECT line_id, {_SUMS} FROM daily GROUP BY line_id), {_FALL.format()}"""))
def waterfall_by_line(spark, sf):
    return reshape.waterfall(gold(spark, sf, "daily"), ["line_id"])
