"""Registry of named queries with optional check SQL, and shared SQL parts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabspark.operators import spc, staging, yields
from fabspark.operators.reshape import to_long
from fabspark.plans import fixtures as X
from fabspark.session import settled

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        if name in QUERIES:
            raise ValueError(name)
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def staged(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stage(X.bronze(spark, sf), X.SENSORS, key=F.col("observation_id"))


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return staging.reporting(staged(spark, sf), X.MAX_MISSING)


def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return staging.quarantine(staged(spark, sf), X.MAX_MISSING)


LONG_KEYS = ["observation_id", "process_timestamp", "line_id", "tester_id", "shift", "lot_id",
             "wafer_status"]


def long(spark: SparkSession, sf: str, keys=tuple(LONG_KEYS)) -> DataFrame:
    return to_long(silver(spark, sf), X.SENSORS, list(keys), prefix="s")


BARE = ("observation_id", "process_timestamp", "line_id", "tester_id")

_BUILD = {
    "daily": lambda s, d: yields.daily_yield(silver(s, d), quarantine(s, d)),
    "shifts": lambda s, d: yields.shift_metrics(silver(s, d), quarantine(s, d)),
    "oee": lambda s, d: yields.oee(gold(s, d, "shifts")),
    "limits": lambda s, d: spc.baseline(long(s, d, BARE)),
    "violations": lambda s, d: spc.violations(long(s, d), gold(s, d, "limits")),
}
_GOLD: dict[tuple[str, str, str], DataFrame] = {}


def gold(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A gold table, built from the driver tables at first use in the application."""
    at = (spark.sparkContext.applicationId, sf, name)
    if at not in _GOLD:
        _GOLD[at] = settled(_BUILD[name](spark, sf), name)
    return _GOLD[at]


# Check SQL. `with_(...)` puts the needed parts in front of a query.

PARTS: dict[str, str] = {
    "bronze": """SELECT event_id AS observation_id, ts AS process_timestamp,
      'LINE_' || substr('ABC', CAST(user_id % 3 AS INTEGER) + 1, 1) AS line_id,
      'TST-0' || CAST(user_id % 3 + 1 AS VARCHAR) AS tester_id,
      CASE WHEN hour(ts) BETWEEN 6 AND 13 THEN 'Day' WHEN hour(ts) BETWEEN 14 AND 21 THEN 'Swing'
           ELSE 'Night' END AS shift,
      'LOT-' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS lot_id,
      CAST(CASE event_type WHEN 'error' THEN 1 WHEN 'signup' THEN 0 ELSE -1 END AS BIGINT) AS label_numeric,
      value AS s59, k AS s103,
      CASE WHEN event_id % 11 <> 0 THEN value * k END AS s511,
      CASE WHEN event_id % 7 <> 0 THEN k - value / 10 END AS s424,
      CASE WHEN event_id % 2 <> 0 THEN CAST(5 AS DOUBLE) END AS s158
      FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS k FROM events)""",
    "staged": """SELECT *,
      CASE label_numeric WHEN -1 THEN 'Pass' WHEN 1 THEN 'Fail' ELSE 'Unknown' END AS wafer_status,
      CAST((s59 IS NULL)::INT + (s103 IS NULL)::INT + (s511 IS NULL)::INT + (s424 IS NULL)::INT
           + (s158 IS NULL)::INT AS INTEGER) AS missing_sensor_count
      FROM bronze""",
    "silver": "SELECT * FROM staged WHERE missing_sensor_count < 2",
    "quar": "SELECT * FROM staged WHERE missing_sensor_count >= 2",
    "daily": """SELECT t.*, round(passed_wafers * 1.0::DOUBLE / total_wafers_tested * 100, 2) AS yield_percentage,
      round(failed_wafers * 1.0::DOUBLE / total_wafers_tested * 1000000, 0) AS ppm_defective
      FROM (SELECT d.process_date, d.line_id, d.total_wafers_tested,
              coalesce(q.n, 0) AS quarantined_wafers, d.passed_wafers, d.failed_wafers
            FROM (SELECT CAST(process_timestamp AS DATE) AS process_date, line_id,
                    count(*) AS total_wafers_tested,
                    count(*) FILTER (WHERE label_numeric = -1) AS passed_wafers,
                    count(*) FILTER (WHERE label_numeric = 1) AS failed_wafers
                  FROM silver GROUP BY ALL) d
            LEFT JOIN (SELECT CAST(process_timestamp AS DATE) AS process_date, line_id, count(*) AS n
                       FROM quar GROUP BY ALL) q USING (process_date, line_id)) t""",
    "shifts": """SELECT a.process_date, a.line_id, a.tester_id, a.shift, wafers_tested, passed_wafers,
      failed_wafers, coalesce(n, 0) AS quarantined_wafers, lots_processed,
      round(passed_wafers::DOUBLE / wafers_tested * 100, 2) AS yield_pct,
      round(failed_wafers::DOUBLE / wafers_tested * 1000000, 0) AS ppm_defective,
      round(coalesce(n, 0)::DOUBLE / (wafers_tested + coalesce(n, 0)) * 100, 2) AS scrap_rate_pct,
      round(missing, 2) AS avg_missing_sensors,
      CAST(list_position(['Day', 'Swing', 'Night'], a.shift) AS INTEGER) AS shift_order
      FROM (SELECT CAST(process_timestamp AS DATE) AS process_date, line_id, tester_id, shift,
              count(*) AS wafers_tested, count(*) FILTER (WHERE wafer_status = 'Pass') AS passed_wafers,
              count(*) FILTER (WHERE wafer_status = 'Fail') AS failed_wafers,
              count(DISTINCT lot_id) AS lots_processed, avg(missing_sensor_count) AS missing
            FROM silver GROUP BY ALL) a
      LEFT JOIN (SELECT CAST(process_timestamp AS DATE) AS process_date, line_id, tester_id, shift,
                   count(*) AS n FROM quar GROUP BY ALL) b USING (process_date, line_id, tester_id, shift)""",
    "oee": """SELECT *, round(p, 2) AS oee_pct, CASE WHEN p >= 85 THEN 'World Class' WHEN p >= 65 THEN 'Good'
        WHEN p >= 50 THEN 'Average' ELSE 'Poor' END AS oee_classification
      FROM (SELECT *, availability_pct / 100.0::DOUBLE * (performance_pct / 100.0::DOUBLE)
                      * (quality_pct / 100.0::DOUBLE) * 100.0::DOUBLE AS p
            FROM (SELECT process_date, line_id, tester_id, count(DISTINCT shift) AS shifts_with_data,
                    CAST(sum(wafers_tested) AS BIGINT) AS total_wafers_tested,
                    CAST(sum(passed_wafers) AS BIGINT) AS total_passed,
                    CAST(sum(failed_wafers) AS BIGINT) AS total_failed,
                    CAST(sum(quarantined_wafers) AS BIGINT) AS total_quarantined,
                    CAST(sum(lots_processed) AS BIGINT) AS total_lots,
                    round(least(count(DISTINCT shift) / 1.0::DOUBLE, 1.0::DOUBLE) * 100, 2) AS availability_pct,
                    round(least(sum(wafers_tested) / 20.0::DOUBLE, 1.0::DOUBLE) * 100, 2) AS performance_pct,
                    round(sum(passed_wafers)::DOUBLE / sum(wafers_tested) * 100, 2) AS quality_pct
                  FROM shifts GROUP BY ALL))""",
    "long": """UNPIVOT (SELECT observation_id, process_timestamp, line_id, tester_id, shift, lot_id,
        wafer_status, label_numeric, s59 AS "59", s103 AS "103", s511 AS "511", s424 AS "424", s158 AS "158"
        FROM silver) ON "59", "103", "511", "424", "158" INTO NAME sensor_id VALUE val""",
    "specs": """SELECT sensor_id, avg(val) + 3.99::DOUBLE * stddev_samp(val) AS usl,
        avg(val) - 3.99::DOUBLE * stddev_samp(val) AS lsl
      FROM (SELECT sensor_id, val, avg(val) OVER g AS m, stddev_samp(val) OVER g AS sd
            FROM (SELECT * FROM long WHERE line_id = 'LINE_A' QUALIFY row_number() OVER (
                    PARTITION BY sensor_id ORDER BY process_timestamp, observation_id) <= 100)
            WINDOW g AS (PARTITION BY sensor_id))
      WHERE abs(val - m) <= 3 * coalesce(sd, 0.0001::DOUBLE) GROUP BY sensor_id""",
    "limits": """SELECT line_id, tester_id, sensor_id, mu, sigma, mu + 3 * sigma AS ucl, mu - 3 * sigma AS lcl,
        mu + 2 * sigma AS uwl, mu - 2 * sigma AS lwl, usl, lsl, readings
      FROM (SELECT line_id, tester_id, sensor_id, avg(val) AS mu, stddev_samp(val) AS sigma, count(*) AS readings
            FROM (SELECT line_id, tester_id, sensor_id, val, avg(val) OVER g AS m, stddev_samp(val) OVER g AS sd
                  FROM (SELECT * FROM long QUALIFY row_number() OVER (PARTITION BY line_id, tester_id, sensor_id
                          ORDER BY process_timestamp, observation_id) <= 100)
                  WINDOW g AS (PARTITION BY line_id, tester_id, sensor_id))
            WHERE abs(val - m) <= 3 * coalesce(sd, 0.0001::DOUBLE) GROUP BY ALL)
      JOIN specs USING (sensor_id) WHERE readings > 30""",
    "points": """SELECT l.*, mu, sigma, ucl, lcl, uwl, lwl, (val - mu) / nullif(sigma, 0) AS z,
        sign(val - mu) AS side,
        row_number() OVER s AS seq, val - lag(val) OVER s AS d1, lag(val) OVER s - lag(val, 2) OVER s AS d0,
        count(*) OVER (PARTITION BY l.sensor_id, l.line_id, l.tester_id) AS series_rows
      FROM long l LEFT JOIN limits USING (sensor_id, line_id, tester_id)
      WINDOW s AS (PARTITION BY l.sensor_id, l.line_id, l.tester_id ORDER BY process_timestamp, observation_id)""",
    "ends": """SELECT *, coalesce(abs(z) > 3, false) AS r1,
        greatest(count(*) FILTER (WHERE side > 0) OVER w9, count(*) FILTER (WHERE side < 0) OVER w9) = 9 AS r2,
        greatest(count(*) FILTER (WHERE d1 > 0) OVER w5, count(*) FILTER (WHERE d1 < 0) OVER w5) = 5 AS r3,
        count(*) FILTER (WHERE (d1 > 0 AND d0 < 0) OR (d1 < 0 AND d0 > 0)) OVER w12 = 12 AS r4,
        greatest(count(*) FILTER (WHERE z > 2) OVER w3, count(*) FILTER (WHERE z < -2) OVER w3) >= 2 AS r5
      FROM points WINDOW
        w3 AS (PARTITION BY sensor_id, line_id, tester_id ORDER BY seq ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
        w5 AS (PARTITION BY sensor_id, line_id, tester_id ORDER BY seq ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
        w9 AS (PARTITION BY sensor_id, line_id, tester_id ORDER BY seq ROWS BETWEEN 8 PRECEDING AND CURRENT ROW),
        w12 AS (PARTITION BY sensor_id, line_id, tester_id ORDER BY seq ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""",
    "viol": """SELECT observation_id, process_timestamp, line_id, tester_id, shift, lot_id, wafer_status, sensor_id,
        round(val, 6) AS sensor_value, round(mu, 6) AS reference_mean, round(sigma, 6) AS reference_sigma,
        round(z, 4) AS z_score, rule_name, rule_number
      FROM ends, (VALUES (1, 'Rule 1: Beyond 3σ'), (2, 'Rule 2: 9 on one side'), (3, 'Rule 3: 6 trending'),
                         (4, 'Rule 4: 14 alternating'), (5, 'Rule 5: 2/3 beyond 2σ')) v(rule_number, rule_name)
      WHERE [r1, r2, r3, r4, r5][rule_number]""",
    # Monitor engine: full frames, nine readings at least, every point of a run.
    "marks": """SELECT *, active AND r1 AS m1,
        coalesce(max((active AND r2 AND seq >= 9)::INT) OVER (s ROWS BETWEEN CURRENT ROW AND 8 FOLLOWING), 0) = 1 AS m2,
        coalesce(max((active AND r3 AND seq >= 6)::INT) OVER (s ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING), 0) = 1 AS m3,
        coalesce(max((active AND r4 AND seq >= 14)::INT) OVER (s ROWS BETWEEN CURRENT ROW AND 13 FOLLOWING), 0) = 1 AS m4,
        coalesce(max((active AND r5 AND seq >= 3)::INT) OVER (s ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING), 0) = 1 AS m5
      FROM (SELECT *, coalesce(series_rows >= 9 AND sigma <> 0, false) AS active FROM ends WHERE mu IS NOT NULL)
      WINDOW s AS (PARTITION BY sensor_id, line_id, tester_id ORDER BY seq)""",
}
_NEEDS = {
    "bronze": (), "staged": ("bronze",), "silver": ("staged",), "quar": ("staged",),
    "daily": ("silver", "quar"), "shifts": ("silver", "quar"), "oee": ("shifts",), "long": ("silver",),
    "specs": ("long",), "limits": ("specs",), "points": ("limits",), "ends": ("points",),
    "viol": ("ends",), "marks": ("ends",),
}


def with_(*parts: str, body: str) -> str:
    """A query over the named parts and whatever they need, in order."""
    out: list[str] = []

    def need(p: str) -> None:
        for q in _NEEDS[p]:
            need(q)
        if p not in out:
            out.append(p)

    for p in parts:
        need(p)
    return "WITH " + ",\n".join(f"{p} AS ({PARTS[p]})" for p in out) + "\n" + body
