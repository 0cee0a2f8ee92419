"""Window functions and statistical process control (groups D, F, G)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fabspark.operators import spc, windows
from fabspark.operators.ordering import positions, with_context
from fabspark.operators.reshape import to_long
from fabspark.plans import fixtures as X
from fabspark.queries.common import cols, r, rounded
from fabspark.queries.registry import BARE, gold, long, query, silver, with_
from fabspark.sources.events import latest_batch

SERIES3 = "sensor_id, line_id, tester_id"
FIRST100 = """SELECT * FROM long QUALIFY row_number() OVER (PARTITION BY line_id, tester_id, sensor_id
  ORDER BY process_timestamp, observation_id) <= 100"""


@query("d3_screened_baseline", with_("limits", body=f"SELECT line_id, tester_id, sensor_id, {cols('mu', 'sigma')}, readings FROM limits"))
def d3(spark, sf):
    s = spc.screened(long(spark, sf, BARE), ["line_id", "tester_id", "sensor_id"], 100)
    return rounded(s.filter(F.col("readings") > 30))


@query("d4_baseline_with_specs", with_("limits", body=f"SELECT line_id, tester_id, sensor_id, {cols('usl', 'lsl')} FROM limits"))
def d4(spark, sf):
    return rounded(spc.baseline(long(spark, sf, BARE)).select("line_id", "tester_id", "sensor_id", "usl", "lsl"))


@query("d5_points_with_limits", with_("points", body="""SELECT sensor_id, line_id, tester_id, count(*) AS points, count(mu) AS limited,
  round(sum(z), 4) AS z_sum FROM points GROUP BY ALL"""))
def d5(spark, sf):
    p = spc.spc_points(long(spark, sf, BARE), gold(spark, sf, "limits"))
    return rounded(p.groupBy(*spc.SERIES).agg(F.count(F.lit(1)).alias("points"), F.count("mu").alias("limited"),
                                              F.sum("z_score").alias("z_sum")), 4)


@query("d9_batch_with_limits", with_("points", body="""SELECT observation_id, sensor_id, val, round(mu, 6) AS mu, round(sigma, 6) AS sigma
  FROM points JOIN (SELECT line_id, max(date_trunc('hour', process_timestamp)) AS newest FROM silver GROUP BY line_id) USING (line_id)
  WHERE mu IS NOT NULL AND process_timestamp >= newest"""))
def d9(spark, sf):
    """Readings of the latest batch of every line with the limits of their series."""
    batch = latest_batch(X.batched(silver(spark, sf), "process_timestamp"))
    rows = to_long(batch, X.SENSORS, list(BARE), "s")
    lim = gold(spark, sf, "limits").select(*spc.SERIES, "mu", "sigma")
    return rounded(rows.filter("val IS NOT NULL").join(lim, spc.SERIES).select("observation_id", "sensor_id", "val", "mu", "sigma"))


@query("d10_spec_lookup", with_("limits", body="""SELECT sensor_id, round(min(usl), 6) AS usl, round(min(lsl), 6) AS lsl, count(*) AS series
  FROM limits GROUP BY sensor_id"""))
def d10(spark, sf):
    g = gold(spark, sf, "limits").groupBy("sensor_id")
    first = F.struct("line_id", "tester_id")
    return rounded(g.agg(F.min_by("usl", first).alias("usl"), F.min_by("lsl", first).alias("lsl"),
                         F.count(F.lit(1)).alias("series")))


@query("f1_first_n_readings", with_("long", body=f"SELECT line_id, tester_id, sensor_id, observation_id, val FROM ({FIRST100})"))
def f1(spark, sf):
    w = Window.partitionBy("line_id", "tester_id", "sensor_id").orderBy(*spc.TIME)
    return long(spark, sf, BARE).filter("val IS NOT NULL").withColumn("rn", F.row_number().over(w)).filter("rn <= 100").select(
        "line_id", "tester_id", "sensor_id", "observation_id", "val")


@query("f2_sequence_number", with_("points", body="SELECT sensor_id, line_id, tester_id, observation_id, seq, series_rows FROM points"))
def f2(spark, sf):
    p = positions(long(spark, sf, BARE).filter("val IS NOT NULL"), spc.SERIES, spc.TIME)
    return p.select(*spc.SERIES, "observation_id", "seq", "series_rows")


def _frames(spark, sf):
    p = spc.spc_points(long(spark, sf, BARE), gold(spark, sf, "limits"))
    return with_context(p, spc.REACH), Window.partitionBy(*spc.SERIES, "_blk").orderBy("seq")


def over(n):
    return f"OVER (PARTITION BY {SERIES3} ORDER BY seq ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


@query("f3_rolling_counts", with_("points", body=f"""SELECT sensor_id, line_id, tester_id, seq,
  count(*) FILTER (WHERE side > 0) {over(9)} AS above9, count(*) FILTER (WHERE side < 0) {over(9)} AS below9,
  count(*) FILTER (WHERE z > 2) {over(3)} AS high3 FROM points"""))
def f3(spark, sf):
    p, w = _frames(spark, sf)
    side = F.col("side_of_mean")
    return p.select(*spc.SERIES, "seq", "_own", spc.hits(side > 0, 9, w).alias("above9"),
                    spc.hits(side < 0, 9, w).alias("below9"),
                    spc.hits(F.col("z_score") > 2, 3, w).alias("high3")).filter("_own").drop("_own")


@query("f4_lags", with_("points", body=f"""SELECT sensor_id, line_id, tester_id, seq, {', '.join(f'lag(val, {k}) OVER s AS v{k}' for k in range(1, 6))}
  FROM points WINDOW s AS (PARTITION BY {SERIES3} ORDER BY seq)"""))
def f4(spark, sf):
    p, w = _frames(spark, sf)
    return p.select(*spc.SERIES, "seq", "_own", *[F.lag("val", k).over(w).alias(f"v{k}") for k in range(1, 6)]).filter(
        "_own").drop("_own")


@query("f5_direction_flips", with_("points", body="""SELECT sensor_id, line_id, tester_id, seq, CAST(sign(d1) AS INTEGER) AS step,
  coalesce(sign(d1) * sign(d0) < 0, false) AS flip FROM points"""))
def f5(spark, sf):
    p, w = _frames(spark, sf)
    p = p.withColumn("step", F.signum(F.col("val") - F.lag("val").over(w)))
    p = p.withColumn("flip", F.coalesce(F.col("step") * F.lag("step").over(w) < 0, F.lit(False)))
    return p.filter("_own").select(*spc.SERIES, "seq", "step", "flip").withColumn("step", F.col("step").cast("int"))


@query("f9_first_difference", with_("points", body="SELECT sensor_id, line_id, tester_id, seq, round(d1, 6) AS diff, CAST(sign(d1) AS INTEGER) AS step FROM points"))
def f9(spark, sf):
    p, w = _frames(spark, sf)
    d = F.col("val") - F.lag("val").over(w)
    return rounded(p.select(*spc.SERIES, "seq", "_own", d.alias("diff"), F.signum(d).cast("int").alias("step")).filter("_own").drop("_own"))


@query("f10_full_window_count", with_("points", body=f"""SELECT sensor_id, line_id, tester_id, seq,
  CASE WHEN seq >= 3 THEN count(*) FILTER (WHERE z > 2) {over(3)} END AS high3 FROM points"""))
def f10(spark, sf):
    p, w = _frames(spark, sf)
    n = spc.hits(F.col("z_score") > 2, 3, w)
    return p.select(*spc.SERIES, "seq", "_own", F.when(F.col("seq") >= 3, n).alias("high3")).filter("_own").drop("_own")


def _rule(n):
    @query(f"g{n + 3}_rule{n}", with_("ends", body=f"SELECT sensor_id, line_id, tester_id, observation_id, seq FROM ends WHERE r{n}"))
    def rule(spark, sf):
        p = spc.spc_points(long(spark, sf, BARE), gold(spark, sf, "limits"))
        return spc.rule_ends(p).filter(F.col("_own") & F.col(f"rule{n}")).select(*spc.SERIES, "observation_id", "seq")


for _n in range(1, 6):
    _rule(_n)

LIMIT_COLS = ("mu", "sigma", "ucl", "lcl", "uwl", "lwl", "usl", "lsl")


@query("g1_baseline", with_("limits", body=f"""SELECT {r(*LIMIT_COLS).replace('* REPLACE', '* EXCLUDE (readings) REPLACE')},
  'v1.0_phase1_frozen' AS logic_version FROM limits"""))
def g1(spark, sf):
    return rounded(spc.baseline(long(spark, sf, BARE)))


@query("g2_spec_limits", with_("specs", body=f"SELECT {r('usl', 'lsl')} FROM specs"))
def g2(spark, sf):
    return rounded(spc.spec_limits(long(spark, sf, BARE)))


@query("g3_spc_points", with_("points", body="""SELECT sensor_id, line_id, tester_id, observation_id, seq, val, round(mu, 6) AS mu,
  round(z, 6) AS z_score, CAST(side AS INTEGER) AS side FROM points"""))
def g3(spark, sf):
    p = spc.spc_points(long(spark, sf, BARE), gold(spark, sf, "limits"))
    return rounded(p.select(*spc.SERIES, "observation_id", "seq", "val", "mu", "z_score",
                            F.col("side_of_mean").cast("int").alias("side")))


@query("g9_spc_violations", with_("viol", body="SELECT * FROM viol"))
def g9(spark, sf):
    return spc.violations(long(spark, sf), gold(spark, sf, "limits"))


@query("g9_worst_rule_only", with_("viol", body="""SELECT * FROM viol QUALIFY row_number() OVER (
  PARTITION BY observation_id, sensor_id ORDER BY rule_number) = 1"""))
def g9_worst(spark, sf):
    return spc.violations(long(spark, sf), gold(spark, sf, "limits"), worst_rule_only=True)


@query("g10_monitor", with_("marks", body="""SELECT sensor_id, line_id, tester_id, observation_id, seq, rule
  FROM marks, unnest([1, 2, 3, 4, 5]) t(rule) WHERE [m1, m2, m3, m4, m5][rule]"""))
def g10(spark, sf):
    m = spc.monitor(long(spark, sf, BARE), gold(spark, sf, "limits"))
    return m.select(*spc.SERIES, "observation_id", "seq", F.explode("rules").alias("rule"))


@query("f11_expand_run", with_("marks", body="""SELECT sensor_id, line_id, tester_id, count(*) FILTER (WHERE m2) AS run9,
  count(*) FILTER (WHERE m3) AS run6, count(*) FILTER (WHERE m4) AS run14, count(*) FILTER (WHERE m5) AS run3 FROM marks GROUP BY ALL"""))
def f11(spark, sf):
    m = spc.monitor(long(spark, sf, BARE), gold(spark, sf, "limits"))
    return m.groupBy(*spc.SERIES).agg(*[F.count_if(F.array_contains("rules", n)).alias(a)
                                        for n, a in ((2, "run9"), (3, "run6"), (4, "run14"), (5, "run3"))])


@query("j2_distinct_points", with_("marks", body="""SELECT sensor_id, line_id, tester_id, count(DISTINCT seq) AS ooc_count
  FROM marks WHERE m1 OR m2 OR m3 OR m4 OR m5 GROUP BY ALL"""))
def j2(spark, sf):
    m = spc.monitor(long(spark, sf, BARE), gold(spark, sf, "limits"))
    return m.filter(F.size("rules") > 0).groupBy(*spc.SERIES).agg(F.count(F.lit(1)).alias("ooc_count"))


CAP = """CASE WHEN readings >= 5 AND s <> 0 THEN round({e}, 3) ELSE 0 END"""


def cap_sql(source, by):
    cp, cu, cl = "(usl - lsl) / (6 * s)", "(usl - m) / (3 * s)", "(m - lsl) / (3 * s)"
    return f"""SELECT *, CASE WHEN cpk >= 1.33::DOUBLE THEN 'Capable' WHEN cpk >= 1 THEN 'Marginal' ELSE 'Incapable' END AS status
      FROM (SELECT {by}, readings, {CAP.format(e=cp)} AS cp, {CAP.format(e=f'least({cu}, {cl})')} AS cpk,
              {CAP.format(e=cu)} AS cpu, {CAP.format(e=cl)} AS cpl
            FROM (SELECT {by}, count(*) AS readings, avg(val) AS m, stddev_samp(val) AS s FROM {source} GROUP BY {by})
            JOIN (SELECT sensor_id, min(usl) AS usl, min(lsl) AS lsl FROM limits GROUP BY sensor_id) USING (sensor_id))"""


@query("g11_analyze_batch", with_("marks", "limits", body=f"""SELECT k.*, c.cp, c.cpk, c.readings
  FROM (SELECT sensor_id, line_id, tester_id, round(avg(val), 4) AS mean, round(coalesce(stddev_samp(val), 0), 4) AS std,
          round(max(ucl), 4) AS ucl, round(max(lcl), 4) AS lcl, count(*) FILTER (WHERE m1 OR m2 OR m3 OR m4 OR m5) AS ooc_count,
          count(*) FILTER (WHERE m1 OR m2 OR m3 OR m4 OR m5) > 0 AS ooc,
          concat_ws(', ', CASE WHEN bool_or(m1) THEN 'Rule 1: Beyond 3σ' END, CASE WHEN bool_or(m2) THEN 'Rule 2: 9 on one side' END,
            CASE WHEN bool_or(m3) THEN 'Rule 3: 6 trending' END, CASE WHEN bool_or(m4) THEN 'Rule 4: 14 alternating' END,
            CASE WHEN bool_or(m5) THEN 'Rule 5: 2/3 beyond 2σ' END) AS violations FROM marks GROUP BY ALL) k
  JOIN ({cap_sql('long', 'sensor_id, line_id, tester_id')}) c USING (sensor_id, line_id, tester_id)"""))
def g11(spark, sf):
    return spc.analyze_batch(long(spark, sf, BARE), gold(spark, sf, "limits"))


@query("g12_chart_series", with_("marks", body=f"""SELECT sensor_id, line_id, tester_id, seq - 1 AS point, val, round(mu, 6) AS mu, round(ucl, 6) AS ucl,
  round(lcl, 6) AS lcl, round(uwl, 6) AS uwl, round(lwl, 6) AS lwl, m1 OR m2 OR m3 OR m4 OR m5 AS violation,
  round(lcl - (ucl - lcl) * 0.25::DOUBLE, 6) AS axis_low, round(ucl + (ucl - lcl) * 0.25::DOUBLE, 6) AS axis_high FROM marks"""))
def g12(spark, sf):
    return rounded(spc.chart_series(long(spark, sf, BARE), gold(spark, sf, "limits")))


@query("g13_capability", with_("limits", body=cap_sql("long", "sensor_id")))
def g13(spark, sf):
    return spc.capability(long(spark, sf, BARE), gold(spark, sf, "limits"))


@query("g14_long_term_capability", with_("limits", body=cap_sql("""(SELECT * FROM long WHERE observation_id IN (SELECT observation_id
  FROM silver QUALIFY process_timestamp >= max(process_timestamp) OVER (PARTITION BY line_id) - INTERVAL 7 DAY))""", "sensor_id")))
def g14(spark, sf):
    recent = windows.trailing(silver(spark, sf), "process_timestamp", "'7' DAY", ["line_id"])
    return spc.capability(to_long(recent, X.SENSORS, ["line_id"], "s"), gold(spark, sf, "limits"))
