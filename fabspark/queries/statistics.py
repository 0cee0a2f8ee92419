"""Correlation, drift, profiling and contracts (group H and D-8, C-4, I-4, I-5, J-1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fabspark.functions import columns as C
from fabspark.operators import drift as D
from fabspark.operators import profile as P
from fabspark.operators import quality as Q
from fabspark.operators import stats
from fabspark.operators.ordering import positions
from fabspark.operators.reshape import to_long
from fabspark.operators.staging import failing
from fabspark.plans import fixtures as X
from fabspark.queries.common import r, rounded
from fabspark.queries.registry import gold, query, silver, staged, with_
from fabspark.sources.events import latest_batch

PARETO = """SELECT row_number() OVER (ORDER BY abs(r) DESC, sensor_id) AS rank, sensor_id, round(r, 6) AS correlation,
  round(abs(r), 6) AS abs_correlation, n AS sample_size,
  CASE WHEN abs(r) >= 0.3::DOUBLE THEN 'Strong' WHEN abs(r) >= 0.1::DOUBLE THEN 'Moderate' ELSE 'Weak' END AS effect_strength,
  CASE WHEN r > 0 THEN 'Higher reading → more failures' WHEN r < 0 THEN 'Higher reading → fewer failures' ELSE 'No association' END AS direction
  FROM (SELECT sensor_id, corr(val, label_numeric) AS r, count(val) AS n FROM long GROUP BY sensor_id)
  WHERE NOT isnan(r) AND n >= 30"""


def _pareto(spark, sf):
    return stats.pareto(silver(spark, sf), X.SENSORS, prefix="s")


@query("h1_failure_pareto", with_("long", body=PARETO))
def h1(spark, sf):
    return _pareto(spark, sf)


@query("i5_top_directions", with_("long", body=f"SELECT rank, sensor_id, direction FROM ({PARETO}) ORDER BY rank LIMIT 5"))
def i5(spark, sf):
    return _pareto(spark, sf).orderBy("rank").limit(5).select("rank", "sensor_id", "direction")


@query("i2_top_sensors", with_("long", body=f"SELECT rank, sensor_id, correlation FROM ({PARETO}) ORDER BY rank LIMIT 20"))
def i2_sensors(spark, sf):
    return _pareto(spark, sf).orderBy("rank").limit(20).select("rank", "sensor_id", "correlation")


@query("f6_rank_sensors", with_("long", body=f"SELECT sensor_id, rank FROM ({PARETO})"))
def f6(spark, sf):
    return _pareto(spark, sf).select("sensor_id", "rank")


# Sensor 103 stands in for the label here, so that some sensors are related to it.
@query("h22_predictors", with_("silver", "long", body="""SELECT sensor_id, CASE WHEN abs(r) >= 0.3::DOUBLE THEN 'Strong' ELSE 'Moderate' END AS effect_strength
  FROM (SELECT sensor_id, corr(val, s103) AS r FROM long JOIN (SELECT observation_id, s103 FROM silver) USING (observation_id) GROUP BY sensor_id)
  WHERE NOT isnan(r) AND abs(r) >= 0.1::DOUBLE"""))
def h22(spark, sf):
    p = stats.pareto(silver(spark, sf).withColumn("label", F.col("s103")), X.SENSORS, "label", prefix="s")
    return stats.predictors(p).select("sensor_id", "effect_strength")


PAIRS = """SELECT a.sensor_id AS sensor_a, b.sensor_id AS sensor_b, count(*) AS n, corr(a.val, b.val) AS r
  FROM long a JOIN long b USING (observation_id) {where} GROUP BY ALL"""
CLEAN_R = "CASE WHEN isnan(r) THEN NULL ELSE round(r, 6) END AS r"


@query("h2_corr_matrix", with_("long", body=f"SELECT sensor_a, sensor_b, n, {CLEAN_R} FROM ({PAIRS.format(where='WHERE a.label_numeric = 1')})"))
def h2(spark, sf):
    m = stats.corr_matrix(failing(silver(spark, sf)), X.SENSORS)
    return rounded(m.withColumns({"sensor_a": F.substring("sensor_a", 2, 9), "sensor_b": F.substring("sensor_b", 2, 9)}))


EMB = """emb AS (SELECT vec_id, CAST(i - 1 AS INTEGER) AS i, v::DOUBLE AS v
  FROM (SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding) AS v FROM embeddings))"""


@query("h2_corr_matrix_wide", f"""WITH {EMB} SELECT 'e' || lpad(CAST(a.i AS VARCHAR), 3, '0') AS sensor_a,
  'e' || lpad(CAST(b.i AS VARCHAR), 3, '0') AS sensor_b, count(*) AS n, round(corr(a.v, b.v), 6) AS r
  FROM emb a JOIN emb b USING (vec_id) WHERE a.v IS NOT NULL AND b.v IS NOT NULL GROUP BY ALL""")
def h2_wide(spark, sf):
    wide = X.embedding_sensors(spark, sf)
    return rounded(stats.corr_matrix(wide, [c for c in wide.columns if c.startswith("e")]))


@query("h3_collinear", with_("long", body=f"""SELECT sensor_a AS sensor_id, round(max(abs(r)), 6) AS max_abs_r FROM ({PAIRS.format(where='')})
  WHERE sensor_a <> sensor_b AND NOT isnan(r) GROUP BY sensor_a HAVING max(abs(r)) >= 0.5::DOUBLE"""))
def h3(spark, sf):
    m = stats.corr_matrix(silver(spark, sf), X.SENSORS)
    return rounded(stats.collinear(m, 0.5).withColumn("sensor_id", F.substring("sensor_id", 2, 9)))


SPEAR = """SELECT sensor_a, sensor_b, count(*) AS n, corr(rx, ry) AS rho
  FROM (SELECT a.sensor_id AS sensor_a, b.sensor_id AS sensor_b,
          rank() OVER (PARTITION BY a.sensor_id, b.sensor_id ORDER BY a.val)
            + (count(*) OVER (PARTITION BY a.sensor_id, b.sensor_id, a.val) - 1) / 2.0::DOUBLE AS rx,
          rank() OVER (PARTITION BY a.sensor_id, b.sensor_id ORDER BY b.val)
            + (count(*) OVER (PARTITION BY a.sensor_id, b.sensor_id, b.val) - 1) / 2.0::DOUBLE AS ry
        FROM long a JOIN long b USING (observation_id)
        WHERE list_position(['59', '103', '511', '424', '158'], a.sensor_id)
            < list_position(['59', '103', '511', '424', '158'], b.sensor_id)) GROUP BY ALL"""


def _spearman(spark, sf):
    s = stats.spearman(silver(spark, sf), X.SENSORS)
    return s.withColumns({"sensor_a": F.substring("sensor_a", 2, 9), "sensor_b": F.substring("sensor_b", 2, 9)})


@query("h4_spearman", with_("long", body=f"SELECT sensor_a, sensor_b, n, CASE WHEN isnan(rho) THEN NULL ELSE round(rho, 6) END AS rho FROM ({SPEAR})"))
def h4(spark, sf):
    return rounded(_spearman(spark, sf))


@query("h4_redundant", with_("long", body=f"""SELECT sensor_b AS sensor_id, round(max(abs(rho)), 6) AS max_abs_rho FROM ({SPEAR})
  WHERE NOT isnan(rho) AND abs(rho) > 0.6::DOUBLE GROUP BY sensor_b"""))
def h4_redundant(spark, sf):
    return rounded(stats.redundant(_spearman(spark, sf), 0.6))


@query("h5_pointbiserial", with_("long", body="""SELECT sensor_id, n, round(r, 6) AS r, round(abs(r), 6) AS abs_r,
  round(r * sqrt((n - 2) / (1 - r * r)), 4) AS t
  FROM (SELECT sensor_id, CASE WHEN isnan(r) THEN NULL ELSE r END AS r, n FROM
    (SELECT sensor_id, corr(val, label_numeric) AS r, count(val) AS n FROM long GROUP BY sensor_id))"""))
def h5(spark, sf):
    p = stats.pointbiserial(silver(spark, sf), X.SENSORS, prefix="s")
    return p.select("sensor_id", "n", C.rounded(F.col("r"), 6).alias("r"), C.rounded(F.col("abs_r"), 6).alias("abs_r"),
                    C.rounded(F.col("t"), 4).alias("t"))


@query("h5_pointbiserial_p_value")
def h5_p(spark, sf):
    return stats.pointbiserial(silver(spark, sf), X.SENSORS, prefix="s")


# Drift: the first three weeks are the baseline, what follows the generated batch.
SPLIT = "2024-01-22"


def _parts(spark, sf):
    s, at = staged(spark, sf), F.lit(SPLIT).cast("timestamp_ntz")
    return s.filter(F.col("process_timestamp") < at), s.filter(F.col("process_timestamp") >= at)


def _drift_inputs(spark, sf):
    base, batch = _parts(spark, sf)
    return to_long(base, X.SENSORS, [], "s"), to_long(batch, X.SENSORS, ["line_id"], "s")


DRIFT = f"""rows AS (UNPIVOT (SELECT process_timestamp < TIMESTAMP '{SPLIT}' AS is_base, line_id, s59 AS "59", s103 AS "103", s511 AS "511",
    s424 AS "424", s158 AS "158" FROM staged) ON "59", "103", "511", "424", "158" INTO NAME sensor_id VALUE val),
  base AS (SELECT sensor_id, val, count(*) OVER (PARTITION BY sensor_id) AS base_n, stddev_samp(val) OVER (PARTITION BY sensor_id) AS sd
           FROM rows WHERE is_base),
  gen AS (SELECT line_id, sensor_id, val, count(*) OVER (PARTITION BY line_id, sensor_id) AS batch_n FROM rows WHERE NOT is_base),
  grp AS (SELECT DISTINCT g.line_id, sensor_id, base_n, batch_n, sd FROM (SELECT DISTINCT line_id, sensor_id, batch_n FROM gen) g
          JOIN (SELECT DISTINCT sensor_id, base_n, sd FROM base) b USING (sensor_id) WHERE base_n >= 5 AND batch_n >= 5 AND sd <> 0),
  steps AS (SELECT line_id, sensor_id, val, 1.0::DOUBLE / base_n AS h FROM base JOIN (SELECT line_id, sensor_id FROM grp) USING (sensor_id)
            UNION ALL SELECT line_id, sensor_id, val, -1.0::DOUBLE / batch_n FROM gen JOIN (SELECT line_id, sensor_id FROM grp) USING (line_id, sensor_id)),
  area AS (SELECT line_id, sensor_id, sum(abs(f) * (nxt - val)) AS distance FROM
            (SELECT line_id, sensor_id, val, lead(val) OVER s AS nxt, sum(h) OVER s AS f
             FROM (SELECT line_id, sensor_id, val, sum(h) AS h FROM steps GROUP BY ALL) WINDOW s AS (PARTITION BY line_id, sensor_id ORDER BY val))
           GROUP BY ALL),
  scores AS (SELECT line_id, sensor_id, base_n, batch_n, round(distance, 6) AS distance, round(distance / sd, 4) AS drift_score,
               distance / sd > 0.1::DOUBLE AS drifted, CASE WHEN distance / sd > 0.1::DOUBLE THEN 'Drifted' ELSE 'Stable' END AS status
             FROM area JOIN grp USING (line_id, sensor_id))"""


def drift_sql(body: str) -> str:
    return with_("staged", body="").rstrip() + ",\n" + DRIFT + "\n" + body


@query("h6_wasserstein_drift", drift_sql("SELECT * FROM scores"))
def h6(spark, sf):
    return D.drift(*_drift_inputs(spark, sf)).withColumn("distance", C.rounded(F.col("distance"), 6))


@query("i4_most_drifted", drift_sql("""SELECT line_id, sensor_id, drift_score FROM scores
  ORDER BY drift_score DESC, line_id, sensor_id LIMIT 1"""))
def i4(spark, sf):
    return D.most_drifted(D.drift(*_drift_inputs(spark, sf))).select("line_id", "sensor_id", "drift_score")


@query("j1_union_baseline_batch", drift_sql("""SELECT source, sensor_id, count(*) AS n FROM (SELECT 'Baseline' AS source, sensor_id FROM base
  UNION ALL SELECT 'Generated', sensor_id FROM gen) GROUP BY ALL"""))
def j1(spark, sf):
    base, gen = _drift_inputs(spark, sf)
    return base.withColumn("source", F.lit("Baseline")).unionByName(
        gen.drop("line_id").withColumn("source", F.lit("Generated"))).groupBy("source", "sensor_id").agg(
        F.count("val").alias("n"))


@query("d8_match_baseline", with_("staged", body="""SELECT observation_id, process_timestamp FROM staged WHERE
  strftime(process_timestamp, '%m-%d') IN (SELECT strftime(process_timestamp, '%m-%d') FROM staged
    QUALIFY date_trunc('hour', process_timestamp) = max(date_trunc('hour', process_timestamp)) OVER (PARTITION BY line_id))"""))
def d8(spark, sf):
    """All rows of the days that the latest batch of any line was made on."""
    s = X.batched(staged(spark, sf), "process_timestamp")
    return D.match_baseline(s, latest_batch(s)).select("observation_id", "process_timestamp")


@query("d8_match_failing_days", with_("staged", body="""SELECT observation_id, process_timestamp FROM staged WHERE
  strftime(process_timestamp, '%m-%d') IN (SELECT strftime(process_timestamp, '%m-%d') FROM staged
    WHERE label_numeric = 1)"""))
def d8_failing(spark, sf):
    s = staged(spark, sf)
    return D.match_baseline(s, failing(s)).select("observation_id", "process_timestamp")


NULLS = f"""SELECT *, max(missing_pct) FILTER (WHERE source <> 'Baseline') OVER (PARTITION BY sensor_id) AS max_generated
  FROM (SELECT u.s AS sensor_id, source, avg((u.v IS NULL)::INT) * 100 AS missing_pct
        FROM (SELECT *, CASE WHEN process_timestamp < TIMESTAMP '{SPLIT}' THEN 'Baseline' ELSE 'Gen ' || line_id END AS source FROM staged),
          unnest([{{'s': '59', 'v': s59}}, {{'s': '103', 'v': s103}}, {{'s': '511', 'v': s511}}, {{'s': '424', 'v': s424}}, {{'s': '158', 'v': s158}}]) t(u)
        GROUP BY ALL) QUALIFY max(missing_pct) OVER (PARTITION BY sensor_id) > 0"""


@query("h7_null_topology", with_("staged", body=f"SELECT {r('missing_pct', 'max_generated')} FROM ({NULLS})"))
def h7(spark, sf):
    base, batch = _parts(spark, sf)
    return rounded(D.null_topology(base, batch, X.SENSORS, "s"))


@query("c4_null_topology_long", with_("staged", body=f"SELECT sensor_id, source, round(missing_pct, 6) AS missing_pct FROM ({NULLS})"))
def c4(spark, sf):
    base, batch = _parts(spark, sf)
    return rounded(D.null_topology(base, batch, X.SENSORS, "s").drop("max_generated"))


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("h8_missing_by_column", with_("staged", body="""SELECT "column", count(*) FILTER (WHERE v IS NULL) AS missing,
  round(avg((v IS NULL)::INT) * 100, 6) AS percent FROM (
  SELECT u.c AS "column", u.v AS v FROM staged, unnest([{'c': 's59', 'v': s59}, {'c': 's103', 'v': s103}, {'c': 's511', 'v': s511},
    {'c': 's424', 'v': s424}, {'c': 's158', 'v': s158}]) t(u)) GROUP BY 1"""))
def h8(spark, sf):
    return rounded(P.missing_by_column(X.bronze(spark, sf), X.SENSORS))


@query("h9_missing_by_row", with_("staged", body="""SELECT observation_id, missing_sensor_count AS missing, missing_sensor_count / 5.0::DOUBLE * 100 AS percent
  FROM staged ORDER BY missing_sensor_count DESC, observation_id LIMIT 20"""))
def h9(spark, sf):
    return P.missing_by_row(X.bronze(spark, sf), X.SENSORS, "observation_id")


@query("h10_duplicates", "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def h10(spark, sf):
    return P.duplicates(X.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("h10_duplicate_rows", "SELECT *, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def h10_rows(spark, sf):
    return P.duplicates(X.table(spark, sf, "lineitem"))


@query("h11_constant_columns", with_("staged", body=" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CASE WHEN count({c}) = 0 THEN 'empty' ELSE 'constant' END AS kind, count({c}) AS "values"
  FROM staged HAVING count(DISTINCT {c}) <= 1""" for c in [*X.SENSORS, "line_id"])))
def h11(spark, sf):
    return P.constant_columns(X.bronze(spark, sf), [*X.SENSORS, "line_id"])


@query("h12_label_balance", with_("staged", body="""SELECT label_numeric, n, round(n::DOUBLE / min(n) OVER (), 6) AS ratio
  FROM (SELECT label_numeric, count(*) AS n FROM staged GROUP BY ALL)"""))
def h12(spark, sf):
    return rounded(P.label_balance(staged(spark, sf), "label_numeric"))


@query("h13_iqr_outliers", """SELECT "column", round(q1, 6) AS q1, round(q3, 6) AS q3,
    count(*) FILTER (WHERE v < q1 - 1.5::DOUBLE * (q3 - q1) OR v > q3 + 1.5::DOUBLE * (q3 - q1)) AS outliers,
    round(count(*) FILTER (WHERE v < q1 - 1.5::DOUBLE * (q3 - q1) OR v > q3 + 1.5::DOUBLE * (q3 - q1))::DOUBLE / count(*) * 100, 2) AS percent
  FROM (UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
        ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME "column" VALUE v)
  JOIN (SELECT "column", quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3
        FROM (UNPIVOT (SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)
              ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME "column" VALUE v) GROUP BY 1) USING ("column")
  GROUP BY "column", q1, q3""")
def h13(spark, sf):
    o = P.iqr_outliers(X.table(spark, sf, "lineitem"), NUMBERS)
    return o.withColumns({c: C.rounded(F.col(c), 6) for c in ("q1", "q3")})


@query("h14_time_span", """SELECT min(ts) AS earliest, max(ts) AS latest, count(DISTINCT ts::DATE) AS days,
  CAST(floor(epoch(max(ts)) - epoch(min(ts))) AS BIGINT) AS span_seconds FROM events""")
def h14(spark, sf):
    return P.time_span(X.table(spark, sf, "events"), "ts")


@query("h16_histogram", with_("staged", body=f"""SELECT source, bin, count(*) AS n FROM (
    SELECT CASE WHEN process_timestamp < TIMESTAMP '{SPLIT}' THEN 'Baseline' ELSE 'Generated' END AS source,
      CAST(least(floor((s59 - min(s59) OVER ()) / ((max(s59) OVER () - min(s59) OVER ()) / 50)), 49) AS BIGINT) AS bin
    FROM staged WHERE s59 IS NOT NULL) GROUP BY ALL"""))
def h16_hist(spark, sf):
    base, batch = _parts(spark, sf)
    return D.histogram(base.select(F.col("s59").alias("val")), batch.select(F.col("s59").alias("val")))


@query("h16_density", with_("staged", body=f"""SELECT source, point, round(any_value(lo + point * (hi - lo) / 500), 6) AS x,
    round(sum(exp(-0.5::DOUBLE * power((lo + point * (hi - lo) / 500 - v) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6) AS density
  FROM (SELECT source, v, min(v) OVER w AS lo, max(v) OVER w AS hi, count(*) OVER w AS n,
          stddev_samp(v) OVER w * power(count(*) OVER w, -0.2::DOUBLE) AS h
        FROM (SELECT CASE WHEN process_timestamp < TIMESTAMP '{SPLIT}' THEN 'Baseline' ELSE 'Generated' END AS source, s424 AS v
              FROM staged WHERE s424 IS NOT NULL) WINDOW w AS (PARTITION BY source)),
    (SELECT CAST(range AS INTEGER) AS point FROM range(500))
  GROUP BY source, point"""))
def h16_density(spark, sf):
    base, batch = _parts(spark, sf)
    return rounded(D.density(base.select(F.col("s424").alias("val")), batch.select(F.col("s424").alias("val"))))


SPLIT_SQL = """SELECT observation_id, CASE WHEN (process_timestamp, observation_id) >=
    (SELECT (process_timestamp, observation_id) FROM (SELECT process_timestamp, observation_id,
       row_number() OVER (ORDER BY process_timestamp DESC, observation_id DESC) AS back FROM staged WHERE label_numeric = 1)
     WHERE back = (SELECT CAST(floor(count(*) * 0.2::DOUBLE) AS BIGINT) FROM staged WHERE label_numeric = 1))
  THEN 'test' ELSE 'train' END AS part FROM staged"""


@query("h17_time_split", with_("staged", body=SPLIT_SQL))
def h17(spark, sf):
    return P.time_split(staged(spark, sf), "label_numeric", ["process_timestamp", "observation_id"]).select(
        "observation_id", "part")


@query("f13_failures_from_end", with_("staged", body="""SELECT observation_id, row_number() OVER (ORDER BY process_timestamp DESC, observation_id DESC) AS seq
  FROM staged WHERE label_numeric = 1"""))
def f13(spark, sf):
    f = failing(staged(spark, sf)).select("observation_id", "process_timestamp", F.lit(0).alias("all"))
    return positions(f, ["all"], [F.desc("process_timestamp"), F.desc("observation_id")]).select("observation_id", "seq")


@query("h18_feature_importance")
def h18(spark, sf):
    s = staged(spark, sf).filter("label_numeric <> 0").withColumns({
        "label": C.binary_label(F.col("label_numeric")), "month": F.month("process_timestamp"),
        "hour": F.hour("process_timestamp")})
    train = P.time_split(s, "label", ["process_timestamp", "observation_id"]).filter("part = 'train'")
    return P.importance(train, [*X.SENSORS, "month", "hour"], "label")


@query("h19_silver_contract", with_("silver", body="""SELECT rule, failures, failures = 0 AS passed FROM (
  SELECT 'unique(observation_id)' AS rule, count(*) - count(DISTINCT observation_id) AS failures FROM silver
  UNION ALL SELECT 'not_null(observation_id)', count(*) FILTER (WHERE observation_id IS NULL) FROM silver
  UNION ALL SELECT 'accepted_values(wafer_status)', count(*) FILTER (WHERE wafer_status NOT IN ('Pass', 'Fail', 'Unknown')) FROM silver)"""))
def h19(spark, sf):
    return Q.check(silver(spark, sf), Q.SILVER_RULES)


@query("h19_daily_contract", with_("daily", body="""SELECT rule, failures, failures = 0 AS passed FROM (
  SELECT 'unique(process_date,line_id)' AS rule, count(*) - count(DISTINCT (process_date, line_id)) AS failures FROM daily
  UNION ALL SELECT 'not_null(process_date)', count(*) FILTER (WHERE process_date IS NULL) FROM daily
  UNION ALL SELECT 'between(yield_percentage)', count(*) FILTER (WHERE yield_percentage NOT BETWEEN 0 AND 100) FROM daily
  UNION ALL SELECT 'not_null(total_wafers_tested)', count(*) FILTER (WHERE total_wafers_tested IS NULL) FROM daily)"""))
def h19_daily(spark, sf):
    return Q.check(gold(spark, sf, "daily"), Q.DAILY_RULES)


@query("h19_broken_contract", """SELECT rule, failures, failures = 0 AS passed FROM (
  SELECT 'unique(l_orderkey,l_linenumber)' AS rule, (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS failures
  UNION ALL SELECT 'between(l_quantity)', (SELECT count(*) FROM lineitem WHERE l_quantity > 40)
  UNION ALL SELECT 'accepted_values(l_returnflag)', (SELECT count(*) FROM lineitem WHERE l_returnflag = 'N'))""")
def h19_broken(spark, sf):
    return Q.check(X.table(spark, sf, "lineitem"), [
        Q.unique("l_orderkey", "l_linenumber"), Q.between("l_quantity", 0, 40), Q.accepted_values("l_returnflag", "A", "R")])


@query("h20_scatter_sample", with_("silver", body="""SELECT observation_id, wafer_status, s59, s424 FROM silver
  ORDER BY md5('0|' || CAST(observation_id AS VARCHAR)), observation_id LIMIT 1000"""))
def h20(spark, sf):
    return stats.scatter_sample(silver(spark, sf), ["s59", "s424"])


@query("h21_box_stats", with_("silver", body="""SELECT wafer_status, count(*) AS n, round(min(s424), 6) AS lowest, round(quantile_cont(s424, 0.25), 6) AS q1,
  round(quantile_cont(s424, 0.5), 6) AS median, round(quantile_cont(s424, 0.75), 6) AS q3, round(max(s424), 6) AS highest
  FROM silver WHERE s424 IS NOT NULL GROUP BY wafer_status"""))
def h21(spark, sf):
    return rounded(stats.box_stats(silver(spark, sf), "s424"))
