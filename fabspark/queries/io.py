"""Sources, sinks, event log, augmentation and streams (groups A, L, N and E-24, E-25, C-7, F-12)."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fabspark.functions import columns as C
from fabspark.functions import schemas
from fabspark.operators import augment, spc
from fabspark.operators.reshape import to_long
from fabspark.plans import fixtures as X
from fabspark.plans.refresh import Setup, refresh, refresh_days
from fabspark.queries.common import cols, r, rounded
from fabspark.queries.registry import BARE, LONG_KEYS, PARTS, gold, long, query, silver, with_
from fabspark.queries.statistics import PARETO
from fabspark.session import new_path, shared_dir
from fabspark.sources import events as E
from fabspark.sources import files, tables
from fabspark.sources.lake import Lake
from fabspark.streaming import intake
from fabspark.streaming import spc as stream

SETUP = dict(sensors=X.SENSORS, monitored=X.SENSORS, ranked=X.SENSORS, max_missing=X.MAX_MISSING, prefix="s")
KEY = T.StructField("observation_id", T.LongType())
LANDING = T.StructType([KEY, *schemas.landing_schema(X.SENSORS).fields])


def _batch(spark, sf):
    """Observations as a landing batch, generated at test time."""
    return X.bronze(spark, sf).withColumns({
        "is_synthetic": F.lit(True), "generation_timestamp": F.col("Time").cast("timestamp"),
        "applied_drift_features": F.lit('{"s59": 0.5}')})


def _landing(spark, sf):
    base = new_path(spark, "landing")
    files.write_landing(_batch(spark, sf), base)
    return base


@query("a1_raw_csv", with_("bronze", body="""SELECT process_timestamp AS "Time", s59, s103, s511, s424, s158,
  label_numeric AS "Pass/Fail" FROM bronze"""))
def a1(spark, sf):
    path = new_path(spark, "csv")
    b = X.bronze(spark, sf).select("Time", *X.SENSORS, "`Pass/Fail`")
    b.withColumn("s424", F.coalesce(F.col("s424").cast("string"), F.lit("NaN"))).write.option("header", True).option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    return files.read_raw_csv(spark, path, X.SENSORS)


DAYKEYS = "line_id, strftime(process_timestamp, '%Y') AS year, strftime(process_timestamp, '%m') AS month, strftime(process_timestamp, '%d') AS day"


@query("a2_landing_scan", with_("bronze", body=f"SELECT observation_id, {DAYKEYS}, s511 FROM bronze"))
def a2(spark, sf):
    base = _landing(spark, sf)
    return files.read_landing(spark, [base], base, LANDING).select("observation_id", "line_id", "year", "month", "day", "s511")


@query("a3_path_list_scan", with_("bronze", body="SELECT observation_id, line_id FROM bronze"))
def a3(spark, sf):
    base = _landing(spark, sf)
    b = X.bronze(spark, sf).select("line_id").distinct()  # one row per line
    listed = ",".join(f"{base}/line_id={r.line_id}" for r in b.collect())
    return files.read_paths(spark, listed, base, LANDING).select("observation_id", "line_id")


@query("a4_source_file", with_("bronze", body="SELECT observation_id, line_id AS file_line FROM bronze"))
def a4(spark, sf):
    base = _landing(spark, sf)
    d = files.with_source_file(files.read_landing(spark, [base], base, LANDING))
    return d.select("observation_id", F.regexp_extract("source_file", "line_id=([^/]+)/", 1).alias("file_line"))


@query("a5_conform", with_("bronze", body="SELECT line_id, observation_id, CAST(label_numeric AS BIGINT) AS label FROM bronze"))
def a5(spark, sf):
    rough = X.bronze(spark, sf).select(C.col("Pass/Fail").cast("int").alias("label"), "observation_id", "line_id", "shift")
    return files.conform(rough, T.StructType([T.StructField("line_id", T.StringType()), KEY, T.StructField("label", T.LongType())]))


@query("a6_ingest_meta", with_("bronze", body="SELECT observation_id, '0.1.0' AS pipeline_version, true AS stamped FROM bronze"))
def a6(spark, sf):
    m = files.with_ingest_meta(X.bronze(spark, sf), "0.1.0")
    return m.select("observation_id", "pipeline_version", F.col("ingestion_timestamp").isNotNull().alias("stamped"))


@query("a7_append_bronze", with_("bronze", body="SELECT observation_id, line_id, s424 FROM bronze"))
def a7(spark, sf):
    db = "bronze_" + uuid.uuid4().hex[:12]
    b = X.bronze(spark, sf).withColumnRenamed("Pass/Fail", "label")
    early = F.coalesce(F.col("Time") < F.lit("2024-01-15").cast("timestamp_ntz"), F.lit(True))
    for part in (b.filter(early), b.filter(~early)):
        tables.append_bronze(part, f"{db}.wafers", f"{shared_dir(spark)}/{db}")
    return spark.table(f"{db}.wafers").select("observation_id", "line_id", "s424")


@query("a8_landing_write", with_("bronze", body=f"SELECT {DAYKEYS}, count(*) AS wafers FROM bronze GROUP BY ALL"))
def a8(spark, sf):
    base = _landing(spark, sf)
    return files.read_landing(spark, [base], base, LANDING).groupBy("line_id", "year", "month", "day").agg(
        F.count(F.lit(1)).alias("wafers"))


@query("a9_materialize", with_("daily", body="SELECT process_date, line_id, yield_percentage FROM daily"))
def a9(spark, sf):
    db = "gold_" + uuid.uuid4().hex[:12]
    t = tables.materialize(gold(spark, sf, "daily"), f"{db}.daily", ["process_date"], f"{shared_dir(spark)}/{db}")
    return t.select("process_date", "line_id", "yield_percentage")


@query("a11_adhoc_sql", with_("daily", body="""SELECT line_id, count(*) AS days, CAST(sum(failed_wafers) AS BIGINT) AS failed
  FROM daily GROUP BY line_id"""))
def a11(spark, sf):
    return tables.sql(spark, "SELECT line_id, count(*) AS days, sum(failed_wafers) AS failed FROM {daily} GROUP BY line_id",
                      daily=gold(spark, sf, "daily"))


FILES = """(SELECT observation_id, line_id, 'line_id=' || line_id || '/batch_' || strftime(process_timestamp, '%Y%m%d%H') || '.parquet' AS source_file
  FROM bronze)"""


@query("a12_latest_batch", with_("bronze", body=f"""SELECT * FROM {FILES} QUALIFY dense_rank() OVER (PARTITION BY line_id ORDER BY source_file DESC) = 2"""))
def a12(spark, sf):
    return E.latest_batch(X.batched(X.bronze(spark, sf)), offset=1).select("observation_id", "line_id", "source_file")


@query("a12_latest_batch_of_line", with_("bronze", body=f"""SELECT * FROM {FILES} WHERE line_id = 'LINE_B'
  QUALIFY dense_rank() OVER (ORDER BY source_file DESC) = 1"""))
def a12_line(spark, sf):
    return E.latest_batch(X.batched(X.bronze(spark, sf)), "LINE_B").select("observation_id", "line_id", "source_file")


@query("c7_latest_of_all_lines", with_("bronze", body=f"""SELECT line_id, count(*) AS wafers FROM (SELECT * FROM {FILES}
  QUALIFY dense_rank() OVER (PARTITION BY line_id ORDER BY source_file DESC) = 1) GROUP BY line_id"""))
def c7(spark, sf):
    return E.latest_batch(X.batched(X.bronze(spark, sf))).groupBy("line_id").agg(F.count(F.lit(1)).alias("wafers"))


def _log(spark, sf):
    return X.table(spark, sf, "events").select(
        F.col("event_id").alias("id"), X.line_of().alias("line_id"), "event_type", F.col("props").alias("payload"), "ts")


@query("a13_events_window", """SELECT event_id AS id, event_type, ts, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events
  WHERE user_id % 3 = 1 AND ts >= (SELECT max(ts) FROM events) - INTERVAL 48 HOUR""")
def a13(spark, sf):
    e = E.events_window(_log(spark, sf), 48, "LINE_B")
    return e.select("id", "event_type", "ts", F.from_json("payload", "k BIGINT")["k"].alias("k"))


@query("i2_newest_events", """SELECT event_id AS id, event_type, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOUR
  ORDER BY ts DESC, event_id DESC LIMIT 200""")
def i2_events(spark, sf):
    return E.events_window(_log(spark, sf), 24).limit(200).select("id", "event_type", "ts")


@query("a14_log_append", "SELECT event_type, count(*) AS n FROM events GROUP BY ALL")
def a14(spark, sf):
    path, log = new_path(spark, "log"), _log(spark, sf)
    faults = F.col("event_type") == "error"
    E.log_event(log.filter(faults), path)
    E.log_event(log.filter(~faults), path)
    return spark.read.schema(schemas.EVENT_LOG).parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("e24_event_summary", """SELECT count(*) FILTER (WHERE event_type = 'purchase') AS batches, count(*) FILTER (WHERE event_type = 'error') AS faults,
  count(DISTINCT user_id % 3) FILTER (WHERE event_type = 'purchase') AS active_lines FROM events""")
def e24(spark, sf):
    return E.event_summary(_log(spark, sf), "purchase", "error")


@query("e24_batches_per_line", """SELECT 'LINE_' || substr('ABC', CAST(user_id % 3 AS INTEGER) + 1, 1) AS line_id, count(*) AS batches
  FROM events WHERE event_type = 'purchase' GROUP BY ALL""")
def e24_line(spark, sf):
    return E.batches_per_line(_log(spark, sf), "purchase")


@query("e25_batch_details", with_("bronze", body="""SELECT line_id, count(*) AS wafers, strftime(max(process_timestamp), '%Y-%m-%d %H:%M:%S') AS generated_at,
  '{"s59": 0.5}' AS active_drift FROM bronze GROUP BY line_id"""))
def e25(spark, sf):
    return E.batch_details(_batch(spark, sf)).withColumn("generated_at", F.date_format("generated_at", "yyyy-MM-dd HH:mm:ss"))


@query("n1_sigma_shift", with_("bronze", body="""SELECT observation_id, round(s59 + 2 * (SELECT stddev_samp(s59) FROM bronze), 6) AS s59,
  round(s424 - 0.5::DOUBLE * (SELECT stddev_samp(s424) FROM bronze), 6) AS s424 FROM bronze"""))
def n1(spark, sf):
    return rounded(augment.sigma_shift(X.bronze(spark, sf), {"s59": 2, "s424": -0.5, "absent": 1}).select("observation_id", "s59", "s424"))


@query("n2_jitter")
def n2(spark, sf):
    return augment.jitter(X.bronze(spark, sf), X.SENSORS, 0.01, "observation_id").select("observation_id", *X.SENSORS)


@query("n2_jitter_keeps_gaps", with_("bronze", body="""SELECT observation_id, s511 IS NULL AS gap511, s424 IS NULL AS gap424, s158 FROM bronze"""))
def n2_gaps(spark, sf):
    j = augment.jitter(X.bronze(spark, sf), X.SENSORS, 0.01, "observation_id")
    return j.select("observation_id", F.col("s511").isNull().alias("gap511"), F.col("s424").isNull().alias("gap424"), "s158")


@query("n3_replay", with_("bronze", body="""SELECT b.block, observation_id, process_timestamp + to_years(CAST((25 + b.block + 1) // d.n AS INTEGER)) AS "Time"
  FROM (SELECT *, dense_rank() OVER (ORDER BY process_timestamp::DATE) - 1 AS day_no FROM bronze),
    (SELECT count(DISTINCT process_timestamp::DATE) AS n FROM bronze) d, (SELECT range AS block FROM range(8)) b
  WHERE day_no = (25 + b.block) % d.n"""))
def n3(spark, sf):
    return augment.replay(X.bronze(spark, sf), 25, 8).select("block", "observation_id", "Time")


@query("f12_day_index", with_("bronze", body="""SELECT process_timestamp::DATE AS block_date, CAST(row_number() OVER (ORDER BY process_timestamp::DATE) - 1 AS INTEGER) AS day_no
  FROM bronze GROUP BY 1"""))
def f12(spark, sf):
    return augment.day_index(X.bronze(spark, sf))


@query("n4_sample_n", with_("bronze", body="""SELECT observation_id, process_timestamp AS "Time" FROM bronze
  ORDER BY md5('7|' || CAST(observation_id AS VARCHAR)), observation_id LIMIT 25"""))
def n4(spark, sf):
    return augment.sample_n(X.bronze(spark, sf), 25, "observation_id", seed=7).select("observation_id", "Time")


@query("n5_enrich_batch", with_("bronze", body="""SELECT observation_id, 'LINE_A' AS line_id, 'TST-09' AS tester_id, 'LINE_A-LOT-00042' AS lot_id, true AS is_synthetic,
  '{"s59": 1.5}' AS applied_drift_features, (SELECT arg_min(shift, process_timestamp) FROM bronze) AS shift FROM bronze"""))
def n5(spark, sf):
    line = augment.LineSetup("LINE_A", "TST-09", 42, {"s59": 1.5})
    return augment.enrich_batch(X.bronze(spark, sf), line).select(
        "observation_id", "line_id", "tester_id", "lot_id", "is_synthetic", "applied_drift_features", "shift")


# Streams

def _messages(spark, sf):
    """One announcement per line and hour, as JSON text."""
    b = X.batched(X.bronze(spark, sf)).groupBy("source_file", "line_id").agg(
        F.count(F.lit(1)).alias("batch_size"), F.max("Time").alias("t"))
    return b.select(F.to_json(F.struct(
        F.lit("TEST_COMPLETED").alias("event_type"), F.concat(F.lit("s3://"), "source_file").alias("file_path"),
        "batch_size", "line_id", F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss").alias("generation_timestamp"),
        F.create_map(F.lit("s59"), F.lit(0.5)).alias("applied_drift_features"))).alias("value"))


MSG = f"SELECT source_file AS file_path, line_id, count(*) AS batch_size FROM {FILES} GROUP BY ALL"


@query("l4_parse_events", with_("bronze", body=MSG))
def l4(spark, sf):
    return E.parse_events(_messages(spark, sf)).select("file_path", "line_id", "batch_size")


@query("l3_redelivered_messages", with_("bronze", body=MSG))
def l3(spark, sf):
    path, out = new_path(spark, "messages"), new_path(spark, "accepted")
    m = _messages(spark, sf)
    old = F.get_json_object("value", "$.generation_timestamp") < "2024-01-20"
    m.filter(~old).write.text(path)
    m.filter(old).write.mode("append").text(path)  # announced days late
    m.write.mode("append").text(path)  # every message is delivered again
    position = new_path(spark, "position")

    def work(batch, i):
        run = tables.run_id(spark, position)
        tables.overwrite_batch(intake.accept(batch, f"{out}-state", run, i), out, run, i)

    intake.start(intake.stream_messages(spark, path, max_files=4), work, position).awaitTermination()
    return spark.read.parquet(out).select("file_path", "line_id", "batch_size")


@query("l4_rejected_messages", with_("bronze", body=f"""SELECT 'no file' AS message, count(*) AS n FROM ({MSG}) UNION ALL
  SELECT 'not json', count(*) FROM ({MSG}) UNION ALL SELECT 'accepted', count(*) FROM ({MSG})"""))
def l4_rejected(spark, sf):
    """Per announcement one message without a path and one that is no JSON; times cannot be read either."""
    path, root, position = new_path(spark, "messages"), new_path(spark, "intake"), new_path(spark, "position")
    m = _messages(spark, sf)
    bad_time = F.regexp_replace("value", '"generation_timestamp":"[^"]*"', '"generation_timestamp":"not a time"')
    m.select(bad_time.alias("value")).union(m.select(F.regexp_replace("value", '"file_path":"[^"]*",', ""))) \
        .union(m.select(F.concat(F.lit("not json "), F.col("value")))).write.text(path)

    def work(batch, i):
        intake.accept(batch, root, tables.run_id(spark, position), i)

    intake.start(intake.stream_messages(spark, path), work, position).awaitTermination()
    kind = F.when(F.col("message").startswith("not json"), "not json").otherwise("no file")
    bad = spark.read.schema("message string").parquet(f"{root}/rejected").groupBy(kind.alias("message")).agg(F.count("*").alias("n"))
    good = spark.read.schema("file_path string").parquet(f"{root}/accepted").agg(F.count("*").alias("n"))
    return bad.unionByName(good.select(F.lit("accepted").alias("message"), "n"))


@query("l5_message_driven", with_("bronze", body="""SELECT observation_id, line_id, s424, '0.1.0' AS pipeline_version FROM bronze"""))
def l5_messages(spark, sf):
    """Every landing file announced twice, under two schemes; bronze has each row once."""
    base, root, bronze = _landing(spark, sf), new_path(spark, "intake"), new_path(spark, "bronze")
    path, position = new_path(spark, "messages"), new_path(spark, "position")
    landed = files.with_source_file(files.read_landing(spark, [base], base, LANDING)).select("source_file").distinct()
    name = F.regexp_extract("source_file", "(line_id=.*)$", 1)
    for scheme in ("s3://", "s3a://"):
        landed.select(F.to_json(F.struct(F.concat(F.lit(scheme), name).alias("file_path"))).alias("value")) \
            .coalesce(2).write.mode("append").text(path)
    intake.ingest_messages(intake.stream_messages(spark, path, max_files=2), root, bronze, base, LANDING, position, "0.1.0") \
        .awaitTermination()
    return spark.read.parquet(bronze).select("observation_id", "line_id", "s424", "pipeline_version")


@query("l5_second_checkpoint", with_("bronze", body="SELECT observation_id, line_id FROM bronze"))
def l5_second(spark, sf):
    """Two streams with checkpoints of their own append to one bronze table."""
    out, b = new_path(spark, "bronze"), _batch(spark, sf)
    for half in (F.col("observation_id") % 2 == 0, F.col("observation_id") % 2 != 0):
        base = new_path(spark, "landing")
        files.write_landing(b.filter(half), base)
        intake.ingest(intake.stream_landing(spark, base, LANDING, max_files=40), out, new_path(spark, "position"), "0.1.0") \
            .awaitTermination()
    return spark.read.parquet(out).select("observation_id", "line_id")


def _ingested(spark, sf, after=None):
    base, out = _landing(spark, sf), new_path(spark, "bronze")
    s = intake.stream_landing(spark, base, LANDING, max_files=20)
    intake.ingest(s, out, new_path(spark, "position"), "0.1.0", after).awaitTermination()
    return spark.read.parquet(out)


@query("l1_file_intake", with_("bronze", body="SELECT line_id, process_timestamp::DATE AS process_date, count(*) AS wafers FROM bronze GROUP BY ALL"))
def l1(spark, sf):
    return _ingested(spark, sf).groupBy("line_id", F.to_date("Time").alias("process_date")).agg(F.count(F.lit(1)).alias("wafers"))


@query("l5_stream_to_bronze", with_("bronze", body="""SELECT observation_id, process_timestamp AS "Time", line_id, s424, '0.1.0' AS pipeline_version,
  line_id AS file_line FROM bronze"""))
def l5(spark, sf):
    return _ingested(spark, sf).select("observation_id", "Time", "line_id", "s424", "pipeline_version",
                                       F.regexp_extract("source_file", "line_id=([^/]+)/", 1).alias("file_line"))


@query("l6_refresh", with_("viol", body="SELECT rule_number, sensor_id, count(*) AS n FROM viol GROUP BY ALL"))
def l6(spark, sf):
    t = refresh(X.bronze(spark, sf), new_path(spark, "lake"), Setup(**SETUP, key=F.col("observation_id")))
    return t["violations"].groupBy("rule_number", "sensor_id").agg(F.count(F.lit(1)).alias("n"))


#: Rows and a sum that depends on every row, of all eight tables.
DIGESTS = {
    "reporting": ("silver", "missing_sensor_count"), "quarantine": ("quar", "missing_sensor_count"),
    "daily": ("daily", "yield_percentage"), "shifts": ("shifts", "yield_pct + avg_missing_sensors"),
    "oee": ("oee", "oee_pct + total_lots"), "limits": ("limits", "mu + sigma + usl"),
    "violations": ("viol", "rule_number * (observation_id % 97)"), "pareto": (f"({PARETO})", "correlation + sample_size")}
LAKE_SQL = with_("quar", "daily", "oee", "viol", body=" UNION ALL ".join(
    f"SELECT '{name}' AS name, count(*) AS n, round(coalesce(sum(CAST({value} AS DOUBLE)), 0), 4) AS total FROM {source} AS t"
    for name, (source, value) in DIGESTS.items()))
#: The same over rows of which every 20th has no time; such rows come first in a series.
UNTIMED_SQL = LAKE_SQL.replace("ts AS process_timestamp", "CASE WHEN event_id % 20 <> 0 THEN ts END AS process_timestamp").replace(
    PARTS["points"], PARTS["points"].replace("ORDER BY process_timestamp,", "ORDER BY process_timestamp NULLS FIRST,"))


def _in_three_intakes(spark, bronze):
    """All tables after a rebuild and two intakes: recent rows, then rows of early days."""
    root, setup = new_path(spark, "lake"), Setup(**SETUP, key=F.col("observation_id"))
    day, n = F.to_date("Time"), F.col("observation_id")
    recent = F.coalesce((day >= F.lit("2024-01-20").cast("date")) & (n % 2 == 0), n % 3 == 0)
    early = ~recent & F.coalesce((day <= F.lit("2024-01-03").cast("date")) & (n % 5 == 0), n % 3 == 1)
    refresh(bronze.filter(~recent & ~early), root, setup)
    refresh_days(bronze.filter(~early), bronze.filter(recent), root, setup)
    t = refresh_days(bronze, bronze.filter(early), root, setup)
    parts = [t[name].agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), C.rounded(F.coalesce(F.sum(
        F.expr(value).cast("double")), F.lit(0.0)), 4).alias("total")) for name, (_, value) in DIGESTS.items()]
    return reduce(DataFrame.unionByName, parts)


@query("l6_refresh_changed_days", LAKE_SQL)
def l6_days(spark, sf):
    return _in_three_intakes(spark, X.bronze(spark, sf))


@query("l6_refresh_untimed_rows", UNTIMED_SQL)
def l6_untimed(spark, sf):
    return _in_three_intakes(spark, X.bronze(spark, sf).withColumn(
        "Time", F.when(F.col("observation_id") % 20 != 0, F.col("Time"))))


@query("g1_baseline_untimed_rows", with_("limits", body=f"SELECT line_id, tester_id, sensor_id, {cols('mu', 'sigma', 'usl', 'lsl')} FROM limits")
       .replace("ts AS process_timestamp", "CASE WHEN event_id % 20 <> 0 THEN ts END AS process_timestamp"))
def g1_untimed(spark, sf):
    rows = long(spark, sf, BARE).withColumn("process_timestamp", F.when(F.col("observation_id") % 20 != 0, F.col("process_timestamp")))
    return rounded(spc.baseline(rows).select("line_id", "tester_id", "sensor_id", "mu", "sigma", "usl", "lsl"))


@query("a9_lake_versions", with_("daily", body="""SELECT 1 AS version, process_date, line_id, total_wafers_tested FROM daily
  WHERE process_date < DATE '2024-01-15' UNION ALL SELECT 2, process_date, line_id, total_wafers_tested FROM daily"""))
def a9_versions(spark, sf):
    """A reader of the first version keeps it while a second one is published."""
    root, rows = new_path(spark, "lake"), gold(spark, sf, "daily")
    early = F.col("process_date") < F.lit("2024-01-15").cast("date")
    c = Lake(spark, root).change()
    c.put("daily", rows.filter(early), "process_date")
    reader = c.publish().read("daily").withColumn("version", F.lit(1))
    late = rows.filter(~early)
    c = Lake(spark, root).change()
    c.put("daily", late, "process_date", [r[0] for r in late.select("process_date").distinct().collect()])
    now = c.publish().read("daily").withColumn("version", F.lit(2))
    return reader.unionByName(now).select("version", "process_date", "line_id", "total_wafers_tested")


@query("l7_stream_spc", with_("viol", body="SELECT observation_id, sensor_id, rule_number, z_score FROM viol"))
def l7(spark, sf):
    base, root = new_path(spark, "readings"), new_path(spark, "spc")
    s, files_each = silver(spark, sf), 4
    t = F.col("process_timestamp")
    early, late = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-11", "2024-01-21"))
    for part in (s.filter(F.coalesce(t < early, F.lit(True))), s.filter((t >= early) & (t < late)), s.filter(t >= late)):
        part.repartition(files_each).write.mode("append").parquet(base)
    rows = spark.readStream.schema(s.schema).option("maxFilesPerTrigger", files_each).parquet(base)
    stream.stream_spc(to_long(rows, X.SENSORS, LONG_KEYS, "s"), gold(spark, sf, "limits"), root,
                      new_path(spark, "position")).awaitTermination()
    return spark.read.parquet(f"{root}/violations").select("observation_id", "sensor_id", "rule_number", "z_score")
