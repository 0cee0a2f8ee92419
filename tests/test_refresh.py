"""All tables after intakes equal a full rebuild; versions, audit columns, messages that announce missing files."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from fabspark.operators import spc, stats
from fabspark.operators.reshape import to_long
from fabspark.plans import fixtures as X
from fabspark.plans.refresh import STAMPS, TABLES, Setup, refresh, refresh_days
from fabspark.session import new_path
from fabspark.sources.lake import Lake
from fabspark.streaming import intake

SENSORS = ["s1", "s2", "s3"]
def setup():
    return Setup(SENSORS, SENSORS, SENSORS, 2, "s", F.col("observation_id"))


SCHEMA = ("observation_id long, Time timestamp_ntz, line_id string, tester_id string, shift string, lot_id string, "
          "`Pass/Fail` long, s1 double, s2 double, s3 double")


def wafers(seed, n=1500, untimed=0.1):
    random.seed(seed)
    rows = []
    for i in range(n):
        t = None if random.random() < untimed else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=random.randint(0, 20 * 1440))
        value = lambda: None if random.random() < 0.1 else round(random.gauss(10, 2), 3)
        line = random.choice(["LINE_A", "LINE_B", None])
        rows.append((i, t, line, random.choice(["T1", "T1", "T2"]), random.choice(["Day", "Night"]), f"L{i % 9}",
                     random.choice([-1, -1, 1]), value(), 4.0 if line == "LINE_B" else value(), value()))
    return rows


def plain(df, name):
    """Rows without stamps, doubles to nine digits, in a fixed order."""
    cols = sorted(c for c in df.columns if c != STAMPS[name][0])
    return sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.select(*[f"`{c}`" for c in cols]).collect())


@pytest.mark.parametrize("seed", [1])
def test_intakes_equal_a_full_rebuild(spark, seed):
    rows = wafers(seed)
    random.seed(seed)
    batch = {r[0]: random.choice([0, 0, 0, 1, 2]) if r[1] is None or r[1].day in (3, 4, 17, 20) else 0 for r in rows}
    root, full = new_path(spark, "lake"), new_path(spark, "full")
    frames = [spark.createDataFrame([r for r in rows if batch[r[0]] <= k], SCHEMA) for k in range(3)]
    refresh(frames[0], root, setup())
    for k in (1, 2):
        new = spark.createDataFrame([r for r in rows if batch[r[0]] == k], SCHEMA)
        got = refresh_days(frames[k], new, root, setup())
    want = refresh(frames[2], full, setup())
    for name in TABLES:
        assert plain(got[name], name) == plain(want[name], name), name
        assert got[name].filter(F.col(STAMPS[name][0]).isNull()).count() == 0
    assert want["violations"].count() > 0 and want["limits"].count() > 0
    assert Lake(spark, root).versions() == [1, 2, 3]


def test_first_intake_builds_everything_and_an_empty_one_nothing(spark):
    df, root = spark.createDataFrame(wafers(3, 200), SCHEMA), new_path(spark, "lake")
    assert refresh_days(df, df, root, setup())["daily"].count() > 0
    refresh_days(df, df.limit(0), root, setup())
    assert Lake(spark, root).versions() == [1]


def test_empty_bronze_gives_empty_tables(spark):
    t = refresh(spark.createDataFrame([], SCHEMA), new_path(spark, "lake"), setup())
    assert all(t[name].count() == 0 for name in TABLES)


def test_readers_keep_their_version(spark):
    root = new_path(spark, "lake")
    one = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, p string")

    def put(df, **how):
        c = Lake(spark, root).change()
        c.put("t", df, "p", **how)
        before = Lake(spark, root).tables  # a reader between write and publish sees nothing of it
        return c.publish(), before

    put(one)
    reader = Lake(spark, root).read("t")
    _, before = put(spark.createDataFrame([(9, "b"), (8, None)], "n int, p string"), replace=["b", None])
    assert set(before["t"]["parts"]) == {"p=a", "p=b", "p=__HIVE_DEFAULT_PARTITION__"}
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(reader) == rows(one)
    assert rows(Lake(spark, root).read("t")) == [(1, "a"), (8, None), (9, "b")]
    assert rows(Lake(spark, root, 1).read("t")) == rows(one)
    put(spark.createDataFrame([], "n int, p string"), replace=["a"])
    assert rows(Lake(spark, root).read("t")) == [(8, None), (9, "b")]
    Lake(spark, root).vacuum(keep=1)
    assert Lake(spark, root).versions() == [3] and rows(Lake(spark, root).read("t")) == [(8, None), (9, "b")]


def test_two_writers_of_one_version(spark):
    root = new_path(spark, "lake")
    a, b = Lake(spark, root).change(), Lake(spark, root).change()
    for c in (a, b):
        c.put("t", spark.range(2))
    a.publish()
    with pytest.raises(RuntimeError):
        b.publish()


def test_baseline_ignores_readings_without_time(spark):
    rows = wafers(4, 1500, untimed=0.3)
    long = lambda some: to_long(spark.createDataFrame(some, SCHEMA).withColumnRenamed("Time", "process_timestamp"), SENSORS,
                                ["observation_id", "process_timestamp", "line_id", "tester_id"], "s")
    order = ["line_id", "tester_id", "sensor_id"]
    got = spc.baseline(long(rows)).orderBy(*order).collect()
    assert got and got == spc.baseline(long([r for r in rows if r[1]])).orderBy(*order).collect()
    assert spc.screened(long(rows), ["sensor_id"], 100).count() == 3


def test_first_readings_of_parts_merge(spark):
    long = to_long(spark.createDataFrame(wafers(5), SCHEMA).withColumnRenamed("Time", "process_timestamp"), SENSORS,
                   ["observation_id", "process_timestamp", "line_id", "tester_id"], "s")
    whole = spc.first_readings(long)
    odd = F.col("observation_id") % 2 == 1
    parts = spc.merged_first(spc.first_readings(long.filter(odd)), spc.first_readings(long.filter(~odd)))
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))


def test_pareto_from_moments_of_parts(spark):
    df = X.bronze(spark, "/root/testdata/sf0.001").withColumn("label_numeric", F.col("Pass/Fail")).withColumn("day", F.to_date("Time"))
    df = df.withColumn("s59", F.col("s59") + 1e6)  # means far from the spread
    want = stats.pareto(df, X.SENSORS, prefix="s").orderBy("rank").collect()
    assert want == stats.pareto_of(stats.label_moments(df, X.SENSORS, "day", prefix="s")).orderBy("rank").collect()


def test_announced_files_that_are_missing(spark):
    base, root, bronze = (new_path(spark, n) for n in ("landing", "intake", "bronze"))
    path, position = new_path(spark, "messages"), new_path(spark, "position")
    from fabspark.queries.io import LANDING
    day = f"{base}/line_id=LINE_A/year=2024/month=01/day=01"
    batch = X.bronze(spark, "/root/testdata/sf0.001").limit(5).withColumns({
        "is_synthetic": F.lit(True), "generation_timestamp": F.col("Time").cast("timestamp"), "applied_drift_features": F.lit("{}")})
    batch.drop("line_id").coalesce(1).write.parquet(f"{day}/one")
    name = "line_id=LINE_A/year=2024/month=01/day=01"
    seen = []

    def announce(*files):
        spark.createDataFrame([(json.dumps({"file_path": f}),) for f in files], "value string").coalesce(1) \
            .write.mode("append").text(path)
        intake.ingest_messages(intake.stream_messages(spark, path), root, bronze, base, LANDING, position, "1",
                               after=lambda rows, i: seen.append(rows.count())).awaitTermination()

    announce(f"{name}/one", f"{name}/two")
    assert spark.read.parquet(bronze).count() == 5 and seen == [5]
    lost = spark.read.parquet(f"{root}/rejected").select("message", "reason").collect()
    assert [tuple(r) for r in lost] == [(f"{name}/two", "file not found")]
    batch.drop("line_id").coalesce(1).write.parquet(f"{day}/two")
    announce(f"{name}/two", f"{name}/one")
    assert spark.read.parquet(bronze).count() == 10 and seen == [5, 5]
