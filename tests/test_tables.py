"""Silver and yield tables, files, augmentation on hand-written rows."""

import datetime as dt
import os
import tempfile

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fabspark.functions import columns as C
from fabspark.functions import schemas
from fabspark.operators import augment, staging, yields
from fabspark.operators.windows import trailing
from fabspark.session import new_path, scratch, settled
from fabspark.sources import events as E
from fabspark.sources import files, tables

TS = dt.datetime


def bronze(spark, rows):
    """(time, label, line, shift, lot, readings...)"""
    n = len(rows[0]) - 5
    schema = T.StructType([T.StructField("Time", T.TimestampNTZType()), T.StructField("Pass/Fail", T.LongType()),
                           *[T.StructField(c, T.StringType()) for c in ("line_id", "shift", "lot_id")],
                           *[T.StructField(str(i), T.DoubleType()) for i in range(n)]])
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({"tester_id": F.lit("T1"), "source_file": F.lit("f.parquet")})


def test_digit_columns_are_counted_not_literals(spark):
    b = bronze(spark, [(TS(2024, 1, 1, 7), 1, "A", "Day", "L1", None, 2.0), (TS(2024, 1, 1, 8), -1, "A", "Day", "L1", 1.0, 2.0),
                       (TS(2024, 1, 1, 9), 7, "A", "Day", "L1", None, None)])
    s = staging.stage(b, ["0", "1"])
    assert [(r.missing_sensor_count, r.wafer_status) for r in s.orderBy("process_timestamp").collect()] == [
        (1, "Fail"), (0, "Pass"), (2, "Unknown")]
    assert s.select("observation_id").distinct().count() == 3
    assert staging.reporting(s, 2).count() == 2
    q = staging.quarantine(s, 2).first()
    assert q.quarantine_reason == "CRITICAL_NULL_THRESHOLD_EXCEEDED"


def test_surrogate_key_marks_nulls(spark):
    a = spark.range(1).select(C.surrogate_key(C.key_text(F.lit("x")), C.key_text(F.lit(None).cast("string"))).alias("k"))
    import hashlib
    assert a.first().k == hashlib.md5(b"x-_dbt_utils_surrogate_key_null_").hexdigest()


def test_day_with_only_quarantined_wafers(spark):
    b = bronze(spark, [(TS(2024, 1, 1, 7), 1, "A", "Day", "L1", 1.0, 2.0), (TS(2024, 1, 1, 7), -1, "A", "Day", "L2", 1.0, 2.0),
                       (TS(2024, 1, 1, 9), -1, "A", "Day", "L1", None, None), (TS(2024, 1, 2, 9), -1, "A", "Day", "L1", None, None),
                       (TS(2024, 1, 1, 9), -1, None, "Day", "L1", None, None), (TS(2024, 1, 1, 9), -1, None, "Day", "L1", 1.0, 1.0)])
    s = staging.stage(b, ["0", "1"])
    rep, quar = staging.reporting(s, 2), staging.quarantine(s, 2)
    d = {(str(r.process_date), r.line_id): r for r in yields.daily_yield(rep, quar).collect()}
    assert set(d) == {("2024-01-01", "A"), ("2024-01-01", None)}
    assert d["2024-01-01", "A"].quarantined_wafers == 1 and d["2024-01-01", "A"].ppm_defective == 500000
    assert d["2024-01-01", None].quarantined_wafers == 0  # NULL keys match nothing
    every = yields.daily_yield(rep, quar, keep_quarantine_only=True).filter("process_date = '2024-01-02'").first()
    assert (every.total_wafers_tested, every.quarantined_wafers, every.yield_percentage) == (0, 1, None)
    sh = yields.shift_metrics(rep, quar).filter("line_id = 'A'").first()
    assert (sh.lots_processed, sh.scrap_rate_pct, sh.avg_missing_sensors) == (2, 33.33, 0.0)


def test_lot_over_two_shifts_counts_twice(spark):
    b = bronze(spark, [(TS(2024, 1, 1, 13), -1, "A", "Day", "L1", 1.0), (TS(2024, 1, 1, 14), -1, "A", "Swing", "L1", 1.0)])
    s = staging.stage(b, ["0"])
    o = yields.oee(yields.shift_metrics(s, staging.quarantine(s, 9)), 2, 4).first()
    assert (o.total_lots, o.availability_pct, o.performance_pct, o.quality_pct, o.oee_pct, o.oee_classification) == (
        2, 100.0, 50.0, 100.0, 50.0, "Average")


@pytest.mark.parametrize("hour, shift", [(5, "Night"), (6, "Day"), (13, "Day"), (14, "Swing"), (21, "Swing"), (22, "Night"), (0, "Night")])
def test_shift_hours(spark, hour, shift):
    assert spark.range(1).select(C.shift_of(F.lit(f"2024-01-01 {hour:02d}:30:00").cast("timestamp_ntz")).alias("s")).first().s == shift


def test_ratios_classes_and_rounding(spark):
    one = spark.range(1)
    col = lambda c: one.select(c.alias("x")).first().x
    assert col(C.ratio(F.lit(1), F.lit(0), 100)) is None
    assert col(C.clipped_ratio(F.lit(0), F.lit(0), 100)) == 0.0
    assert col(C.rounded(F.lit(0.575), 2)) == 0.57 and col(C.rounded(F.lit(-2.5), 0)) == -3
    assert col(C.oee_class(F.lit(None).cast("double"))) == "Poor"
    assert col(C.effect_strength(F.lit(float("nan")))) == "Weak"
    assert col(C.effect_direction(F.lit(float("nan")))) == "No association"
    assert col(C.capability_class(F.lit(1.33))) == "Capable"
    assert col(C.least_or_null(F.lit(None).cast("double"), F.lit(1.0))) is None
    assert [col(C.weekday(F.lit(d).cast("date"))) for d in ("2024-01-01", "2024-01-07")] == [0, 6]
    assert col(C.iso_week(F.lit("2021-01-03").cast("date"))) == 53


def test_trailing_windows(spark):
    df = spark.createDataFrame([("A", "2024-01-10"), ("A", "2024-01-03"), ("A", "2024-01-02"), ("B", "2023-06-08"),
                                ("B", "2023-06-01"), (None, "2024-01-10")], "line string, d string").withColumn("d", F.to_date("d"))
    by_line = trailing(df, "d", "'7' DAY", ["line"])
    assert sorted((r.line, str(r.d)) for r in by_line.collect()) == [
        ("A", "2024-01-03"), ("A", "2024-01-10"), ("B", "2023-06-01"), ("B", "2023-06-08")]
    assert trailing(df, "d", "'7' DAY").count() == 3
    assert trailing(df.limit(0), "d", "'7' DAY").count() == 0
    assert trailing(df.limit(0), "d", "'7' DAY", ["line"]).count() == 0


def test_raw_csv_gaps(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="fabspark-test-"), "raw.csv")
    with open(path, "w") as f:
        f.write("Time,0,1,Pass/Fail\n2008-07-19 11:55:00,NaN,1.5,-1\n2008-07-19 12:32:00,,2,1\n")
    rows = files.read_raw_csv(spark, path, ["0", "1"]).collect()
    assert [tuple(r) for r in rows] == [(TS(2008, 7, 19, 11, 55), None, 1.5, -1), (TS(2008, 7, 19, 12, 32), None, 2.0, 1)]


def test_landing_keys_stay_text(spark):
    base = new_path(spark, "landing")
    b = bronze(spark, [(TS(2024, 1, 1, 7), 1, "007", "Day", "L1", 1.0)]).drop("source_file").withColumns({
        "is_synthetic": F.lit(True), "generation_timestamp": F.lit("2024-03-05 01:00:00").cast("timestamp"),
        "applied_drift_features": F.lit("{}")})
    files.write_landing(b, base)
    r = files.with_source_file(files.read_landing(spark, [base], base, schemas.landing_schema(["0"]))).first()
    assert (r.line_id, r.year, r.month, r.day) == ("007", "2024", "03", "05") and "month=03" in r.source_file


def test_append_refuses_other_columns(spark):
    db = "t" + os.urandom(4).hex()
    at = new_path(spark, db)
    tables.append_bronze(spark.createDataFrame([(1, "a")], "x int, y string"), f"{db}.t", at)
    tables.append_bronze(spark.createDataFrame([("b", 2)], "y string, x int"), f"{db}.t", at)
    assert sorted(tuple(r) for r in spark.table(f"{db}.t").collect()) == [(1, "a"), (2, "b")]
    with pytest.raises(AnalysisException):
        tables.append_bronze(spark.createDataFrame([("z", "b")], "x string, y string"), f"{db}.t", at)


def test_scratch_tables_go(spark):
    with scratch(spark):
        df = settled(spark.range(5))
        path = df.inputFiles()[0].removeprefix("file:").lstrip("/")
        assert os.path.exists("/" + path) and df.count() == 5
    assert not os.path.exists("/" + path)
    assert settled(spark.range(0)).count() == 0


def test_latest_batch(spark):
    df = spark.createDataFrame([("A", "f1", 1), ("A", "f2", 2), ("A", "f2", 3), ("B", "g1", 4)], "line_id string, source_file string, x int")
    got = lambda *a: sorted(r.x for r in E.latest_batch(df, *a).collect())
    assert (got(), got(None, 1), got("A", 1), got("B", 3)) == ([2, 3, 4], [1], [1], [])


def test_jitter(spark):
    rng = np.random.default_rng(0)
    rows = [(i, TS(2024, 1, 1 + i % 3), float(v) if i % 4 else None) for i, v in enumerate(rng.normal(0, 10, 6000))]
    df = spark.createDataFrame(rows, "id long, Time timestamp_ntz, `7` double")
    a = augment.jitter(df, ["7"], 0.05, "id", seed=3).orderBy("id").toPandas()
    b = augment.jitter(df.repartition(7), ["7"], 0.05, "id", seed=3).orderBy("id").toPandas()
    src = df.orderBy("id").toPandas()
    assert a["7"].isna().equals(src["7"].isna()) and np.allclose(a["7"], b["7"], equal_nan=True)
    noise = (a["7"] - src["7"]).dropna()
    assert abs(noise.mean()) < 0.03 and noise.std() == pytest.approx(0.5, rel=0.05)
    assert not np.allclose(augment.jitter(df, ["7"], 0.05, "id", seed=4).orderBy("id").toPandas()["7"], a["7"], equal_nan=True)


def test_sigma_shift_uses_the_baseline_spread(spark):
    base = spark.createDataFrame([(0.0,), (2.0,)], "`7` double")
    got = augment.sigma_shift(spark.createDataFrame([(1.0,), (None,)], "`7` double"), {"7": 2.0}, base).collect()
    assert [r["7"] for r in got] == [pytest.approx(1 + 2 * 2 ** 0.5), None]


def test_replay_wraps_and_moves_years(spark):
    df = spark.createDataFrame([(TS(2024, 2, 28, 1),), (TS(2024, 2, 29, 2),), (TS(2024, 3, 1, 3),)], "Time timestamp_ntz")
    got = sorted((r.block, r.Time) for r in augment.replay(df, 1, 5).collect())
    assert got == [(0, TS(2024, 2, 29, 2)), (1, TS(2025, 3, 1, 3)), (2, TS(2025, 2, 28, 1)), (3, TS(2025, 2, 28, 2)), (4, TS(2026, 3, 1, 3))]
    assert augment.replay(df.limit(0), 0, 3).count() == 0


def test_sensor_columns(spark):
    df = spark.createDataFrame([(TS(2024, 1, 1), 1.0, 2, "x", -1)], "Time timestamp_ntz, `0` double, `589` int, lot string, `Pass/Fail` int")
    assert schemas.sensor_columns(df) == ["0", "589"]
    assert schemas.shared_sensors(df, df.drop("0")) == ["589"]
    long = df.withColumn("chamber_pressure", df["0"]).withColumn("run_no", df["0"])
    assert schemas.shared_sensors(long, long, ["run_no"]) == ["0", "589", "chamber_pressure"]
    assert len(schemas.raw_schema(schemas.sensor_names()).fields) == 592


def test_reads_and_refresh_leave_nothing_behind(spark, tmp_path):
    """Serving calls write no table, a rebuild drops what it settles."""
    import os

    from fabspark.operators.windows import trailing
    from fabspark.plans import fixtures as X
    from fabspark.plans.refresh import Setup, refresh
    from fabspark.session import new_path, shared_dir
    from pyspark.sql import functions as F

    new_path(spark)
    folder = shared_dir(spark).removeprefix("file:")
    os.makedirs(folder, exist_ok=True)
    before = sorted(os.listdir(folder))
    b = X.bronze(spark, "/root/testdata/sf0.001")
    trailing(b, "Time", "'7' DAY", ["line_id"]).count()
    setup = Setup(X.SENSORS, X.SENSORS, X.SENSORS, X.MAX_MISSING, "s", F.col("observation_id"))
    assert refresh(b, str(tmp_path / "lake"), setup)["daily"].count() > 0
    assert sorted(os.listdir(folder)) == before
