"""Both rule engines against plain Python, at several block sizes."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fabspark.functions import columns as C
from fabspark.operators import spc

READING = T.StructType([
    T.StructField("observation_id", T.LongType()), T.StructField("process_timestamp", T.TimestampNTZType()),
    T.StructField("line_id", T.StringType()), T.StructField("tester_id", T.StringType()),
    T.StructField("sensor_id", T.StringType()), T.StructField("val", T.DoubleType())])
START = dt.datetime(2024, 1, 1)


def frame(spark, series):
    """{(sensor, line): values} with one reading a minute; None is a gap."""
    rows, n = [], 0
    for (sensor, line), values in series.items():
        for i, v in enumerate(values):
            rows.append((n, START + dt.timedelta(minutes=i // 2), line, "T1", sensor,
                         None if v is None else float(v)))
            n += 1
    return spark.createDataFrame(rows, READING)


def limits(spark, rows):
    return spark.createDataFrame(
        [(s, l, "T1", m, sd, m + 3 * sd, m - 3 * sd, m + 2 * sd, m - 2 * sd, m + 3.99 * sd, m - 3.99 * sd)
         for s, l, m, sd in rows],
        "sensor_id string, line_id string, tester_id string, mu double, sigma double, ucl double, lcl double, "
        "uwl double, lwl double, usl double, lsl double")


def ends(values, mu, sigma):
    """Rule number -> indices of run ends, straight from the definitions."""
    v = [x for x in values if x is not None]
    z = [None if mu is None or not sigma else (x - mu) / sigma for x in v]
    out = {n: set() for n in range(1, 6)}
    for i in range(len(v)):
        if z[i] is not None and abs(z[i]) > 3:
            out[1].add(i)
        if mu is not None and i >= 8:
            w = v[i - 8:i + 1]
            if all(x > mu for x in w) or all(x < mu for x in w):
                out[2].add(i)
        if i >= 5:
            w = v[i - 5:i + 1]
            if all(a < b for a, b in zip(w, w[1:])) or all(a > b for a, b in zip(w, w[1:])):
                out[3].add(i)
        if i >= 13:
            d = [b - a for a, b in zip(v[i - 13:i], v[i - 12:i + 1])]
            if all(a * b < 0 for a, b in zip(d, d[1:])):
                out[4].add(i)
        w = [x for x in z[max(0, i - 2):i + 1] if x is not None]
        if sum(x > 2 for x in w) >= 2 or sum(x < -2 for x in w) >= 2:
            out[5].add(i)
    return out


def expanded(values, mu, sigma):
    v = [x for x in values if x is not None]
    if mu is None or not sigma or len(v) < 9:
        return {}
    span = {1: 1, 2: 9, 3: 6, 4: 14, 5: 3}
    out = {}
    for n, idx in ends(values, mu, sigma).items():
        for i in idx:
            if i >= span[n] - 1:
                for j in range(i - span[n] + 1, i + 1):
                    out.setdefault(j, set()).add(n)
    return out


def random_series(seed):
    rnd = random.Random(seed)
    walk = [0.0]
    for _ in range(160):
        walk.append(walk[-1] + rnd.choice([1, 1, 0, -1]))
    return {
        ("s1", "A"): [rnd.gauss(0, 1.6) for _ in range(400)],
        ("s1", "B"): [(-1) ** i * (1 + rnd.random()) if rnd.random() < 0.97 else 0.0 for i in range(250)],
        ("s2", "A"): [None if rnd.random() < 0.1 else x for x in walk],
        ("s2", "B"): [5.0] * 40,
        ("s3", "A"): [rnd.choice([-3, -2.5, 0, 2.5, 3.5]) for _ in range(120)],
        ("s3", "B"): [rnd.gauss(0, 3) for _ in range(8)],
        ("s4", "A"): list(range(20)) + list(range(20, 0, -1)),  # no limits
    }


LIMITS = [("s1", "A", 0.0, 1.0), ("s1", "B", 0.0, 1.0), ("s2", "A", 0.0, 4.0), ("s2", "B", 5.0, 0.0),
          ("s3", "A", 0.0, 1.0), ("s3", "B", 0.0, 1.0)]
MU = {(s, l): (m, sd) for s, l, m, sd in LIMITS}


@pytest.mark.parametrize("block", [13, 14, 31, None])
def test_table_engine(spark, block):
    series = random_series(3)
    v = spc.rule_ends(spc.spc_points(frame(spark, series), limits(spark, LIMITS)), block).filter("_own")
    got = {}
    for row in v.collect():
        for n in range(1, 6):
            if row[f"rule{n}"]:
                got.setdefault((row.sensor_id, row.line_id), {m: set() for m in range(1, 6)})[n].add(row.seq - 1)
    for k, values in series.items():
        want = ends(values, *MU.get(k, (None, None)))
        assert got.get(k, {n: set() for n in range(1, 6)}) == want, k


@pytest.mark.parametrize("block", [13, 20, None])
def test_monitor_engine(spark, block):
    series = random_series(5)
    m = spc.monitor(frame(spark, series), limits(spark, LIMITS), block)
    got = {}
    for row in m.collect():
        got.setdefault((row.sensor_id, row.line_id), {})[row.seq - 1] = set(row.rules)
    assert ("s4", "A") not in got
    for k, values in series.items():
        if k in MU:
            want = expanded(values, *MU[k])
            assert {i: r for i, r in got[k].items() if r} == want, k


def hits(spark, values, mu=0.0, sigma=1.0):
    df = spc.violations(frame(spark, {("s", "A"): values}), limits(spark, [("s", "A", mu, sigma)]))
    return sorted((r.rule_number, r.observation_id) for r in df.collect())


def test_run_lengths(spark):
    assert hits(spark, [1, 1.1] * 4) == []
    assert hits(spark, [1, 1.1, 1.2] * 3) == [(2, 8)]
    assert hits(spark, [-1, 0, 1, 1.5, 1.8]) == []
    assert hits(spark, [-1.5, -1, 0, 1, 1.5, 1.8]) == [(3, 5)]
    assert hits(spark, [-1.5, -1, 0, 0, 1, 1.5, 1.8]) == []
    assert hits(spark, [0, 1] * 6 + [0]) == []
    assert hits(spark, [0, 1] * 7) == [(4, 13)]
    assert hits(spark, [2.5, 0, 2.5, 0]) == [(5, 2)]
    assert hits(spark, [2.5, 2.5]) == [(5, 1)]


def test_zero_spread_and_worst_rule(spark):
    assert hits(spark, [5, 5, 9, 9, 9, 5], 5.0, 0.0) == []
    f, lim = frame(spark, {("s", "A"): [4.0, 4.0, 4.0]}), limits(spark, [("s", "A", 0.0, 1.0)])
    assert spc.violations(f, lim).count() == 5
    worst = spc.violations(f, lim, worst_rule_only=True).collect()
    assert sorted((r.observation_id, r.rule_number) for r in worst) == [(0, 1), (1, 1), (2, 1)]


def test_monitor_needs_nine_readings(spark):
    lim = limits(spark, [("s", "A", 0.0, 1.0)])
    eight = spc.monitor(frame(spark, {("s", "A"): [9.0] * 8}), lim)
    nine = spc.monitor(frame(spark, {("s", "A"): [9.0] * 9}), lim)
    assert eight.filter(F.size("rules") > 0).count() == 0
    assert nine.filter(F.array_contains("rules", 2)).count() == 9


def test_baseline_drops_raw_outliers_and_short_series(spark):
    values = [0.0, 1.0] * 20 + [1000.0]
    f = frame(spark, {("s", "LINE_A"): values, ("s", "LINE_B"): [1.0, 2.0] * 15})
    rows = spc.baseline(f).collect()
    assert [(r.line_id, r.mu) for r in rows] == [("LINE_A", 0.5)]
    assert rows[0].usl == pytest.approx(0.5 + 3.99 * rows[0].sigma)
    assert spc.baseline(f, line="LINE_Z").count() == 0


def test_flat_sensor_has_exactly_no_spread(spark):
    """0.1 is not exact in binary: sums and merged moments drift by an ulp."""
    f = frame(spark, {("s", "LINE_A"): [0.1] * 61}).repartition(7)
    lim = spc.baseline(f)
    row = lim.first()
    assert (row.mu, row.sigma, row.usl, row.lsl) == (0.1, 0.0, 0.1, 0.1)
    assert spc.violations(f.withColumns({"shift": F.lit("Day")}), lim).count() == 0
    assert spc.capability(f, lim).first().cpk == 0.0


def test_capability_guards(spark):
    lim = limits(spark, [("a", "A", 0.0, 1.0), ("b", "A", 0.0, 1.0), ("c", "A", 0.0, 1.0)])
    f = frame(spark, {("a", "A"): [1.0, 2.0, 3.0, 4.0], ("b", "A"): [2.0] * 9, ("c", "A"): [-1.0, 0.0, 1.0, 0.5, -0.5]})
    got = {r.sensor_id: r for r in spc.capability(f, lim).collect()}
    assert got["a"].cpk == got["b"].cpk == 0.0 and got["b"].status == "Incapable"
    sd = (sum(x * x for x in (-1, 0, 1, 0.5, -0.5)) / 4) ** 0.5
    assert got["c"].cp == round(2 * 3.99 / (6 * sd), 3)


def test_rounded_value_equals_rounded(spark):
    rnd = random.Random(5)
    values = [rnd.gauss(0, 10) for _ in range(2000)] + [n + d for n in (-3.0, 0.0, 4.0) for d in (0.5e-4, 1.25e-4, 0.49999999999999994e-4)] + [
        -0.0, -1e-9, 0.5e-6, 2.5, -2.5, 1e300, float("nan"), float("inf"), float("-inf"), 4503599627.3704955, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (4, 6):
        rows = df.select(C.rounded(F.col("v"), digits).alias("a"), C.rounded_value("v", digits).alias("b")).collect()
        assert [str(r.a) for r in rows] == [str(r.b) for r in rows]


def test_first_readings_from_kept_counts(spark):
    df = frame(spark, random_series(7)).withColumn("process_timestamp", F.when(
        F.col("observation_id") % 20 != 0, F.expr("process_timestamp + make_dt_interval(CAST(observation_id % 9 AS INT))")))
    counts = df.filter("val IS NOT NULL").groupBy(*spc.SERIES, F.to_date("process_timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("readings"))
    rows = lambda d: sorted(map(str, d.collect()))
    assert rows(spc.first_readings(df, 30, counts)) == rows(spc.first_readings(df, 30))
