"""Correlation, ranks, drift, outliers and splits against numpy and pandas."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fabspark.operators import drift as D
from fabspark.operators import profile as P
from fabspark.operators import quality as Q
from fabspark.operators import stats


def gappy(n=600, seed=2):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=n)
    f = pd.DataFrame({"a": a, "b": a * 2 + rng.normal(size=n) * 0.1, "c": rng.integers(0, 4, n).astype(float),
                      "d": np.full(n, 0.1), "e": 1e6 + a * 1e-2})
    f.loc[rng.random(n) < 0.2, "b"] = np.nan
    f.loc[rng.random(n) < 0.3, "c"] = np.nan
    f["y"] = np.where(a + rng.normal(size=n) > 1, 1, -1)
    return f


def frame(spark, pdf):
    df = spark.createDataFrame(pdf)
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def test_corr_matrix_matches_pandas(spark):
    pdf, cols = gappy(), list("abcde")
    got = stats.corr_matrix(frame(spark, pdf).repartition(5), cols).toPandas().set_index(["sensor_a", "sensor_b"])
    want = pdf[cols].corr()
    assert len(got) == 25
    for i in cols:
        for j in cols:
            r = got.loc[(i, j), "r"]
            if "d" in (i, j):
                assert pd.isna(r)
            else:
                assert r == pytest.approx(want.loc[i, j], abs=1e-6)
            assert got.loc[(i, j), "n"] == pdf[[i, j]].dropna().shape[0] if i != j else True


def test_collinear(spark):
    m = stats.corr_matrix(frame(spark, gappy()), list("abcde"))
    assert {r.sensor_id for r in stats.collinear(m).collect()} == {"a", "b", "e"}
    assert stats.collinear(m, k=2).count() == 2


def test_spearman_matches_pandas(spark):
    pdf, cols = gappy(300), ["a", "b", "c", "d"]
    got = stats.spearman(frame(spark, pdf), cols).toPandas()
    for _, r in got.iterrows():
        both = pdf[[r.sensor_a, r.sensor_b]].dropna()
        want = both.rank().corr().iloc[0, 1]
        assert (pd.isna(want) and pd.isna(r.rho)) or r.rho == pytest.approx(want, abs=1e-9)
        assert r.n == len(both)
    assert [r.sensor_id for r in stats.redundant(stats.spearman(frame(spark, pdf), cols)).collect()] == ["b"]


def test_pareto_skips_constant_and_scarce(spark):
    pdf = gappy()
    pdf["f"] = np.nan
    pdf.loc[:20, "f"] = np.arange(21.0)
    got = stats.pareto(frame(spark, pdf), ["a", "b", "c", "d", "f"], "y").orderBy("rank").collect()
    assert {r.sensor_id for r in got} == {"a", "b", "c"}
    assert got[0].correlation == pytest.approx(max(pdf["a"].corr(pdf["y"]), pdf["b"].corr(pdf["y"])), abs=1e-6)
    assert got[0].direction.endswith("more failures") and got[0].effect_strength == "Strong"


@pytest.mark.parametrize("t, dof, p", [  # table values of Student's t
    (0.0, 10, 1.0), (12.706204736, 1, 0.05), (2.228138852, 10, 0.05), (3.169272673, 10, 0.01),
    (1.959963985, 1e9, 0.05), (1.0, 1, 0.5)])
def test_t_tail(t, dof, p):
    assert stats.t_tail(t, dof) == pytest.approx(p, rel=1e-6)


def test_pointbiserial_p_value(spark):
    pdf = gappy()
    row = {r.sensor_id: r for r in stats.pointbiserial(frame(spark, pdf), ["a", "c", "d"], "y").collect()}
    r, n = pdf["a"].corr(pdf["y"]), len(pdf)
    assert row["a"].p_value == pytest.approx(stats.t_tail(r * np.sqrt((n - 2) / (1 - r * r)), n - 2), rel=1e-9)
    assert row["a"].p_value < 1e-6 and row["d"].p_value is None


def w1(x, y):
    grid = np.sort(np.concatenate([x, y]))
    fx = np.searchsorted(np.sort(x), grid[:-1], side="right") / len(x)
    fy = np.searchsorted(np.sort(y), grid[:-1], side="right") / len(y)
    return float(np.sum(np.abs(fx - fy) * np.diff(grid)))


def test_drift_matches_the_area_between_distributions(spark):
    rng = np.random.default_rng(4)
    base = {"a": rng.normal(size=700), "b": rng.integers(0, 5, 300).astype(float), "flat": np.ones(50), "few": np.arange(4.0)}
    gen = {("L1", "a"): rng.normal(0.4, 1, 150), ("L2", "a"): base["a"], ("L1", "b"): rng.integers(1, 7, 90).astype(float),
           ("L2", "b"): base["b"] + 2.5, ("L1", "flat"): np.ones(9), ("L1", "few"): np.arange(9.0), ("L3", "a"): np.arange(4.0)}
    b = spark.createDataFrame([(s, float(v)) for s, x in base.items() for v in x], "sensor_id string, val double")
    g = spark.createDataFrame([(l, s, float(v)) for (l, s), x in gen.items() for v in x],
                              "line_id string, sensor_id string, val double")
    got = {(r.line_id, r.sensor_id): r for r in D.drift(b, g).collect()}
    assert set(got) == {("L1", "a"), ("L2", "a"), ("L1", "b"), ("L2", "b")}
    for k, r in got.items():
        assert r.distance == pytest.approx(w1(base[k[1]], gen[k]), abs=1e-9)
        assert r.drifted == (r.distance / base[k[1]].std(ddof=1) > 0.1)
    assert got[("L2", "a")].distance == 0 and got[("L2", "b")].distance == pytest.approx(2.5)
    assert D.most_drifted(D.drift(b, g)).first().line_id == "L2"


def test_density_is_a_kernel_estimate(spark):
    x = np.random.default_rng(1).normal(size=200)
    one = spark.createDataFrame([(float(v),) for v in x], "val double")
    got = D.density(one, one.limit(1), 64).orderBy("point").toPandas()
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = x.min() + np.arange(64) * (x.max() - x.min()) / 64
    want = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))
    assert set(got["source"]) == {"Baseline"}  # one value gives no curve
    assert np.allclose(got["x"], grid) and np.allclose(got["density"], want)


def test_iqr_outliers_match_pandas(spark):
    pdf = gappy()[["a", "b", "c"]]
    for r in P.iqr_outliers(frame(spark, pdf), ["a", "b", "c"]).collect():
        s = pdf[r.column]
        q1, q3 = s.quantile(0.25), s.quantile(0.75)
        n = int(((s < q1 - 1.5 * (q3 - q1)) | (s > q3 + 1.5 * (q3 - q1))).sum())
        assert (r.outliers, r.percent) == (n, round(n / len(s) * 100, 2))


def test_profile_of_gaps_constants_duplicates(spark):
    df = spark.createDataFrame([(1, 2.0, None, "x"), (1, 2.0, None, "x"), (2, None, None, "x")],
                               "a int, b double, c double, d string")
    missing = {r.column: (r.missing, round(r.percent, 2)) for r in P.missing_by_column(df).collect()}
    assert missing == {"a": (0, 0.0), "b": (1, 33.33), "c": (3, 100.0), "d": (0, 0.0)}
    assert {(r.column, r.kind) for r in P.constant_columns(df).collect()} == {
        ("b", "constant"), ("c", "empty"), ("d", "constant")}
    assert [(r.a, r.copies) for r in P.duplicates(df).collect()] == [(1, 2)]
    assert {r.type: r["columns"] for r in P.type_profile(df).collect()} == {"int": 1, "double": 2, "string": 1}


def wafers(spark, labels):
    t0 = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(i, t0 + dt.timedelta(hours=i), y) for i, y in enumerate(labels)],
                                 "id long, ts timestamp_ntz, y int")


@pytest.mark.parametrize("labels, share, first_test", [
    ([0, 1, 0, 1, 1, 0, 1, 0, 1, 0], 0.4, 6), ([1, 1, 1, 1, 1], 0.2, 4), ([0, 1, 0, 0], 0.2, 3), ([0, 0, 0], 0.2, 2)])
def test_time_split(spark, labels, share, first_test):
    got = P.time_split(wafers(spark, labels), "y", ["ts", "id"], share)
    assert {r.id for r in got.filter("part = 'test'").collect()} == set(range(first_test, len(labels)))


def test_importance_finds_the_telling_sensor(spark):
    pdf = gappy(400)
    pdf["label"] = (pdf["a"] > 0.8).astype(int)
    top = P.importance(frame(spark, pdf), ["c", "a", "d"], "label", rounds=3).first()
    assert top.feature == "a" and top.importance > 0.8


def test_contracts(spark):
    df = spark.createDataFrame([(1, "Pass", 50.0), (1, "Odd", 101.0), (None, "Fail", None)], "id int, s string, y double")
    got = {r.rule: r.failures for r in Q.check(df, [
        Q.unique("id"), Q.not_null("id"), Q.accepted_values("s", "Pass", "Fail"), Q.between("y", 0, 100)]).collect()}
    assert got == {"unique(id)": 1, "not_null(id)": 1, "accepted_values(s)": 1, "between(y)": 1}
