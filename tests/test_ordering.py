"""Places, running totals and bordered blocks against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fabspark.operators.ordering import positions, with_context
from fabspark.operators.ranking import average_ranks, percentiles, value_counts


def skewed(n=4000, seed=1):
    """One series holds most rows, one has a single row, one has a NULL key."""
    rng = np.random.default_rng(seed)
    series = rng.choice(["hot", "warm", "cold", None], n, p=[0.8, 0.1, 0.07, 0.03])
    frame = pd.DataFrame({"k": series, "t": rng.integers(0, 50, n), "id": np.arange(n),
                          "x": rng.integers(0, 9, n), "v": rng.normal(size=n).round(2)})
    frame.loc[n] = ["single", 1, n, 4, 0.5]
    return frame


def test_positions_match_pandas(spark):
    pdf = skewed()
    got = positions(spark.createDataFrame(pdf), ["k"], ["t", "id"], totals={"cum": "x"}, following="v").toPandas()
    s = pdf.sort_values(["t", "id"])
    g = s.groupby("k", dropna=False)
    want = s.assign(seq=g.cumcount() + 1, series_rows=g["id"].transform("size"), cum=g["x"].cumsum(),
                    series_cum=g["x"].transform("sum"), next_v=g["v"].shift(-1))
    a = got.sort_values("id").reset_index(drop=True)
    b = want.sort_values("id").reset_index(drop=True)
    for c in ("seq", "series_rows", "cum", "series_cum"):
        assert (a[c].astype(int) == b[c].astype(int)).all(), c
    assert np.allclose(a["next_v"].astype(float), b["next_v"].astype(float), equal_nan=True)


def test_positions_descending(spark):
    pdf = skewed(500)
    got = positions(spark.createDataFrame(pdf), ["k"], [F.desc("t"), F.desc("id")]).toPandas()
    s = pdf.sort_values(["t", "id"], ascending=False)
    want = s.assign(seq=s.groupby("k", dropna=False).cumcount() + 1).set_index("id")["seq"]
    assert (got.set_index("id")["seq"].sort_index() == want.sort_index()).all()


def test_positions_of_nothing(spark):
    df = spark.createDataFrame([], "k string, t int, id int")
    assert positions(df, ["k"], ["t", "id"]).count() == 0


@pytest.mark.parametrize("size", [3, 7, 1000])
def test_blocks_give_the_frames_of_the_whole_series(spark, size):
    pdf = skewed(1500)
    p = positions(spark.createDataFrame(pdf), ["k"], ["t", "id"])
    whole = Window.partitionBy("k").orderBy("seq")
    block = Window.partitionBy("k", "_blk").orderBy("seq")
    frame = lambda w: F.sum("x").over(w.rowsBetween(-3, 2))
    want = p.select("id", frame(whole).alias("s")).toPandas().set_index("id")["s"]
    got = with_context(p, 3, 2, size).withColumn("s", frame(block)).filter("_own").select("id", "s").toPandas()
    assert len(got) == len(pdf)
    assert (got.set_index("id")["s"].sort_index() == want.sort_index()).all()


def test_block_shorter_than_its_border_is_refused(spark):
    p = spark.range(3).withColumn("seq", F.col("id") + 1)
    with pytest.raises(ValueError):
        with_context(p, 13, 0, 5)


def test_percentiles_match_numpy(spark):
    pdf = skewed(3000)
    pdf.loc[::17, "v"] = np.nan
    got = percentiles(spark.createDataFrame(pdf), ["k"], {"lo": 0.0, "q": 0.25, "m": 0.5, "p": 0.9, "hi": 1.0}, "v")
    for row in got.collect():
        part = pdf[pdf["k"].isna()] if row.k is None else pdf[pdf["k"] == row.k]
        want = part["v"].dropna().quantile([0, 0.25, 0.5, 0.9, 1.0]).tolist()
        assert np.allclose([row.lo, row.q, row.m, row.p, row.hi], want)
        assert row.n == part["v"].notna().sum()


def test_average_ranks_match_pandas(spark):
    pdf = skewed(2000).dropna(subset=["k"])
    counts = value_counts(spark.createDataFrame(pdf), ["k"], "v")
    got = average_ranks(counts, ["k"], "v").toPandas().set_index(["k", "v"])["avg_rank"]
    want = pdf.assign(r=pdf.groupby("k")["v"].rank()).groupby(["k", "v"])["r"].first()
    assert np.allclose(got.sort_index(), want.sort_index())
