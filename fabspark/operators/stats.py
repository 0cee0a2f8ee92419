"""Correlation of sensors with the label and with each other."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fabspark.functions import columns as C
from fabspark.operators.ranking import average_ranks, percentiles
from fabspark.operators.reshape import to_long
from fabspark.session import settled


def label_correlation(df: DataFrame, sensors: Sequence[str], label: str = "label_numeric",
                      prefix: str = "") -> DataFrame:
    """Pearson r of every sensor with the label and the readings behind it, in one scan."""
    return to_long(df, sensors, [label], prefix).groupBy("sensor_id").agg(
        C.safe_corr(F.col("val"), F.col(label).cast("double")).alias("r"),
        F.count("val").alias("n"),
        F.count(F.when(F.col("val").isNotNull() & F.col(label).isNotNull(), 1)).alias("pairs"))


def pareto(df: DataFrame, sensors: Sequence[str], label: str = "label_numeric",
           min_readings: int = 30, prefix: str = "") -> DataFrame:
    """Sensors by strength of association with failure."""
    return _ranked(label_correlation(df, sensors, label, prefix), min_readings)


def _ranked(c: DataFrame, min_readings: int) -> DataFrame:
    c = c.filter(F.col("r").isNotNull() & ~F.isnan("r") & (F.col("n") >= min_readings))
    # One row per sensor, so ranking in one task is bounded by the schema.
    w = Window.orderBy(F.abs("r").desc_nulls_last(), "sensor_id")
    r = F.col("r")
    return c.select(
        F.row_number().over(w).cast("long").alias("rank"), "sensor_id", C.rounded(r, 6).alias("correlation"),
        C.rounded(F.abs(r), 6).alias("abs_correlation"), F.col("n").alias("sample_size"),
        C.effect_strength(r).alias("effect_strength"), C.effect_direction(r).alias("direction"))


def label_moments(df: DataFrame, sensors: Sequence[str], by: str, label: str = "label_numeric",
                  prefix: str = "") -> DataFrame:
    """Counts, means and centred sums of every sensor with the label, per value of ``by``: enough to make ``pareto`` anew.

    Rows of other values of ``by`` need not be read again when one changes.
    """
    x, y = F.col("val"), F.col(label).cast("double")
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x), F.when(both, y)
    n = F.count(px)
    return to_long(df, sensors, [by, label], prefix).groupBy("sensor_id", by).agg(
        F.count("val").alias("n"), n.alias("pairs"), F.avg(px).alias("mx"), F.avg(py).alias("my"),
        (F.var_pop(px) * n).alias("xx"), (F.var_pop(py) * n).alias("yy"), (F.covar_pop(px, py) * n).alias("xy"),
        F.min(px).alias("x0"), F.max(px).alias("x1"), F.min(py).alias("y0"), F.max(py).alias("y1"))


def pareto_of(moments: DataFrame, min_readings: int = 30) -> DataFrame:
    """``pareto`` from the moments of parts: centred sums plus what the parts' means are off the mean of all."""
    g = Window.partitionBy("sensor_id")
    part = F.col("pairs")
    mean = lambda c: F.sum(F.col(c) * part).over(g) / F.nullif(F.sum(part).over(g), F.lit(0))
    m = moments.withColumns({"dx": F.col("mx") - mean("mx"), "dy": F.col("my") - mean("my")})
    total = lambda c, a, b: F.sum(F.col(c) + part * F.col(a) * F.col(b))
    varies = (F.min("x0") != F.max("x1")) & (F.min("y0") != F.max("y1"))
    dev = F.sqrt(total("xx", "dx", "dx") * total("yy", "dy", "dy"))
    c = m.groupBy("sensor_id").agg(
        F.when(varies, F.try_divide(total("xy", "dx", "dy"), F.nullif(dev, F.lit(0.0)))).alias("r"), F.sum("n").alias("n"))
    return _ranked(c, min_readings)


def predictors(pareto: DataFrame) -> DataFrame:
    """Sensors strong enough to be plotted against the label."""
    return pareto.filter(F.col("effect_strength").isin("Strong", "Moderate"))


def _beta_tail(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_tail(b, a, 1.0 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x)) / a
    # Modified Lentz evaluation.
    tiny = 1e-300
    c, d = 1.0, 1.0 / ((1.0 - (a + b) * x / (a + 1)) or tiny)
    f = d
    for m in range(1, 500):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 / ((1.0 + num * d) or tiny)
            c = (1.0 + num / c) or tiny
            f *= c * d
        if abs(1.0 - c * d) < 1e-15:
            break
    return front * f


def t_tail(t: float, dof: float) -> float:
    """Two-sided tail of Student's t."""
    return _beta_tail(dof / 2.0, 0.5, dof / (dof + t * t))


@F.pandas_udf(T.DoubleType())
def t_test_p(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(a) or pd.isna(b) or b <= 0 else t_tail(a, b)
                      for a, b in zip(t, dof)], dtype="float64")


def pointbiserial(df: DataFrame, sensors: Sequence[str], label: str = "label_numeric",
                  prefix: str = "") -> DataFrame:
    """r with the label, its t statistic and two-sided p-value, strongest first."""
    c = label_correlation(df, sensors, label, prefix)
    r, dof = F.col("r"), F.col("pairs") - 2
    t = r * F.sqrt(F.try_divide(dof.cast("double"), (1 - r) * (1 + r)))
    c = c.select("sensor_id", "r", F.abs("r").alias("abs_r"), F.col("pairs").alias("n"),
                 F.when(dof > 0, t).alias("t"))
    c = c.withColumn("p_value", F.when(F.abs("r") == 1, 0.0).otherwise(
        t_test_p("t", (F.col("n") - 2).cast("double"))))
    return c.orderBy(F.col("abs_r").desc_nulls_last(), "sensor_id")


PAIR_SUMS = "a int, b int, n double, sa double, sb double, saa double, sbb double, sab double"


def _pair_sums(centres: Sequence[float]):
    """Per-task sums over all column pairs, as blocks of matrix products."""
    k = len(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mid = np.asarray(centres, dtype="float64")
        n, s, q, p = (np.zeros((k, k)) for _ in range(4))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype("float64")
                                 for c in batch.columns])
            here = ~np.isnan(x)
            x = np.where(here, x - mid, 0.0)
            m = here.astype("float64")
            n += m.T @ m
            s += x.T @ m
            q += (x * x).T @ m
            p += x.T @ x
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_pydict({
            "a": pa.array(i, pa.int32()), "b": pa.array(j, pa.int32()), "n": n[i, j],
            "sa": s[i, j], "sb": s[j, i], "saa": q[i, j], "sbb": q[j, i], "sab": p[i, j]})

    return run


def corr_matrix(df: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """Pearson r of all sensor pairs over rows where both are present.

    One scan: each task multiplies its Arrow batches into pair sums, which are
    added up by pair. Values are centred first, so sums do not cancel. Tasks are
    merged to a two per core, since each gives one row per pair. r is NULL where
    a side does not vary.
    """
    spark = df.sparkSession
    sensors = list(sensors)
    mid = to_long(df, sensors, []).groupBy("sensor_id").agg(
        C.mean(F.col("val")).alias("m"))
    # One row per sensor: bounded by the schema.
    centre = {row[0]: row[1] or 0.0 for row in mid.collect()}
    values = df.selectExpr(*[f"CAST({C.ident(s)} AS DOUBLE) AS {C.ident(s)}" for s in sensors])
    sums = (values.coalesce(2 * spark.sparkContext.defaultParallelism)
            .mapInArrow(_pair_sums([centre.get(s, 0.0) for s in sensors]), PAIR_SUMS)
            .groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab")]))
    n, sa, sb = F.col("n"), F.col("sa"), F.col("sb")
    va = F.col("saa") - F.try_divide(sa * sa, n)
    vb = F.col("sbb") - F.try_divide(sb * sb, n)
    varies = (va > 1e-12 * F.col("saa")) & (vb > 1e-12 * F.col("sbb"))
    r = F.try_divide(F.col("sab") - F.try_divide(sa * sb, n), F.sqrt(F.when(varies, va) * vb))
    names = C.array_of([C.text(s) for s in sensors])
    half = sums.select("a", "b", n.cast("long").alias("n"),
                       F.when(F.col("a") == F.col("b"), F.when(varies, F.lit(1.0))).otherwise(r).alias("r"))
    both = half.withColumn("_p", F.explode(F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b")))
                                           .otherwise(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))))
    return both.select(F.get(names, F.col("_p.a")).alias("sensor_a"),
                       F.get(names, F.col("_p.b")).alias("sensor_b"), "n", "r")


def collinear(matrix: DataFrame, threshold: float = 0.70, k: int | None = None) -> DataFrame:
    """Sensors with a partner at or above ``threshold``, strongest first; the first ``k`` if given."""
    best = matrix.filter(F.col("sensor_a") != F.col("sensor_b")).groupBy(
        F.col("sensor_a").alias("sensor_id")).agg(F.max(F.abs("r")).alias("max_abs_r"))
    out = best.filter(F.col("max_abs_r") >= threshold).orderBy(F.desc("max_abs_r"), "sensor_id")
    return out if k is None else out.limit(k)


def spearman(df: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """Rank correlation of every pair in column order, ranked anew per pair.

    Rows enter a pair only where both sides are present, as pairwise-complete
    ranking asks. Work grows with rows times pairs: meant for a chosen set of
    sensors; equal (x, y) rows are counted before the first shuffle.
    """
    sensors = list(sensors)
    pairs = [(i, j) for i in range(len(sensors)) for j in range(i + 1, len(sensors))]
    cell = F.array(*[
        F.when(C.col(sensors[i]).isNotNull() & C.col(sensors[j]).isNotNull(),
               F.struct(F.lit(p).alias("pair"), C.col(sensors[i]).cast("double").alias("x"),
                        C.col(sensors[j]).cast("double").alias("y")))
        for p, (i, j) in enumerate(pairs)])
    xy = df.select(F.explode(F.array_compact(cell)).alias("c")).groupBy("c.pair", "c.x", "c.y").agg(
        F.count(F.lit(1)).alias("w"))
    xy = settled(xy, "pairs")
    sides = xy.select("pair", "w", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("x").alias("val")),
        F.struct(F.lit(1).alias("side"), F.col("y").alias("val")))).alias("s"))
    counts = sides.groupBy("pair", "s.side", "s.val").agg(F.sum("w").alias("_n"))
    ranks = settled(average_ranks(counts, ["pair", "side"]), "ranks")
    rx = ranks.filter("side = 0").select("pair", F.col("val").alias("x"),
                                         (F.col("avg_rank") - (F.col("n") + 1) / 2).alias("rx"))
    ry = ranks.filter("side = 1").select("pair", F.col("val").alias("y"),
                                         (F.col("avg_rank") - (F.col("n") + 1) / 2).alias("ry"))
    j = xy.join(rx, ["pair", "x"]).join(ry, ["pair", "y"])
    w = F.col("w")
    s = j.groupBy("pair").agg(F.sum("w").alias("n"), F.sum(w * F.col("rx") * F.col("ry")).alias("xy"),
                              F.sum(w * F.col("rx") * F.col("rx")).alias("xx"),
                              F.sum(w * F.col("ry") * F.col("ry")).alias("yy"))
    rho = F.try_divide(F.col("xy"), F.sqrt(F.col("xx") * F.col("yy")))
    left = F.array(*[F.lit(sensors[i]) for i, _ in pairs])
    right = F.array(*[F.lit(sensors[j]) for _, j in pairs])
    return s.select(F.get(left, F.col("pair")).alias("sensor_a"), F.get(right, F.col("pair")).alias("sensor_b"),
                    "n", rho.alias("rho"))


def redundant(pairs: DataFrame, threshold: float = 0.85) -> DataFrame:
    """Sensors that an earlier column already explains."""
    return pairs.filter(F.abs("rho") > threshold).groupBy(F.col("sensor_b").alias("sensor_id")).agg(
        F.max(F.abs("rho")).alias("max_abs_rho"))


def box_stats(df: DataFrame, sensor: str, status: str = "wafer_status") -> DataFrame:
    """Five-number summary of a sensor per wafer status."""
    long = df.select(status, C.col(sensor).cast("double").alias("val"))
    return percentiles(long, [status], {"lowest": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "highest": 1.0})


def scatter_sample(df: DataFrame, sensors: Sequence[str], n: int = 1000, key: str = "observation_id",
                   seed: int = 0) -> DataFrame:
    """Repeatable sample of ``n`` labelled rows, by hash of the key."""
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    return (df.filter(F.col("wafer_status").isNotNull())
            .select(key, "wafer_status", *[C.col(s) for s in sensors], order.alias("_h"))
            .orderBy("_h", key).limit(n).drop("_h"))
