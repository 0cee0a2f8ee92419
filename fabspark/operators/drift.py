"""Distribution drift of new batches against a baseline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabspark import constants as K
from fabspark.functions import columns as C
from fabspark.operators.ordering import positions
from fabspark.operators.ranking import value_counts
from fabspark.operators.reshape import to_long
from fabspark.session import settled


def match_baseline(base: DataFrame, batch: DataFrame, ts: str = "process_timestamp") -> DataFrame:
    """Baseline rows whose month and day occur in the batch (at most 366 of them)."""
    days = settled(batch.select(C.month_day(F.col(ts)).alias("_md")).distinct(), "days")
    return base.withColumn("_md", C.month_day(F.col(ts))).join(days, "_md", "left_semi").drop("_md")


def drift(base: DataFrame, batch: DataFrame, limit: float = K.DRIFT_LIMIT,
          min_readings: int = 5) -> DataFrame:
    """Wasserstein-1 distance per (line, sensor), relative to the baseline spread.

    ``base`` has (sensor_id, val), ``batch`` (line_id, sensor_id, val). Both are
    counted by distinct value first. The distance is the area between the two
    distribution functions: running counts of both sides over the merged values,
    times the gap to the next value.
    """
    spread = base.groupBy("sensor_id").agg(F.count("val").alias("base_n"),
                                           C.spread(F.col("val")).alias("base_std"))
    sizes = batch.groupBy("line_id", "sensor_id").agg(F.count("val").alias("batch_n"))
    # One row per line and sensor; its written size decides the join.
    groups = settled(sizes.join(spread, "sensor_id").filter(
        (F.col("base_n") >= min_readings) & (F.col("batch_n") >= min_readings)
        & (F.col("base_std") != 0)), "groups")
    b = value_counts(base, ["sensor_id"]).join(groups.select("line_id", "sensor_id"), "sensor_id").select(
        "line_id", "sensor_id", "val", F.col("_n").alias("b"), F.lit(0).cast("long").alias("g"))
    g = value_counts(batch, ["line_id", "sensor_id"]).join(
        groups.select("line_id", "sensor_id"), ["line_id", "sensor_id"], "left_semi").select(
        "line_id", "sensor_id", "val", F.lit(0).cast("long").alias("b"), F.col("_n").alias("g"))
    merged = b.unionByName(g).groupBy("line_id", "sensor_id", "val").agg(
        F.sum("b").alias("b"), F.sum("g").alias("g"))
    placed = positions(merged, ["line_id", "sensor_id"], ["val"],
                       totals={"cum_b": "b", "cum_g": "g"}, following="val")
    gap = F.abs(F.col("cum_b") / F.col("series_cum_b") - F.col("cum_g") / F.col("series_cum_g"))
    dist = placed.groupBy("line_id", "sensor_id").agg(
        F.coalesce(F.sum(gap * (F.col("next_val") - F.col("val"))), F.lit(0.0)).alias("distance"))
    rel = F.col("distance") / F.col("base_std")
    return dist.join(groups, ["line_id", "sensor_id"]).select(
        "line_id", "sensor_id", "base_n", "batch_n", "distance",
        C.rounded(rel, 4).alias("drift_score"), (rel > limit).alias("drifted"),
        F.when(rel > limit, "Drifted").otherwise("Stable").alias("status"))


def ranked(scores: DataFrame) -> DataFrame:
    return scores.orderBy(F.desc("drift_score"), "line_id", "sensor_id")


def most_drifted(scores: DataFrame) -> DataFrame:
    return ranked(scores).limit(1)


def null_topology(base: DataFrame, batch: DataFrame, sensors: Sequence[str], prefix: str = "") -> DataFrame:
    """Percent of missing readings per sensor in the baseline and in each line.

    Sensors complete everywhere are dropped. ``max_generated`` is the sort key:
    the worst line of the sensor.
    """
    def share(df, source):
        return to_long(df.withColumn("_src", source), sensors, ["_src"], prefix).groupBy(
            F.col("_src").alias("source"), "sensor_id").agg(
            (F.count_if(F.col("val").isNull()) / F.count(F.lit(1)) * 100).alias("missing_pct"))

    both = share(base, F.lit("Baseline")).unionByName(
        share(batch, F.concat(F.lit("Gen "), F.col("line_id"))))
    both = settled(both, "nulls")
    worst = both.groupBy("sensor_id").agg(
        F.max("missing_pct").alias("_any"),
        F.max(F.when(F.col("source") != "Baseline", F.col("missing_pct"))).alias("max_generated"))
    return both.join(worst.filter(F.col("_any") > 0).drop("_any"), "sensor_id").select(
        "sensor_id", "source", "missing_pct", "max_generated")


def histogram(base: DataFrame, batch: DataFrame, bins: int = 50) -> DataFrame:
    """Counts of two (val) frames in equal bins over their common range."""
    both = base.select(F.lit("Baseline").alias("source"), "val").unionByName(
        batch.select(F.lit("Generated").alias("source"), "val")).filter(
        F.col("val").isNotNull() & ~F.isnan("val"))
    lo, hi = both.agg(F.min("val"), F.max("val")).first()
    if lo is None:
        return both.groupBy("source", F.lit(0).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (hi - lo) / bins or 1.0
    cell = F.least(F.floor((F.col("val") - lo) / F.lit(width)), F.lit(bins - 1)).cast("long")
    return both.groupBy("source", cell.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def density(base: DataFrame, batch: DataFrame, points: int = 500) -> DataFrame:
    """Gaussian kernel density of two (val) frames, each on its own even grid.

    The bandwidth is std * n^(-1/5). Every distinct value adds its kernel to each
    of ``points`` grid cells, summed inside the task before the shuffle.
    """
    both = base.select(F.lit("Baseline").alias("source"), "val").unionByName(
        batch.select(F.lit("Generated").alias("source"), "val")).filter(
        F.col("val").isNotNull() & ~F.isnan("val"))
    # Two rows, one per source.
    shape = settled(both.groupBy("source").agg(
        F.min("val").alias("lo"), F.max("val").alias("hi"), F.count(F.lit(1)).alias("n"),
        C.spread(F.col("val")).alias("sd")).filter((F.col("n") > 1) & (F.col("sd") > 0)), "shape")
    h = F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    cells = value_counts(both, ["source"]).join(shape, "source").withColumn(
        "point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    x = F.col("lo") + F.col("point") * (F.col("hi") - F.col("lo")) / points
    u = (x - F.col("val")) / h
    kernel = F.exp(-0.5 * u * u) * F.col("_n") / (F.col("n") * h * F.sqrt(2 * F.pi()))
    return cells.select("source", "point", x.alias("x"), kernel.alias("k")).groupBy("source", "point").agg(
        F.min("x").alias("x"), F.sum("k").alias("density"))
