"""Profiling of raw tables: gaps, duplicates, constants, outliers, time span, split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fabspark.functions import columns as C
from fabspark.operators.ordering import positions
from fabspark.operators.ranking import percentiles
from fabspark.operators.reshape import to_long
from fabspark.session import settled


def _cells(cols: Sequence[str], value: str) -> Column:
    return F.inline(C.array_of([
        f"named_struct('column', {C.text(c)}, 'value', {value.format(c=C.ident(c))})" for c in cols]))


def missing_by_column(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    m = F.count_if("value")
    gaps = df.select(_cells(cols or df.columns, "{c} IS NULL"))
    return gaps.groupBy("column").agg(
        m.alias("missing"), (m / F.count(F.lit(1)) * 100).alias("percent"))


def missing_by_row(df: DataFrame, cols: Sequence[str], key: str, k: int = 20) -> DataFrame:
    """The ``k`` rows with most missing columns."""
    n = C.missing_count(cols)
    return df.select(key, n.alias("missing"), (n / len(cols) * 100).alias("percent")).orderBy(
        F.desc("missing"), key).limit(k)


def duplicates(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows that occur more than once, with how often.

    Only row hashes are shuffled to find candidates; the full rows of those few
    are then compared exactly.
    """
    cols = list(cols or df.columns)
    hashed = df.select(*map(C.ident, cols)).withColumn("_h", F.expr(f"xxhash64({', '.join(map(C.ident, cols))})"))
    again = settled(hashed.groupBy("_h").count().filter("count > 1").select("_h"), "hashes")
    return hashed.join(again, "_h", "left_semi").groupBy(*map(C.ident, cols)).agg(
        F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def constant_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Columns without a value or with one value only; no distinct count needed.

    Smallest and largest are taken of 64-bit hashes of the values: longs keep to a
    hash aggregate, text would be sorted.
    """
    hashes = df.select(_cells(cols or df.columns, "CASE WHEN {c} IS NOT NULL THEN xxhash64({c}) END"))
    c = hashes.groupBy("column").agg(
        F.count("value").alias("values"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    return c.filter((F.col("values") == 0) | (F.col("lo") == F.col("hi"))).select(
        "column", F.when(F.col("values") == 0, "empty").otherwise("constant").alias("kind"), "values")


def label_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows per label and their ratio to the rarest label (few labels: one row each)."""
    c = settled(df.groupBy(label).agg(F.count(F.lit(1)).alias("n")), "labels")
    least = c.agg(F.min("n")).first()[0]
    return c.withColumn("ratio", F.col("n") / F.lit(float(least or 1)))


def iqr_outliers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Values beyond 1.5 interquartile ranges, per column, with exact quartiles."""
    long = to_long(df, cols, [])
    # One row per column: bounded by the schema.
    q = settled(percentiles(long, ["sensor_id"], {"q1": 0.25, "q3": 0.75}), "quartiles")
    reach = (F.col("q3") - F.col("q1")) * 1.5
    v = F.col("val")
    hit = (v < F.col("q1") - reach) | (v > F.col("q3") + reach)
    c = long.join(q.drop("n"), "sensor_id", "left").groupBy(F.col("sensor_id").alias("column")).agg(
        F.max("q1").alias("q1"), F.max("q3").alias("q3"), F.count_if(hit).alias("outliers"),
        F.count(F.lit(1)).alias("_all"))
    return c.select("column", "q1", "q3", "outliers",
                    C.ratio(F.col("outliers"), F.col("_all"), 100, 2).alias("percent"))


def time_span(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.min(ts).alias("earliest"), F.max(ts).alias("latest"),
                  F.countDistinct(F.to_date(ts)).alias("days")).withColumn(
        "span_seconds", F.expr("timestampdiff(SECOND, earliest, latest)"))


def type_profile(df: DataFrame) -> DataFrame:
    """Columns of each type, from the schema alone."""
    rows: dict[str, list[str]] = {}
    for f in df.schema.fields:
        rows.setdefault(f.dataType.simpleString(), []).append(f.name)
    return df.sparkSession.createDataFrame(
        [(t, len(c), c) for t, c in rows.items()],
        T.StructType([T.StructField("type", T.StringType()), T.StructField("columns", T.IntegerType()),
                      T.StructField("names", T.ArrayType(T.StringType()))]))


def split_point(df: DataFrame, label: str, order: Sequence[str], share: float = 0.2):
    """First row of the test part: the k-th latest failure, k = floor(failures * share).

    With k = 0 the newest row alone is the test part. Returns the values of
    ``order`` of that row as text, or None for an empty table.
    """
    text = [F.col(c).cast("string") for c in order]
    fails = df.filter(F.col(label) == 1).select(*order)
    back = [F.col(c).desc() for c in order]
    k = int(fails.count() * share)
    if k == 0:
        return df.select(*order).orderBy(*back).limit(1).select(*text).first()
    placed = positions(fails.withColumn("_all", F.lit(0)), ["_all"], back)
    return placed.filter(F.col("seq") == k).select(*text).first()


def time_split(df: DataFrame, label: str, order: Sequence[str], share: float = 0.2) -> DataFrame:
    """Mark rows ``train`` or ``test`` so that the newest part holds ``share`` of the failures."""
    at = split_point(df, label, order, share)
    if at is None:
        return df.withColumn("part", F.lit("train"))
    cut = F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order, at)])
    late = F.struct(*[F.col(c) for c in order]) >= cut
    return df.withColumn("part", F.when(late, "test").otherwise("train"))


def importance(train: DataFrame, features: Sequence[str], label: str, k: int = 15, rounds: int = 20,
               depth: int = 4, seed: int = 42) -> DataFrame:
    """Feature importance of a boosted tree in which both classes weigh the same."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import Imputer, VectorAssembler

    spark = train.sparkSession
    counts = {row[0]: row[1] for row in train.groupBy(label).count().collect()}  # two rows
    weight = F.when(F.col(label) == 1, float(counts.get(0, 1)) / max(counts.get(1, 1), 1)).otherwise(1.0)
    names = [f"_x{i}" for i in range(len(features))]
    data = train.select(F.col(label).cast("double").alias("_y"), weight.alias("_w"),
                        *[C.col(f).cast("double").alias(n) for f, n in zip(features, names)])
    filled = [n + "f" for n in names]
    model = Pipeline(stages=[
        Imputer(inputCols=names, outputCols=filled, strategy="median"),
        VectorAssembler(inputCols=filled, outputCol="_v"),
        GBTClassifier(featuresCol="_v", labelCol="_y", weightCol="_w", maxIter=rounds, maxDepth=depth,
                      stepSize=0.1, seed=seed, checkpointInterval=10),
    ]).fit(data)
    scores = model.stages[-1].featureImportances.toArray()
    rows = [(f, float(s)) for f, s in zip(features, scores)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature").limit(k)
