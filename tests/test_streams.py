"""Stream results equal table results; replays and late readings."""

import datetime as dt

from pyspark.sql import functions as F

from fabspark.operators import spc
from fabspark.session import new_path
from fabspark.streaming import spc as stream
from test_rules import LIMITS, frame, limits, random_series


def rows(df):
    return sorted((r.sensor_id, r.line_id, r.observation_id, r.rule_number) for r in df.collect())


def test_batches_in_order_equal_the_table(spark):
    f, lim, root = frame(spark, random_series(8)), limits(spark, LIMITS), new_path(spark, "spc")
    cuts = [dt.datetime(2024, 1, 1, 0, m) for m in (0, 7, 8, 40, 41)] + [dt.datetime(2025, 1, 1)]
    t = F.col("process_timestamp")
    for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        part = f.filter((t >= F.lit(str(lo)).cast("timestamp_ntz")) & (t < F.lit(str(hi)).cast("timestamp_ntz")))
        stream.judge(part, lim, root, i, block_rows=16)
        if i == 2:  # a batch delivered again replaces itself
            stream.judge(part, lim, root, i, block_rows=16)
    assert rows(spark.read.parquet(f"{root}/violations")) == rows(spc.violations(f, lim))
    assert spark.read.parquet(f"{root}/late").count() == 0


def test_late_readings_go_to_the_side(spark):
    f, lim, root = frame(spark, {("s", "A"): [0.0] * 20}), limits(spark, [("s", "A", 0.0, 1.0)]), new_path(spark, "spc")
    stream.judge(f.filter("observation_id >= 10"), lim, root, 0)
    stream.judge(f.filter("observation_id < 12"), lim, root, 1)
    assert sorted(r.observation_id for r in spark.read.parquet(f"{root}/late").collect()) == list(range(12))
