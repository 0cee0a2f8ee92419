"""Physical plans: shuffles, pushdown, column pruning, no product joins."""

import contextlib
import io
import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from fabspark.operators import spc, stats, windows
from fabspark.plans import fixtures as X
from fabspark.queries import registry as R

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def tree(df) -> str:
    return plan(df).split("\n\n")[0]


def test_rules_share_one_shuffle_and_sort(spark):
    p = spc.spc_points(R.long(spark, SF), R.gold(spark, SF, "limits"))
    t = tree(spc.violation_rows(spc.rule_ends(p).filter("_own")))
    assert t.count(" Exchange (") == 1 and t.count(" Sort (") == 1 and "SortMergeJoin" not in t
    assert "CartesianProduct" not in t and "NestedLoop" not in t


def test_first_readings_are_cut_before_the_shuffle(spark):
    t = tree(spc.screened(R.long(spark, SF, R.BARE), ["line_id", "tester_id", "sensor_id"], 100))
    assert t.count("WindowGroupLimit") == 2 and t.rindex("WindowGroupLimit") > t.index(" Exchange")


def test_baseline_scan_leaves_later_data_out(spark):
    text = plan(spc.screened(R.long(spark, SF, R.BARE), ["line_id", "tester_id", "sensor_id"], 5))
    assert "LessThan(ts,2024-01" in text


def test_pareto_scans_once(spark):
    t = tree(stats.label_correlation(R.silver(spark, SF), X.SENSORS))
    assert t.count("Scan parquet") == 1 and "HashAggregate" in t and t.count(" Exchange (") == 1


def test_filters_and_columns_reach_the_scan(spark):
    d = windows.trailing(R.silver(spark, SF), "process_timestamp", "'24' HOUR").select("process_timestamp")
    text = plan(d)
    assert "GreaterThanOrEqual(ts" in text
    narrow = plan(R.staged(spark, SF).select("observation_id", "wafer_status"))
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in narrow


def test_daily_yield_shuffles_once(spark):
    from fabspark.operators import yields
    t = tree(yields.daily_yield(R.silver(spark, SF), R.quarantine(spark, SF)))
    assert t.count(" Exchange (") == 1 and "Join" not in t


def test_rules_take_one_step_a_row(spark):
    """No frame is summed anew for each row, and no row is passed through an interpreted array function."""
    p = spc.spc_points(R.long(spark, SF), R.gold(spark, SF, "limits"))
    t = plan(spc.violation_rows(spc.rule_ends(p).filter("_own"))).lower()
    frames = set(re.findall(r"specifiedwindowframe\(rowframe, ([^,]+), ([^)]+)\)", t))
    assert frames and all(low == "unboundedpreceding$()" or low == high for low, high in frames)
    assert "lambda" not in t
