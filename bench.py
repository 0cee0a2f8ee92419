"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data, BENCH_CPUS the local cores. Every query is read
from the driver tables and run in full into a sink that keeps nothing; gold
tables that serving queries read are built first and timed as ``build_gold``.
"""

from __future__ import annotations

import json
import os
import time

from fabspark.queries import load
from fabspark.queries.registry import QUERIES, gold
from fabspark.session import build_session

HEADLINE = [
    # tables
    "e1_daily_yield", "e5_shift_metrics", "e7_oee", "g1_baseline", "g9_spc_violations", "h1_failure_pareto",
    # control charts and statistics
    "g10_monitor", "g11_analyze_batch", "g13_capability", "g14_long_term_capability", "f2_sequence_number",
    "h2_corr_matrix", "h2_corr_matrix_wide", "h4_spearman", "h6_wasserstein_drift", "h7_null_topology",
    "h10_duplicates", "h13_iqr_outliers", "h17_time_split", "h21_box_stats",
    # serving
    "e8_headline", "e9_yield_trend", "e10_active_alarms", "e13_daily_kpis", "e15_calendar", "e17_yield_by",
    "e19_violation_log", "e21_health_matrix", "e23_oee_snapshot", "e26_dppm_trend", "c6_waterfall",
    # sources, augmentation, streams
    "a2_landing_scan", "a12_latest_batch", "n2_jitter", "n3_replay", "l5_stream_to_bronze", "l7_stream_spc",
    "h11_constant_columns", "h16_density", "h18_feature_importance", "l3_redelivered_messages", "l5_message_driven", "l6_refresh",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    load()
    run(QUERIES["e1_daily_yield"](spark, sf_dir))  # start the engine
    seconds: dict[str, float] = {}
    start = time.time()
    for name in ("daily", "shifts", "oee", "limits", "violations"):
        gold(spark, sf_dir, name)
    seconds["build_gold"] = round(time.time() - start, 3)
    for name in HEADLINE:
        start = time.time()
        run(QUERIES[name](spark, sf_dir))
        seconds[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "total_wall_clock", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
