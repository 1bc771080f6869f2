"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from funnelspark.plans import catalog  # noqa: E402
from funnelspark.session import build_session  # noqa: E402

QUERIES = [
    "a1_daily_stats", "x1_latest_wins", "scd2_history", "j1_lookback_first_touch", "j2_followup", "j4_tiered_linking",
    "j6_fuzzy_blocked", "j6_similar_words", "j12_funnel_weekly", "a3_spend_weekly", "a4_stage_counts", "m5_trailing28", "m15_adc", "c2_block_score",
    "c12_fin_unified", "w5_merge",
]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    names = sys.argv[1:] or QUERIES
    spark = build_session("bench", f"local[{cpus}]", spark_ui_enabled="false", spark_sql_shuffle_partitions=str(2 * int(cpus)), spark_checkpoint_dir=tempfile.mkdtemp(prefix="bench-"))
    spark.sparkContext.setLogLevel("ERROR")
    all_queries, seconds = catalog.queries(), {}
    for name in names:
        times = []
        for _ in range(RUNS + 1):  # the first run warms up
            start = time.perf_counter()
            all_queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
