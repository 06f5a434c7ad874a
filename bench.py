"""Time the headline queries and print one JSON line.

Reads ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``. Every query runs to
completion into a sink that discards rows, so reading results back is not measured.
"""

from __future__ import annotations

import json
import os
import time

from sensorloom.session import build_session
from sensorloom.workload import QUERIES

HEADLINE = [
    "layered_flow", "decode_json", "window_mean", "count_by_id", "daily_sum", "time_range", "spread_by_type",
    "label_left_join", "label_left_join_salted", "join_sort_merge", "bucketed_join", "bucketed_join_salted",
    "bucketed_count", "dedup_latest", "balance_classes", "merge_insert", "delete_where", "version_merged",
    "version_changes", "partition_pruning", "expectation_report", "rescued_record", "class_metrics", "auroc",
    "stream_label_join", "stream_window_append", "evolving_ingest", "shapley_values",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("OFF")
    # Start-up of the engine itself is not a property of any query.
    QUERIES["count_by_id"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
