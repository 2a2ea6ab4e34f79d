"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8). Every query runs once to warm up and
is then timed; its whole result is produced and discarded, so nothing is pruned away by an outer count.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from docfold.plans import catalog  # noqa: E402

HEADLINES = (
    "q_changes_scan q_key_unwrap q_geo_latlon q_doc_bytes q_flatten_struct_array q_flatten_map_kv q_flatten_variant q_iso_instant "
    "q_apply_index q_apply_delete q_apply_upsert q_apply_null_clears q_apply_atomic q_version_guard q_version_guard_trace "
    "q_soft_delete q_redelivery q_runs q_batches_count q_batches_bytes q_malformed q_poison_isolation q_safe_offsets "
    "q_latency_stats q_find q_range q_search_anything q_geofilt q_sort_missing_last q_topk q_custom_field q_recent_children q_top_hits"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("docfold-bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINES
    seconds = {}
    for name in wanted:
        for _ in range(2):
            began = time.perf_counter()
            catalog.QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
