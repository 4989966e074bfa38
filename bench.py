"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "personal_columns_report", "f8_normalize_name", "r2_all_matches", "r11_entity_resolution",
    "a1_name_catalog", "a8_mine_families", "a11_mixed_labels", "a16_pool_candidates",
    "w2_authority_dedup", "w4_top_candidates", "m9_slice_guarantee", "m5_target_encoding_oof",
    "e1_threshold_grid", "e9_average_precision", "w1_keep_latest", "j14_merge_history",
    "a23_stale_projects_1m", "a21_activity_histogram", "m1_char_tfidf", "j1_nearest_at_floor", "j1_nearest_complete",
    "m26_label_transfer", "m19_name_clusters", "m25_two_stage_scoring", "t1_batch_scoring",
]


def main() -> None:
    from checks import all_queries
    from tablescout.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    shared = tempfile.mkdtemp(prefix="tablescout-bench-")
    spark = build_session(f"local[{cpus}]", "tablescout-bench", **{
        "spark.checkpoint.dir": f"file://{shared}/checkpoints", "spark.sql.warehouse.dir": f"{shared}/warehouse",
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = all_queries()
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors
    times: dict[str, float] = {}
    for name in HEADLINE:
        if only and name not in only:
            continue
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
