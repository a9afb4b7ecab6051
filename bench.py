"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (tables, default sf0.1), BENCH_CPUS (local cores, default 8).
Each query runs twice: cold, its code generation included, and warm. Results go to the
no-op sink, so every row is computed. ``value`` is the sum of the cold times.
"""

import json
import os
import time

from basketstream.plans.queries import REGISTRY
from basketstream.session import build_session

HEADLINE = [
    "scan_numbered", "scan_window", "events_union", "record_ids", "envelope_build", "transform_errors",
    "publish_rows", "contract_events", "event_validation", "products_latest", "roundtrip_events",
    "landing_insert", "landing_violations",
    "incremental_load", "daily_event_activity", "client_prior_day", "client_product_candidates",
    "feature_snapshot", "dq_snapshot_integrity", "dq_not_null_unique", "offline_snapshot",
    "snapshot_by_date", "purchase_labels", "labels_by_date", "snapshot_from_orders", "labels_from_orders",
    "profile_tables", "training_rows", "training_guard_counts", "ranking_metrics", "timing_metrics",
    "stream_bronze", "purchase_model_eval",
    "replay_summary", "events_bronze", "validation_summary", "contract_products",
    "stream_landing", "end_to_end_status", "scan_multi_file",
]


def timed(spark, name, sf_dir):
    started = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds, warm = {}, {}
    timed(spark, "feature_snapshot", sf_dir)
    for name in HEADLINE:
        seconds[name] = timed(spark, name, sf_dir)
        warm[name] = timed(spark, name, sf_dir)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "warm": warm,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
