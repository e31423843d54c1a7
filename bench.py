"""Time the headline queries and print one JSON line.

BENCH_SF_DIR chooses the data (default sf0.1), BENCH_CPUS the cores. Each query is run to the last row
into a sink that discards them; a first, untimed query warms the session up.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.plans import cases
from tidemark.session import session

HEADLINE = (
    "patterns_by_time", "top_by_bucket", "feature_profile", "daily_trends", "share_of_total", "hourly_profile",
    "pairwise_corr", "period_compare", "part_of_day_profile", "shift_patterns", "state_transitions",
    "recommend_top", "best_hours", "rule_playlists", "intervention_hours", "zscore_anomalies", "silver_anomalies",
    "state_counts", "behavior_segment", "behavior_segment_by_user", "multi_source_join", "source_preference",
    "deterministic_features", "training_scan", "json_events", "one_per_key", "idempotent_append", "upsert",
    "dq_suite", "predict_linear",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = session(
        "bench",
        master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    cases.QUERIES["scan_events"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        cases.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir)}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
