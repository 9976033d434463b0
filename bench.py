"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Each query is
run once to warm up and then timed, with its result fully computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemill.plans.queries import QUERIES  # noqa: E402
from tidemill.session import build_session  # noqa: E402

HEADLINE = [
    "minute_rollup", "location_rollup", "reduced_rollup", "rollup_excluding_users",
    "incremental_window", "latest_per_key", "merge_upsert", "incremental_load_replay",
    "change_only", "bulk_load", "int_lists", "route_documents", "dlq_split", "topic_routing",
    "topic_upsert", "stream_change_only", "stream_minute_rollup", "flagged_sessions", "risk_report",
    "tag_range_search", "attribution_totals", "latency_summary", "value_histogram", "value_cdf",
    "hot_keys", "salted_totals", "key_slots", "knn_exact", "knn_approx", "running_alerts",
    "ledger_balance", "ledger_links",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in wanted:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
