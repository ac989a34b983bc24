"""Time every headline query; prints one JSON line.

Environment: BENCH_SF_DIR (table folder), BENCH_CPUS (threads), BENCH_RUNS
(timed runs after one warm-up, the median counts), BENCH_QUERIES (comma list).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from itemsync.plans.queries import QUERIES  # noqa: E402
from itemsync.session import local_session  # noqa: E402

# One query per kind of plan: window scan, attachment join, shaping of each
# object, text extraction, dedup, registry, access lists, batching, state, jobs.
HEADLINE = [
    "item_window_open",
    "items_per_chunk",
    "item_attachments",
    "item_attachments_same_chunk",
    "account_items_local_time",
    "mail_documents",
    "calendar_documents",
    "task_documents",
    "contact_documents",
    "html_body_text",
    "attachment_text",
    "dedup_documents",
    "latest_by_id",
    "registry_merge",
    "deleted_ids",
    "revoked_identities",
    "granted_permissions",
    "round_robin_buckets",
    "fixed_chunks",
    "document_sizes",
    "byte_batches",
    "consumer_batches",
    "ids_by_type",
    "index_report",
    "upsert_snapshot",
    "full_sync_docs",
    "incremental_sync_docs",
    "deletion_sync_plan",
    "permission_sync_plan",
    "incremental_stream",
]


def timed(query, spark, folder: str) -> float:
    begin = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = local_session(cpus, "itemsync-bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        timed(QUERIES[name], spark, folder)
        times = [timed(QUERIES[name], spark, folder) for _ in range(runs)]
        seconds[name] = round(statistics.median(times), 3)
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
