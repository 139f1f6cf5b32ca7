"""Headline queries, each run to completion; prints one JSON line.

``BENCH_SF_DIR`` names the input folder and ``BENCH_CPUS`` the local cores. The
landing of feed, change messages and raw tables is timed on its own, so every
query is measured on tables that already lie on storage.
"""

from __future__ import annotations

import json
import os
import sys
import time

from murmur.catalog.queries import all_queries
from murmur.catalog.workspace import open_workspace
from murmur.session import build_session

HEADLINE = (
    "parse_events",
    "entity_current",
    "users_seen",
    "cdc_validate",
    "cdc_apply",
    "event_counts_by_minute",
    "active_users_by_minute",
    "hashtag_counts_by_minute",
    "language_counts_by_minute",
    "stream_batches",
    "windowed_event_counts",
    "int_user_daily_activity",
    "int_user_activity_summary",
    "fct_interactions",
    "fct_interactions_incremental",
    "dim_user_snapshot",
    "scd2_repair",
    "mart_engagement",
    "mart_trending_hashtags",
    "mart_anomalous_accounts",
    "mart_daily_summary",
    "dq_report",
    "serve_trending",
    "serve_top_posts",
    "run_log",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "murmur-bench",
        master=f"local[{cpus}]",
        conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    workspace = open_workspace(spark, sf_dir)
    seconds = {
        "land_feed": timed(workspace.feed),
        "land_messages": timed(workspace.message_folder),
        "log_changes": timed(workspace.logged_changes),
        "ingest_events": timed(workspace.ingested_events),
        "build_raw": timed(lambda: workspace.raw("posts")),
    }
    chosen = sys.argv[1:] or HEADLINE
    registered = all_queries()
    for name in chosen:
        seconds[name] = timed(
            lambda: registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        )
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
