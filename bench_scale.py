"""The daily pipeline on replicated events: wall time per step at a chosen size.

    python bench_scale.py COPIES [HOT_SHARE]

Copies keep the order of events and get users of their own. With HOT_SHARE,
that share of all events belongs to one single user.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile

from pyspark.sql import functions as F

from bench import timed
from murmur.catalog import mapping
from murmur.catalog.workspace import open_workspace
from murmur.operators import checks
from murmur.plans import daily_report, intermediate, marts, staging
from murmur.operators import history
from murmur.session import build_session


def replicate(spark, sf_dir: str, copies: int, hot_share: float) -> str:
    target = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    events = mapping.given(spark, sf_dir, "events")
    users = events.agg((F.max("user_id") + 1).alias("n")).scalar()
    many = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    owner = F.col("user_id") + F.col("copy") * users
    is_hot = F.pmod(F.xxhash64("event_id", "copy"), F.lit(1000)) < int(hot_share * 1000)
    many.select(
        (F.col("event_id") * copies + F.col("copy")).alias("event_id"),
        "ts",
        F.when(is_hot, 1).otherwise(owner).cast("long").alias("user_id"),
        "event_type", "value", "props",
    ).write.parquet(f"{target}/events.parquet")
    mapping.given(spark, sf_dir, "documents").write.parquet(f"{target}/documents.parquet")
    return target


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 20
    hot_share = float(sys.argv[2]) if len(sys.argv) > 2 else 0.0
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "murmur-bench-scale",
        master=f"local[{cpus}]",
        conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "20g",
            "spark.sql.shuffle.partitions": "32",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    w = open_workspace(spark, replicate(spark, base, copies, hot_share))
    seconds = {"land_messages": timed(w.message_folder), "land_feed": timed(w.feed)}
    seconds["log_changes"] = timed(w.logged_changes)
    seconds["ingest_events"] = timed(w.ingested_events)
    seconds["build_raw"] = timed(lambda: w.raw("posts"))
    raw, store = w.raw_tables(), w.scratch_store("scale")
    book = daily_report.ledger(store)
    staged = staging.stage_all(raw)
    models = daily_report.build_models(spark, staged, w.settings)
    facts = models.pop(daily_report.INTERACTIONS)
    current = intermediate.user_activity_summary(staged, w.settings)

    def step(label: str, table: str, build) -> None:
        """Build the parts of a table and commit them."""

        def run() -> None:
            base = book.snapshot()
            book.commit(base, {table: build(base)})

        seconds[label] = timed(run)

    for name, table in models.items():
        step(name, name, lambda base, name=name, table=table: book.replace_all(base, name, table))
    for label in ("first_facts", "next_facts"):
        step(
            label, daily_report.INTERACTIONS,
            lambda base: daily_report.interaction_changes(book, base, facts, w.settings),
        )
    for label, at in (("first_snapshot", mapping.DAY), ("next_snapshot", mapping.AS_OF)):
        step(
            label, daily_report.SNAPSHOT,
            lambda base, at=at: daily_report.snapshot_changes(book, base, current, at),
        )
    versions = daily_report.read(store, daily_report.SNAPSHOT)
    users = history.with_month(marts.dim_user(versions))
    step("dim_user", daily_report.USERS, lambda base: book.replace_all(base, daily_report.USERS, users))
    seconds["checks"] = timed(
        lambda: checks.enforce(checks.report(daily_report.written_suite(store, raw)))
    )
    daily = daily_report.read(store, "fct_user_daily_activity")
    seconds["partition_gate"] = timed(lambda: checks.partition_gate(daily, mapping.DAY, 1).first())
    seconds["publish"] = timed(
        lambda: store.overwrite_partitions(
            daily_report.SUMMARY, marts.daily_summary(daily, mapping.DAY), "report_date"
        )
    )
    print(json.dumps({"copies": copies, "hot_share": hot_share, "seconds": seconds}))


if __name__ == "__main__":
    main()
