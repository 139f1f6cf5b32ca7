"""The models in their order, and the gated report of one date."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.constants import ACTIVITY_ENTITIES
from murmur.functions.times import utc_literal
from murmur.operators import checks, history
from murmur.operators.checks import Check, QualityFailure
from murmur.plans import intermediate, marts, quality, registry, staging
from murmur.settings import Settings
from murmur.sources.ledger import Layout, Ledger, Part, Runs, Snapshot
from murmur.sources.tables import TableStore, together

SNAPSHOT, SUMMARY, RUN_LOG = "dim_user_snapshot", "mart_daily_summary", "pipeline_runs"
INTERACTIONS, USERS = "fct_interactions", "dim_user"
_LAYOUTS = {
    "dim_date": Layout(),
    **{name: Layout() for name in registry.MODELS},
    "fct_posts": Layout(("occurred_date",)),
    "fct_user_daily_activity": Layout(("activity_date",)),
    INTERACTIONS: Layout(("day",)),
    # Closed versions by month, never written again; the open ones have no month.
    SNAPSHOT: Layout(("month",)),
    USERS: Layout(("month",)),
}
# Partition columns that only say where a row lies.
_PLACES = ("day", "month")
_OPEN: Part = (None,)


def ledger(store: TableStore) -> Ledger:
    return Ledger(store, _LAYOUTS)


def read(store: TableStore, name: str, book: Ledger | None = None) -> DataFrame:
    """A table as the newest commit shows it."""
    book = book or ledger(store)
    return book.read(book.snapshot(), name).drop(*_PLACES)


def build_models(
    spark: SparkSession, staged: dict[str, DataFrame], settings: Settings
) -> dict[str, DataFrame]:
    """Every mart that does not need history, as lazy plans."""
    posts = staged["posts"]
    summary = intermediate.user_activity_summary(staged, settings)
    return {
        "dim_date": marts.dim_date(spark),
        "dim_hashtag": marts.dim_hashtag(posts),
        "dim_language": marts.dim_language(posts),
        "fct_posts": marts.fct_posts(posts),
        "fct_interactions": marts.fct_interactions(staged),
        "fct_user_daily_activity": marts.fct_user_daily_activity(
            intermediate.user_daily_activity(staged)
        ),
        "mart_engagement": marts.mart_engagement(posts, staged["likes"], staged["reposts"]),
        "mart_trending_hashtags": marts.mart_trending_hashtags(posts),
        "mart_anomalous_accounts": marts.mart_anomalous_accounts(summary, settings),
    }


_PARALLEL_MODELS = 4


def suite(
    spark: SparkSession, raw: dict[str, DataFrame], snapshot: DataFrame, settings: Settings
) -> list[Check]:
    """All checks over lazily built models."""
    staged = staging.stage_all(raw)
    models = build_models(spark, staged, settings)
    models["dim_user"] = marts.dim_user(snapshot)
    return quality.staging_checks(staged) + quality.mart_checks(models)


def snapshot_changes(
    book: Ledger, base: Snapshot, current: DataFrame, run_at: str
) -> dict[Part, Runs]:
    """One run of the type-2 history: the open part is replaced, versions it closes are appended.

    Files of versions closed by earlier runs are neither read nor written.
    """
    at = utc_literal(run_at)
    held = base.parts(SNAPSHOT)
    if held:
        open_rows = book.read(base, SNAPSHOT, lambda part: part == _OPEN).drop(*_PLACES)
        rows = history.snapshot_step(open_rows, current, at)
    else:
        rows = history.first_snapshot(current, at)
    return _opened_and_closed(book, base, SNAPSHOT, rows)


def _opened_and_closed(book: Ledger, base: Snapshot, table: str, rows: DataFrame) -> dict[Part, Runs]:
    written = book.write(table, history.with_month(rows))
    closed = {
        part: (*base.parts(table).get(part, ()), *runs)
        for part, runs in written.items()
        if part != _OPEN
    }
    return {_OPEN: written.get(_OPEN, ())} | closed


def interaction_changes(
    book: Ledger, base: Snapshot, interactions: DataFrame, settings: Settings
) -> dict[Part, Runs]:
    """One incremental run of the fact: only days with a new or changed row are written."""
    if not base.parts(INTERACTIONS):
        rows = interactions.withColumn("day", F.to_date("occurred_at"))
        return book.replace_all(base, INTERACTIONS, rows)
    target = book.read(base, INTERACTIONS)
    arrived = interactions.filter(F.col("occurred_at") > marts.lookback_bound(target, settings))
    arrived = book.store.scratch(arrived.withColumn("day", F.to_date("occurred_at")), "fact-arrived")
    return book.upsert(
        base, INTERACTIONS, arrived, marts.INTERACTION_KEY, lambda held, new: new
    )


def run_models(
    spark: SparkSession,
    store: TableStore,
    raw: dict[str, DataFrame],
    run_at: str,
    settings: Settings,
) -> Snapshot:
    """All models, the history and the dimension read from it, shown by one commit.

    Of two runs that overlap the later one is refused, so history has a single writer.
    """
    book = ledger(store)
    base = book.snapshot()
    staged = staging.stage_all(raw)
    models = build_models(spark, staged, settings)
    facts = models.pop(INTERACTIONS)
    work: dict[str, Callable[[], dict[Part, Runs]]] = {
        name: lambda name=name, rows=rows: book.replace_all(base, name, rows)
        for name, rows in models.items()
    }
    work[INTERACTIONS] = lambda: interaction_changes(book, base, facts, settings)
    current = intermediate.user_activity_summary(staged, settings)
    work[SNAPSHOT] = lambda: snapshot_changes(book, base, current, run_at)
    moved = together(spark, work, _PARALLEL_MODELS)
    # What this run has written of the history is what the dimension gets.
    fresh = {part: runs[-1:] for part, runs in moved[SNAPSHOT].items()}
    seen = book.preview(Snapshot(), {SNAPSHOT: fresh})
    versions = book.read(seen, SNAPSHOT).drop(*_PLACES)
    moved[USERS] = _opened_and_closed(book, base, USERS, marts.dim_user(versions))
    return book.commit(base, moved, {"run_at": run_at})


def written_suite(store: TableStore, raw: dict[str, DataFrame]) -> list[Check]:
    """All checks over the tables a run has written."""
    book = ledger(store)
    return quality.staging_checks(staging.stage_all(raw)) + quality.mart_checks(
        {name: read(store, name, book) for name in (*registry.MODELS, "dim_date")}
    )


# ------------------------------------------------------------------- run log


@dataclass
class RunLog:
    day: str
    entries: list[tuple] = field(default_factory=list)

    def add(
        self, task: str, status: str, read: int | None, written: int | None, note: str = ""
    ) -> None:
        self.entries.append((self.day, task, status, read, written, note))

    def save(self, spark: SparkSession, store: TableStore) -> None:
        schema = (
            "report_date string, task string, status string, rows_read bigint, "
            "rows_written bigint, note string"
        )
        rows = spark.createDataFrame(self.entries, schema)
        rows.coalesce(1).write.mode("append").parquet(store.location(RUN_LOG))


def read_run_log(store: TableStore) -> DataFrame:
    return store.spark.read.parquet(store.location(RUN_LOG))


# -------------------------------------------------------------- daily report


def _total(counts: DataFrame) -> int:
    return counts.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("n")).first()["n"]


def wait_until(
    ready: Callable[[], bool],
    settings: Settings,
    pause: Callable[[float], None] = time.sleep,
) -> None:
    """Ask every few seconds whether the stream has passed; give up past the limit."""
    waited = 0
    while not ready():
        if waited >= settings.catch_up_limit_seconds:
            raise QualityFailure(
                f"the change stream has not caught up within {settings.catch_up_limit_seconds} s"
            )
        pause(settings.catch_up_poll_seconds)
        waited += settings.catch_up_poll_seconds


def run_daily(
    spark: SparkSession,
    store: TableStore,
    raw: dict[str, DataFrame],
    day: str,
    run_at: str,
    settings: Settings,
    source_counts: DataFrame | None = None,
    min_rows: int | None = None,
    caught_up: Callable[[], bool] = lambda: True,
) -> None:
    """Counts, catch-up, models, checks, gate, publish. A failed step publishes nothing.

    ``caught_up`` tells whether the change stream has passed the moment of the source counts;
    raw rows are counted after that.
    """
    log = RunLog(day)
    step = "check_source_partition"
    try:
        activity = {entity: raw[entity] for entity in ACTIVITY_ENTITIES}
        source_total = None if source_counts is None else _total(source_counts)
        if source_total is not None:
            log.add(step, "success" if source_total else "skipped", source_total, None)

        step = "load_raw_partition"
        wait_until(caught_up, settings)
        raw_counts = checks.partition_counts(activity, day)
        raw_total = _total(raw_counts)
        if source_total is None:
            # No other source: the raw layer is its own.
            source_total = raw_total
            log.add("check_source_partition", "success" if raw_total else "skipped", raw_total, None)
        if source_total > 0 and raw_total == 0:
            raise QualityFailure(f"the source has {source_total} rows for {day}, raw has none")
        log.add(
            step, "success", source_total, raw_total, f"difference={raw_total - source_total}"
        )

        step = "run_models"
        run_models(spark, store, raw, run_at, settings)
        log.add(step, "success", None, None)

        step = "run_checks"
        warnings = checks.enforce(checks.report(written_suite(store, raw)))
        log.add(step, "success", None, None, f"warnings={len(warnings)}")

        step = "check_partition_quality"
        daily = read(store, "fct_user_daily_activity")
        threshold = min_rows if min_rows is not None else int(source_total > 0)
        verdict = checks.partition_gate(daily, day, threshold).first()
        if not verdict["passed"]:
            raise QualityFailure(f"data quality failed for {day}: {verdict.asDict()}")
        log.add(step, "success", verdict["row_count"], None)

        step = "publish_daily_summary"
        store.overwrite_partitions(SUMMARY, marts.daily_summary(daily, day), "report_date")
        log.add(step, "success", verdict["row_count"], 1)
        # The commit before stays for readers that have it open.
        ledger(store).vacuum()
    except Exception as failure:
        log.add(step, "failed", None, None, str(failure))
        raise
    finally:
        log.save(spark, store)
