"""Micro-batch job: change messages to current state, quarantine, rollups and statistics.

Every sink writes one folder per batch in overwrite mode, so replaying a batch after a failure
replaces its own output and nothing is counted twice. No row passes through the driver; the
statistics come from an observation on the batch that is being written anyway.

Every ``fold_every`` batches, the batches behind the last fold move into partitioned tables,
all by one commit that also names the last batch it covers. Changes are merged into the
state, of which only the parts (entity, day, bucket of keys) that hold a changed key are
rewritten. Counts, quarantine and statistics are appended to their days; a day that
has gathered many runs is merged into one, and once no valid change can reach it any more it is
merged a last time and sealed. So the bytes a fold writes follow its batches, not the history.
Readers take the newest commit and the batches behind it. A batch that is replayed after it
was folded is written again and not read.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from murmur.functions.times import day_of_millis, millis_to_utc
from murmur.operators import changes, keyed_state, minute_rollups
from murmur.schemas import KEY_COLUMNS, STATE_ROW, placed
from murmur.settings import Settings
from murmur.sources import streams
from murmur.sources.ledger import Layout, Ledger, Part, Runs, Snapshot
from murmur.sources.tables import TableStore, together

CHANGES, QUARANTINE = "changes", "quarantine"
PARTIALS, BATCHES = "rollup_partials", "stream_batches"
_BATCHED = (CHANGES, QUARANTINE, PARTIALS, BATCHES)
STATE, ROLLUPS = "state", "rollups"
_THROUGH, _SEALED = "through_batch", "sealed_before"

BATCH_STATS = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("valid_row_count", T.LongType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("latency_ms", T.LongType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)
_REJECTED = T.StructType(
    [
        T.StructField("source_table", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("raw_payload", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("quarantined_at", T.TimestampNTZType()),
    ]
)
_COUNTS = T.StructType(
    [
        T.StructField("minute_ms", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("subkey", T.StringType()),
        T.StructField("n", T.LongType()),
    ]
)
_HOME = ("entity", "day", "bucket")
LAYOUTS = {
    STATE: Layout(_HOME, placed(STATE_ROW, *_HOME)),
    ROLLUPS: Layout(("metric", "day"), placed(_COUNTS, "metric", "day"), digests=("key",)),
    QUARANTINE: Layout(("day",), placed(_REJECTED, "day")),
    BATCHES: Layout(("day",), placed(BATCH_STATS, "day")),
}


def wall_clock_ms() -> int:
    return int(time.time() * 1000)


# ------------------------------------------------------------------- batches


def process_batch(
    messages: DataFrame,
    batch_id: int,
    store: TableStore,
    settings: Settings,
    clock: Callable[[], int] = wall_clock_ms,
) -> None:
    """Write one micro-batch. ``clock`` is read once, so a batch has one "now"."""
    started = time.monotonic()
    now_ms = clock()
    parsed = changes.parse_changes(messages, settings)
    observed = Observation("batch")
    source_time = F.nullif(F.col("source_ts_ms"), F.lit(0).cast("long"))
    is_valid = F.col("reason").isNull()
    validated = changes.validate_changes(parsed, settings, now_ms).observe(
        observed,
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(is_valid).alias("valid_row_count"),
        F.max(F.when(is_valid, source_time)).alias("newest_ms"),
    )
    # Three sinks read the parsed batch; lost executors rebuild it from the source. Messages and
    # images are kept of rejected rows only, which are the ones that are written with them.
    validated = validated.withColumn("value", F.when(~is_valid, F.col("value")))
    validated = validated.drop("before", "after").persist()
    try:
        valid = changes.valid_changes(validated)
        ingested_at = millis_to_utc(F.lit(now_ms).cast("long"))
        activity = minute_rollups.activity_changes(valid, now_ms)
        rejected = changes.quarantined_changes(validated).withColumn("quarantined_at", ingested_at)
        # The first sink fills the cache and the figures, the others read them side by side.
        store.append_batch(CHANGES, keyed_state.change_log(valid, ingested_at), batch_id)
        partials = minute_rollups.rollup_partials(activity)
        together(
            store.spark,
            {
                QUARANTINE: lambda: store.append_batch(QUARANTINE, rejected, batch_id),
                PARTIALS: lambda: store.append_batch(PARTIALS, partials, batch_id),
            },
        )
    finally:
        validated.unpersist()
    figures = observed.get
    newest = figures["newest_ms"]
    row = messages.sparkSession.range(1).select(
        F.lit(figures["row_count"]).cast("long").alias("row_count"),
        F.lit(figures["valid_row_count"]).cast("long").alias("valid_row_count"),
        F.lit(int((time.monotonic() - started) * 1000)).cast("long").alias("duration_ms"),
        F.lit(None if newest is None else now_ms - newest).cast("long").alias("latency_ms"),
        ingested_at.alias("created_at"),
    )
    store.append_batch(BATCHES, row, batch_id)


def start(
    messages: DataFrame,
    store: TableStore,
    settings: Settings,
    checkpoint: str,
    clock: Callable[[], int] = wall_clock_ms,
    available_now: bool = False,
) -> StreamingQuery:
    """Run continuously on the trigger interval, or drain what is there and stop."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, batch_id, store, settings, clock)
        if (batch_id + 1) % settings.fold_every == 0:
            fold(store, batch_id, settings, clock)

    if settings.redelivery_window:
        messages = streams.without_redelivered(messages, settings.redelivery_window)
    writer = messages.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=settings.trigger_interval).start()


# --------------------------------------------------------------------- folds


def ledger(store: TableStore) -> Ledger:
    return Ledger(store, LAYOUTS)


def _covered(snapshot: Snapshot) -> int:
    return int(snapshot.notes.get(_THROUGH, -1))


def _pending(store: TableStore, name: str, after: int, through: int | None = None) -> DataFrame | None:
    """The finished batches behind a commit, None if there are none.

    A batch is finished when its statistics are there, which are written last: until then no
    reader sees any of its sinks.
    """
    last = max(store.batch_ids(BATCHES), default=-1)
    last = last if through is None else min(last, through)
    if last <= after:
        return None
    at = F.col("batch_id")
    return store.read_batches(name).filter((at > after) & (at <= last))


def with_home(rows: DataFrame, settings: Settings) -> DataFrame:
    """Adds the partition columns of the state; a delete names no day of its own."""
    return keyed_state.with_bucket(rows, settings.state_buckets).withColumn(
        "day", F.to_date("occurred_at")
    )


def _day_of_counts() -> Column:
    return day_of_millis(F.col("minute_ms"))


def _folded_counts(
    book: Ledger, snapshot: Snapshot, arrived: DataFrame, settings: Settings, open_from: str
) -> dict[Part, Runs]:
    """Counts of the new batches behind those of their days; full or closing days become one run."""
    added = minute_rollups.merged_partials(arrived.drop("batch_id"))
    fresh = book.append(snapshot, ROLLUPS, added.withColumn("day", _day_of_counts()))
    sealed_before = str(snapshot.notes.get(_SEALED, ""))
    day = LAYOUTS[ROLLUPS].place("day")
    after = {**snapshot.parts(ROLLUPS), **fresh}
    crowded = {
        part
        for part, runs in after.items()
        if len(runs) > settings.most_runs
        or (len(runs) > 1 and sealed_before <= (part[day] or "") < open_from)
    }
    if not crowded:
        return fresh
    whole = book.preview(snapshot, {ROLLUPS: fresh})
    merged = minute_rollups.merged_partials(book.read(whole, ROLLUPS, crowded.__contains__))
    return fresh | book.replace(ROLLUPS, merged.withColumn("day", _day_of_counts()), crowded)


def fold(
    store: TableStore,
    through: int,
    settings: Settings,
    clock: Callable[[], int] = wall_clock_ms,
) -> Snapshot:
    """Move all batches up to ``through``, the last finished one, into the tables, by one commit.

    Batches stay until the next fold, for readers that opened the commit before this one.
    """
    book = ledger(store)
    snapshot = book.snapshot()
    covered = _covered(snapshot)
    open_from = str(millis_to_day(clock() - settings.max_age_ms))

    def state(log: DataFrame) -> dict[Part, Runs]:
        arrived = with_home(keyed_state.compact_changes(log.drop("batch_id")), settings)
        return book.upsert(
            snapshot, STATE, store.scratch(arrived, "fold-changes"), KEY_COLUMNS,
            lambda held, new: with_home(keyed_state.merge_state(held, new), settings),
            home=("entity", "bucket"), by_key=True,
        )

    def appended(name: str, stamp: str) -> Callable[[DataFrame], dict[Part, Runs]]:
        return lambda rows: book.append(snapshot, name, rows.withColumn("day", F.to_date(stamp)))

    work = {
        STATE: (CHANGES, state),
        ROLLUPS: (PARTIALS, lambda rows: _folded_counts(book, snapshot, rows, settings, open_from)),
        QUARANTINE: (QUARANTINE, appended(QUARANTINE, "quarantined_at")),
        BATCHES: (BATCHES, appended(BATCHES, "created_at")),
    }
    pending = {name: _pending(store, source, covered, through) for name, (source, _) in work.items()}
    moved = together(
        store.spark,
        {
            name: lambda build=work[name][1], rows=rows: build(rows)
            for name, rows in pending.items()
            if rows is not None
        },
    )
    sealed = max(open_from, str(snapshot.notes.get(_SEALED, "")))
    after = book.commit(snapshot, moved, {_THROUGH: max(through, covered), _SEALED: sealed})
    book.vacuum()
    for name in _BATCHED:
        store.drop_batches(name, covered)
    return after


def fold_all(
    store: TableStore, settings: Settings, clock: Callable[[], int] = wall_clock_ms
) -> Snapshot:
    """Fold what waits behind the last commit, if anything does."""
    snapshot = ledger(store).snapshot()
    newest = max(store.batch_ids(BATCHES), default=-1)
    return fold(store, newest, settings, clock) if newest > _covered(snapshot) else snapshot


def millis_to_day(millis: int) -> str:
    return time.strftime("%Y-%m-%d", time.gmtime(millis // 1000))


# --------------------------------------------------------------------- reads


def _current(store: TableStore, name: str) -> DataFrame:
    """Folded rows of an appended table and those of the batches behind them."""
    book = ledger(store)
    snapshot = book.snapshot()
    folded = book.read(snapshot, name).drop("day")
    later = _pending(store, name, _covered(snapshot))
    if later is None:
        return folded
    return folded.unionByName(later.select(*folded.columns))


def read_batches(store: TableStore) -> DataFrame:
    return _current(store, BATCHES)


def read_quarantine(store: TableStore) -> DataFrame:
    return _current(store, QUARANTINE)


def read_rollup(store: TableStore, metric: str) -> DataFrame:
    """Folded counts and those of the batches behind them, added up."""
    book = ledger(store)
    snapshot = book.snapshot()
    place = LAYOUTS[ROLLUPS].place("metric")
    counts = book.read(snapshot, ROLLUPS, lambda part: part[place] == metric).drop("day")
    later = _pending(store, PARTIALS, _covered(snapshot))
    if later is not None:
        counts = counts.unionByName(later.select(*counts.columns))
    return minute_rollups.merged_rollup(counts, metric)


def read_state(store: TableStore) -> DataFrame:
    """Current rows of every entity; no shuffle unless batches wait behind the last commit."""
    book = ledger(store)
    snapshot = book.snapshot()
    held = book.read(snapshot, STATE)
    later = _pending(store, CHANGES, _covered(snapshot))
    if later is not None:
        held = keyed_state.merge_state(held, later.drop("batch_id"))
    return keyed_state.plain_state(held)
