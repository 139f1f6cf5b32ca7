"""Batch and stream agree, replay changes nothing, late rows behave as documented."""

import json
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from murmur.operators import changes, keyed_state, minute_rollups
from murmur.schemas import KEY_COLUMNS, PAYLOAD_COLUMNS, RAW_STATE
from murmur.settings import Settings
from murmur.sources import streams
from murmur.sources.tables import CommitRefused
from murmur.streaming import change_stream, feed_stream, windowed

NOW = 1_706_659_200_000
SETTINGS = Settings(salt="s", sampling_rate=1.0)
MINUTE = 60_000
COLUMNS = "topic string, partition int, offset long, value string"


def change(offset, user="u1", ts=NOW, op="c", entity="posts", tags=("A", "b"), language="en", key=None):
    image = {"user_id_hash": user, "record_key": key or f"r{offset}", "language": language,
             "hashtags": list(tags)}
    before, after = (image, None) if op == "d" else (None, image)
    value = {"before": before, "after": after, "source": {"ts_ms": ts}, "op": op}
    return (SETTINGS.topic_prefix + entity, 0, offset, json.dumps(value))


MESSAGES = [
    change(1, ts=NOW - 9 * MINUTE), change(2, "u2", NOW - 9 * MINUTE, tags=("A",)),
    change(3, ts=NOW - 8 * MINUTE, op="d", key="r1"),
    change(4, ts=NOW - 7 * MINUTE, language="", tags=()), change(5, "u2", NOW - 7 * MINUTE, entity="likes"),
    (SETTINGS.topic_prefix + "posts", 0, 6, "not-json"),
    change(7, entity="users", ts=NOW - 7 * MINUTE),
    change(8, ts=NOW - 6 * MINUTE), change(9, "u3", None),
]


@pytest.fixture
def folder(spark, tmp_path):
    """Three files, so that a stream of one file per trigger has three batches."""
    path = str(tmp_path / "landed")
    for start in range(0, len(MESSAGES), 3):
        rows = spark.createDataFrame(MESSAGES[start:start + 3], COLUMNS)
        rows.coalesce(1).write.mode("append").parquet(path)
    return path


def drain(spark, folder, store, settings=SETTINGS):
    change_stream.start(
        streams.file_changes(spark, folder, 1), store, settings, store.location("checkpoint"),
        clock=lambda: NOW, available_now=True,
    ).awaitTermination()


def valid(spark, folder):
    parsed = changes.parse_changes(streams.landed_changes(spark, folder), SETTINGS)
    return changes.valid_changes(changes.validate_changes(parsed, SETTINGS, NOW))


def rows(table):
    return sorted((tuple(r) for r in table.select(*sorted(table.columns)).collect()), key=repr)


def batch_rollups(activity):
    return {
        minute_rollups.EVENTS: minute_rollups.event_counts(activity),
        minute_rollups.USERS: minute_rollups.active_users(activity),
        minute_rollups.TAGS: minute_rollups.hashtag_counts(activity),
        minute_rollups.LANGUAGES: minute_rollups.language_counts(activity),
    }


def test_rollups_of_the_batch(spark, folder):
    activity = minute_rollups.activity_changes(valid(spark, folder), NOW)
    found = batch_rollups(activity)
    assert found[minute_rollups.EVENTS].agg(F.sum("event_count")).first()[0] == 7
    assert found[minute_rollups.TAGS].filter("hashtag = 'A'").agg(F.sum("tag_count")).first()[0] == 4
    assert found[minute_rollups.LANGUAGES].filter("language = ''").count() == 0
    at = {r.minute_bucket.minute for r in found[minute_rollups.USERS].filter("user_id_hash = 'u3'").collect()}
    assert at == {0}, "a change without a time counts as now"


@pytest.mark.parametrize("fold_every", [100, 2])
def test_stream_equals_batch_and_replay_is_idempotent(spark, folder, store, fold_every):
    drain(spark, folder, store, replace(SETTINGS, fold_every=fold_every))
    activity = minute_rollups.activity_changes(valid(spark, folder), NOW)
    expected = {name: rows(table) for name, table in batch_rollups(activity).items()}

    def check():
        for name, wanted in expected.items():
            assert rows(change_stream.read_rollup(store, name)) == wanted, name
        log = keyed_state.change_log(valid(spark, folder), F.lit(None).cast("timestamp_ntz"))
        state = keyed_state.collapse_changes(log).drop("ingested_at")
        assert rows(change_stream.read_state(store).drop("ingested_at")) == rows(state)
        assert change_stream.read_quarantine(store).count() == 1
        stats = change_stream.read_batches(store).orderBy("batch_id").collect()
        assert [(r.row_count, r.valid_row_count) for r in stats] == [(3, 3), (3, 2), (3, 3)]
        assert [r.latency_ms for r in stats] == [8 * MINUTE, 7 * MINUTE, 6 * MINUTE]

    check()
    again = spark.createDataFrame(MESSAGES[3:6], COLUMNS)
    change_stream.process_batch(again, 1, store, SETTINGS, lambda: NOW)
    check()
    change_stream.fold(store, 2, SETTINGS, lambda: NOW)
    check()


def test_reads_leave_folded_batches_alone(spark, folder, store):
    drain(spark, folder, store, replace(SETTINGS, fold_every=2))
    for read in (change_stream.read_state(store), change_stream.read_rollup(store, minute_rollups.EVENTS)):
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "batch_id#" in plan and "> 1)" in plan
    change_stream.fold(store, 2, SETTINGS, lambda: NOW)
    for name in ("changes", "quarantine", "rollup_partials", "stream_batches"):
        assert store.batch_ids(name) == [2], name
    plan = change_stream.read_state(store)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan, "kept state is read as it lies"


def runs_of(store, table):
    return dict(change_stream.ledger(store).snapshot().parts(table))


def test_a_fold_rewrites_only_parts_with_changed_keys(spark, store):
    day = 86_400_000
    settings = replace(SETTINGS, state_buckets=16)

    def batch(number, messages):
        change_stream.process_batch(
            spark.createDataFrame(messages, COLUMNS), number, store, settings, lambda: NOW
        )
        change_stream.fold(store, number, settings, lambda: NOW)

    def at(offset, user, days, **kwargs):
        message = list(change(offset, user, NOW - days * day, **kwargs))
        value = json.loads(message[3])
        for image in ("before", "after"):
            if value[image]:
                value[image]["occurred_at"] = f"2024-01-{30 - days:02d}T12:00:00Z"
        return (*message[:3], json.dumps(value))

    batch(0, [at(i, f"u{i}", i % 5) for i in range(1, 61)])
    before = runs_of(store, "state")
    assert {part[1] for part in before} == {f"2024-01-{d}" for d in range(26, 31)} and len(before) > 25
    # One user writes today, one changes an old post, one moves a post to another day.
    batch(1, [at(201, "u1", 0, key="new"), at(202, "u8", 3, op="u", key="r8"), at(203, "u4", 2, op="u", key="r4")])
    after = runs_of(store, "state")
    changed = {part for part in set(before) | set(after) if before.get(part) != after.get(part)}
    assert {part[1] for part in changed} == {"2024-01-30", "2024-01-27", "2024-01-26", "2024-01-28"}
    assert len(changed) == 4
    state = change_stream.read_state(store)
    assert state.count() == 61
    moved = state.filter("record_key = 'r4'").collect()
    assert [r.occurred_at.day for r in moved] == [28] and [r.cdc_op for r in moved] == ["u"]
    # A delete keeps the row in its part, and nothing else moves.
    batch(2, [at(204, "u8", 3, op="d", key="r8")])
    last = runs_of(store, "state")
    assert len({p for p in set(last) | set(after) if last.get(p) != after.get(p)}) == 1
    assert change_stream.read_state(store).filter("is_deleted").count() == 1


def test_counts_are_appended_then_merged_and_sealed(spark, store):
    """The counts' part of a fold, run by itself."""
    settings = replace(SETTINGS, most_runs=2)
    book = change_stream.ledger(store)

    def fold_counts(day, open_from):
        minute = int(datetime.fromisoformat(f"{day}T12:00:00+00:00").timestamp() * 1000)
        counts = spark.createDataFrame(
            [("events", minute, "posts", "c", 3)], "metric string, minute_ms long, key string, subkey string, n long")
        snapshot = book.snapshot()
        moved = change_stream._folded_counts(book, snapshot, counts, settings, open_from)
        book.commit(snapshot, {"rollups": moved}, {"sealed_before": open_from})
        return dict(book.snapshot().parts("rollups"))

    part = ("events", "2024-01-30")
    for n in (1, 2):
        assert len(fold_counts("2024-01-30", "2024-01-01")[part]) == n
    assert len(fold_counts("2024-01-30", "2024-01-01")[part]) == 1, "a crowded day becomes one run"
    assert len(fold_counts("2024-01-30", "2024-01-01")[part]) == 2
    sealed = fold_counts("2024-02-05", "2024-02-01")[part]
    assert len(sealed) == 1, "a day no change can reach is merged"
    assert fold_counts("2024-02-05", "2024-02-01")[part] == sealed
    rows_ = book.read(book.snapshot(), "rollups")
    assert {(str(r.day), r.n) for r in rows_.groupBy("day").agg(F.sum("n").alias("n")).collect()} == {
        ("2024-01-30", 12), ("2024-02-05", 6)}


def test_a_fold_that_breaks_off_shows_nothing(spark, folder, store, monkeypatch):
    """State and counts move by one commit: failing between their writes leaves readers behind it."""
    drain(spark, folder, store, SETTINGS)
    change_stream.fold(store, 1, SETTINGS, lambda: NOW)
    before = rows(change_stream.read_state(store)), rows(change_stream.read_rollup(store, minute_rollups.EVENTS))
    number = change_stream.ledger(store).snapshot().number

    def broken(*args, **kwargs):
        raise OSError("disk full")

    with monkeypatch.context() as patch:
        patch.setattr(change_stream, "_folded_counts", broken)
        with pytest.raises(OSError):
            change_stream.fold(store, 2, SETTINGS, lambda: NOW)
    assert change_stream.ledger(store).snapshot().number == number
    assert before == (rows(change_stream.read_state(store)), rows(change_stream.read_rollup(store, minute_rollups.EVENTS)))
    change_stream.fold(store, 2, SETTINGS, lambda: NOW)
    assert before == (rows(change_stream.read_state(store)), rows(change_stream.read_rollup(store, minute_rollups.EVENTS)))


def test_a_batch_that_breaks_off_is_not_seen(spark, store, monkeypatch):
    first = spark.createDataFrame(MESSAGES[:3], COLUMNS)
    second = spark.createDataFrame(MESSAGES[3:6], COLUMNS)
    change_stream.process_batch(first, 0, store, SETTINGS, lambda: NOW)

    def seen():
        return [rows(change_stream.read_state(store)), rows(change_stream.read_quarantine(store)),
                rows(change_stream.read_rollup(store, minute_rollups.EVENTS)),
                [r.batch_id for r in change_stream.read_batches(store).select("batch_id").collect()]]

    before, write = seen(), store.append_batch

    def broken(name, *args, **kwargs):
        if name == "rollup_partials":
            raise OSError("disk full")
        write(name, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(store, "append_batch", broken)
        with pytest.raises(OSError):
            change_stream.process_batch(second, 1, store, SETTINGS, lambda: NOW)
    assert store.batch_ids("changes") == [0, 1] and seen() == before
    change_stream.process_batch(second, 1, store, SETTINGS, lambda: NOW)
    assert seen() != before and len(seen()[0]) == 4


def test_of_two_folds_that_overlap_one_is_refused(spark, folder, store):
    drain(spark, folder, store, SETTINGS)
    book = change_stream.ledger(store)
    base = book.snapshot()
    change_stream.fold(store, 2, SETTINGS, lambda: NOW)
    with pytest.raises(CommitRefused):
        book.commit(base, {}, {"through_batch": 2})


def test_older_changes_do_not_regress_compacted_state(spark):
    log = spark.createDataFrame(
        [(1, "c", "a", "en"), (2, "u", "a", "de"), (3, "d", "a", None), (1, "d", "b", None),
         (4, "c", "c", "fr"), (5, "u", "c", "pt")],
        "offset int, op string, user_id_hash string, language string",
    )
    log = log.select(
        F.lit("posts").alias("entity"), "user_id_hash", F.lit("r").alias("record_key"),
        F.struct(F.lit(0).alias("partition"), F.col("offset").cast("long").alias("offset")).alias("seq"),
        "op", F.lit(None).cast("timestamp_ntz").alias("ingested_at"), "language",
        F.col("offset").cast("long").alias("kafka_offset"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in RAW_STATE.fields
          if f.name in PAYLOAD_COLUMNS and f.name not in (*KEY_COLUMNS, "language")],
    )
    whole = rows(keyed_state.collapse_changes(log))
    compact = keyed_state.compact_changes(log)
    assert compact.count() == 4
    older = log.filter("offset <= 2")
    assert rows(keyed_state.collapse_changes(compact.unionByName(older))) == whole
    again = keyed_state.compact_changes(compact.unionByName(older))
    assert rows(keyed_state.collapse_changes(again)) == whole
    halves = keyed_state.compact_changes(log.filter("offset > 2")).unionByName(older)
    assert rows(keyed_state.collapse_changes(keyed_state.compact_changes(halves))) == whole


def test_watermarked_counts_equal_batch_on_ordered_input(spark, folder, store):
    activity = minute_rollups.activity_changes(valid(spark, folder), NOW)
    stream = windowed.watermarked_activity(streams.file_changes(spark, folder, 1), SETTINGS, F.lit(NOW))
    for name, build, keys, value in (
        (minute_rollups.EVENTS, windowed.event_counts, ["event_type", "operation"], "event_count"),
        (minute_rollups.TAGS, windowed.hashtag_counts, ["hashtag"], "tag_count"),
    ):
        windowed.start_updates(
            build(stream), store, name, store.location(f"checkpoint-{name}"), available_now=True
        ).awaitTermination()
        latest = windowed.latest_values(store, name, keys, value)
        assert rows(latest) == rows(batch_rollups(activity)[name])


def test_feed_stream(spark, store, tmp_path):
    def line(seq, did, time_us, kind="app.bsky.feed.post"):
        event = {"did": did, "time_us": time_us, "kind": "commit", "commit": {
            "operation": "create", "collection": kind, "rkey": "k", "record": {"text": "#x"}}}
        return (seq, json.dumps(event))

    path = str(tmp_path / "feed")
    for part in ([line(1, "did:a", 10)], [line(2, "did:a", 30), line(3, "did:b", 20, "app.bsky.graph.follow")]):
        spark.createDataFrame(part, "seq long, value string").coalesce(1).write.mode("append").parquet(path)
    feed_stream.start(
        streams.feed_stream(spark, path, 1), store, SETTINGS, store.location("checkpoint"),
        available_now=True,
    ).awaitTermination()
    assert feed_stream.read_current(store).count() == 1
    assert feed_stream.read_users(store).count() == 1
    assert feed_stream.read_high_water(store).first()[0] == 30
    assert store.read_batches(feed_stream.REJECTED).count() == 1


def test_feed_folds_by_touched_parts(spark, store):
    def line(seq, user, days, operation="create", key="k", kind="app.bsky.feed.post"):
        event = {"did": f"did:{user}", "time_us": (NOW - days * 86_400_000) * 1000, "kind": "commit", "commit": {
            "operation": operation, "collection": kind, "rkey": key, "record": {"text": "#x"}}}
        return (seq, json.dumps(event))

    settings = replace(SETTINGS, state_buckets=8, most_runs=2)

    def batch(number, lines):
        feed_stream.process_batch(spark.createDataFrame(lines, "seq long, value string"), number, store, settings)
        before = dict(feed_stream.ledger(store).snapshot().parts("current"))
        feed_stream.fold(store, number, settings)
        after = dict(feed_stream.ledger(store).snapshot().parts("current"))
        return {p for p in set(before) | set(after) if before.get(p) != after.get(p)}

    first = batch(0, [line(i, f"u{i}", i % 4) for i in range(1, 41)])
    assert len(first) > 20
    # One new post, one post written again on another day, one deleted.
    touched = batch(1, [line(50, "u1", 0, key="new"), line(51, "u2", 0, "update"), line(52, "u3", 0, "delete")])
    assert len(touched) <= 5 and {p[1] for p in touched} >= {"2024-01-31"}
    assert feed_stream.read_current(store).count() == 40
    assert feed_stream.read_users(store).count() == 40
    batch(2, [line(60, "u5", 0, key="more"), line(61, "u6", 0, kind="app.bsky.graph.follow")])
    assert feed_stream.read_rejected(store).count() == 1
    spans = dict(feed_stream.ledger(store).snapshot().parts("spans"))
    assert max(len(runs) for runs in spans.values()) <= 2
    [u1] = [r for r in feed_stream.read_users(store).collect() if r.first_seen_at < r.last_seen_at][:1]
    assert (u1.last_seen_at - u1.first_seen_at).days >= 1
    # A folded batch that is replayed changes nothing.
    held = rows(feed_stream.read_current(store))
    feed_stream.process_batch(
        spark.createDataFrame([line(3, "u3", 3)], "seq long, value string"), 0, store, settings)
    assert rows(feed_stream.read_current(store)) == held
    assert feed_stream.read_high_water(store).first()[0] == NOW * 1000


def test_a_deleted_user_leaves_staging(spark):
    from murmur.plans import staging

    messages = [change(1, "u1", entity="users"), change(2, "u2", entity="users"),
                change(3, "u1", NOW + 1, op="d", entity="users", key="r1"), change(4, "u1")]
    cleaned = [(t, p, o, v.replace('"record_key": "r1", ', "").replace('"record_key": "r2", ', "")) for t, p, o, v in messages]
    parsed = changes.parse_changes(spark.createDataFrame(cleaned, COLUMNS), SETTINGS)
    valid_ = changes.valid_changes(changes.validate_changes(parsed, SETTINGS, NOW))
    state = keyed_state.collapse_changes(keyed_state.change_log(valid_, F.lit(None).cast("timestamp_ntz")))
    users = staging.staged(keyed_state.entity_state(state, "users"), "users")
    assert [r.user_id_hash for r in users.collect()] == ["u2"]
    assert state.filter("entity = 'users' and is_deleted").count() == 1


def test_redelivered_messages_are_counted_once(spark, store, tmp_path):
    path = str(tmp_path / "twice")
    for rows_ in (MESSAGES[:5], MESSAGES[3:], MESSAGES[:4]):
        spark.createDataFrame(rows_, COLUMNS).coalesce(1).write.mode("append").parquet(path)
    drain(spark, path, store, replace(SETTINGS, redelivery_window="1 hour"))
    counts = change_stream.read_rollup(store, minute_rollups.EVENTS)
    assert counts.agg(F.sum("event_count")).first()[0] == 7
    assert change_stream.read_quarantine(store).count() == 1
    assert change_stream.read_batches(store).agg(F.sum("row_count")).first()[0] == len(MESSAGES)


def test_late_rows_within_the_watermark_are_counted(spark, store, tmp_path):
    """Rows hours and weeks late come after newer ones and are neither lost nor counted twice."""
    hour, day = 60 * MINUTE, 24 * 60 * MINUTE
    path = str(tmp_path / "late")
    ages = [0, 3 * hour, 1 * day, 29 * day]
    for number, age in enumerate(ages):
        batch = [change(number * 10 + i, f"u{i}", NOW - age) for i in range(3)]
        spark.createDataFrame(batch, COLUMNS).coalesce(1).write.mode("append").parquet(path)
    stream = windowed.watermarked_activity(streams.file_changes(spark, path, 1), SETTINGS, F.lit(NOW))
    windowed.start_updates(
        windowed.event_counts(stream), store, "late", store.location("checkpoint"), available_now=True
    ).awaitTermination()
    found = windowed.latest_values(store, "late", ["event_type", "operation"], "event_count")
    assert sorted(r.event_count for r in found.collect()) == [3, 3, 3, 3]


def test_feed_places_of_several_partitions_do_not_meet(spark):
    records = spark.createDataFrame(
        [(p, o, bytearray(b"x")) for p in range(3) for o in range(4)], "partition int, offset long, value binary")
    places = [r.seq for r in streams.feed_records(records).collect()]
    assert len(set(places)) == 12 and sorted(places[:4]) == places[:4]
    assert streams.feed_options(SETTINGS, "b:1", "feed")["maxOffsetsPerTrigger"] == "50000"


def test_kafka_options_cap_a_batch():
    options = streams.kafka_options(SETTINGS, "broker:9092")
    assert options["startingOffsets"] == "earliest"
    assert options["maxOffsetsPerTrigger"] == "50000"
    assert options["subscribe"].count(",") == 6


def test_ingest_rate_and_recent_types(spark):
    arrivals = spark.createDataFrame([(0,), (500_000,), (3_000_000,)], "arrived_us long")
    rate = {r.window_end.second: r.events_per_second for r in minute_rollups.ingest_rate(arrivals).collect()}
    assert rate == {1: 0.4, 2: 0.4, 3: 0.4, 4: 0.6, 5: 0.6, 6: 0.2, 7: 0.2, 8: 0.2}
    events = spark.range(50).select(F.col("id").alias("seq"), F.lit("post").alias("event_type"))
    assert [r.seq for r in minute_rollups.recent_types(events).collect()] == list(range(49, 29, -1))
