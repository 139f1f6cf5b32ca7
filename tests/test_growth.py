"""What is read, joined and listed once, however many chunks, tables or deleted keys there are."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from murmur.catalog import mapping
from murmur.catalog.workspace import Workspace
from murmur.functions import text
from murmur.operators import keyed_state
from murmur.schemas import STATE_ROW
from murmur.session import use_utc
from murmur.sources.ledger import Layout, Ledger

TYPES = ("view", "click", "error", "signup", "purchase")


@pytest.fixture(scope="module")
def given(spark, tmp_path_factory):
    """Events in no order, one of them twice and one without a place."""
    use_utc(spark)
    folder = str(tmp_path_factory.mktemp("given"))
    start = dt.datetime(2024, 1, 3)
    events = [
        (
            None if seq == 0 else seq, start + dt.timedelta(minutes=31 * seq),
            (seq * 7) % 30,
            TYPES[seq % 5], 1.0, f'{{"k": {seq % 100}}}',
        )
        for seq in [*range(599, -1, -1), 300]
    ]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(events, schema).write.parquet(f"{folder}/events.parquet")
    documents = [(0, "a #b https://x", "en", "web"), (1, None, None, "web"), (2, "c", "de", None)]
    spark.createDataFrame(
        documents, "doc_id long, text string, lang string, source string"
    ).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_events_are_joined_once_for_all_chunks(spark, given, monkeypatch):
    plain, calls = mapping.social_events, []

    def counted(*args, **kinds):
        calls.append(args)
        return plain(*args, **kinds)

    monkeypatch.setattr(mapping, "social_events", counted)
    w = Workspace(spark, given)
    landed = sorted(map(tuple, w.messages().collect()), key=str)
    # Spans of users, the last offset, and the rows of all messages.
    assert len(calls) == 3
    documents, spans = mapping.document_features(spark, given), mapping.user_spans(spark, given)
    whole = mapping.change_messages(spark, given, documents, spans, 0, 600, 3)
    assert landed == sorted(map(tuple, whole.collect()), key=str) != []
    # A chunk's messages lie in files of their own, in order.
    spread = w.messages().withColumn("file", F.input_file_name()).groupBy("file").agg(
        F.countDistinct(F.floor(F.col("offset") / 120)).alias("chunks")
    )
    assert spread.agg(F.max("chunks")).first()[0] == 1


def _changes(spark, *rows):
    types = {f.name: f.dataType.simpleString() for f in STATE_ROW.fields}
    changes = spark.createDataFrame(
        rows, "entity string, user_id_hash string, record_key string, language string, "
        "seq struct<partition:int,offset:long>, op string, ingested_at timestamp_ntz, kafka_offset long"
    )
    left = [c for c in keyed_state._STATE_PAYLOAD if c not in changes.columns]
    return changes.withColumns({c: F.lit(None).cast(types[c]) for c in left})


def test_kept_state_is_read_once_and_merged_by_arrival(spark, tmp_path):
    early, late = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    user = "0123456789abcdef" * 4
    first = _changes(
        spark,
        ("posts", user, "r", "en", (0, 1), "c", early, 1),
        ("posts", "u1", "r", "de", (0, 2), "c", early, 2), ("posts", "u1", "r", None, (0, 3), "d", early, 3),
        ("posts", "u2", None, "fr", (0, 4), "u", early, 4), ("posts", "u2", None, None, (None, 9), "d", early, 9),
        ("posts", "u4", "r", "es", (0, 5), "c", early, 5), ("posts", "u4", "r", None, (0, 6), "d", early, 6),
    )
    more = _changes(
        spark,
        ("posts", user, "r", None, (0, 11), "d", late, 11),
        ("posts", "u1", "r", "it", (0, 0), "c", late, 0),
        ("posts", "u3", "r", None, (0, 12), "d", late, 12),
        ("posts", "u4", "r", "nl", (0, 13), "u", late, 13),
    )
    empty = spark.createDataFrame([], STATE_ROW)
    keyed_state.merge_state(empty, first).write.parquet(f"{tmp_path}/state")
    held = spark.read.schema(STATE_ROW).parquet(f"{tmp_path}/state")
    merged = keyed_state.merge_state(held, more)
    assert merged._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    seen = {
        r.user_id_hash: (r.language, r.cdc_op, r.is_deleted, r.ingested_at, r.kafka_offset)
        for r in merged.collect()
    }
    assert seen == {
        user: ("en", "d", True, late, 1), "u1": ("de", "d", True, early, 2),
        "u2": ("fr", "u", False, early, 4), "u4": ("nl", "u", False, late, 13),
    }
    applied = keyed_state.apply_changes(keyed_state.plain_state(held), more)
    assert applied._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1


def test_a_fold_that_reaches_all_parts_lists_them_once(spark, store, monkeypatch):
    book = Ledger(store, {"t": Layout(("day",))})
    rows = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, n int, day string")
    book.commit(book.snapshot(), {"t": book.append(book.snapshot(), "t", rows)})
    arrived = store.scratch(spark.createDataFrame([("a", 5, "x"), ("c", 6, "y")], rows.schema), "arrived")
    plain, read = Ledger.read, []

    def counted(self, *args, **kinds):
        read.append(args)
        return plain(self, *args, **kinds)

    def merge(held, new):
        largest = held.unionByName(new).groupBy("k").agg(F.max_by(F.struct("n", "day"), "n").alias("v"))
        return largest.select("k", "v.*")

    monkeypatch.setattr(Ledger, "read", counted)
    base = book.snapshot()
    moved = book.upsert(base, "t", arrived, ["k"], merge, by_key=True)
    assert len(read) == 1
    after = book.commit(base, {"t": moved})
    assert sorted(map(tuple, book.read(after, "t").select("k", "n").collect())) == [("a", 5), ("b", 2), ("c", 6)]


def test_texts_without_a_mark_are_not_searched_by_patterns(spark):
    texts = ["", None, "plain", "#", "# x", "a#b#b #é_1", "http:/x", "xhttps://y", "HTTP://z", "http://"]
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    none = F.lit(None).cast("string")
    seen = rows.orderBy("n").select(
        text.hashtags(F.col("t")).alias("tags"), text.has_link(F.col("t"), none).alias("link")
    )
    found = [(list(r.tags), r.link) for r in seen.collect()]
    assert [f[0] for f in found] == [[], [], [], [], [], ["b", "é_1"], [], [], [], []]
    assert [f[1] for f in found] == [False] * 7 + [True, False, True]
    plan = seen._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan and "Contains" in plan
