"""What collapses carry through their shuffles, and what the history carries from run to run."""

import datetime as dt

from pyspark.sql import functions as F

from murmur.catalog.workspace import Workspace
from murmur.functions import identity
from murmur.operators import keyed_state
from murmur.schemas import RAW_STATE
from murmur.sources.ledger import Layout, Ledger

DIGEST = "0f" * 32
NAMES = [
    DIGEST, DIGEST.upper(), DIGEST + "\n", DIGEST[:-1], DIGEST + "a", "", "u1", "\x00", "é", None,
    bytes.fromhex("41" * 32).decode(), "41" * 32,
]


def test_packing_keeps_every_text_and_keeps_texts_apart(spark):
    rows = spark.createDataFrame([(n,) for n in NAMES], "name string")
    packed = rows.select("name", identity.packed(F.col("name")).alias("p"))
    found = packed.select("name", "p", identity.unpacked(F.col("p")).alias("again")).collect()
    assert [r.again for r in found] == [r.name for r in found] == NAMES
    assert len({None if r.p is None else bytes(r.p) for r in found}) == len(NAMES)
    assert {len(r.p) for r in found if r.name == DIGEST} == {33}


def test_collapses_shuffle_packed_pseudonyms(spark):
    changes = spark.createDataFrame(
        [
            ("posts", DIGEST, "r1", (0, 1), "c", None, DIGEST, 1),
            ("posts", DIGEST, "r1", (0, 2), "u", None, "plain", 2),
            ("posts", "plain", None, (0, 3), "c", None, None, 3),
        ],
        "entity string, user_id_hash string, record_key string, "
        "seq struct<partition:int,offset:long>, op string, ingested_at timestamp_ntz, "
        "target_user_id_hash string, kafka_offset long",
    )
    missing = [f for f in RAW_STATE.fields if f.name not in changes.columns]
    changes = changes.withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in missing if f.name not in ("cdc_op", "is_deleted")}
    )
    state = keyed_state.collapse_changes(changes)
    rows = {(r.user_id_hash, r.record_key, r.target_user_id_hash) for r in state.collect()}
    assert rows == {(DIGEST, "r1", "plain"), ("plain", None, None)}
    for table in (state, keyed_state.compact_changes(changes)):
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        assert "unhex" in plan


def test_history_carries_only_what_a_summary_reads(spark, tmp_path):
    start = dt.datetime(2024, 1, 3)
    events = [
        (n, start + dt.timedelta(minutes=50 * n), n % 30, ("view", "purchase")[n % 2], 1.0, '{"k": 5}')
        for n in range(600)
    ]
    spark.createDataFrame(
        events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    ).write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame(
        [(0, "text", "en", "web")], "doc_id long, text string, lang string, source string"
    ).write.parquet(f"{tmp_path}/documents.parquet")
    workspace = Workspace(spark, str(tmp_path))
    assert workspace.history().filter("total_posts > 0 and main_language = 'en'").count() > 0
    state = workspace.store.read("history_state", RAW_STATE)
    unread = ["target_user_id_hash", "target_record_key", "hashtags", "occurred_at", "text_length"]
    assert state.filter("language is not null").count() > 0
    assert state.agg(*[F.count(c).alias(c) for c in unread]).first().asDict() == dict.fromkeys(unread, 0)


def test_a_merge_by_key_joins_nothing_to_the_held_rows(spark, store, monkeypatch):
    """Parts are taken whole; a key that moves to another day still leaves its old part."""
    schema = "user_id_hash string, v int, day string"
    held_schema = spark.createDataFrame([], schema).schema
    book = Ledger(store, {"t": Layout(("day",), held_schema)})

    def fold(rows, by_key):
        base = book.snapshot()
        arrived = store.scratch(spark.createDataFrame(rows, schema), "arrived")

        def merge(held, new):
            both = held.withColumn("at", F.lit(0)).unionByName(new.withColumn("at", F.lit(1)))
            last = F.max_by(F.struct("v", "day"), "at").alias("last")
            return both.groupBy("user_id_hash").agg(last).select("user_id_hash", "last.*")

        moved = book.upsert(base, "t", arrived, ["user_id_hash"], merge, by_key=by_key)
        book.commit(base, {"t": moved})
        return sorted(tuple(r) for r in book.read(book.snapshot(), "t").collect())

    fold([(DIGEST, 1, "d1"), ("b", 1, "d1"), ("c", 1, "d2")], True)
    assert fold([("b", 2, "d2")], True) == [(DIGEST, 1, "d1"), ("b", 2, "d2"), ("c", 1, "d2")]
    joins = []
    plain = type(spark.range(1)).join
    monkeypatch.setattr(
        type(spark.range(1)), "join", lambda self, other, on=None, how=None: joins.append(how) or plain(self, other, on, how)
    )
    searched = []
    monkeypatch.setattr(Ledger, "parts_of", lambda self, *a, of=Ledger.parts_of: searched.append(1) or of(self, *a))
    found = fold([(DIGEST, 3, "d1"), ("c", 3, "d2")], True)
    assert found == [(DIGEST, 3, "d1"), ("b", 2, "d2"), ("c", 3, "d2")]
    # Every part was reached: only the arrived rows were asked for their parts.
    assert "left_anti" not in joins and len(searched) == 1
