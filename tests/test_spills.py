"""What a task holds or sorts at once, and what a collapse sends through its shuffle."""

import datetime as dt
import random

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.catalog import mapping, queries
from murmur.catalog.workspace import Workspace, open_workspace
from murmur.operators import keyed_state
from murmur.schemas import KEY_COLUMNS
from murmur.session import SPLIT_BYTES, small_splits
from murmur.streaming import change_stream

SPLITS = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def workspace(spark, tmp_path):
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
    return Workspace(spark, str(tmp_path))


def _shuffled_bytes(table: DataFrame) -> int:
    """Bytes of the rows that went through the shuffles of a plan, before compression."""
    plan = table._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    found, nodes = 0, [plan]
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "Exchange":
            found += node.metrics().apply("dataSize").value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return found


def test_compacting_carries_a_written_row_once(spark):
    rng = random.Random(1)
    tags = {n: "".join(rng.choices("abcdefgh", k=20_000)) for n in range(4)}
    rows = [
        # Written; written and removed; removed and written again; only removed.
        ("posts", "u0", "r", (0, 1), "c", tags[0]), ("posts", "u0", "r", (0, 2), "u", tags[1]),
        ("posts", "u1", "r", (0, 3), "c", tags[2]), ("posts", "u1", "r", (0, 4), "d", None),
        ("posts", "u2", "r", (0, 5), "d", None), ("posts", "u2", "r", (0, 6), "c", tags[3]),
        ("posts", "u3", None, (None, 7), "d", None),
    ]
    changes = spark.createDataFrame(
        rows, "entity string, user_id_hash string, record_key string, "
        "seq struct<partition:int,offset:long>, op string, language string"
    )
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        compact = keyed_state.compact_changes(changes)
        kept = {(r.user_id_hash, r.seq.offset, r.op, r.language) for r in compact.collect()}
        shuffled = _shuffled_bytes(keyed_state.compact_changes(changes))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert kept == {
        ("u0", 2, "u", tags[1]), ("u1", 3, "c", tags[2]), ("u1", 4, "d", None),
        ("u2", 6, "c", tags[3]), ("u3", 7, "d", None),
    }
    # Three texts once each, a fourth if its row and the newer one lie in two tasks.
    assert 60_000 < shuffled < 90_000


def test_source_counts_carry_no_values(workspace, monkeypatch):
    counts = queries._source_counts(workspace)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "hashtags" not in plan and "target" not in plan
    whole = keyed_state.current_entities(workspace.ingested_events()).filter(
        F.to_date("occurred_at") == mapping.DAY
    )
    expected = {r.entity: r["count"] for r in whole.groupBy("entity").count().collect()}
    assert {r.entity: r.row_count for r in counts.collect()} == {
        k: v for k, v in expected.items() if k != "profile_updates"
    } != {}


def test_feed_events_are_written_without_a_sort(workspace):
    assert workspace.ingested_events().filter("entity = 'posts'").count() > 0
    assert not workspace.store.holds("ingested_events", "entity=posts")


def test_tasks_read_little_of_a_compressed_log(spark, tmp_path):
    before = spark.conf.get(SPLITS)
    try:
        spark.conf.set(SPLITS, "128m")
        open_workspace(spark, str(tmp_path))
        assert int(spark.conf.get(SPLITS).rstrip("b")) == SPLIT_BYTES
        spark.conf.set(SPLITS, "1m")
        small_splits(spark)
        assert spark.conf.get(SPLITS) == "1m"
    finally:
        spark.conf.set(SPLITS, before)


def test_a_batch_holds_messages_of_rejected_rows_only(workspace, store, monkeypatch):
    held = []
    plain = type(workspace.spark.range(1))
    persist = plain.persist

    def kept(rows, *level):
        held.append(rows)
        return persist(rows, *level)

    monkeypatch.setattr(plain, "persist", kept)
    change_stream.process_batch(
        workspace.messages(), 0, store, workspace.settings, lambda: mapping.AS_OF_MS
    )
    assert not {"before", "after"} & set(held[0].columns)
    assert held[0].filter("reason is null and value is not null").count() == 0
    rejected = change_stream.read_quarantine(store)
    assert rejected.filter("raw_payload like '%\"value\":%'").count() > 0
    assert set(KEY_COLUMNS) <= set(held[0].columns)
