"""Keyed state from ordered changes.

Every collapse is one ``groupBy`` with ``max_by``/``min_by``. These combine on
the map side, so a key that owns a large share of all rows reaches the shuffle
as one row per task. Order is the arrival order, never the event time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.functions.identity import with_packed, with_unpacked
from murmur.schemas import (
    CURRENT_ROW,
    KEY_COLUMNS,
    PAYLOAD_COLUMNS,
    RAW_STATE,
    STATE_ROW,
    raw_schema,
)

_STATE_PAYLOAD = [c for c in PAYLOAD_COLUMNS if c not in KEY_COLUMNS]
# Most of a row's bytes, and nothing that compression in a shuffle could make smaller.
PSEUDONYMS = ["user_id_hash", "target_user_id_hash"]
# The key with the user first: aggregates of whole rows sort, and rows of an entity begin alike.
_GROUPED = ["user_id_hash", "record_key", "entity"]


# ---------------------------------------------------------------- feed side


def last_events(events: DataFrame, payload: list[str] | None = None) -> DataFrame:
    """The last event of every key, deletes included; a user has one profile row.

    ``payload`` names the values that are wanted besides the key, all of them by default.
    """
    single_row = F.col("entity") == "profile_updates"
    keyed = events.withColumn(
        "record_key", F.when(single_row, F.lit(None)).otherwise(F.col("record_key"))
    )
    payload = payload or [c for c in CURRENT_ROW.fieldNames() if c not in KEY_COLUMNS]
    last = (
        with_packed(keyed, *PSEUDONYMS)
        .groupBy(*KEY_COLUMNS)
        .agg(F.max_by(F.struct(*payload), "seq").alias("last"))
        .select(*KEY_COLUMNS, "last.*")
    )
    return with_unpacked(last, *PSEUDONYMS)


def written_events(last: DataFrame) -> DataFrame:
    """Without the keys whose last operation is a delete."""
    return last.filter(F.col("operation") != "delete")


def current_entities(events: DataFrame, values: list[str] | None = None) -> DataFrame:
    """Last write wins; a key whose last operation is a delete is gone.

    With ``values``, only those are carried besides the key and the operation.
    """
    payload = None if values is None else ["operation", *values]
    return written_events(last_events(events, payload)).drop("seq")


def spans(events: DataFrame, *more: Column) -> DataFrame:
    """First and last arrival per user, deletes and every entity included."""
    return events.groupBy("user_id_hash").agg(
        F.min_by("occurred_at", "seq").alias("first_seen_at"),
        F.max_by("occurred_at", "seq").alias("last_seen_at"),
        F.min("seq").alias("first_seq"),
        F.max("seq").alias("last_seq"),
        *more,
    )


def merged_spans(parts: DataFrame) -> DataFrame:
    """Spans of any pieces of the feed put together."""
    return parts.groupBy("user_id_hash").agg(
        F.min_by("first_seen_at", "first_seq").alias("first_seen_at"),
        F.max_by("last_seen_at", "last_seq").alias("last_seen_at"),
        F.min("first_seq").alias("first_seq"),
        F.max("last_seq").alias("last_seq"),
    )


def users_seen(events: DataFrame) -> DataFrame:
    return spans(events).drop("first_seq", "last_seq")


def high_water(events: DataFrame) -> DataFrame:
    """One row: the largest event time already taken in."""
    return events.agg(F.max("time_us").alias("last_time_us"))


# ----------------------------------------------------------------- CDC side


def change_log(valid: DataFrame, ingested_at: Column) -> DataFrame:
    """Valid changes reduced to what the collapse needs."""
    return valid.select(
        *KEY_COLUMNS,
        F.struct("partition", "offset").alias("seq"),
        "op",
        ingested_at.alias("ingested_at"),
        *_STATE_PAYLOAD,
        F.col("offset").alias("kafka_offset"),
    )


def _pieces(rows: DataFrame, op: Column, written: Column, written_at: Column, last_at: Column) -> DataFrame:
    """What a row tells of its key: values and their arrival if any, the last change and its arrival."""
    image = F.struct(*_STATE_PAYLOAD, "kafka_offset")
    return with_packed(rows, *PSEUDONYMS).select(
        *KEY_COLUMNS,
        F.when(written, image).alias("image"),
        F.struct(op.alias("op"), "ingested_at").alias("last"),
        F.when(written, written_at).alias("write_seq"),
        last_at.alias("last_seq"),
    )


def _pieces_of_changes(changes: DataFrame) -> DataFrame:
    op, seq = F.col("op"), F.col("seq")
    return _pieces(changes, op, op != "d", seq, seq)


def _pieces_of_state(state: DataFrame, written_at: Column, last_at: Column) -> DataFrame:
    """One row per key, deleted or not, so kept state is read once."""
    return _pieces(state, F.col("cdc_op"), F.lit(True), written_at, last_at)


def _collapsed(pieces: DataFrame) -> DataFrame:
    """State per key with the arrival of its values and of its last change."""
    state = (
        pieces.groupBy(*_GROUPED)
        .agg(
            # A null ordering never wins, so deletes do not replace the values.
            F.max_by("image", "write_seq").alias("image"),
            F.max_by("last", "last_seq").alias("last"),
            F.max("write_seq").alias("write_seq"),
            F.max("last_seq").alias("last_seq"),
        )
        .filter(F.col("image").isNotNull())
        .select(
            *KEY_COLUMNS,
            "image.*",
            F.col("last.op").alias("cdc_op"),
            F.col("last.ingested_at").alias("ingested_at"),
            (F.col("last.op") == "d").alias("is_deleted"),
            "write_seq",
            "last_seq",
        )
    )
    return with_unpacked(state, *PSEUDONYMS)


def plain_state(state: DataFrame) -> DataFrame:
    """State without its arrival and partition columns."""
    return state.select(*RAW_STATE.fieldNames())


def collapse_changes(changes: DataFrame) -> DataFrame:
    """State per key: values of the last non-delete, flags of the last change.

    A key that only ever saw deletes has no row. One shuffle for all entities.
    """
    return plain_state(_collapsed(_pieces_of_changes(changes)))


def merge_state(state: DataFrame, changes: DataFrame) -> DataFrame:
    """Kept state with further changes, old or new: arrival decides, so any order will do."""
    held = _pieces_of_state(state, F.col("write_seq"), F.col("last_seq"))
    return _collapsed(held.unionByName(_pieces_of_changes(changes))).select(
        *STATE_ROW.fieldNames()
    )


def with_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    """Adds the hash bucket of the user, in which all rows of a key lie."""
    bucket = F.pmod(F.xxhash64("user_id_hash"), F.lit(buckets)).cast("int")
    return rows.withColumn("bucket", bucket)


def compact_changes(changes: DataFrame) -> DataFrame:
    """The changes that still matter: per key its last write and its last change.

    Rows keep their arrival order, so compacting a compacted log together with further
    changes, old or new, gives what compacting everything at once would.
    """
    # The key is there once, as what is grouped by.
    whole = F.struct(*[c for c in changes.columns if c not in KEY_COLUMNS])
    writes = F.when(F.col("op") != "d", F.col("seq"))
    # A last change that is a write is the last write: it is not carried a second time.
    removal = F.when(F.col("op") == "d", whole)
    compact = (
        with_packed(changes, *PSEUDONYMS)
        .groupBy(*_GROUPED)
        .agg(
            F.max_by(F.when(F.col("op") != "d", whole), writes).alias("write"),
            F.max_by(removal, "seq").alias("removal"),
        )
        .select(*KEY_COLUMNS, F.explode(F.array_compact(F.array("write", "removal"))).alias("change"))
        .select(*KEY_COLUMNS, "change.*")
    )
    return with_unpacked(compact, *PSEUDONYMS).select(*changes.columns)


def apply_changes(state: DataFrame, changes: DataFrame) -> DataFrame:
    """Fold new changes into plain collapsed state; replaying a batch changes nothing."""

    def before_all(position: int) -> Column:
        return F.struct(F.lit(-1).alias("partition"), F.lit(position).cast("long").alias("offset"))

    last_at = F.when(F.col("is_deleted"), before_all(-1)).otherwise(before_all(-2))
    held = _pieces_of_state(state, before_all(-2), last_at)
    return plain_state(_collapsed(held.unionByName(_pieces_of_changes(changes))))


def entity_state(state: DataFrame, entity: str) -> DataFrame:
    return state.filter(F.col("entity") == entity).select(*raw_schema(entity).fieldNames())


# ------------------------------------------------------------ generic merges


def merge_additive(partials: list[DataFrame], keys: list[str], count: str) -> DataFrame:
    """``old + new`` per key over any number of partial counts."""
    return (
        reduce(DataFrame.unionByName, partials)
        .groupBy(*keys)
        .agg(F.sum(count).cast("long").alias(count))
    )


def insert_missing(target: DataFrame, arrived: DataFrame, keys: list[str]) -> DataFrame:
    """Insert-or-ignore: rows whose key is absent from the target, once each."""
    fresh = arrived.dropDuplicates(keys)
    return target.unionByName(fresh.join(target, keys, "left_anti"))


def replace_by_key(target: DataFrame, arrived: DataFrame, keys: list[str]) -> DataFrame:
    """Arrived rows replace target rows with the same key; all others stay."""
    return target.join(arrived, keys, "left_anti").unionByName(arrived)


def drop_redelivered(messages: DataFrame) -> DataFrame:
    """At-least-once copies share topic, partition and offset."""
    return messages.dropDuplicates(["topic", "partition", "offset"])
