"""Feed JSON to typed, pseudonymised and sampled activity rows."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.constants import (
    COLLECTION_BY_KIND,
    ENTITY_BY_KIND,
    FEED_OPERATIONS,
    REASON_MISSING_FIELD,
)
from murmur.functions import identity, text, times
from murmur.functions.documents import json_roots, only_object
from murmur.functions.once import with_evaluated
from murmur.schemas import ENTITY_COLUMNS, FEED_SCHEMA


def _lookup(mapping: dict[str, str], key: Column) -> Column:
    literal_map = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(literal_map, key)


def decode_feed(feed: DataFrame) -> DataFrame:
    """One JSON parse per line; lines that are no JSON object become null rows."""
    decoded = with_evaluated(feed, "roots", json_roots("value", FEED_SCHEMA))
    return decoded.withColumn("event", only_object("roots", "value")).drop("roots")


def scan_feed(feed: DataFrame) -> DataFrame:
    """Lines of the tracked collections only."""
    return (
        decode_feed(feed)
        .filter(F.col("event.commit.collection").isin(*COLLECTION_BY_KIND.values()))
        .select(
            "seq",
            F.col("event.did").alias("did"),
            F.col("event.time_us").alias("time_us"),
            F.col("event.kind").alias("message_kind"),
            F.col("event.commit.collection").alias("collection"),
        )
    )


def parse_events(feed: DataFrame) -> DataFrame:
    """Well-formed commits of tracked collections; everything else is skipped."""
    kind_by_collection = {nsid: kind for kind, nsid in COLLECTION_BY_KIND.items()}
    commit = "event.commit"
    record = F.col(f"{commit}.record")
    accepted = (
        decode_feed(feed)
        .filter(F.col("event.kind") == "commit")
        .filter(F.col(f"{commit}.operation").isin(*FEED_OPERATIONS))
        .filter((F.col("event.did") != "") & (F.col(f"{commit}.rkey") != ""))
        .filter(F.col("event.time_us").isNotNull())
        .filter(F.col(f"{commit}.collection").isin(*COLLECTION_BY_KIND.values()))
        .select(
            "seq",
            _lookup(kind_by_collection, F.col(f"{commit}.collection")).alias("event_type"),
            F.col(f"{commit}.operation").alias("operation"),
            F.col("event.did").alias("did"),
            F.col(f"{commit}.rkey").alias("record_key"),
            F.col("event.time_us").alias("time_us"),
            record.alias("record"),
        )
    )
    return _with_fields(accepted)


def _with_fields(accepted: DataFrame) -> DataFrame:
    record = F.col("record")
    body = record["text"]
    embed_type = F.get_json_object(record["embed"], "$.$type")
    langs = F.from_json(record["langs"], "array<string>")
    is_post = F.col("event_type") == "post"
    names_record = F.col("event_type").isin("like", "repost")
    names_account = F.col("event_type").isin("follow", "block")
    uri = F.when(names_record, F.get_json_object(record["subject"], "$.uri"))
    with_target = with_evaluated(accepted, "target", text.split_record_uri(uri))
    return with_target.select(
        "seq",
        "event_type",
        "operation",
        "did",
        "record_key",
        "time_us",
        F.when(is_post, text.first_language(langs)).alias("language"),
        F.when(is_post, text.text_length(body)).alias("text_length"),
        F.when(is_post, text.hashtags(body)).alias("hashtags"),
        F.when(is_post, text.has_link(body, embed_type)).alias("has_link"),
        F.when(is_post, text.has_media(embed_type)).alias("has_media"),
        F.when(
            is_post, F.coalesce(F.map_contains_key(record, F.lit("reply")), F.lit(False))
        ).alias("is_reply"),
        F.when(names_record, F.col("target.did"))
        .when(names_account, record["subject"])
        .alias("target_did"),
        F.col("target.record_key").alias("target_record_key"),
    )


def entity_events(parsed: DataFrame, salt: str, rate: float) -> DataFrame:
    """Hash both ids, keep sampled users, name the target entity of each row.

    The raw ids are gone from the output.
    """
    hashed = with_evaluated(parsed, "user_id_hash", identity.hash_user_id(F.col("did"), salt))
    return hashed.filter(identity.is_sampled(F.col("user_id_hash"), rate)).select(
        "seq",
        _lookup(ENTITY_BY_KIND, F.col("event_type")).alias("entity"),
        "operation",
        "user_id_hash",
        "record_key",
        "time_us",
        times.micros_to_utc(F.col("time_us")).alias("occurred_at"),
        "language",
        "text_length",
        "hashtags",
        "has_link",
        "has_media",
        "is_reply",
        identity.hash_target_id(F.col("target_did"), salt).alias("target_user_id_hash"),
        "target_record_key",
    )


def _lacks_target() -> Column:
    writes = F.col("operation") != "delete"
    return (
        F.col("entity").isin("follows", "blocks")
        & writes
        & F.col("target_user_id_hash").isNull()
    )


def writable_events(events: DataFrame) -> DataFrame:
    """A follow or block needs an account target; rows without one are set aside."""
    return events.filter(~_lacks_target())


def rejected_events(events: DataFrame) -> DataFrame:
    return events.filter(_lacks_target()).withColumn(
        "reason", F.lit(REASON_MISSING_FIELD + "target_user_id_hash")
    )


def entity_rows(events: DataFrame, entity: str) -> DataFrame:
    """The columns of one entity plus arrival order and operation."""
    columns = [c for c in ENTITY_COLUMNS[entity] if c != "operation"]
    return events.filter(F.col("entity") == entity).select("seq", "operation", *columns)


def resume_after(parsed: DataFrame, cursor: DataFrame) -> DataFrame:
    """Rows past a one-row cursor table; an empty cursor resumes from the start."""
    position = F.coalesce(cursor.scalar(), F.lit(-(2**63)))
    return parsed.filter(F.col("time_us") > position)
