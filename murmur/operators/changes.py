"""Change-data-capture messages: decode, validate, split, quarantine."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur.constants import (
    CHANGE_OPERATIONS,
    ENTITIES,
    REASON_FUTURE,
    REASON_MISSING_FIELD,
    REASON_PAST,
    REASON_UNKNOWN_ENTITY,
    REASON_UNKNOWN_OPERATION,
    REASON_UNPARSEABLE,
)
from murmur.functions.documents import is_object, json_roots, only_object
from murmur.functions.once import with_evaluated
from murmur.schemas import PAYLOAD_COLUMNS, PAYLOAD_JSON, REQUIRED_COLUMNS, payload_type
from murmur.settings import Settings

# Scalars are read as strings; a field or block of the wrong shape becomes null.
_ENVELOPE = (
    T.StructType()
    .add("op", "string")
    .add("before", PAYLOAD_JSON)
    .add("after", PAYLOAD_JSON)
    .add("source", T.VariantType())
    .add("ts_ms", "string")
)


def entity_of_topic(topic: Column, prefix: str) -> Column:
    names = [(prefix + entity, entity) for entity in ENTITIES]
    literal_map = F.create_map(*[F.lit(x) for x in chain.from_iterable(names)])
    return F.try_element_at(literal_map, topic)


def _truthy(number: Column) -> Column:
    return F.nullif(number, F.lit(0).cast("long"))


def _whole_number(text: Column) -> Column:
    """JSON may spell a whole number as 1.7e12."""
    return F.coalesce(text.try_cast("long"), text.try_cast("double").try_cast("long"))


def parse_changes(messages: DataFrame, settings: Settings) -> DataFrame:
    """Unpack the envelope. Broken input sets parse_error, it never fails the job.

    Row images come out typed in the same parse; a missing or empty value is an
    empty envelope, not an error.
    """
    if settings.drop_tombstones:
        messages = messages.filter(F.col("value").isNotNull())
    present = F.coalesce(F.col("value") != "", F.lit(False))
    decoded = with_evaluated(
        messages.select("topic", "partition", "offset", "value"),
        "roots",
        F.when(present, json_roots("value", _ENVELOPE)),
    )
    # A source block that is there must be an object as well.
    root = only_object("roots", "value")
    whole = F.coalesce(is_object(root["source"]), F.lit(True))
    decoded = with_evaluated(decoded, "envelope", F.when(whole, root)).drop("roots")
    broken = present & F.col("envelope").isNull()
    source_ts = _whole_number(F.try_variant_get("envelope.source", "$.ts_ms", "string"))
    return decoded.select(
        "partition",
        "offset",
        "value",
        entity_of_topic(F.col("topic"), settings.topic_prefix).alias("entity"),
        F.col("envelope.op").alias("op"),
        F.col("envelope.before").alias("before"),
        F.col("envelope.after").alias("after"),
        F.coalesce(_truthy(source_ts), _whole_number(F.col("envelope.ts_ms"))).alias("source_ts_ms"),
        F.when(broken, F.lit("invalid JSON")).alias("parse_error"),
    )


def typed_payload(parsed: DataFrame) -> DataFrame:
    """Add the effective row image: the old one for deletes, else the new one."""

    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    with_image = with_evaluated(parsed, "image", image)

    def typed(name: str) -> Column:
        column = F.col(f"image.{name}")
        kind = payload_type(name)
        if isinstance(kind, (T.StringType, T.ArrayType)):
            return column.alias(name)
        if isinstance(kind, T.TimestampNTZType):
            # An offset moves the time to UTC; texts without one are UTC already.
            return column.try_cast("timestamp").cast(kind).alias(name)
        return column.try_cast(kind).alias(name)

    return with_image.select(*parsed.columns, *[typed(name) for name in PAYLOAD_COLUMNS])


def _printed(column: Column) -> Column:
    return F.coalesce(column, F.lit("None"))


def _missing_required(settings: Settings) -> list[tuple[Column, str]]:
    if not settings.strict_keys:
        return []
    rules = []
    for entity, columns in REQUIRED_COLUMNS.items():
        for name in columns:
            # A delete only carries its key.
            if name not in ("record_key",):
                applies = (F.col("entity") == entity) & (F.col("op") != "d")
            else:
                applies = F.col("entity") == entity
            rules.append((applies & F.col(name).isNull(), REASON_MISSING_FIELD + name))
    return rules


def validate_changes(
    parsed: DataFrame, settings: Settings, now_ms: int | Column
) -> DataFrame:
    """Add typed payload columns and ``reason``: the first failing rule, else null."""
    now = F.lit(now_ms) if isinstance(now_ms, int) else now_ms
    age = now - F.col("source_ts_ms")
    no_user = F.col("user_id_hash").isNull() | (F.col("user_id_hash") == "")
    rules: list[tuple[Column, Column | str]] = [
        (F.col("parse_error").isNotNull(), REASON_UNPARSEABLE),
        (
            F.col("entity").isNull(),
            F.concat(F.lit(REASON_UNKNOWN_ENTITY), _printed(F.col("entity"))),
        ),
        (
            F.col("op").isNull() | ~F.col("op").isin(*CHANGE_OPERATIONS),
            F.concat(F.lit(REASON_UNKNOWN_OPERATION), _printed(F.col("op"))),
        ),
        (no_user, REASON_MISSING_FIELD + "user_id_hash"),
        (-age > settings.future_tolerance_ms, REASON_FUTURE),
        (age > settings.max_age_ms, REASON_PAST),
        *_missing_required(settings),
    ]
    reason = F.lit(None).cast("string")
    for condition, outcome in reversed(rules):
        text = F.lit(outcome) if isinstance(outcome, str) else outcome
        reason = F.when(condition, text).otherwise(reason)
    return typed_payload(parsed).withColumn("reason", reason)


def valid_changes(validated: DataFrame) -> DataFrame:
    accepted = validated.filter(F.col("reason").isNull())
    return accepted.drop("reason", "parse_error", "value", "before", "after")


def quarantined_changes(validated: DataFrame) -> DataFrame:
    """Rejected rows with the whole parsed message kept as JSON.

    The images are cut from the message text, so fields no schema knows survive.
    """
    parsed = F.col("parse_error").isNull()
    payload = F.to_json(
        F.struct(
            F.col("entity").alias("table"),
            "op",
            F.when(parsed, F.get_json_object("value", "$.before")).alias("before"),
            F.when(parsed, F.get_json_object("value", "$.after")).alias("after"),
            "source_ts_ms",
            F.col("offset").alias("kafka_offset"),
            "parse_error",
            F.when(~parsed, F.col("value")).alias("value"),
        )
    )
    return validated.filter(F.col("reason").isNotNull()).select(
        F.col("entity").alias("source_table"),
        "reason",
        payload.alias("raw_payload"),
        "partition",
        "offset",
    )


def batch_latency(valid: DataFrame, now_ms: int) -> DataFrame:
    """Age of the newest change; null when no row carries a time."""
    return valid.agg((F.lit(now_ms) - F.max(_truthy(F.col("source_ts_ms")))).alias("latency_ms"))
