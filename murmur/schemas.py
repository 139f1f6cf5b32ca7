"""Explicit schemas. Unknown JSON fields are dropped, missing ones become null."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and types in this file are fixed values: messages and tables carry them.

FEED_SCHEMA = T.StructType(
    [
        T.StructField("did", T.StringType()),
        T.StructField("time_us", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField(
            "commit",
            T.StructType(
                [
                    T.StructField("operation", T.StringType()),
                    T.StructField("collection", T.StringType()),
                    T.StructField("rkey", T.StringType()),
                    # A map keeps keys whose value is null, a struct would lose them.
                    T.StructField("record", T.MapType(T.StringType(), T.StringType())),
                ]
            ),
        ),
    ]
)

FEED_TABLE = T.StructType(
    [T.StructField("seq", T.LongType()), T.StructField("value", T.StringType())]
)

CHANGE_MESSAGE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("value", T.StringType()),
    ]
)

_TYPES = {
    "user_id_hash": T.StringType(),
    "record_key": T.StringType(),
    "occurred_at": T.TimestampNTZType(),
    "language": T.StringType(),
    "text_length": T.IntegerType(),
    "hashtags": T.ArrayType(T.StringType()),
    "has_link": T.BooleanType(),
    "has_media": T.BooleanType(),
    "is_reply": T.BooleanType(),
    "target_user_id_hash": T.StringType(),
    "target_record_key": T.StringType(),
    "first_seen_at": T.TimestampNTZType(),
    "last_seen_at": T.TimestampNTZType(),
    "operation": T.StringType(),
}

ENTITY_COLUMNS = {
    "users": ["user_id_hash", "first_seen_at", "last_seen_at"],
    "posts": [
        "user_id_hash", "record_key", "occurred_at", "language", "text_length",
        "hashtags", "has_link", "has_media", "is_reply",
    ],
    "likes": [
        "user_id_hash", "record_key", "occurred_at", "target_user_id_hash", "target_record_key",
    ],
    "reposts": [
        "user_id_hash", "record_key", "occurred_at", "target_user_id_hash", "target_record_key",
    ],
    "follows": ["user_id_hash", "record_key", "occurred_at", "target_user_id_hash"],
    "blocks": ["user_id_hash", "record_key", "occurred_at", "target_user_id_hash"],
    "profile_updates": ["user_id_hash", "occurred_at", "operation"],
}

# NOT NULL columns besides user_id_hash, checked only with Settings.strict_keys.
REQUIRED_COLUMNS = {
    "users": ["first_seen_at", "last_seen_at"],
    "posts": ["record_key", "occurred_at"],
    "likes": ["record_key", "occurred_at"],
    "reposts": ["record_key", "occurred_at"],
    "follows": ["record_key", "occurred_at", "target_user_id_hash"],
    "blocks": ["record_key", "occurred_at", "target_user_id_hash"],
    "profile_updates": ["occurred_at", "operation"],
}

# All entity columns side by side: one change log carries every entity.
PAYLOAD_COLUMNS = list(_TYPES)
KEY_COLUMNS = ["entity", "user_id_hash", "record_key"]

LINEAGE = [
    T.StructField("kafka_offset", T.LongType()),
    T.StructField("cdc_op", T.StringType()),
    T.StructField("ingested_at", T.TimestampNTZType()),
    T.StructField("is_deleted", T.BooleanType()),
]

RAW_STATE = T.StructType(
    [T.StructField("entity", T.StringType())]
    + [T.StructField(name, kind) for name, kind in _TYPES.items()]
    + LINEAGE
)

# Current rows of the feed side, with their place in the feed.
CURRENT_ROW = T.StructType(
    [T.StructField("entity", T.StringType())]
    + [
        T.StructField(name, kind)
        for name, kind in _TYPES.items()
        if name not in ("first_seen_at", "last_seen_at")
    ]
    + [T.StructField("seq", T.LongType())]
)

_ARRIVAL = T.StructType([T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType())])

# Kept state also knows when its values and its last change arrived, so that merging changes
# again, in whatever order, gives the same rows.
STATE_ROW = T.StructType(
    [*RAW_STATE.fields, T.StructField("write_seq", _ARRIVAL), T.StructField("last_seq", _ARRIVAL)]
)


def placed(rows: T.StructType, *names: str) -> T.StructType:
    """A schema with partition columns behind its own."""
    kinds = {"day": T.DateType(), "bucket": T.IntegerType()}
    own = [f for f in rows.fields if f.name not in names]
    return T.StructType(own + [T.StructField(n, kinds.get(n, T.StringType())) for n in names])

# Typed fields stay strings inside JSON and are cast leniently afterwards, so
# one bad field nulls that field only.
PAYLOAD_JSON = T.StructType(
    [
        T.StructField(name, kind if isinstance(kind, T.ArrayType) else T.StringType())
        for name, kind in _TYPES.items()
    ]
)


def payload_type(name: str) -> T.DataType:
    return _TYPES[name]


def raw_schema(entity: str) -> T.StructType:
    return T.StructType(
        [T.StructField(name, _TYPES[name]) for name in ENTITY_COLUMNS[entity]] + LINEAGE
    )
