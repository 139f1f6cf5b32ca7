import itertools
import json

import pytest
from pyspark.sql import functions as F

from murmur.operators import changes, keyed_state
from murmur.settings import Settings

NOW = 1_706_659_200_000
SETTINGS = Settings(salt="s")
TOPIC = SETTINGS.topic_prefix


def message(op="c", offset=1, entity="posts", before=None, after=None, ts=NOW, **extra):
    after = after if after is not None or op == "d" else {"user_id_hash": "u1", "record_key": "r1"}
    envelope = {"before": before, "after": after, "source": {"ts_ms": ts}, "op": op, **extra}
    return (TOPIC + entity, 0, offset, json.dumps(envelope))


def raw(value, topic=TOPIC + "posts"):
    return (topic, 0, 1, value)


def parse(spark, *messages, settings=SETTINGS):
    table = spark.createDataFrame(
        list(messages), "topic string, partition int, offset long, value string"
    )
    return changes.parse_changes(table, settings)


def reasons(spark, *messages, settings=SETTINGS):
    validated = changes.validate_changes(parse(spark, *messages, settings=settings), settings, NOW)
    return [r.reason for r in validated.select("reason").collect()]


def test_envelope_fields(spark):
    [row] = parse(spark, message(offset=42)).collect()
    assert (row.entity, row.op, row.offset, row.source_ts_ms) == ("posts", "c", 42, NOW)
    assert row.after.user_id_hash == "u1" and row.before is None and row.parse_error is None


def test_delete_and_unknown_topic(spark):
    gone = message("d", before={"user_id_hash": "u1", "record_key": "r1"})
    rows = parse(spark, gone, raw("{}", "elsewhere")).collect()
    assert rows[0].before.user_id_hash == "u1" and rows[0].after is None
    assert rows[1].entity is None


@pytest.mark.parametrize(
    "value",
    ["not-json", "null", "[]", "5", '{"op":"c"', '{"op":"c"} tail', '[{"op":"c"}]',
     '{"op":"c","source":"x"}', '{"op":"c","source":"{bad"}', '{"op":"c","source":"{\\"ts_ms\\":1}"}',
     '{"op":"c"}],[{"op":"u"}', '{"op":"c"},{"op":"u"}', '{"op":"c"}]', '{"op":"c","source":[1]}', '{"op":"c"}{"op":"u"}'],
)
def test_broken_values_are_unparseable(spark, value):
    [row] = parse(spark, raw(value)).collect()
    assert row.parse_error == "invalid JSON"
    assert reasons(spark, raw(value)) == ["unparseable message: invalid JSON"]


def test_missing_value_is_an_empty_envelope(spark):
    assert reasons(spark, raw(None), raw("")) == ["unknown operation: None"] * 2
    dropping = Settings(salt="s", drop_tombstones=True)
    assert reasons(spark, raw(None), settings=dropping) == []


def test_source_time_falls_back_to_envelope_time(spark):
    rows = parse(
        spark, message(ts=0, ts_ms=7), message(ts=None, ts_ms=8), message(ts=0), message(ts=5, ts_ms=9)
    ).collect()
    assert [r.source_ts_ms for r in rows] == [7, 8, None, 5]


def test_validation_rules(spark):
    user = {"user_id_hash": "u1", "record_key": "r1"}
    cases = [
        (message(), None),
        (message(entity="gadgets"), "unknown event type: None"),
        (message("x"), "unknown operation: x"),
        (message(after={"record_key": "r1"}), "missing required field: user_id_hash"),
        (message(after={"user_id_hash": ""}), "missing required field: user_id_hash"),
        (message(after={}), "missing required field: user_id_hash"),
        (message(ts=NOW + 3_600_000), "timestamp too far in the future"),
        (message(ts=NOW + 300_000), None),
        (message(ts=NOW + 300_001), "timestamp too far in the future"),
        (message(ts=1), "timestamp too far in the past"),
        (message(ts=NOW - 2_592_000_000), None),
        (message(ts=NOW - 2_592_000_001), "timestamp too far in the past"),
        (message(ts=None), None),
        (message(ts=0, ts_ms=0), "timestamp too far in the past"),
        (message("d", before=user), None),
        (message("d", after=user), "missing required field: user_id_hash"),
    ]
    for given, expected in cases:
        assert reasons(spark, given) == [expected], given


def test_strict_keys_add_a_rule(spark):
    strict = Settings(salt="s", strict_keys=True)
    no_key = message(after={"user_id_hash": "u", "occurred_at": "2024-01-01T00:00:00Z"})
    assert reasons(spark, no_key) == [None]
    assert reasons(spark, no_key, settings=strict) == ["missing required field: record_key"]


def test_quarantine_keeps_unknown_fields(spark):
    odd = message("x", after={"user_id_hash": "u", "surprise": 1})
    validated = changes.validate_changes(parse(spark, odd, raw("oops")), SETTINGS, NOW)
    rows = changes.quarantined_changes(validated).collect()
    payload = {r.reason: json.loads(r.raw_payload) for r in rows}
    assert json.loads(payload["unknown operation: x"]["after"])["surprise"] == 1
    assert payload["unparseable message: invalid JSON"]["value"] == "oops"
    assert changes.valid_changes(validated).count() == 0


def state(spark, *messages, previous=None):
    valid = changes.valid_changes(
        changes.validate_changes(parse(spark, *messages), SETTINGS, NOW)
    )
    log = keyed_state.change_log(valid, F.timestamp_millis("source_ts_ms").cast("timestamp_ntz"))
    table = (
        keyed_state.collapse_changes(log)
        if previous is None
        else keyed_state.apply_changes(previous, log)
    )
    rows = table.collect()
    return table, {
        (r.entity, r.user_id_hash, r.record_key): (
            r.language, r.kafka_offset, r.cdc_op, r.is_deleted, r.text_length)
        for r in rows
    }


def post(op, offset, key="r1", lang=None):
    image = {"user_id_hash": "u1", "record_key": key, "language": lang, "text_length": 3}
    return message(op, offset, before=image if op == "d" else None, after=None if op == "d" else image)


HISTORY = [
    post("c", 1, lang="en"), post("u", 2, lang="de"), post("d", 3),
    post("d", 4, "ghost"),
    post("c", 5, "back", "en"), post("d", 6, "back"), post("u", 7, "back", "fr"),
]
EXPECTED = {
    ("posts", "u1", "r1"): ("de", 2, "d", True, 3),
    ("posts", "u1", "back"): ("fr", 7, "u", False, 3),
}


def test_collapse_keeps_values_and_offset_of_the_last_write(spark):
    assert state(spark, *HISTORY)[1] == EXPECTED


def test_collapse_does_not_depend_on_row_order(spark):
    for order in itertools.islice(itertools.permutations(HISTORY), 0, 5040, 1111):
        assert state(spark, *order)[1] == EXPECTED


def test_redelivered_messages_change_nothing(spark):
    assert state(spark, *HISTORY, *HISTORY)[1] == EXPECTED
    table = spark.createDataFrame(
        HISTORY + HISTORY, "topic string, partition int, offset long, value string"
    )
    assert keyed_state.drop_redelivered(table).count() == len(HISTORY)


@pytest.mark.parametrize("cut", range(1, len(HISTORY)))
def test_incremental_equals_one_pass(spark, cut):
    first, _ = state(spark, *HISTORY[:cut])
    assert state(spark, *HISTORY[cut:], previous=first)[1] == EXPECTED


def test_hot_key_collapses_in_one_row(spark):
    many = [post("u", i, lang="en") for i in range(1, 2000)] + [post("u", 5000, lang="it")]
    assert state(spark, *many)[1] == {("posts", "u1", "r1"): ("it", 5000, "u", False, 3)}


def test_additive_and_insert_missing(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, n long")
    b = spark.createDataFrame([("x", 5)], "k string, n long")
    merged = keyed_state.merge_additive([a, b], ["k"], "n").collect()
    assert {(r.k, r.n) for r in merged} == {("x", 6), ("y", 2)}
    kept = keyed_state.insert_missing(a, b.union(b).unionByName(
        spark.createDataFrame([("z", 9), ("z", 9)], "k string, n long")), ["k"]).collect()
    assert sorted((r.k, r.n) for r in kept) == [("x", 1), ("y", 2), ("z", 9)]


@pytest.mark.parametrize(
    "value",
    ["{'op':'c'}", '{"op":"c"} {"a":1}', '{"op":"c"},{"op":"d"}', '{"op":"c"}]', '{"op":"c"},'],
)
def test_near_misses_of_json_are_unparseable(spark, value):
    [row] = parse(spark, raw(value)).collect()
    assert (row.parse_error, row.op) == ("invalid JSON", None)


def test_one_odd_field_is_null_and_the_rest_stays(spark):
    value = '{"op":"c","after":{"user_id_hash":"u","hashtags":"x","text_length":3},"ts_ms":1.7e12}'
    [row] = parse(spark, raw(value)).collect()
    assert (row.parse_error, row.source_ts_ms) == (None, 1_700_000_000_000)
    assert (row.after.user_id_hash, row.after.hashtags, row.after.text_length) == ("u", None, "3")


def test_zone_offsets_move_times_to_utc(spark):
    value = '{"op":"c","after":{"user_id_hash":"u","occurred_at":"2024-01-01T00:00:00+02:00"}}'
    [row] = changes.typed_payload(parse(spark, raw(value))).collect()
    assert str(row.occurred_at) == "2023-12-31 22:00:00"
