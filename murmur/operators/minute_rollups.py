"""Per-minute aggregates over valid changes.

Batch and streaming share these expressions. Buckets are integers while they
are grouped and turn into timestamps at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.functions.identity import with_packed, with_unpacked
from murmur.functions.times import floor_to_minute_ms, millis_to_utc

EVENTS, USERS, TAGS, LANGUAGES = "events", "users", "hashtags", "languages"
COUNT_COLUMN = {EVENTS: "event_count", TAGS: "tag_count", LANGUAGES: "post_count"}
KEY_COLUMNS = {
    EVENTS: ["minute_bucket", "event_type", "operation"],
    USERS: ["minute_bucket", "user_id_hash"],
    TAGS: ["minute_bucket", "hashtag"],
    LANGUAGES: ["minute_bucket", "language"],
}


def minute_ms(now_ms: int | Column) -> Column:
    """Bucket of the source commit time; a missing or zero time counts as now."""
    now = F.lit(now_ms) if isinstance(now_ms, int) else now_ms
    return floor_to_minute_ms(
        F.coalesce(F.nullif(F.col("source_ts_ms"), F.lit(0).cast("long")), now)
    )


def activity_changes(valid: DataFrame, now_ms: int | Column) -> DataFrame:
    """Bookkeeping changes of the users entity are no user-facing activity."""
    return valid.filter(F.col("entity") != "users").withColumn("minute_ms", minute_ms(now_ms))


def _written_posts(activity: DataFrame) -> DataFrame:
    return activity.filter((F.col("entity") == "posts") & (F.col("op") != "d"))


def _with_bucket(counts: DataFrame, columns: list[str]) -> DataFrame:
    return counts.withColumn("minute_bucket", millis_to_utc(F.col("minute_ms"))).select(*columns)


def event_counts(activity: DataFrame) -> DataFrame:
    counts = activity.groupBy(
        "minute_ms", F.col("entity").alias("event_type"), F.col("op").alias("operation")
    ).agg(F.count(F.lit(1)).alias("event_count"))
    return _with_bucket(counts, [*KEY_COLUMNS[EVENTS], "event_count"])


def active_users(activity: DataFrame) -> DataFrame:
    """Membership, not a running count: exact across any split into batches."""
    members = activity.select("minute_ms", "user_id_hash").distinct()
    return _with_bucket(members, KEY_COLUMNS[USERS])


def active_user_counts(members: DataFrame) -> DataFrame:
    return members.groupBy("minute_bucket").agg(F.count(F.lit(1)).alias("active_users"))


def hashtag_counts(activity: DataFrame) -> DataFrame:
    counts = (
        _written_posts(activity)
        .select("minute_ms", F.explode("hashtags").alias("hashtag"))
        .groupBy("minute_ms", "hashtag")
        .agg(F.count(F.lit(1)).alias("tag_count"))
    )
    return _with_bucket(counts, [*KEY_COLUMNS[TAGS], "tag_count"])


def language_counts(activity: DataFrame) -> DataFrame:
    counts = (
        _written_posts(activity)
        .filter(F.col("language") != "")
        .groupBy("minute_ms", "language")
        .agg(F.count(F.lit(1)).alias("post_count"))
    )
    return _with_bucket(counts, [*KEY_COLUMNS[LANGUAGES], "post_count"])


def rollup_partials(activity: DataFrame) -> DataFrame:
    """All four aggregates of one micro-batch in one scan and one shuffle.

    Each change fans out to its facts (metric, two keys); grouping them counts
    events, tags and languages, and leaves one row per (minute, user).
    """

    def fact(metric: str, first: Column, second: Column | None = None) -> Column:
        other = second if second is not None else F.lit(None).cast("string")
        return F.struct(
            F.lit(metric).alias("metric"), first.alias("key"), other.alias("subkey")
        )

    is_post = (F.col("entity") == "posts") & (F.col("op") != "d")
    tags = F.when(is_post, F.col("hashtags"))
    language = F.when(is_post & (F.col("language") != ""), fact(LANGUAGES, F.col("language")))
    facts = F.concat(
        F.array_compact(
            F.array(
                fact(EVENTS, F.col("entity"), F.col("op")),
                fact(USERS, F.col("user_id_hash")),
                language,
            )
        ),
        F.coalesce(
            F.transform(tags, lambda tag: fact(TAGS, tag)),
            F.array().cast("array<struct<metric:string,key:string,subkey:string>>"),
        ),
    )
    counted = (
        with_packed(
            activity.select("minute_ms", F.explode(facts).alias("fact")).select("minute_ms", "fact.*"),
            "key",
        )
        .groupBy("metric", "minute_ms", "key", "subkey")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return with_unpacked(counted, "key")


def merged_partials(partials: DataFrame) -> DataFrame:
    """Partials of several batches as one set of partials."""
    merged = (
        with_packed(partials, "key")
        .groupBy("metric", "minute_ms", "key", "subkey")
        .agg(F.sum("n").cast("long").alias("n"))
    )
    return with_unpacked(merged, "key")


def merged_rollup(partials: DataFrame, metric: str) -> DataFrame:
    """Partials of any number of batches back to one aggregate."""
    counted = (
        with_packed(partials.filter(F.col("metric") == metric), "key")
        .groupBy("minute_ms", "key", "subkey")
        .agg(F.sum("n").cast("long").alias("n"))
    )
    merged = (
        with_unpacked(counted, "key")
        .withColumn("minute_bucket", millis_to_utc(F.col("minute_ms")))
    )
    keys = KEY_COLUMNS[metric]
    columns = [F.col("minute_bucket"), F.col("key").alias(keys[1])]
    if len(keys) == 3:
        columns.append(F.col("subkey").alias(keys[2]))
    if metric in COUNT_COLUMN:
        columns.append(F.col("n").alias(COUNT_COLUMN[metric]))
    return merged.select(*columns)


def ingest_rate(arrivals: DataFrame, seconds: int = 5) -> DataFrame:
    """Arrivals per second over a trailing window that advances every second.

    Counting whole seconds first keeps the five-fold fan-out off the raw rows.
    """
    second = F.floor(F.col("arrived_us") / F.lit(1_000_000)).cast("long")
    per_second = arrivals.groupBy(second.alias("second")).agg(F.count(F.lit(1)).alias("n"))
    return (
        per_second.select(
            F.explode(F.sequence(F.col("second") + 1, F.col("second") + seconds)).alias("end_s"),
            "n",
        )
        .groupBy("end_s")
        .agg((F.sum("n") / F.lit(float(seconds))).alias("events_per_second"))
        .select(
            F.timestamp_seconds("end_s").cast("timestamp_ntz").alias("window_end"),
            "events_per_second",
        )
    )


def recent_types(events: DataFrame, limit: int = 20) -> DataFrame:
    """Newest arrivals first (a top-k, so only k rows per task leave the scan)."""
    return events.select("seq", "event_type").orderBy(F.desc("seq")).limit(limit)
