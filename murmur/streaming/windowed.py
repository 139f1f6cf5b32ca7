"""Native event-time aggregation with a watermark.

The delay covers every age that validation accepts, so no valid change is dropped
and the state stays bounded by that age. A streaming ``groupBy`` combines before its
shuffle; ``dropDuplicates`` would not, so membership is grouped as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from murmur.operators import changes, minute_rollups
from murmur.settings import Settings
from murmur.sources.tables import TableStore


def watermarked_activity(
    messages: DataFrame, settings: Settings, now_ms: Column | None = None
) -> DataFrame:
    """Valid changes with their minute as event time.

    The clock is a column, by default each batch's own time: a number would stand still in a
    query that runs for days.
    """
    if now_ms is None:
        now_ms = F.unix_millis(F.current_timestamp())
    parsed = changes.parse_changes(messages, settings)
    valid = changes.valid_changes(changes.validate_changes(parsed, settings, now_ms))
    activity = minute_rollups.activity_changes(valid, now_ms)
    # Watermarks need an instant, not a zone-less timestamp.
    return activity.withColumn("minute", F.timestamp_millis("minute_ms")).withWatermark(
        "minute", settings.watermark_delay
    )


def event_counts(activity: DataFrame) -> DataFrame:
    return activity.groupBy(
        "minute", F.col("entity").alias("event_type"), F.col("op").alias("operation")
    ).agg(F.count(F.lit(1)).alias("event_count"))


def active_users(activity: DataFrame) -> DataFrame:
    return activity.groupBy("minute", "user_id_hash").agg(F.count(F.lit(1)).alias("actions"))


def hashtag_counts(activity: DataFrame) -> DataFrame:
    written = activity.filter((F.col("entity") == "posts") & (F.col("op") != "d"))
    return (
        written.select("minute", F.explode("hashtags").alias("hashtag"))
        .groupBy("minute", "hashtag")
        .agg(F.count(F.lit(1)).alias("tag_count"))
    )


def language_counts(activity: DataFrame) -> DataFrame:
    written = activity.filter((F.col("entity") == "posts") & (F.col("op") != "d"))
    return (
        written.filter(F.col("language") != "")
        .groupBy("minute", "language")
        .agg(F.count(F.lit(1)).alias("post_count"))
    )


def start_updates(
    counts: DataFrame, store: TableStore, name: str, checkpoint: str, available_now: bool = False,
    trigger_interval: str = Settings.trigger_interval,
) -> StreamingQuery:
    """Update mode: a bucket touched by several batches is emitted by each of them."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        store.append_batch(name, batch, batch_id)

    writer = (
        counts.writeStream.outputMode("update")
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger_interval).start()


def latest_values(store: TableStore, name: str, keys: list[str], value: str) -> DataFrame:
    """The newest emission of each bucket."""
    return (
        store.read_batches(name)
        .groupBy("minute", *keys)
        .agg(F.max_by(value, "batch_id").alias(value))
        .select(F.col("minute").cast("timestamp_ntz").alias("minute_bucket"), *keys, value)
    )
