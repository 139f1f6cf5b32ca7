"""Stream and batch scans of the change topics and of the activity feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.constants import ENTITIES
from murmur.schemas import CHANGE_MESSAGE, FEED_TABLE
from murmur.settings import Settings


def topics(settings: Settings) -> list[str]:
    return [settings.topic_prefix + entity for entity in ENTITIES]


def kafka_options(settings: Settings, bootstrap_servers: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": ",".join(topics(settings)),
        "startingOffsets": "earliest",
        # An uncapped backlog would arrive as one batch after a pause.
        "maxOffsetsPerTrigger": str(settings.max_offsets_per_trigger),
    }


def _messages(records: DataFrame) -> DataFrame:
    return records.select(
        "topic", "partition", "offset", F.col("value").cast("string").alias("value")
    )


def kafka_changes(spark: SparkSession, settings: Settings, bootstrap_servers: str) -> DataFrame:
    """Live change topics (needs the Kafka connector on the classpath)."""
    reader = spark.readStream.format("kafka").options(**kafka_options(settings, bootstrap_servers))
    return _messages(reader.load())


def file_changes(
    spark: SparkSession, folder: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same messages as a stream of landed parquet files."""
    reader = spark.readStream.schema(CHANGE_MESSAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _messages(reader.parquet(folder))


def without_redelivered(messages: DataFrame, window: str) -> DataFrame:
    """A stream of messages of which each (topic, partition, offset) passes once.

    Places are remembered for the window, counted from their arrival, and then forgotten, so
    the state is bounded by what arrives in that time. It comes before any parsing.
    """
    stamped = messages.withColumn("received_at", F.current_timestamp()).withWatermark(
        "received_at", window
    )
    return stamped.dropDuplicatesWithinWatermark(["topic", "partition", "offset"]).drop("received_at")


def landed_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Batch scan of landed messages."""
    return _messages(spark.read.schema(CHANGE_MESSAGE).parquet(folder))


def tracked_messages(messages: DataFrame, settings: Settings) -> DataFrame:
    """What a subscription to the seven topics delivers."""
    return messages.filter(F.col("topic").isin(*topics(settings)))


def landed_feed(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(FEED_TABLE).parquet(folder)


def feed_stream(
    spark: SparkSession, folder: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(FEED_TABLE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder)


# Partitions of one feed topic: places of different partitions never meet below this number.
_MOST_PARTITIONS = 4096


def feed_options(settings: Settings, bootstrap_servers: str, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": str(settings.max_offsets_per_trigger),
    }


def feed_records(records: DataFrame) -> DataFrame:
    """Feed lines in an order that is that of the offsets within each partition.

    Senders key the topic by user, so a user's events lie in one partition and only their
    order matters.
    """
    place = F.col("offset") * _MOST_PARTITIONS + F.col("partition")
    return records.select(
        place.cast("long").alias("seq"), F.col("value").cast("string").alias("value")
    )


def kafka_feed(
    spark: SparkSession, settings: Settings, bootstrap_servers: str, topic: str
) -> DataFrame:
    """Live feed topic of any number of partitions (needs the Kafka connector)."""
    options = feed_options(settings, bootstrap_servers, topic)
    return feed_records(spark.readStream.format("kafka").options(**options).load())


def json_lines_feed(spark: SparkSession, folder: str, streaming: bool = False) -> DataFrame:
    """Feed lines from text files, which carry no arrival order but their event time."""
    reader = spark.readStream if streaming else spark.read
    return reader.text(folder).select(
        F.get_json_object("value", "$.time_us").try_cast("long").alias("seq"), "value"
    )
