"""Dashboard reads over the finished tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def event_rate(event_counts: DataFrame) -> DataFrame:
    return event_counts.groupBy("minute_bucket").agg(
        F.round(F.sum("event_count") / F.lit(60.0), 6).alias("events_per_second")
    )


def top_hashtags(hashtag_counts: DataFrame, limit: int = 10) -> DataFrame:
    return (
        hashtag_counts.groupBy("hashtag")
        .agg(F.sum("tag_count").cast("long").alias("uses"))
        .orderBy(F.desc("uses"), "hashtag")
        .limit(limit)
    )


def segment_distribution(users: DataFrame) -> DataFrame:
    return users.filter("is_current").groupBy("segment").agg(F.count(F.lit(1)).alias("users"))


def trending_by_hour(trending: DataFrame, limit: int = 3) -> DataFrame:
    """Top tags per hour. The rank limit is applied before the shuffle as well."""
    by_use = Window.partitionBy("hour_bucket").orderBy(F.desc("usage_count"), "hashtag")
    return (
        trending.withColumn("position", F.row_number().over(by_use))
        .filter(F.col("position") <= limit)
        .select("hour_bucket", "position", "hashtag", "usage_count")
    )


def anomalous_accounts(accounts: DataFrame) -> DataFrame:
    return accounts.filter("is_anomalous").orderBy(F.desc("anomaly_score"), "user_id_hash")


def top_posts(engagement: DataFrame, limit: int = 10) -> DataFrame:
    return (
        engagement.orderBy(F.desc("engagement_count"), "post_id")
        .limit(limit)
        .select("post_id", "like_count", "repost_count", "engagement_count")
    )


def layer_totals(layers: dict[str, list[DataFrame]]) -> DataFrame:
    """Row counts per layer: counts of every table, added up per layer."""
    parts = [
        table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(layer).alias("layer"), "n")
        for layer, tables in layers.items()
        for table in tables
    ]
    stacked = reduce(DataFrame.unionByName, parts)
    return stacked.groupBy("layer").agg(F.sum("n").cast("long").alias("row_count"))


def pipeline_health(batches: DataFrame) -> DataFrame:
    return batches.agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("row_count").cast("long").alias("row_count"),
        F.sum("valid_row_count").cast("long").alias("valid_row_count"),
        F.round(F.sum("valid_row_count") / F.sum("row_count"), 6).alias("valid_share"),
        F.max("latency_ms").alias("max_latency_ms"),
    )
