"""Curated models: dimensions, facts and report marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.constants import (
    CALENDAR_END,
    CALENDAR_START,
    REASON_FOLLOW_RATE,
    REASON_LIKE_RATE,
)
from murmur.functions.times import utc_literal
from murmur.operators.keyed_state import replace_by_key
from murmur.plans.staging import record_id
from murmur.settings import Settings

INTERACTION_KEY = ["user_id_hash", "record_key", "interaction_type"]
INTERACTION_COLUMNS = [
    "interaction_type", "user_id_hash", "record_key", "occurred_at",
    "target_user_id_hash", "target_record_key",
]


def dim_user(history: DataFrame) -> DataFrame:
    kept = [c for c in history.columns if c != "scd_id"]
    return history.select(*kept, F.col("valid_to").isNull().alias("is_current"))


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    day = F.col("date_day")
    return spark.range(1).select(F.explode(days).alias("date_day")).select(
        "date_day",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
        (F.weekday(day) + 1).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
    )


def _lowered_tags(posts: DataFrame, *columns: str) -> DataFrame:
    return (
        posts.select(*columns, F.explode("hashtags").alias("tag"))
        .filter(F.col("tag") != "")
        .select(*columns, F.lower("tag").alias("hashtag"))
    )


def dim_hashtag(posts: DataFrame) -> DataFrame:
    return _lowered_tags(posts).distinct()


def dim_language(posts: DataFrame) -> DataFrame:
    return posts.filter(F.col("language").isNotNull()).select("language").distinct()


def fct_posts(posts: DataFrame) -> DataFrame:
    return posts


def fct_interactions(staged: dict[str, DataFrame]) -> DataFrame:
    """Likes, reposts, follows and blocks under one roof."""

    def tagged(entity: str, name: str) -> DataFrame:
        return staged[entity].withColumn("interaction_type", F.lit(name))

    parts = [
        tagged("likes", "like"), tagged("reposts", "repost"),
        tagged("follows", "follow"), tagged("blocks", "block"),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.select(*INTERACTION_COLUMNS)


def lookback_bound(target: DataFrame, settings: Settings) -> Column:
    """The time from which rows are read again: a little before the newest known one."""
    newest = F.coalesce(F.max("occurred_at"), utc_literal("1970-01-01 00:00:00"))
    lookback = F.make_dt_interval(hours=F.lit(settings.incremental_lookback_hours))
    return target.agg((newest - lookback).alias("bound")).scalar()


def incremental_interactions(
    target: DataFrame, interactions: DataFrame, settings: Settings
) -> DataFrame:
    """Re-read a lookback window behind the newest known row, replace by key.

    The bound is a scalar subquery, so the scan of ``interactions`` filters on it.
    """
    bound = lookback_bound(target, settings)
    return replace_by_key(
        target, interactions.filter(F.col("occurred_at") > bound), INTERACTION_KEY
    ).select(*INTERACTION_COLUMNS)


def fct_user_daily_activity(daily: DataFrame) -> DataFrame:
    return daily


def mart_engagement(posts: DataFrame, likes: DataFrame, reposts: DataFrame) -> DataFrame:
    """Likes and reposts per post in one aggregation and no join.

    Posts and the records they were targeted by meet under the same key
    (author, record key), which is unique per post. Partial counts collapse a
    viral post before the shuffle; keys without a post drop out afterwards.
    """

    def targeted(actions: DataFrame, name: str) -> DataFrame:
        named = F.col("target_user_id_hash").isNotNull() & F.col("target_record_key").isNotNull()
        return actions.filter(named).select(
            F.col("target_user_id_hash").alias("user_id_hash"),
            F.col("target_record_key").alias("record_key"),
            F.lit(None).cast("timestamp_ntz").alias("occurred_at"),
            F.lit(name).alias("role"),
        )

    written = posts.select("user_id_hash", "record_key", "occurred_at", F.lit("post").alias("role"))
    stacked = written.unionByName(targeted(likes, "like")).unionByName(
        targeted(reposts, "repost")
    )
    return (
        stacked.groupBy("user_id_hash", "record_key")
        .agg(
            F.count_if(F.col("role") == "post").alias("posts"),
            F.max("occurred_at").alias("occurred_at"),
            F.count_if(F.col("role") == "like").alias("like_count"),
            F.count_if(F.col("role") == "repost").alias("repost_count"),
        )
        .filter(F.col("posts") > 0)
        .select(
            record_id().alias("post_id"),
            "user_id_hash",
            "record_key",
            "occurred_at",
            "like_count",
            "repost_count",
            (F.col("like_count") + F.col("repost_count")).alias("engagement_count"),
        )
    )


def mart_trending_hashtags(posts: DataFrame) -> DataFrame:
    """Uses per tag and hour; two spellings in one post count twice."""
    hour = F.date_trunc("hour", F.col("occurred_at")).cast("timestamp_ntz")
    return (
        _lowered_tags(posts, "occurred_at")
        .groupBy("hashtag", hour.alias("hour_bucket"))
        .agg(F.count(F.lit(1)).alias("usage_count"))
    )


def _micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def mart_anomalous_accounts(summary: DataFrame, settings: Settings) -> DataFrame:
    """Follow and like rates no person sustains. Limits test unrounded rates."""
    hours = (_micros("last_seen_at") - _micros("first_seen_at")) / F.lit(3.6e9)
    rated = summary.withColumn("age", F.greatest(hours, F.lit(1.0) / F.lit(60.0)))
    follows, likes = F.col("total_follows") / F.col("age"), F.col("total_likes") / F.col("age")
    fast_follows = follows > settings.follows_per_hour_limit
    fast_likes = likes > settings.likes_per_hour_limit
    reasons = F.array_compact(
        F.array(F.when(fast_follows, REASON_FOLLOW_RATE), F.when(fast_likes, REASON_LIKE_RATE))
    )
    return rated.select(
        "user_id_hash",
        "total_follows",
        "total_likes",
        F.round("age", 2).alias("account_age_hours"),
        F.round(follows, 2).alias("follows_per_hour"),
        F.round(likes, 2).alias("likes_per_hour"),
        (fast_follows.cast("int") + fast_likes.cast("int")).alias("anomaly_score"),
        F.nullif(F.array_join(reasons, ", "), F.lit("")).alias("reason"),
        (fast_follows | fast_likes).alias("is_anomalous"),
    )


def daily_summary(daily: DataFrame, report_date: str) -> DataFrame:
    """Exactly one row per date: a date without activity reports zeros."""
    columns = {
        "total_posts": "post_count", "total_likes": "like_count",
        "total_reposts": "repost_count", "total_follows": "follow_count",
        "total_blocks": "block_count",
    }
    day = F.lit(report_date).cast("date")
    return (
        daily.filter(F.col("activity_date") == day)
        .agg(
            *[
                F.coalesce(F.sum(source), F.lit(0)).cast("long").alias(name)
                for name, source in columns.items()
            ],
            F.count_if(F.col("total_activity_count") > 0).alias("active_users"),
        )
        .select(day.alias("report_date"), *columns, "active_users")
    )
