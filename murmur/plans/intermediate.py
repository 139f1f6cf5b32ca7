"""Daily activity per user, and one summary row per user.

The five activity entities are tagged and stacked, so each model is one
aggregation over one union instead of a join of separate aggregates.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.constants import ACTIVITY_ENTITIES
from murmur.settings import Settings

COUNT_BY_ENTITY = {
    "posts": "post_count",
    "likes": "like_count",
    "reposts": "repost_count",
    "follows": "follow_count",
    "blocks": "block_count",
}
TOTAL_BY_ENTITY = {entity: f"total_{entity}" for entity in ACTIVITY_ENTITIES}
SUMMARY_COLUMNS = [
    "user_id_hash", "first_seen_at", "last_seen_at", *TOTAL_BY_ENTITY.values(),
    "main_language", "segment",
]

# Values that the summary of a user reads, besides keys and the date of an action.
READ_COLUMNS = ["language", "first_seen_at", "last_seen_at"]


def _stacked(staged: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    parts = [
        staged[entity].select(F.lit(entity).alias("entity"), *columns)
        for entity in ACTIVITY_ENTITIES
    ]
    return reduce(DataFrame.unionByName, parts)


def _count_of(entity: str) -> Column:
    return F.count_if(F.col("entity") == entity)


def user_daily_activity(staged: dict[str, DataFrame]) -> DataFrame:
    """A (user, day) row exists once there is any live activity on that day."""
    return (
        _stacked(staged, ["user_id_hash", "occurred_date"])
        .groupBy("user_id_hash", F.col("occurred_date").alias("activity_date"))
        .agg(
            *[_count_of(entity).alias(name) for entity, name in COUNT_BY_ENTITY.items()],
            F.count(F.lit(1)).alias("total_activity_count"),
        )
    )


def main_language(posts: DataFrame) -> DataFrame:
    """Most used language per user; the smallest one wins a tie."""
    per_language = (
        posts.filter(F.col("language").isNotNull())
        .groupBy("user_id_hash", "language")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_language.groupBy("user_id_hash").agg(
        F.min_by("language", F.struct((-F.col("n")).alias("n"), "language")).alias("language")
    )


def segment(settings: Settings) -> Column:
    actions = F.col("total_likes") + F.col("total_reposts") + F.col("total_follows")
    return (
        F.when(F.col("total_posts") >= settings.creator_min_posts, "creator")
        .when(actions >= settings.engager_min_actions, "engager")
        .otherwise("lurker")
    )


def user_activity_summary(staged: dict[str, DataFrame], settings: Settings) -> DataFrame:
    """Every known user with all-time totals, main language and segment.

    Users, posts and interactions are stacked and reduced twice: per (user,
    language), then per user. The first step shrinks even a very busy user to
    a few rows per task, so the second shuffle is small.
    """
    no_time = F.lit(None).cast("timestamp_ntz")
    no_language = F.lit(None).cast("string")

    def activity(entity: str, language: Column) -> DataFrame:
        return staged[entity].select(
            "user_id_hash",
            F.lit(entity).alias("entity"),
            language.alias("language"),
            no_time.alias("first_seen_at"),
            no_time.alias("last_seen_at"),
        )

    users = staged["users"].select(
        "user_id_hash",
        F.lit("users").alias("entity"),
        no_language.alias("language"),
        "first_seen_at",
        "last_seen_at",
    )
    parts = [users] + [
        activity(entity, F.col("language") if entity == "posts" else no_language)
        for entity in ACTIVITY_ENTITIES
    ]
    per_language = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("user_id_hash", "language")
        .agg(
            F.count_if(F.col("entity") == "users").alias("known"),
            F.max("first_seen_at").alias("first_seen_at"),
            F.max("last_seen_at").alias("last_seen_at"),
            *[_count_of(entity).alias(name) for entity, name in TOTAL_BY_ENTITY.items()],
        )
    )
    has_language = F.col("language").isNotNull()
    rank = F.when(
        has_language, F.struct((-F.col("total_posts")).alias("n"), F.col("language"))
    )
    per_user = (
        per_language.groupBy("user_id_hash")
        .agg(
            F.sum("known").alias("known"),
            F.max("first_seen_at").alias("first_seen_at"),
            F.max("last_seen_at").alias("last_seen_at"),
            *[F.sum(name).cast("long").alias(name) for name in TOTAL_BY_ENTITY.values()],
            F.min(rank)["language"].alias("main_language"),
        )
        .filter(F.col("known") > 0)
    )
    return per_user.withColumn("segment", segment(settings)).select(*SUMMARY_COLUMNS)
