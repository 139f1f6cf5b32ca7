"""The check suite over staging tables and marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.constants import INTERACTIONS, SEGMENTS
from murmur.operators import checks
from murmur.operators.checks import Check
from murmur.plans.staging import ID_COLUMN


def staging_checks(staged: dict[str, DataFrame]) -> list[Check]:
    suite: list[Check] = []
    for entity, table in staged.items():
        name = f"stg_{entity}"
        if entity in ID_COLUMN:
            suite += [
                checks.unique(name, table, ID_COLUMN[entity]),
                checks.not_null(name, table, ID_COLUMN[entity]),
                checks.not_null(name, table, "user_id_hash"),
            ]
        else:
            suite += [
                checks.unique(name, table, "user_id_hash"),
                checks.not_null(name, table, "user_id_hash"),
            ]
    suite.append(checks.not_null("stg_follows", staged["follows"], "target_user_id_hash"))
    return suite


def mart_checks(marts: dict[str, DataFrame]) -> list[Check]:
    users = marts["dim_user"]
    posts, interactions = marts["fct_posts"], marts["fct_interactions"]
    suite = [
        checks.not_null("dim_user", users, "user_id_hash"),
        checks.accepted("dim_user", users, "segment", SEGMENTS),
    ]
    for name, column in (
        ("dim_date", "date_day"),
        ("dim_hashtag", "hashtag"),
        ("dim_language", "language"),
        ("fct_posts", "post_id"),
        ("mart_engagement", "post_id"),
        ("mart_anomalous_accounts", "user_id_hash"),
    ):
        suite += [
            checks.unique(name, marts[name], column),
            checks.not_null(name, marts[name], column),
        ]
    activity = marts["fct_user_daily_activity"]
    suite += [
        checks.relationship("fct_posts", posts, "user_id_hash", users, "user_id_hash"),
        checks.accepted("fct_interactions", interactions, "interaction_type", INTERACTIONS),
        checks.not_null("fct_interactions", interactions, "user_id_hash"),
        checks.relationship(
            "fct_interactions", interactions, "target_user_id_hash", users, "user_id_hash"
        ),
        checks.not_null("fct_user_daily_activity", activity, "user_id_hash"),
        checks.not_null("fct_user_daily_activity", activity, "activity_date"),
        checks.not_null(
            "mart_trending_hashtags", marts["mart_trending_hashtags"], "hashtag"
        ),
        Check(
            "one_current_row_per_user",
            checks.users_with_many_current_rows(users).select("user_id_hash"),
        ),
    ]
    return suite


def layer_counts(
    raw_posts: DataFrame,
    stg_posts: DataFrame,
    fct_posts: DataFrame,
    summaries: DataFrame,
    day: str,
) -> DataFrame:
    """One row for a date: posts per layer and whether the layers agree.

    Staging hides deleted rows, so it is compared with the live raw rows.
    """

    def counted(table: DataFrame, condition: Column, name: str) -> DataFrame:
        return table.filter(condition).agg(F.count(F.lit(1)).alias(name))

    dated = F.col("occurred_date") == F.lit(day).cast("date")
    of_day = F.col("report_date") == F.lit(day).cast("date")
    live = counted(raw_posts, checks.in_day(raw_posts, day) & ~F.col("is_deleted"), "raw_rows")
    return live.select(
        "raw_rows",
        counted(stg_posts, dated, "n").scalar().alias("stg_rows"),
        counted(fct_posts, dated, "n").scalar().alias("fct_rows"),
        counted(summaries, of_day, "n").scalar().alias("summary_rows"),
    ).withColumn(
        "reconciled",
        (F.col("raw_rows") == F.col("stg_rows"))
        & (F.col("fct_rows") <= F.col("raw_rows"))
        & (F.col("summary_rows") == 1),
    )


def interaction_drift(interactions: DataFrame, fct_interactions: DataFrame) -> DataFrame:
    """Rows the incremental fact kept after deletion upstream, or missed as too late."""
    key = ["user_id_hash", "record_key", "interaction_type"]
    sides = (
        interactions.select(*key, F.lit(1).alias("now"), F.lit(0).alias("kept"))
        .unionByName(fct_interactions.select(*key, F.lit(0).alias("now"), F.lit(1).alias("kept")))
        .groupBy(*key)
        .agg(F.max("now").alias("now"), F.max("kept").alias("kept"))
    )
    return sides.agg(
        F.count_if((F.col("kept") == 1) & (F.col("now") == 0)).alias("deleted_upstream"),
        F.count_if((F.col("kept") == 0) & (F.col("now") == 1)).alias("missed_late"),
    )
