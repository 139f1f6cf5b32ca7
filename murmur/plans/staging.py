"""Staging views: live rows, surrogate ids and the activity date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.schemas import ENTITY_COLUMNS

ID_COLUMN = {
    "posts": "post_id",
    "likes": "like_id",
    "reposts": "repost_id",
    "follows": "follow_id",
    "blocks": "block_id",
}


def record_id():
    return F.concat("user_id_hash", F.lit("::"), "record_key")


def staged(raw: DataFrame, entity: str) -> DataFrame:
    """``users`` and ``profile_updates`` have neither a surrogate id nor a date."""
    live = raw.filter(~F.col("is_deleted"))
    # Filters on the date of a partitioned table reach its folders.
    day = F.col("day") if "day" in raw.columns else F.to_date("occurred_at")
    columns = ENTITY_COLUMNS[entity]
    if entity not in ID_COLUMN:
        return live.select(*columns)
    return live.select(
        record_id().alias(ID_COLUMN[entity]),
        *columns,
        day.alias("occurred_date"),
    )


def stage_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {entity: staged(table, entity) for entity, table in raw.items()}
