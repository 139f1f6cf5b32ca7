"""Type-2 history of users: snapshot by checked columns, and its repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "user_id_hash"
CHECKED = ["segment", "main_language"]


def version_id(valid_from: Column) -> Column:
    return F.md5(F.concat_ws("|", F.col(KEY), F.unix_micros(valid_from.cast("timestamp"))))


def _opened(rows: DataFrame, run_at: Column) -> DataFrame:
    return rows.select(
        "*",
        run_at.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        version_id(run_at).alias("scd_id"),
    )


def first_snapshot(current: DataFrame, run_at: Column) -> DataFrame:
    return _opened(current, run_at)


def snapshot_step(open_rows: DataFrame, current: DataFrame, run_at: Column) -> DataFrame:
    """Next versions of the open rows: kept, closed, and newly opened.

    Only open rows take part, closed history never moves again. Both sides are
    unique per user, so the join cannot skew. An unchanged user keeps the totals
    of the run that opened its row; a user missing from ``current`` stays open.
    """
    columns = current.columns
    pairs = open_rows.select(F.struct("*").alias("held"), F.col(KEY)).join(
        current.select(F.struct("*").alias("now"), F.col(KEY)), KEY, "full_outer"
    )
    same = F.lit(True)
    for name in CHECKED:
        same = same & F.col(f"held.{name}").eqNullSafe(F.col(f"now.{name}"))
    held, now = F.col("held").isNotNull(), F.col("now").isNotNull()
    replaced = held & now & ~same
    entered = now & (~held | ~same)
    closing = F.when(replaced, run_at).otherwise(F.col("held.valid_to"))
    no_end = F.lit(None).cast("timestamp_ntz")

    def version(side: str, valid_from: Column, valid_to: Column, scd_id: Column) -> Column:
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in columns],
            valid_from.alias("valid_from"),
            valid_to.alias("valid_to"),
            scd_id.alias("scd_id"),
        )

    kept = F.when(held, version("held", F.col("held.valid_from"), closing, F.col("held.scd_id")))
    fresh = F.when(entered, version("now", run_at, no_end, version_id(run_at)))
    versions = F.array_compact(F.array(kept, fresh))
    return pairs.select(F.explode(versions).alias("row")).select("row.*")


def split_open(history: DataFrame) -> tuple[DataFrame, DataFrame]:
    is_open = F.col("valid_to").isNull()
    return history.filter(is_open), history.filter(~is_open)


def snapshot(history: DataFrame, current: DataFrame, run_at: Column) -> DataFrame:
    """Whole history after one run."""
    open_rows, closed = split_open(history)
    return closed.unionByName(snapshot_step(open_rows, current, run_at))


def with_month(versions: DataFrame) -> DataFrame:
    """Adds the part of each version: the month in which it was closed, none while open."""
    return versions.withColumn("month", F.date_format("valid_to", "yyyy-MM"))


def repair_history(history: DataFrame) -> DataFrame:
    """Undo overlapping runs: one row per version, one open row per user.

    Rows sharing a version id are identical, so any one of them stands for all.
    The newest start per user is aggregated and joined back; a window would
    sort all rows of a heavily duplicated user in one task.
    """
    columns = [c for c in history.columns if c != "scd_id"]
    unique = (
        history.groupBy("scd_id")
        .agg(F.first(F.struct(*columns)).alias("row"))
        .select("row.*", "scd_id")
    )
    # Extremes ignore duplicates, so this side needs no de-duplicated input.
    crowded = (
        history.filter(F.col("valid_to").isNull())
        .groupBy(KEY)
        .agg(F.max("valid_from").alias("newest_from"), F.min("valid_from").alias("oldest_from"))
        .filter(F.col("oldest_from") < F.col("newest_from"))
        .select(KEY, "newest_from")
    )
    superseded = F.col("valid_to").isNull() & (F.col("valid_from") < F.col("newest_from"))
    return (
        unique.join(crowded, KEY, "left")
        .withColumn(
            "valid_to", F.when(superseded, F.col("newest_from")).otherwise(F.col("valid_to"))
        )
        .select(*history.columns)
    )
