"""Exact row numbers inside groups of any size, without a window over a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm.common import stored

_ROW_BITS = 33


def ranked(rows: DataFrame, key: str, order: list[str], label: str) -> DataFrame:
    """Adds group_id (long, never null, ascending with ``key``), group_rows and place (from 0).

    Rows are dealt by ranges of (key, order), so a group of any size is spread evenly, and
    written once with their partition and row number. What is then counted per key and
    partition has no more rows than keys and partitions together. Nulls come first; rows that
    tie in ``order`` must be interchangeable.
    """
    columns = [F.col(name) for name in (key, *order)]
    placed = stored(
        rows.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*columns, F.col("_tie"))
        .sortWithinPartitions(*columns, F.col("_tie"))
        .drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id()),
        label,
    ).withColumn("_part", F.shiftright("_at", _ROW_BITS))
    runs = placed.groupBy(F.col(key).alias("_key"), F.col("_part").alias("_run_part")).agg(
        F.min("_at").alias("_start"), F.count(F.lit(1)).alias("_rows")
    )
    runs = stored(runs, f"{label}-runs")
    # One row per partition: this window has no key, and no need of one.
    parts = runs.groupBy(F.col("_run_part").alias("_of")).agg(F.sum("_rows").alias("_held"))
    earlier = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_of", F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_before"))
    of_key = Window.partitionBy("_key")
    before = of_key.orderBy("_run_part").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("_before") + F.col("_start").bitwiseAND((1 << _ROW_BITS) - 1)
    runs = runs.join(parts, F.col("_run_part") == F.col("_of")).select(
        "_key",
        "_run_part",
        "_start",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(of_key).alias("group_rows"),
        F.min(first).over(of_key).alias("group_id"),
    )
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_run_part"))
    return placed.join(runs, same).select(
        *rows.columns,
        "group_id",
        "group_rows",
        (F.col("_at") - F.col("_start") + F.col("_offset")).alias("place"),
    )
