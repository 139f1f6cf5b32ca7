"""Evaluate an expensive expression once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_evaluated(table: DataFrame, name: str, column: Column) -> DataFrame:
    """``withColumn`` whose value later filters cannot recompute.

    The optimizer pushes a filter below a projection by repeating the projected
    expression inside the predicate, so a parsed JSON document would be parsed
    again for every field that is tested. A one-element generator is a boundary
    for such filters, while filters on other columns still pass it.
    """
    return table.select("*", F.explode(F.array(column)).alias(name))
