"""Epoch numbers to zone-less UTC timestamps (sessions run in UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE_MS = 60_000


def micros_to_utc(value: Column) -> Column:
    return F.timestamp_micros(value).cast("timestamp_ntz")


def millis_to_utc(value: Column) -> Column:
    return F.timestamp_millis(value).cast("timestamp_ntz")


def day_of_millis(value: Column) -> Column:
    return F.to_date(millis_to_utc(value))


def utc_literal(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def floor_to_minute_ms(millis: Column) -> Column:
    """Integer bucket: cheap to hash and group by, turned into a timestamp afterwards."""
    return millis - F.pmod(millis, F.lit(MINUTE_MS))


def day_range(column: Column, day: str) -> Column:
    """Half-open range on the raw column, so that parquet can skip pages by it."""
    start = F.lit(day).cast("date")
    return (column >= start.cast("timestamp_ntz")) & (
        column < F.date_add(start, 1).cast("timestamp_ntz")
    )
