"""Data-quality checks. Every check yields its violations or one verdict row."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.functions.times import day_range

ERROR, WARN = "error", "warn"


# ------------------------------------------------------------------- checks


def duplicates(table: DataFrame, column: str) -> DataFrame:
    return (
        table.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def nulls(table: DataFrame, column: str) -> DataFrame:
    return table.filter(F.col(column).isNull())


def unexpected_values(table: DataFrame, column: str, accepted: tuple[str, ...]) -> DataFrame:
    """Values outside the list with their row counts; null passes."""
    return (
        table.filter(~F.col(column).isin(*accepted))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent and how many child rows use them.

    Both sides are reduced to distinct keys first, so a value that fills a third
    of the child table is one row in the join.
    """
    used = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )
    known = parent.select(F.col(parent_column).alias("value")).distinct()
    return used.join(known, "value", "left_anti")


def users_with_many_current_rows(dim_user: DataFrame) -> DataFrame:
    return (
        dim_user.filter("is_current")
        .groupBy("user_id_hash")
        .agg(F.count(F.lit(1)).alias("current_rows"))
        .filter(F.col("current_rows") > 1)
    )


def freshness(raw: dict[str, DataFrame], as_of: Column, minutes: int) -> DataFrame:
    """Newest load time per source table and whether it is older than allowed."""
    allowed = F.make_dt_interval(mins=F.lit(minutes))
    parts = [
        table.agg(F.max("ingested_at").alias("newest")).select(
            F.lit(name).alias("source_table"),
            "newest",
            F.coalesce(as_of - F.col("newest") > allowed, F.lit(True)).alias("is_stale"),
        )
        for name, table in raw.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def partition_gate(daily: DataFrame, day: str, min_rows: int) -> DataFrame:
    """One verdict row for a date. Null keys also count as duplicates."""
    key = F.col("user_id_hash")
    return (
        daily.filter(F.col("activity_date") == F.lit(day).cast("date"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(key.isNull()).alias("null_keys"),
            (F.count(F.lit(1)) - F.count_distinct(key)).alias("duplicate_keys"),
        )
        .withColumn(
            "passed",
            (F.col("row_count") >= min_rows)
            & (F.col("null_keys") == 0)
            & (F.col("duplicate_keys") == 0),
        )
    )


def in_day(table: DataFrame, day: str) -> Column:
    """Rows of one date: by the folders of a table that lies by day, else by its times."""
    if "day" in table.columns:
        return F.col("day") == F.lit(day).cast("date")
    return day_range(F.col("occurred_at"), day)


def partition_counts(tables: dict[str, DataFrame], day: str) -> DataFrame:
    """Rows per entity inside one date; an empty entity reports zero."""
    parts = [
        table.filter(in_day(table, day))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(entity).alias("entity"), "row_count")
        for entity, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def reconcile(source_counts: DataFrame, raw_counts: DataFrame) -> DataFrame:
    source = source_counts.withColumnRenamed("row_count", "source_rows")
    raw = raw_counts.withColumnRenamed("row_count", "raw_rows")
    return source.join(raw, "entity", "full_outer").select(
        "entity",
        F.coalesce("source_rows", F.lit(0)).cast("long").alias("source_rows"),
        F.coalesce("raw_rows", F.lit(0)).cast("long").alias("raw_rows"),
        (F.coalesce("raw_rows", F.lit(0)) - F.coalesce("source_rows", F.lit(0)))
        .cast("long")
        .alias("difference"),
    )


def caught_up(batches: DataFrame, snapshot_at: Column, margin_seconds: int) -> DataFrame:
    """Has a batch finished later than the snapshot plus a margin?"""
    limit = snapshot_at + F.make_dt_interval(secs=F.lit(margin_seconds))
    return batches.agg(
        F.coalesce(F.max("created_at") > limit, F.lit(False)).alias("caught_up")
    )


def grew(before: DataFrame, after: DataFrame) -> DataFrame:
    """Compare two one-value tables; nothing observed before counts as growth."""
    return after.select(F.col(after.columns[0]).alias("current_value")).select(
        before.scalar().alias("previous_value"),
        "current_value",
        F.coalesce(
            F.col("current_value") > before.scalar(), F.col("current_value").isNotNull()
        ).alias("grew"),
    )


# ------------------------------------------------------------------- runner


@dataclass(frozen=True)
class Check:
    """A named violation table and what to do when it is not empty.

    ``rule`` marks the plain column tests, which a report runs together.
    """

    name: str
    violations: DataFrame
    severity: str = ERROR
    rule: str | None = None
    table: DataFrame | None = None
    column: str | None = None


_UNIQUE, _NOT_NULL = "unique", "not_null"


def unique(name: str, table: DataFrame, column: str) -> Check:
    found = duplicates(table, column).select("value")
    return Check(f"unique_{name}_{column}", found, ERROR, _UNIQUE, table, column)


def not_null(name: str, table: DataFrame, column: str) -> Check:
    found = nulls(table, column).select(column)
    return Check(f"not_null_{name}_{column}", found, ERROR, _NOT_NULL, table, column)


def accepted(name: str, table: DataFrame, column: str, values: tuple[str, ...]) -> Check:
    return Check(
        f"accepted_values_{name}_{column}", unexpected_values(table, column, values).select("value")
    )


def relationship(
    name: str, child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> Check:
    missing = orphans(child, column, parent, parent_column)
    return Check(f"relationships_{name}_{column}", missing.select("value"), WARN)


def _repeated_values(checks: list[Check]) -> DataFrame:
    """All uniqueness tests in one aggregation keyed by (check, value)."""
    tagged = [
        check.table.select(
            F.lit(check.name).alias("check_name"), F.col(check.column).cast("string").alias("value")
        ).filter(F.col("value").isNotNull())
        for check in checks
    ]
    return (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("check_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .select("check_name")
    )


def _null_rows(checks: list[Check]) -> DataFrame:
    """One scan per table; a row comes out once for every column it leaves null."""
    by_table: dict[int, list[Check]] = {}
    for check in checks:
        by_table.setdefault(id(check.table), []).append(check)
    parts = []
    for group in by_table.values():
        failed = F.array_compact(
            F.array(*[F.when(F.col(c.column).isNull(), F.lit(c.name)) for c in group])
        )
        any_null = reduce(lambda a, b: a | b, [F.col(c.column).isNull() for c in group])
        parts.append(
            group[0].table.filter(any_null).select(F.explode(failed).alias("check_name"))
        )
    return reduce(DataFrame.unionByName, parts)


def report(checks: list[Check]) -> DataFrame:
    """Violation counts of all checks in one job.

    Every check contributes the name of each violation; counting names is one
    aggregation for the whole suite, started from a zero per check.
    """
    severity = {check.name: check.severity for check in checks}
    names = F.array(*[F.lit(name) for name in severity])
    spark = checks[0].violations.sparkSession
    parts = [
        spark.range(1).select(F.explode(names).alias("check_name"), F.lit(0).alias("n")),
    ]
    unique_tests = [c for c in checks if c.rule == _UNIQUE]
    null_tests = [c for c in checks if c.rule == _NOT_NULL]
    if unique_tests:
        parts.append(_repeated_values(unique_tests).withColumn("n", F.lit(1)))
    if null_tests:
        parts.append(_null_rows(null_tests).withColumn("n", F.lit(1)))
    parts += [
        c.violations.select(F.lit(c.name).alias("check_name"), F.lit(1).alias("n"))
        for c in checks
        if c.rule is None
    ]
    warn_only = [name for name, level in severity.items() if level == WARN]
    is_warning = F.col("check_name").isin(*warn_only) if warn_only else F.lit(False)
    counted = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("check_name")
        .agg(F.sum("n").cast("long").alias("violations"))
        .withColumn("severity", F.when(is_warning, WARN).otherwise(ERROR))
    )
    status = (
        F.when(F.col("violations") == 0, "pass")
        .when(F.col("severity") == WARN, "warn")
        .otherwise("fail")
    )
    return counted.withColumn("status", status).select(
        "check_name", "severity", "violations", "status"
    )


class QualityFailure(RuntimeError):
    """Raised when a check of severity error finds violations."""


def enforce(results: DataFrame) -> list:
    """Raise on failed errors, return the warnings. One small row per check."""
    rows = results.filter(F.col("status") != "pass").collect()
    failed = sorted(f"{r.check_name}={r.violations}" for r in rows if r.status == "fail")
    if failed:
        raise QualityFailure("data quality failed: " + ", ".join(failed))
    return [r for r in rows if r.status == "warn"]
