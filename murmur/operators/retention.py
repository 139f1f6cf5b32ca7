"""Age limits on operational tables: counted, filtered, and applied by dropping parts."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.functions.times import utc_literal
from murmur.sources.ledger import Ledger, Part, Snapshot
from murmur.sources.tables import together


def _cutoff(as_of: Column, days: int) -> Column:
    return as_of - F.make_dt_interval(days=F.lit(days))


def keep_recent(table: DataFrame, time_column: str, as_of: Column, days: int) -> DataFrame:
    """Rows younger than the limit; rows without a time are never deleted."""
    stamp = F.col(time_column)
    return table.filter(stamp.isNull() | (stamp >= _cutoff(as_of, days)))


def retention_counts(
    tables: dict[str, tuple[DataFrame, str]], as_of: Column, days: int
) -> DataFrame:
    """Kept and deleted rows per table, all tables in one job."""
    cutoff = _cutoff(as_of, days)
    parts = []
    for name, (table, time_column) in tables.items():
        is_old = F.coalesce(F.col(time_column) < cutoff, F.lit(False))
        parts.append(
            table.agg(
                F.count_if(~is_old).alias("kept_rows"), F.count_if(is_old).alias("deleted_rows")
            ).select(F.lit(name).alias("table_name"), "kept_rows", "deleted_rows")
        )
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class Retained:
    """A logical table under the age limit: where its parts lie and how its rows read.

    ``stored_time`` is the time in the stored rows, ``time`` the one in the rows that ``rows``
    makes of them.
    """

    name: str
    table: str
    keep: Callable[[Part], bool]
    stored_time: Column
    time: str
    rows: Callable[[DataFrame], DataFrame] = lambda stored: stored


def apply_retention(
    book: Ledger, tables: list[Retained], as_of: str, days: int
) -> tuple[Snapshot, DataFrame]:
    """Drop what is older than the limit from all tables by one commit; deleted rows per table.

    Whole days leave the manifest and no file is read for it. Only parts of the day that the
    limit falls into can be rewritten. The counts read the parts that went away, which stay on
    storage until the next vacuum but one.
    """
    cutoff = datetime.fromisoformat(as_of) - timedelta(days=days)
    edge, limit = cutoff.strftime("%Y-%m-%d"), utc_literal(cutoff.isoformat(sep=" "))
    before = book.snapshot()
    gone: dict[str, dict[Part, tuple[str, ...]]] = {}
    # Each table looks at its edge day by jobs of its own and has its files listed: side by side.
    dropped = together(
        book.spark,
        {
            held.name: lambda held=held: book.drop_before(
                before, held.table, held.keep, limit, edge, held.stored_time
            )
            for held in tables
        },
    )
    for held in tables:
        gone.setdefault(held.table, {}).update(dropped[held.name])
    after = book.commit(before, gone)
    lost = together(
        book.spark,
        {
            held.name: lambda held=held: book.read(
                before, held.table, lambda p: held.keep(p) and p in gone[held.table]
            )
            for held in tables
        },
    )
    parts = []
    for held in tables:
        old = held.rows(lost[held.name]).filter(F.col(held.time) < limit)
        parts.append(
            old.agg(F.count(F.lit(1)).alias("deleted_rows")).select(
                F.lit(held.name).alias("table_name"), "deleted_rows"
            )
        )
    return after, reduce(DataFrame.unionByName, parts)


def survivors(book: Ledger, snapshot: Snapshot, tables: list[Retained]) -> Mapping[str, DataFrame]:
    """Rows of each retained table in a snapshot."""
    return together(
        book.spark,
        {t.name: lambda t=t: t.rows(book.read(snapshot, t.table, t.keep)) for t in tables},
    )
