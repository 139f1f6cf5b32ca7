"""All tables of the platform with their layer and what may happen to them.

Reset, retention and vacuum are derived from this one list. A table is held by the feed job,
by the change job or by the daily run; the first two keep parts in a ledger, where several
tables can share one, told apart by a partition value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.constants import ENTITIES
from murmur.functions.times import millis_to_utc
from murmur.operators import minute_rollups
from murmur.operators.retention import Retained
from murmur.sources.ledger import Ledger, Part, Runs
from murmur.streaming import change_stream, feed_stream

FEED, CHANGES, DAILY = "feed", "changes", "daily"


@dataclass(frozen=True)
class TableInfo:
    """``stored`` is the table of the holder's ledger or store, ``value`` tells it from others there."""

    name: str
    holder: str
    stored: str
    value: str | None = None
    stored_time: Column | None = None
    time: str | None = None
    reset: bool = True
    rows: Callable[[DataFrame], DataFrame] = lambda stored: stored

    @property
    def layer(self) -> str:
        return self.name.split(".")[0]

    def holds(self, part: Part) -> bool:
        """Entity and metric are the first partition column of the tables that share one."""
        return self.value is None or part[0] == self.value

    def retained(self) -> Retained:
        return Retained(self.name, self.stored, self.holds, self.stored_time, self.time, self.rows)


def _entity(layer: str, holder: str, stored: str, entity: str) -> TableInfo:
    aged = entity != "users"
    return TableInfo(
        f"{layer}.{entity}", holder, stored, entity,
        F.col("occurred_at") if aged else None, "occurred_at" if aged else None,
    )


def _rollup(name: str, metric: str) -> TableInfo:
    return TableInfo(
        f"realtime.{name}_by_minute", CHANGES, change_stream.ROLLUPS, metric,
        millis_to_utc(F.col("minute_ms")), "minute_bucket",
        rows=lambda stored: minute_rollups.merged_rollup(stored, metric),
    )


def all_tables() -> list[TableInfo]:
    """The order is that of the layers: source, raw, realtime, checks, history, marts."""
    source = [
        TableInfo("source.users", FEED, feed_stream.SPANS),
        *[_entity("source", FEED, feed_stream.CURRENT, e) for e in ENTITIES if e != "users"],
    ]
    raw = [_entity("raw", CHANGES, change_stream.STATE, e) for e in ENTITIES]
    realtime = [
        _rollup("event_counts", minute_rollups.EVENTS),
        _rollup("active_users", minute_rollups.USERS),
        _rollup("hashtag_counts", minute_rollups.TAGS),
        _rollup("language_counts", minute_rollups.LANGUAGES),
    ]
    checked = [
        TableInfo(f"dq.{stored}", CHANGES, stored, None, F.col(stamp), stamp)
        for stored, stamp in (
            (change_stream.QUARANTINE, "quarantined_at"), (change_stream.BATCHES, "created_at")
        )
    ]
    marts = [TableInfo("snapshots.dim_user_snapshot", DAILY, "dim_user_snapshot")]
    marts += [TableInfo(f"marts.{name}", DAILY, name) for name in MODELS]
    # Calendar, published reports and run log outlive a reset.
    kept = [
        TableInfo(f"marts.{name}", DAILY, name, reset=False)
        for name in ("dim_date", "mart_daily_summary", "pipeline_runs")
    ]
    return [*source, *raw, *realtime, *checked, *marts, *kept]


#: The marts that the daily run builds from data.
MODELS = (
    "dim_user", "dim_hashtag", "dim_language", "fct_posts", "fct_interactions",
    "fct_user_daily_activity", "mart_engagement", "mart_trending_hashtags", "mart_anomalous_accounts",
)


def retained_tables(holder: str) -> list[Retained]:
    """Tables of a holder that the age limit applies to."""
    return [t.retained() for t in all_tables() if t.holder == holder and t.time is not None]


def reset(book: Ledger, holder: str) -> list[str]:
    """Empty the tables of a ledger that a reset covers, by one commit; names of those it had.

    Schemas and notes stay, so readers find empty tables and jobs go on behind the last batch.
    """
    snapshot = book.snapshot()
    tables = [t for t in all_tables() if t.holder == holder and t.reset]
    gone: dict[str, dict[Part, Runs]] = {}
    found = []
    for info in tables:
        parts = {part: () for part in snapshot.parts(info.stored) if info.holds(part)}
        if parts:
            found.append(info.name)
            gone.setdefault(info.stored, {}).update(parts)
    book.commit(snapshot, gone)
    return found
