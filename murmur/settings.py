"""Tunable parameters with the defaults of the reference pipeline."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    salt: str
    sampling_rate: float = 0.10
    topic_prefix: str = "social.public."

    # row validation
    future_tolerance_ms: int = 5 * 60 * 1000
    max_age_ms: int = 30 * 24 * 60 * 60 * 1000
    strict_keys: bool = False
    drop_tombstones: bool = False

    # streaming
    trigger_interval: str = "5 seconds"
    max_offsets_per_trigger: int = 50_000
    # How long a message may be delivered again and still be recognised; None: it is not looked
    # for, which only matters to the counts, since state is keyed.
    redelivery_window: str | None = None
    # Files of a landed feed in one batch.
    files_per_trigger: int = 4
    # Batches between two folds into the partitioned tables.
    fold_every: int = 720
    # Parts of one entity and day, by hash of the user: a fold rewrites those with a changed key.
    state_buckets: int = 64
    # Runs that a day of counts gathers before they are merged.
    most_runs: int = 8

    # models
    creator_min_posts: int = 5
    engager_min_actions: int = 5
    follows_per_hour_limit: float = 30.0
    likes_per_hour_limit: float = 60.0
    incremental_lookback_hours: int = 2

    # operations
    retention_days: int = 7
    freshness_minutes: int = 1
    catch_up_margin_seconds: int = 15
    catch_up_poll_seconds: int = 5
    catch_up_limit_seconds: int = 300

    @property
    def watermark_delay(self) -> str:
        """No accepted change is late: the newest may be ahead, the oldest is ``max_age_ms``
        behind, and buckets start up to a minute before their rows."""
        return f"{(self.future_tolerance_ms + self.max_age_ms) // 1000 + 60} seconds"
