"""Tables derived from one input folder, written once per application.

The feed and the change topics are landed first, then the raw layer is
collapsed from the landed changes. Queries read these tables the way models
read a warehouse. All of it lies in the cluster's shared folder, so it outlives
lost executors and cuts lineage.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.catalog import mapping
from murmur.constants import ENTITIES
from murmur.functions.identity import with_packed, with_unpacked
from murmur.functions.times import utc_literal
from murmur.operators import changes, feed_events, keyed_state
from murmur.operators.keyed_state import PSEUDONYMS
from murmur.plans import daily_report, intermediate, staging
from murmur.schemas import (
    KEY_COLUMNS,
    PAYLOAD_COLUMNS,
    RAW_STATE,
    payload_type,
    placed,
    raw_schema,
)
from murmur.session import shared_folder, small_splits, use_utc
from murmur.sources import streams
from murmur.sources.tables import SMALL_GROUPS, TableStore, together

_OPEN: dict[tuple[str, str], "Workspace"] = {}


def open_workspace(spark: SparkSession, sf_dir: str) -> "Workspace":
    use_utc(spark)
    small_splits(spark)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _OPEN:
        _OPEN[key] = Workspace(spark, sf_dir.rstrip("/"))
    return _OPEN[key]


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.settings = mapping.SETTINGS
        self._landed = False
        self._chunk_files = mapping.CHUNK_FILES
        self._history_built = False
        self.fed: TableStore | None = None
        self.drained: TableStore | None = None
        self.reported: TableStore | None = None
        self.store = TableStore(
            spark, f"{shared_folder(spark)}/murmur-{spark.sparkContext.applicationId}-{uuid4().hex}"
        )

    def _once(self, name: str, build: Callable[[], None]) -> None:
        if not self.store.exists(name):
            build()

    def scratch_store(self, purpose: str) -> TableStore:
        """A fresh place for one streaming run and its checkpoint."""
        return TableStore(self.spark, f"{self.store.root}/{purpose}-{uuid4().hex}")

    # ------------------------------------------------------------- landing

    def feed(self) -> DataFrame:
        self._once("feed", lambda: self.store.write("feed", mapping.feed_lines(self.spark, self.sf_dir)))
        return self.store.read("feed")

    def message_folder(self) -> str:
        """Change messages in arrival order: one chunk of files after the other.

        A stream over the folder sees the chunks as successive micro-batches.
        """
        folder = self.store.location("messages/landed")
        if not self._landed:
            scanned = {
                "document-features": mapping.document_features, "user-spans": mapping.user_spans
            }
            documents, spans = together(
                self.spark,
                {
                    label: lambda label=label, scan=scan: self.store.scratch(
                        scan(self.spark, self.sf_dir), label
                    )
                    for label, scan in scanned.items()
                },
            ).values()
            rows, last = together(
                self.spark,
                {
                    "rows": lambda: self.store.scratch(
                        mapping.change_rows(self.spark, self.sf_dir, documents, spans), "change-rows"
                    ),
                    "last": lambda: mapping.last_offset(self.spark, self.sf_dir, documents),
                },
            ).values()
            size = (last or 0) // mapping.CHUNKS + 1
            self._chunk_files *= 1 + size // (mapping.CHUNK_FILES * mapping.CHUNK_FILE_OFFSETS)
            for chunk in range(mapping.CHUNKS):
                messages = mapping.change_messages(
                    self.spark, self.sf_dir, documents, spans,
                    chunk * size, (chunk + 1) * size, self._chunk_files, rows,
                )
                # A landing that broke off starts over.
                messages.write.mode("append" if chunk else "overwrite").options(
                    **SMALL_GROUPS
                ).parquet(folder)
            self._landed = True
        return folder

    def messages(self) -> DataFrame:
        return streams.landed_changes(self.spark, self.message_folder())

    def message_stream(self) -> DataFrame:
        folder = self.message_folder()
        return streams.file_changes(self.spark, folder, self._chunk_files)

    # ----------------------------------------------------------- feed side

    def parsed_feed(self) -> DataFrame:
        return feed_events.parse_events(self.feed())

    def entity_events(self, rate: float | None = None) -> DataFrame:
        chosen = self.settings.sampling_rate if rate is None else rate
        return feed_events.entity_events(self.parsed_feed(), self.settings.salt, chosen)

    # ------------------------------------------------------------ CDC side

    def parsed_changes(self) -> DataFrame:
        return changes.parse_changes(self.messages(), self.settings)

    def validated(self) -> DataFrame:
        return changes.validate_changes(self.parsed_changes(), self.settings, mapping.AS_OF_MS)

    def valid(self) -> DataFrame:
        return changes.valid_changes(self.validated())

    def change_log(self) -> DataFrame:
        loaded = F.timestamp_millis("source_ts_ms").cast("timestamp_ntz")
        return keyed_state.change_log(self.valid(), loaded)

    def logged_changes(self) -> DataFrame:
        """The append-only change log: valid changes, typed, in arrival order."""

        def build() -> None:
            log = self.change_log().sortWithinPartitions("entity", "ingested_at")
            self.store.write("change_log", log, ("entity",))

        self._once("change_log", build)
        return self.store.read("change_log")

    def ingested_events(self) -> DataFrame:
        """Pseudonymised feed events of all users, as they come: a task's rows are not sorted."""

        def build() -> None:
            events = feed_events.writable_events(self.entity_events(1.0))
            self.store.write("ingested_events", events)

        self._once("ingested_events", build)
        return self.store.read("ingested_events")

    # ----------------------------------------------------------- raw layer

    def _build_raw(self) -> None:
        """One set of files per entity and day, times clustered for page skipping."""
        state = keyed_state.collapse_changes(self.logged_changes())
        rows = with_packed(state.withColumn("day", F.to_date("occurred_at")), *PSEUDONYMS)
        rows = rows.hint("rebalance", F.col("entity"), F.col("day")).sortWithinPartitions(
            "entity", "day", "occurred_at"
        )
        self.store.write("raw", with_unpacked(rows, *PSEUDONYMS), ("entity", "day"))

    def raw(self, entity: str) -> DataFrame:
        """Rows of one entity; filters on ``day`` prune folders."""
        self._once("raw", self._build_raw)
        schema, within = placed(RAW_STATE, "entity", "day"), f"entity={entity}"
        if not self.store.holds("raw", within):
            return self.spark.createDataFrame([], schema).select(*raw_schema(entity).fieldNames(), "day")
        rows = self.store.read("raw", schema, within=within)
        return rows.select(*raw_schema(entity).fieldNames(), "day")

    def raw_tables(self) -> dict[str, DataFrame]:
        return {entity: self.raw(entity) for entity in ENTITIES}

    def staged(self) -> dict[str, DataFrame]:
        return staging.stage_all(self.raw_tables())

    def summary(self) -> DataFrame:
        return intermediate.user_activity_summary(self.staged(), self.settings)

    # ------------------------------------------------------------- history

    def _build_history(self) -> None:
        """Three snapshot runs, each on the state its changes had reached by then.

        State is carried from run to run as a written table, and a run only reads the changes
        that arrived since the previous one. Each run replaces the open part of the history.
        Of the values only those that a summary reads are carried.
        """
        log = self.logged_changes()
        unread = [c for c in PAYLOAD_COLUMNS if c not in (*KEY_COLUMNS, *intermediate.READ_COLUMNS)]
        log = log.withColumns({c: F.lit(None).cast(payload_type(c)) for c in unread})
        book = daily_report.ledger(self.store)
        since = None
        for run in mapping.RUNS:
            arrived = F.col("ingested_at") < utc_literal(run)
            if since is not None:
                arrived = arrived & (F.col("ingested_at") >= utc_literal(since))
            fresh = log.filter(arrived)
            if since is None:
                state = keyed_state.collapse_changes(fresh)
            else:
                state = keyed_state.apply_changes(self.store.read("history_state", RAW_STATE), fresh)
            self.store.write("history_state", state, ("entity",))
            state = self.store.read("history_state", RAW_STATE)
            staged = {
                entity: staging.staged(keyed_state.entity_state(state, entity), entity)
                for entity in ENTITIES
            }
            current = intermediate.user_activity_summary(staged, self.settings)
            base = book.snapshot()
            moved = daily_report.snapshot_changes(book, base, current, run)
            book.commit(base, {daily_report.SNAPSHOT: moved})
            since = run
        self._history_built = True

    def history(self) -> DataFrame:
        if not self._history_built:
            self._build_history()
        return daily_report.read(self.store, daily_report.SNAPSHOT)
