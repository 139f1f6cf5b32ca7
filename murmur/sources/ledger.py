"""Tables made of parts, and commits that move several of them at once.

A part is one combination of partition values, such as an entity and a day. Its rows lie in
one or more runs: folders that Spark wrote and that never change. A commit is one small
manifest file naming the runs of every part of every table. It is created only if no file of
its number exists, so of two writers that started from the same state one is refused, and a
reader sees all tables of a commit or none of it.

Writing a few parts leaves the files of all others alone, and dropping a part touches no file.
The driver handles part names, never rows; their number is dates times buckets.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur.functions.identity import with_packed, with_unpacked
from murmur.sources.tables import COMPRESSION, CommitRefused, TableStore

Part = tuple[str | None, ...]
Runs = tuple[str, ...]
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_RUN = "run"


@dataclass(frozen=True)
class Snapshot:
    """What one commit made visible."""

    number: int = -1
    tables: Mapping[str, Mapping[Part, Runs]] = field(default_factory=dict)
    notes: Mapping[str, object] = field(default_factory=dict)
    schemas: Mapping[str, T.StructType] = field(default_factory=dict)

    def parts(self, table: str) -> Mapping[Part, Runs]:
        return self.tables.get(table, {})

    def changed(
        self,
        changes: Mapping[str, Mapping[Part, Runs]],
        notes: Mapping[str, object],
        schemas: Mapping[str, T.StructType],
    ) -> "Snapshot":
        """The next snapshot: some parts with other runs, parts without runs gone."""
        tables = {name: dict(parts) for name, parts in self.tables.items()}
        for name, parts in changes.items():
            held = tables.setdefault(name, {})
            for part, runs in parts.items():
                if runs:
                    held[part] = tuple(runs)
                else:
                    held.pop(part, None)
        return Snapshot(
            self.number + 1, tables, {**self.notes, **notes}, {**self.schemas, **schemas}
        )


@dataclass(frozen=True)
class Layout:
    """Partition columns of a table, in order; its whole schema, or that of the rows written.

    ``digests`` are columns that mostly hold pseudonyms, which go packed through a shuffle.
    """

    partition_by: tuple[str, ...] = ()
    schema: T.StructType | None = None
    digests: tuple[str, ...] = ("user_id_hash", "target_user_id_hash")

    def place(self, column: str) -> int:
        return self.partition_by.index(column)


class Ledger:
    def __init__(self, store: TableStore, layouts: Mapping[str, Layout], line: str = "_commits"):
        self.store = store
        self.spark = store.spark
        self.layouts = dict(layouts)
        self._line = line
        self._written: dict[str, T.StructType] = {}

    def fork(self, line: str) -> "Ledger":
        """A line of commits of its own over the same runs, beginning with the newest commit."""
        other = Ledger(self.store, self.layouts, line)
        base = self.snapshot()
        other.commit(Snapshot(schemas=base.schemas), base.tables, base.notes)
        return other

    def _root(self, table: str) -> str:
        return self.store.location(f"tables/{table}")

    # ------------------------------------------------------------ manifests

    def _manifest(self, number: int) -> str:
        return f"{self.store.location(self._line)}/{number:09d}.json"

    def numbers(self) -> list[int]:
        pattern, fs = self.store._path(f"{self.store.location(self._line)}/*.json")
        found = fs.globStatus(pattern) or []
        return sorted(int(s.getPath().getName().split(".")[0]) for s in found)

    def snapshot(self, number: int | None = None) -> Snapshot:
        known = self.numbers()
        if not known:
            return Snapshot()
        chosen = known[-1] if number is None else number
        held = json.loads(self.store.read_text(self._manifest(chosen)))
        tables = {
            name: {tuple(part): tuple(runs) for part, runs in parts}
            for name, parts in held["tables"].items()
        }
        schemas = {name: T.StructType.fromJson(kind) for name, kind in held["schemas"].items()}
        return Snapshot(chosen, tables, held["notes"], schemas)

    def preview(self, base: Snapshot, changes: Mapping[str, Mapping[Part, Runs]]) -> Snapshot:
        """What a commit of these changes would show."""
        return base.changed(changes, {}, self._written)

    def commit(
        self,
        base: Snapshot,
        changes: Mapping[str, Mapping[Part, Runs]],
        notes: Mapping[str, object] | None = None,
    ) -> Snapshot:
        """``base`` with the runs of some parts replaced; a part without runs goes away."""
        after = base.changed(changes, notes or {}, self._written)
        text = json.dumps(
            {
                "tables": {
                    name: sorted(([list(p), list(r)] for p, r in parts.items()), key=str)
                    for name, parts in after.tables.items()
                },
                "notes": dict(after.notes),
                "schemas": {name: kind.jsonValue() for name, kind in after.schemas.items()},
            }
        )
        if not self.store.create_text(self._manifest(after.number), text):
            raise CommitRefused(f"commit {after.number} of {self.store.root} was taken by another writer")
        return after

    # ----------------------------------------------------------------- rows

    def write(self, table: str, rows: DataFrame) -> dict[Part, Runs]:
        """New runs for the parts that have rows; nothing is visible before a commit names them."""
        layout, run = self.layouts[table], uuid4().hex
        # A folder of its own, so that writers that overlap do not clean up each other's files.
        target = f"{self._root(table)}/{_RUN}={run}"
        rows = rows.select(*layout.schema.fieldNames()) if layout.schema else rows
        self._written[table] = rows.schema
        if not layout.partition_by:
            rows.write.option("compression", COMPRESSION).parquet(target)
            return {(): (run,)}
        # Rows of a part come together, so that it gets few files; large parts are split again.
        placed = with_packed(rows, *layout.digests).hint(
            "rebalance", *[F.col(c) for c in layout.partition_by]
        )
        placed = with_unpacked(placed, *layout.digests)
        writer = placed.write.option("compression", COMPRESSION)
        writer.partitionBy(*layout.partition_by).parquet(target)
        pattern = "/".join(f"{c}=*" for c in layout.partition_by)
        path, fs = self.store._path(f"{target}/{pattern}")
        found: dict[Part, Runs] = {}
        for status in fs.globStatus(path) or []:
            names = status.getPath().toUri().getPath().split("/")[-len(layout.partition_by) :]
            values = [unquote(name.split("=", 1)[1]) for name in names]
            found[tuple(None if v == _NO_VALUE else v for v in values)] = (run,)
        return found

    def read(
        self,
        snapshot: Snapshot,
        table: str,
        keep: Callable[[Part], bool] = lambda part: True,
    ) -> DataFrame:
        """Rows of the chosen parts with their partition columns, by which filters prune folders."""
        layout = self.layouts[table]
        whole = layout.schema or snapshot.schemas.get(table)
        if whole is None:
            raise FileNotFoundError(f"no commit of {self.store.root} has a table {table}")
        root = self._root(table)
        folders = [
            f"{root}/{self._folder(layout, part, run)}"
            for part, runs in snapshot.parts(table).items()
            if keep(part)
            for run in runs
        ]
        if not folders:
            return self.spark.createDataFrame([], whole)
        reader = self.spark.read.schema(whole).option("basePath", root)
        return reader.parquet(*folders).select(*whole.fieldNames())

    @staticmethod
    def _folder(layout: Layout, part: Part, run: str) -> str:
        places = [f"{c}={_NO_VALUE if v is None else v}" for c, v in zip(layout.partition_by, part)]
        return "/".join([f"{_RUN}={run}", *places])

    def parts_of(self, table: str, rows: DataFrame) -> set[Part]:
        """The parts that rows belong to: as many values as there are parts."""
        columns = [F.col(c).cast("string") for c in self.layouts[table].partition_by]
        return {tuple(row) for row in rows.select(*columns).distinct().collect()}

    # ------------------------------------------------------------ whole changes

    def replace(self, table: str, rows: DataFrame, touched: Iterable[Part]) -> dict[Part, Runs]:
        """Runs of the touched parts after their content became ``rows``."""
        written = self.write(table, rows)
        stray = set(written) - set(touched)
        if stray:
            raise ValueError(f"{table}: rows outside the touched parts {sorted(stray, key=str)[:3]}")
        return {part: written.get(part, ()) for part in touched}

    def replace_all(self, snapshot: Snapshot, table: str, rows: DataFrame) -> dict[Part, Runs]:
        """Runs of all parts after the whole table became ``rows``."""
        return {part: () for part in snapshot.parts(table)} | self.write(table, rows)

    def append(self, snapshot: Snapshot, table: str, rows: DataFrame) -> dict[Part, Runs]:
        """Runs of the parts that get more rows."""
        held = snapshot.parts(table)
        return {part: (*held.get(part, ()), *runs) for part, runs in self.write(table, rows).items()}

    def upsert(
        self,
        snapshot: Snapshot,
        table: str,
        arrived: DataFrame,
        keys: list[str],
        merge: Callable[[DataFrame, DataFrame], DataFrame],
        home: tuple[str, ...] = (),
        by_key: bool = False,
    ) -> dict[Part, Runs]:
        """Rows of ``arrived`` merged into a table that has one row per key, touched parts only.

        ``arrived`` is a written table with the partition columns of its rows. A key always lies
        in one value of the columns ``home``, so parts elsewhere are not searched for it.
        ``merge`` takes the held rows of the arrived keys and the arrived rows, and gives the
        new rows, each in a part that one of those lies in. With ``by_key``, it gives held rows
        of other keys back as they are, so it takes the touched parts whole and nothing is joined
        to them. No key is searched for where every part is reached anyway.
        """
        places = [self.layouts[table].place(c) for c in home]
        reached = self.parts_of(table, arrived)
        homes = {tuple(part[i] for i in places) for part in reached}
        same = reduce(
            lambda a, b: a & b, [F.col(f"held.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys]
        )
        names = arrived.select(*keys).alias("new")
        around = {p for p in snapshot.parts(table) if tuple(p[i] for i in places) in homes}

        def known() -> DataFrame:
            """Held rows of the arrived keys: listing their files is left where it can be."""
            near = self.read(snapshot, table, around.__contains__)
            return near.alias("held").join(names, same, "left_semi")

        touched = reached | (set() if around <= reached else self.parts_of(table, known()))
        held = self.read(snapshot, table, lambda part: part in touched).alias("held")
        if by_key:
            return self.replace(table, merge(held, arrived), touched)
        old = known()
        kept = held.join(names, same, "left_anti")
        fresh = merge(old, arrived).select(*kept.columns)
        return self.replace(table, kept.unionByName(fresh), touched)

    # -------------------------------------------------------------- lifecycle

    def drop_before(
        self,
        snapshot: Snapshot,
        table: str,
        keep: Callable[[Part], bool],
        limit: Column,
        edge_day: str,
        time: Column,
    ) -> dict[Part, Runs]:
        """Of the parts that ``keep`` chooses, those of days before ``edge_day`` go away.

        Of that day itself, rows with a time before ``limit``: parts are rewritten only if they
        have any. Parts without a day stay.
        """
        at = self.layouts[table].place("day")
        chosen = [part for part in snapshot.parts(table) if keep(part) and part[at] is not None]
        gone: dict[Part, Runs] = {part: () for part in chosen if part[at] < edge_day}
        edge = {part for part in chosen if part[at] == edge_day}
        old = F.coalesce(time < limit, F.lit(False))
        aged = self.parts_of(table, self.read(snapshot, table, edge.__contains__).filter(old)) if edge else set()
        if aged:
            kept = self.read(snapshot, table, aged.__contains__).filter(~old)
            gone |= self.replace(table, kept, aged)
        return gone

    def vacuum(self, keep: int = 2) -> int:
        """Delete the manifests behind the newest ``keep`` and every run none of those names.

        Runs of a commit that is being written are not known yet: only the writer calls this.
        """
        numbers = self.numbers()
        named = {
            (table, part, run)
            for number in numbers[-keep:]
            for table, parts in self.snapshot(number).tables.items()
            for part, runs in parts.items()
            for run in runs
        }
        dropped = 0
        for number in numbers[:-keep]:
            for table, parts in self.snapshot(number).tables.items():
                for part, runs in parts.items():
                    for run in runs:
                        if (table, part, run) not in named:
                            named.add((table, part, run))
                            folder = self._folder(self.layouts[table], part, run)
                            dropped += self.store.delete(f"{self._root(table)}/{folder}")
            self.store.delete(self._manifest(number))
        return dropped
