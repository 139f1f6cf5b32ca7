"""Structure repair of conversations: cheapest edits to ``(system)? (user assistant)+``.

A dynamic program runs over the rows of a conversation. Its states say what the repaired part
ends with; per state it keeps the cheapest cost and the edits that lead there, as a node of
``EditTrie``, so all states and rows share their prefixes. Of equally cheap edits the
least in ASCII order stays; since every sequence ends with the letter of the same row, none is
the beginning of another, and the order of two prefixes is the order of all that follows.
For the same reason a conversation can be cut into blocks of rows: a block tells, for every
state before and after it, the cost and how its edits rank, and a short scan joins the blocks.

Rows are ranked, marked and solved in blocks, so a conversation of any length is spread over
tasks; only its audit (one letter an edit, a value of the result) and the running SHA-256 of the
repaired texts, which cannot be split, belong to one task, which streams the texts.

Null roles and texts read as one blank. A null conv_id is a conversation of its own. Null turns
come first; rows that tie are ordered by role, then by digest of role and text. Empty texts are
blank. Conversations without rows give zeros, an empty audit and the digest of an empty text.
An empty table gives no rows. Other columns of the input never matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import stored
from murmur.llm.edit_trie import ROOT, EditTrie
from murmur.llm.ranks import ranked

#: The blanks of a text and what may end a sentence.
BLANKS, SENTENCE_ENDS = " \t\n\x0b\x0c\r", ".!?"
BLOCK_ROWS = 2_048
START, SYSTEM, USER, ASSISTANT = range(4)
_STATES = (START, SYSTEM, USER, ASSISTANT)
_LEGAL = ("su", "ua", "au")
#: What edits cost.
DELETE_COST, REROLE_COST, INSERT_COST, TRUNCATED_COST = 3, 2, 2, 1
#: Edits inserted before a row: letters and the state they lead to.
_INSERTS = {
    START: (("", START), ("I", USER), ("II", ASSISTANT)),
    SYSTEM: (("", SYSTEM), ("I", USER), ("II", ASSISTANT)),
    USER: (("", USER), ("I", ASSISTANT)),
    ASSISTANT: (("", ASSISTANT), ("I", USER)),
}
#: Inserts that complete a conversation.
_TAIL = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}


def _spoken(state: int) -> str:
    """Whose turn it is."""
    return "assistant" if state == USER else "user"


def _after_keep(state: int, initial: str) -> int | None:
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == _spoken(state)[0]:
        return USER if initial == "u" else ASSISTANT
    return None


# ------------------------------------------------------------ one block of rows


def solve_block(
    rows: list[tuple[str, bool, bool]], entries: Iterable[int], trie: type[EditTrie] = EditTrie
) -> dict[int, dict[int, tuple[int, int, str]]]:
    """Per entry and exit state: cost, rank among the exits of this entry, edits.

    A row is (initial of its role, must go, is truncated).
    """
    return {entry: _solve(rows, entry, trie()) for entry in entries}


def _solve(rows, entry: int, nodes: EditTrie) -> dict[int, tuple[int, int, str]]:
    best = {entry: (0, ROOT)}
    for initial, must_go, truncated in rows:
        found: dict[int, tuple[int, int]] = {}

        def offer(state: int, cost: int, node: int, letters: str, found=found) -> None:
            held = found.get(state)
            if held is None or cost < held[0]:
                found[state] = (cost, nodes.extend(node, letters))
            elif cost == held[0]:
                other = nodes.extend(node, letters)
                if nodes.compare(other, held[1]) < 0:
                    found[state] = (cost, other)

        extra = TRUNCATED_COST if truncated else 0
        for state, (cost, node) in best.items():
            for inserted, at in _INSERTS[state]:
                spent = cost + INSERT_COST * len(inserted)
                offer(at, spent + DELETE_COST, node, inserted + "D")
                if must_go:
                    continue
                kept = _after_keep(at, initial)
                if kept is not None:
                    offer(kept, spent + extra, node, inserted + "K")
                turned = ASSISTANT if at == USER else USER
                offer(turned, spent + REROLE_COST + extra, node, inserted + "R")
        best = found
    states = list(best)
    ranks = nodes.ranks([best[s][1] for s in states])
    return {s: (best[s][0], rank, nodes.text(best[s][1])) for s, rank in zip(states, ranks)}


# ---------------------------------------------------------- a chain of blocks


@dataclass
class Chain:
    """Scan over the blocks of one conversation; keeps four small numbers a block."""

    costs: dict[int, int] = field(default_factory=lambda: {START: 0})
    order: dict[int, int] = field(default_factory=lambda: {START: 0})
    back: list[dict[int, int]] = field(default_factory=list)
    illegal: int = 0
    last: str | None = None

    def add(self, exits: dict[int, dict[int, tuple[int, int]]], illegal: int, first: str, last: str):
        self.illegal += illegal
        if self.last is not None and self.last + first not in _LEGAL:
            self.illegal += 1
        self.last = last
        best: dict[int, tuple[int, int, int, int]] = {}
        for entry, cost in self.costs.items():
            for state, (more, rank) in exits[entry].items():
                offer = (cost + more, self.order[entry], rank, entry)
                if state not in best or offer < best[state]:
                    best[state] = offer
        self.costs = {s: offer[0] for s, offer in best.items()}
        placed = sorted(best, key=lambda s: best[s][1:3])
        self.order = {s: i for i, s in enumerate(placed)}
        self.back.append({s: offer[3] for s, offer in best.items()})

    def finish(self) -> tuple[int, str, list[tuple[int, int]]]:
        """Cost, closing inserts, and entry and exit state of every block."""
        end = min(
            self.costs,
            key=lambda s: (self.costs[s] + INSERT_COST * len(_TAIL[s]), self.order[s]),
        )
        cost, state, path = self.costs[end] + INSERT_COST * len(_TAIL[end]), end, []
        for back in reversed(self.back):
            path.append((back[state], state))
            state = back[state]
        return cost, _TAIL[end], path[::-1]


# ------------------------------------------------------------------ Spark side


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as a careless export leaves them: dropped, emptied, cut, repeated, under a wrong role."""

    def shown(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        shown("role").alias("role"),
        shown("text").alias("text"),
        fate.alias("fate"),
    ).where("fate != 0")
    text = F.when(F.col("fate") == 1, "").when(
        F.col("fate") == 2, F.translate("text", SENTENCE_ENDS, "")
    )
    copies = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def _plain(rows: DataFrame) -> DataFrame:
    blank = F.lit(" ")
    role, text = F.coalesce(F.col("role"), blank), F.coalesce(F.col("text"), blank)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"))


def _digest() -> Column:
    return F.sha2(F.concat(F.octet_length("role"), F.lit(":"), "role", "text"), 256)


def _marked(rows: DataFrame) -> DataFrame:
    """Rows in order with the first fault of each; texts stay behind."""
    stripped = F.rtrim(F.col("text"), F.lit(BLANKS))
    light = rows.select(
        "conv_id",
        "turn",
        "role",
        _digest().alias("digest"),
        (stripped == "").alias("blank"),
        (~F.substring(stripped, -1, 1).isin(*SENTENCE_ENDS)).alias("cut"),
    )
    placed = stored(
        ranked(light, "conv_id", ["turn", "role", "digest"], "turns").select(
            "conv_id", "group_id", "group_rows", "place", "turn", F.substring("role", 1, 1).alias("initial"),
            "digest", "blank", "cut",
        ),
        "turns-placed",
    )
    # Both sides of the join have one row per place: equal rows, however many, cannot skew it.
    firsts = placed.groupBy("group_id", "digest").agg(F.min("place").alias("place")).select(
        "group_id", "place", F.lit(True).alias("first")
    )
    blank, first = F.col("blank"), F.col("first").isNotNull()
    return placed.join(firsts, ["group_id", "place"], "left").select(
        "conv_id",
        "group_id",
        "place",
        "turn",
        "initial",
        "blank",
        (~blank & ~first).alias("duplicate"),
        (~blank & first & F.col("cut")).alias("truncated"),
    )


_BLOCK = (
    "group_id long, block long, first string, last string, illegal long, "
    "exits array<struct<entry:int,state:int,cost:long,rank:int,edits:string>>"
)
_EXITS = pa.list_(
    pa.struct(
        [("entry", pa.int32()), ("state", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32()),
         ("edits", pa.string())]
    )
)


def _block_row(group: int, block: int, rows: list) -> tuple:
    initials = [row[0] for row in rows]
    illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
    # The first block of a conversation can only be entered at its start.
    solved = solve_block(rows, _STATES if block else (START,))
    exits = [
        {"entry": e, "state": s, "cost": cost, "rank": rank, "edits": edits}
        for e, states in solved.items()
        for s, (cost, rank, edits) in states.items()
    ]
    return group, block, initials[0], initials[-1], illegal, exits


def _solve_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = None, []
    for batch in batches:
        done = []
        columns = [column.to_pylist() for column in batch.columns]
        for group, block, initial, must_go, truncated in zip(*columns):
            if (group, block) != held:
                if held is not None:
                    done.append(_block_row(*held, rows))
                held, rows = (group, block), []
            rows.append((initial, must_go, truncated))
        if done:
            yield _block_batch(done)
    if held is not None:
        yield _block_batch([_block_row(*held, rows)])


def _block_batch(done: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), _EXITS)
    names = ("group_id", "block", "first", "last", "illegal", "exits")
    arrays = [pa.array(values, kind) for values, kind in zip(zip(*done), kinds)]
    return pa.RecordBatch.from_arrays(arrays, names=list(names))


_PICK = "group_id long, block long, entry int, state int, cost long, illegal long, tail string"


def _scan_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block the chosen states; cost, illegal pairs and tail with block 0."""
    held, chain = None, Chain()

    def picks() -> pa.RecordBatch:
        cost, tail, path = chain.finish()
        n = len(path)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([held] * n, pa.int64()),
                pa.array(range(n), pa.int64()),
                pa.array([p for p, _ in path], pa.int32()),
                pa.array([q for _, q in path], pa.int32()),
                pa.array([cost] + [None] * (n - 1), pa.int64()),
                pa.array([chain.illegal] + [None] * (n - 1), pa.int64()),
                pa.array([tail] + [None] * (n - 1), pa.string()),
            ],
            names=["group_id", "block", "entry", "state", "cost", "illegal", "tail"],
        )

    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if row["group_id"] != held:
                if held is not None:
                    done.append(picks())
                held, chain = row["group_id"], Chain()
            exits: dict[int, dict[int, tuple[int, int]]] = {}
            for e in row["exits"]:
                exits.setdefault(e["entry"], {})[e["state"]] = (e["cost"], e["rank"])
            chain.add(exits, row["illegal"], row["first"], row["last"])
        if done:
            yield from pa.Table.from_batches(done).combine_chunks().to_batches()
    if held is not None:
        yield picks()


def _audits(marked: DataFrame) -> DataFrame:
    """group_id, cost, illegal, audit."""
    blocked = marked.select(
        "group_id",
        F.floor(F.col("place") / F.lit(BLOCK_ROWS)).cast("long").alias("block"),
        "place",
        "initial",
        (F.col("blank") | F.col("duplicate")).alias("must_go"),
        "truncated",
    )
    solved = stored(
        blocked.repartition("group_id", "block")
        .sortWithinPartitions("group_id", "block", "place")
        .drop("place")
        .mapInArrow(_solve_blocks, _BLOCK),
        "turn-blocks",
    )
    light = solved.withColumn(
        "exits", F.transform("exits", lambda e: e.withField("edits", F.lit("")))
    )
    picks = (
        light.repartition("group_id").sortWithinPartitions("group_id", "block").mapInArrow(_scan_blocks, _PICK)
    )
    pieces = solved.select("group_id", "block", F.explode("exits").alias("exit")).select(
        "group_id", "block", "exit.entry", "exit.state", "exit.edits"
    )
    parts = picks.join(pieces, ["group_id", "block", "entry", "state"])
    ordered = F.array_sort(F.collect_list(F.struct("block", "edits")))
    return parts.groupBy("group_id").agg(
        F.max("cost").alias("cost"),
        F.max("illegal").alias("illegal"),
        F.concat(
            F.array_join(F.transform(ordered, lambda p: p["edits"]), ""), F.max("tail")
        ).alias("audit"),
    )


def _reports(rows: DataFrame) -> DataFrame:
    """Per conversation with rows: the counts, cost and audit."""
    marked = stored(_marked(rows), "turns-marked")
    counts = marked.groupBy("group_id").agg(
        F.first("conv_id").alias("conv_id"),
        F.coalesce(
            F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)
        ).cast("long").alias("gaps"),
        *[F.count_if(F.col(c)).alias(c) for c in ("blank", "duplicate", "truncated")],
    )
    return counts.join(_audits(marked), "group_id").drop("group_id")


_FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_FED = (*_FIGURES, "audit")


def _with_reports(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """Each conversation's report before its rows, dealt by conversation: texts move once."""
    told = reports.select("conv_id", F.lit(0).alias("kind"), *_FED)
    texts = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", _digest().alias("digest"))
    both = told.unionByName(texts, allowMissingColumns=True)
    return (
        both.repartition("conv_id")
        .sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
        .select("conv_id", "kind", *_FED, "role", "text")
    )


class _Applied:
    """Applies an audit to the rows of its conversation as they pass."""

    def __init__(self, audit: str):
        self._audit, self._at, self._state = audit, 0, START

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self._at < len(self._audit) and self._audit[self._at] == "I":
            self._at += 1
            yield "I", *self._say(_spoken(self._state), "")

    def _say(self, role: str, text: str) -> tuple[str, str]:
        self._state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
        return role, text

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()
        edit = self._audit[self._at]
        self._at += 1
        if edit == "K":
            yield edit, *self._say(role, text)
        elif edit == "R":
            yield edit, *self._say(_spoken(self._state), text)

    def rest(self) -> Iterator[tuple[str, str, str]]:
        return self._inserted()


def _figures_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * (1 + len(_FIGURES)) + [pa.string()] * 2
    arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(arrays, names=["conv_id", *_FED, "repaired_sha256"])


def _hash_repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    report, applied, digest, empty = None, None, None, True

    def say(turns) -> None:
        nonlocal empty
        for _, role, text in turns:
            digest.update(("" if empty else "\n").encode() + role.encode() + b":" + text.encode())
            empty = False

    for batch in batches:
        done = []
        for values in zip(*[column.to_pylist() for column in batch.columns]):
            if values[1] == 0:
                if report is not None:
                    say(applied.rest())
                    done.append((*report, digest.hexdigest()))
                report = (values[0], *values[2 : 2 + len(_FED)])
                applied, digest, empty = _Applied(report[-1]), hashlib.sha256(), True
            else:
                say(applied.row(*values[-2:]))
        if done:
            yield _figures_batch(done)
    if report is not None:
        say(applied.rest())
        yield _figures_batch([(*report, digest.hexdigest())])


def _emit_repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv_id, applied, number = None, None, 0
    names = ["conv_id", "turn", "edit", "role", "text"]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
    for batch in batches:
        done: list[tuple] = []

        def say(turns, done=done) -> None:
            nonlocal number
            for edit, role, text in turns:
                done.append((conv_id, number, edit, role, text))
                number += 1

        for values in zip(*[column.to_pylist() for column in batch.columns]):
            if values[1] == 0:
                if applied is not None:
                    say(applied.rest())
                conv_id, applied, number = values[0], _Applied(values[1 + len(_FED)]), 0
            else:
                say(applied.row(*values[-2:]))
        if done:
            arrays = [pa.array(v, k) for v, k in zip(zip(*done), kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
    if applied is not None:
        done = [(conv_id, number + i, *turn) for i, turn in enumerate(applied.rest())]
        if done:
            arrays = [pa.array(v, k) for v, k in zip(zip(*done), kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, turn (from 0), edit (K, R or I), role, text."""
    plain = _plain(rows)
    return _with_reports(plain, _reports(plain)).mapInArrow(
        _emit_repaired, "conv_id long, turn long, edit string, role string, text string"
    )


def repair_report(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per conv_id of ``conversations``: faults, cost, audit and digest of the repair."""
    plain = _plain(rows)
    schema = (
        "conv_id long, " + ", ".join(f"{c} long" for c in _FIGURES) + ", audit string, repaired_sha256 string"
    )
    found = _with_reports(plain, _reports(plain)).mapInArrow(_hash_repaired, schema)
    every = conversations.select(F.col("conv_id").cast("long").alias("asked")).distinct()
    joined = every.join(found, F.col("asked").eqNullSafe(F.col("conv_id")), "left")
    return joined.select(
        F.col("asked").alias("conv_id"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in _FIGURES],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Damages every conversation and repairs what is left."""
    return repair_report(damaged(conversations), conversations)
