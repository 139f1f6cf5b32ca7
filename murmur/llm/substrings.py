"""Removal of repeated passages, located by Aho-Corasick automata.

A window is 13 consecutive words. A word goes when a window over it also starts in a
document with a smaller doc_id. Equal windows have equal minimisers (the least hash among
their runs of three words), so only windows whose minimiser recurs in another document can
recur; those are compared by their own hash, which yields the confirmed windows of each
document. Consecutive ones are joined to passages. Tasks compile the passages of a bounded
share of documents to an automaton each and stream those documents through it; every
occurrence of a passage in its own or a later document is removed.

Hashes have 64 bits. Tasks reduce a phrase or window to one row per block of documents
before the shuffle, so a passage that fills the corpus is no hot key. Rows without doc_id
neither lose words nor count as earlier documents; repeated rows are no earlier documents
of each other. Null texts have no words.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm.common import byte_values, scratch
from murmur.llm.hashing import each_word_hashes, shingle_hashes, word_hashes


@dataclass(frozen=True)
class PassageRules:
    window_words: int = 13
    phrase_words: int = 3
    block_rows: int = 2_000_000
    automaton_bytes: int = 4 << 20
    automaton_texts: int = 24 << 20


def minimisers(words: np.ndarray, rules: PassageRules) -> np.ndarray:
    """The least phrase hash of every window, in order."""
    if len(words) < rules.window_words:
        return np.empty(0, np.uint64)
    phrases = shingle_hashes(words, rules.phrase_words)
    count = len(words) - rules.window_words + 1
    least = phrases[:count].copy()
    for step in range(1, rules.window_words - rules.phrase_words + 1):
        np.minimum(least, phrases[step : step + count], out=least)
    return least


def window_hashes(words: np.ndarray, rules: PassageRules) -> np.ndarray:
    if len(words) < rules.window_words:
        return np.empty(0, np.uint64)
    return shingle_hashes(words, rules.window_words)


class _Block:
    """Hashes of some documents, reduced to the least document per hash."""

    def __init__(self):
        self.hashes, self.docs, self.rows = [], [], 0

    def add(self, doc: int, hashes: np.ndarray) -> None:
        self.hashes.append(hashes)
        self.docs.append(np.full(len(hashes), doc, np.int64))
        self.rows += len(hashes)

    def batch(self) -> pa.RecordBatch:
        """(hash, doc, first, shared): ``first`` marks a block's least document of a hash,
        ``shared`` that the block has others."""
        if not self.hashes:
            hashes, docs = np.empty(0, np.uint64), np.empty(0, np.int64)
        else:
            hashes, docs = np.concatenate(self.hashes), np.concatenate(self.docs)
        order = np.lexsort((docs, hashes))
        hashes, docs = hashes[order], docs[order]
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        # A document has a hash once here, unless its row is repeated.
        group = np.cumsum(new) - 1
        least = docs[new][group] if len(docs) else docs
        first = docs == least
        greatest = np.maximum.reduceat(docs, np.flatnonzero(new)) if len(docs) else docs
        shared = (greatest != docs[new])[group] if len(docs) else first
        keep = new | ~first
        return pa.RecordBatch.from_arrays(
            [
                pa.array(hashes[keep].view(np.int64)),
                pa.array(docs[keep]),
                pa.array(first[keep]),
                pa.array(shared[keep]),
            ],
            names=["hash", "doc_id", "first", "shared"],
        )


_BLOCK_SCHEMA = "hash long, doc_id long, first boolean, shared boolean"


def _recurring_phrases(docs: DataFrame, rules: PassageRules) -> DataFrame:
    """(doc_id, phrases): the minimisers of each document that another document has too."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in batches:
            hashed = each_word_hashes(byte_values(batch.column(1)))
            for doc, words in zip(batch.column(0).to_pylist(), hashed):
                block.add(doc, np.unique(minimisers(words, rules)))
                if block.rows > rules.block_rows:
                    yield block.batch()
                    block = _Block()
        yield block.batch()

    rows = docs.select("doc_id", "text").mapInArrow(emit, _BLOCK_SCHEMA)
    sure = F.col("shared") | (F.col("least") != F.col("greatest"))
    own = Window.partitionBy("hash")
    asked = (
        rows.where("first")
        .withColumn("least", F.min("doc_id").over(own))
        .withColumn("greatest", F.max("doc_id").over(own))
        .where(sure)
        .select("doc_id", "hash")
    )
    known = rows.where("not first").select("doc_id", "hash")
    return asked.union(known).groupBy("doc_id").agg(F.collect_set("hash").alias("phrases"))


def _candidates(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """The documents that share a phrase, with their phrases, written once.

    The table is bucketed by doc_id as the join left it, so the later join with the
    confirmed windows reads the texts in place.
    """
    spark = docs.sparkSession
    name = f"candidates_{uuid.uuid4().hex}"
    (
        docs.select("doc_id", "text")
        .join(phrases, "doc_id")
        .write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id")
        .option("path", scratch(spark, "candidates"))
        .option("compression", "zstd")
        .saveAsTable(name)
    )
    return spark.table(name)


def _confirmed(candidates: DataFrame, rules: PassageRules) -> DataFrame:
    """(doc_id, windows): the windows of each document that a smaller doc_id has."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in batches:
            hashed = each_word_hashes(byte_values(batch.column(1)))
            lists = batch.column(2)
            for at, (doc, words) in enumerate(zip(batch.column(0).to_pylist(), hashed)):
                wanted = lists[at].values.to_numpy(zero_copy_only=False).view(np.uint64)
                mine = np.isin(minimisers(words, rules), wanted)
                block.add(doc, np.unique(window_hashes(words, rules)[mine]))
                if block.rows > rules.block_rows:
                    yield block.batch()
                    block = _Block()
        yield block.batch()

    rows = candidates.mapInArrow(emit, _BLOCK_SCHEMA)
    asked = (
        rows.where("first")
        .withColumn("least", F.min("doc_id").over(Window.partitionBy("hash")))
        .where("least < doc_id")
        .select("doc_id", "hash")
    )
    known = rows.where("not first").select("doc_id", "hash")
    return asked.union(known).groupBy("doc_id").agg(F.collect_set("hash").alias("windows"))


class PassageAutomaton:
    """Passages with the least document each is confirmed for."""

    def __init__(self):
        self.owner: dict[str, int] = {}
        self.size = 0

    def add(self, passage: str, doc: int) -> None:
        before = self.owner.get(passage)
        if before is None:
            self.size += len(passage)
        if before is None or doc < before:
            self.owner[passage] = doc

    def compile(self) -> None:
        self.machine = ahocorasick.Automaton()
        for passage, doc in self.owner.items():
            self.machine.add_word(passage, (len(passage), doc))
        if self.owner:
            self.machine.make_automaton()

    def covered(self, text: str, doc: int) -> list[tuple[int, int]]:
        """Character ranges of ``text`` (from the blank before a passage to the one after)."""
        if not self.owner:
            return []
        return [
            (end + 1 - length, end + 1)
            for end, (length, owner) in self.machine.iter(text)
            if owner <= doc
        ]


def passages(words: list[str], windows: np.ndarray, rules: PassageRules) -> Iterator[str]:
    """Runs of confirmed windows as text, between blanks."""
    hashes = window_hashes(word_hashes(" ".join(words).encode()), rules)
    starts = np.flatnonzero(np.isin(hashes, windows))
    if not len(starts):
        return
    breaks = np.flatnonzero(np.diff(starts) > 1)
    firsts = np.concatenate(([0], breaks + 1))
    lasts = np.concatenate((breaks, [len(starts) - 1]))
    for first, last in zip(starts[firsts], starts[lasts]):
        yield f" {' '.join(words[first : last + rules.window_words])} "


def kept_words(words: list[str], ranges: list[tuple[int, int]]) -> list[str]:
    """The words outside the ranges of `` w1 w2 ... ``."""
    starts = np.cumsum([0, *(len(word) + 1 for word in words)])
    steps = np.zeros(len(words) + 1, np.int64)
    for low, high in ranges:
        steps[np.searchsorted(starts, low)] += 1
        steps[np.searchsorted(starts, high - 1)] -= 1
    gone = np.cumsum(steps[:-1]) > 0
    return [word for word, out in zip(words, gone) if not out]


def _removed(found: DataFrame, rules: PassageRules) -> DataFrame:
    """found: doc_id, text, windows. Per row: doc_id, text_hash, n_removed, kept_sha256, kept."""

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, automaton, size = [], PassageAutomaton(), 0

        def searched() -> pa.RecordBatch:
            automaton.compile()
            rows = []
            for doc, text_hash, words in held:
                left = kept_words(words, automaton.covered(f" {' '.join(words)} ", doc))
                text = " ".join(left)
                digest = hashlib.sha256(text.encode()).hexdigest()
                rows.append((doc, text_hash, len(words) - len(left), digest, text))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            columns = zip(*rows) if rows else [[]] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "text_hash", "n_removed", "kept_sha256", "kept"],
            )

        for batch in batches:
            docs, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at, text in enumerate(byte_values(batch.column(2))):
                words = [word.decode() for word in text.split()]
                windows = batch.column(3)[at].values.to_numpy(zero_copy_only=False)
                for passage in passages(words, windows.view(np.uint64), rules):
                    automaton.add(passage, docs[at])
                held.append((docs[at], hashes[at], words))
                size += len(text)
                if automaton.size > rules.automaton_bytes or size > rules.automaton_texts:
                    yield searched()
                    held, automaton, size = [], PassageAutomaton(), 0
        yield searched()

    schema = "doc_id long, text_hash long, n_removed long, kept_sha256 string, kept string"
    picked = found.select("doc_id", F.xxhash64("text").alias("text_hash"), "text", "windows")
    return picked.mapInArrow(locate, schema)


def without_repeats(docs: DataFrame, rules: PassageRules = PassageRules()) -> DataFrame:
    """Documents that lose words: doc_id, text_hash, n_removed, kept_sha256, kept."""
    named = docs.select(F.col("doc_id").cast("long"), "text").where(
        "doc_id is not null and text is not null"
    )
    candidates = _candidates(named, _recurring_phrases(named, rules))
    confirmed = _confirmed(candidates, rules)
    found = candidates.select("doc_id", "text").join(confirmed, "doc_id")
    return _removed(found, rules).dropDuplicates(["doc_id", "text_hash"])


def remove_repeats(docs: DataFrame, rules: PassageRules = PassageRules()) -> DataFrame:
    """One row per document: its words, removed words and the digest of what is left."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests = [], []
            for text in byte_values(batch.column(2)):
                words = text.split()
                counts.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(digests, pa.string())],
                names=["doc_id", "text_hash", "n_words", "whole_sha256"],
            )

    every = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text"
    ).mapInArrow(whole, "doc_id long, text_hash long, n_words long, whole_sha256 string")
    less = without_repeats(docs, rules).drop("kept")
    return every.join(less, ["doc_id", "text_hash"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
    )
