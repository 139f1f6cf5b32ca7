"""Benchmark decontamination: passages of documents searched in an index of test items.

Items are cut into segments that an inverted index holds with BM25 impacts, each divided
by the segment's score against itself. Segments lie in blocks; for every term and block
the greatest impact is known. A passage is scored in a block only where the sum of these
maxima can reach the threshold (block-max WAND at the grain of blocks); every segment at or
above it is retrieved. A retrieved item counts when the document holds enough of the
shingles of both its question and its answer.

The index is built a shard of items at a time, so its size is bounded whatever the size of
the benchmark; every document is searched against every shard. Words are runs of letters
and digits in lower case. Documents or items without words have no hits; repeated rows
yield repeated hits. Null ids are carried through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import byte_values
from murmur.llm.hashing import each_word_hashes, shingle_hashes, word_hashes

#: ASCII to lower case, other ASCII than letters and digits to blanks.
_PLAIN = bytes(
    ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else (32 if b < 128 else b)
    for b in range(256)
)


@dataclass(frozen=True)
class SearchRules:
    passage_words: int = 64
    segment_words: int = 48
    score: float = 0.55
    overlap: float = 0.8
    shingle_words: int = 5
    block_segments: int = 8
    shard_items: int = 2_000
    k1: float = 1.2
    b: float = 0.75


def plain_words(text: bytes) -> np.ndarray:
    return word_hashes(text.translate(_PLAIN))


def each_plain(texts: pa.Array) -> Iterator[np.ndarray]:
    return each_word_hashes(text.translate(_PLAIN) for text in byte_values(texts))


class ItemIndex:
    """Blocked inverted index over the segments of some items, with what verifies them."""

    def __init__(self, items: list[tuple], rules: SearchRules):
        self.rules = rules
        self.ids, self.questions, self.answers = [], [], []
        owners, segments = [], []
        for item_id, question, answer in items:
            question_words = plain_words((question or "").encode())
            answer_words = plain_words((answer or "").encode())
            whole = np.concatenate((question_words, answer_words))
            if not len(whole):
                continue
            parts = math.ceil(len(whole) / rules.segment_words)
            for part in np.array_split(whole, parts):
                owners.append(len(self.ids))
                segments.append(part)
            self.ids.append(item_id)
            self.questions.append(np.unique(shingle_hashes(question_words, rules.shingle_words)))
            self.answers.append(answer_words)
        order = sorted(range(len(segments)), key=lambda i: len(segments[i]))
        self.owners = np.array([owners[i] for i in order], np.int64)
        self._fill([segments[i] for i in order])

    def _fill(self, segments: list[np.ndarray]) -> None:
        rules = self.rules
        self.terms = np.unique(np.concatenate(segments)) if segments else np.empty(0, np.uint64)
        self.blocks = math.ceil(len(segments) / rules.block_segments)
        if not segments:
            return
        mean = sum(map(len, segments)) / len(segments)
        rows = []
        for at, words in enumerate(segments):
            found, counts = np.unique(np.searchsorted(self.terms, words), return_counts=True)
            length = 1 - rules.b + rules.b * len(words) / mean
            rows.append((found, counts * (rules.k1 + 1) / (counts + rules.k1 * length)))
        held = np.bincount(np.concatenate([r[0] for r in rows]), minlength=len(self.terms))
        idf = np.log1p((len(segments) - held + 0.5) / (held + 0.5))
        term, segment, impact = [], [], []
        for at, (found, weight) in enumerate(rows):
            own = idf[found] * weight
            term.append(found)
            segment.append(np.full(len(found), at))
            impact.append(own / own.sum())
        term, segment = np.concatenate(term), np.concatenate(segment)
        impact = np.concatenate(impact)
        order = np.lexsort((segment, term))
        term, self.segment, self.impact = term[order], segment[order], impact[order]
        block = self.segment // rules.block_segments
        self.maxima = np.zeros((len(self.terms) + 1, self.blocks), np.float32)
        np.maximum.at(self.maxima, (term, block), self.impact)
        cell = term * self.blocks + block
        self.starts = np.searchsorted(cell, np.arange(len(self.terms) * self.blocks + 1))
        bits = 1 << max(16, (16 * len(self.terms)).bit_length())
        self.mask = np.uint64(bits - 1)
        self.maybe = np.zeros(bits, bool)
        self.maybe[(self.terms & self.mask).astype(np.int64)] = True

    def term_places(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the words that the index knows, and their terms."""
        likely = np.flatnonzero(self.maybe[(words & self.mask).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.terms, words[likely]), len(self.terms) - 1)
        known = self.terms[at] == words[likely]
        return likely[known], at[known]

    def retrieve(self, words: np.ndarray) -> dict[int, float]:
        """Items whose segments reach the threshold in some passage, with the best score."""
        rules = self.rules
        if not self.blocks or not len(words):
            return {}
        stride = rules.passage_words // 2
        place, term = self.term_places(words)
        if not len(place):
            return {}
        halves = (len(words) + stride - 1) // stride
        passages = max(1, halves - 1)
        keys = np.unique((place // stride) * np.int64(len(self.terms)) + term)
        half, term = keys // len(self.terms), keys % len(self.terms)
        best: dict[int, float] = {}
        for first in range(0, halves, 4_096):
            low, high = np.searchsorted(half, (first, first + 4_097))
            if low == high:
                continue
            own_half, own_term = half[low:high] - first, term[low:high]
            sums = np.zeros((4_098, self.blocks), np.float32)
            used, starts = np.unique(own_half, return_index=True)
            sums[used] = np.add.reduceat(self.maxima[own_term], starts, axis=0)
            bound = sums[:-1] + sums[1:]
            last = min(4_096, passages - first)
            for passage, block in np.argwhere(bound[:last] >= rules.score - 1e-4):
                inside = np.unique(own_term[(own_half == passage) | (own_half == passage + 1)])
                self._score(inside, int(block), best)
        return best

    def _score(self, terms: np.ndarray, block: int, best: dict[int, float]) -> None:
        rules = self.rules
        size = rules.block_segments
        scores = np.zeros(size)
        weights = self.maxima[terms, block]
        if weights.sum() < rules.score - 1e-4:
            return
        for term in terms[weights > 0]:
            cell = int(term) * self.blocks + block
            low, high = self.starts[cell], self.starts[cell + 1]
            scores[self.segment[low:high] - block * size] += self.impact[low:high]
        for at in np.flatnonzero(scores >= rules.score):
            owner = int(self.owners[block * size + at])
            best[owner] = max(best.get(owner, 0.0), float(scores[at]))

    def hits(self, words: np.ndarray) -> list[tuple]:
        """(item_id, score, question overlap, answer overlap) of the verified items."""
        found = self.retrieve(words)
        if not found:
            return []
        shingles = np.unique(shingle_hashes(words, self.rules.shingle_words))
        out = []
        for owner, score in sorted(found.items()):
            asked = _share(self.questions[owner], shingles)
            answered = self._answer_share(self.answers[owner], words)
            if min(asked, answered) >= self.rules.overlap:
                out.append((self.ids[owner], score, asked, answered))
        return out

    def _answer_share(self, answer: np.ndarray, words: np.ndarray) -> float:
        """Short answers are looked for as one phrase, longer ones by their shingles."""
        width = min(self.rules.shingle_words, len(answer))
        if not width:
            return 1.0
        if len(words) < width:
            return 0.0
        return _share(
            np.unique(shingle_hashes(answer, width)), np.unique(shingle_hashes(words, width))
        )


def _share(part: np.ndarray, whole: np.ndarray) -> float:
    return float(np.isin(part, whole).mean()) if len(part) else 1.0


def item_indexes(items: DataFrame, rules: SearchRules) -> Iterator[ItemIndex]:
    """Indexes over shards of about ``shard_items`` items (item_id, question, answer)."""
    spread = items.select("item_id", "question", "answer")
    shards = max(1, math.ceil(spread.count() / rules.shard_items))
    for shard in range(shards):
        mine = spread.where(F.pmod(F.xxhash64("item_id", "question"), F.lit(shards)) == shard)
        rows = [tuple(row) for row in mine.collect()]
        yield ItemIndex(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)), rules)


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """Question and answer of test items: the last sentence answers where there are several."""
    text = F.trim(F.coalesce("text", F.lit("")))
    pattern = r"^(.*[.?!])\s+([^.?!]*[.?!]?)$"
    answer = F.regexp_extract(text, f"(?s){pattern}", 2)
    question = F.regexp_extract(text, f"(?s){pattern}", 1)
    split = F.length(answer) > 0
    return benchmark.select(
        "item_id",
        F.when(split, question).otherwise(text).alias("question"),
        F.when(split, answer).otherwise(F.lit(None)).alias("answer"),
    )


def contaminations(
    docs: DataFrame, items: DataFrame, rules: SearchRules = SearchRules()
) -> DataFrame:
    """A row per document and test item that it holds."""
    context = docs.sparkSession.sparkContext
    picked = docs.select(F.col("doc_id").cast("long"), "text")
    schema = (
        "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    )
    found = None
    for index in item_indexes(items, rules):
        shared = context.broadcast(index)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [
                    (doc_id, *hit)
                    for doc_id, words in zip(batch.column(0).to_pylist(), each_plain(batch.column(1)))
                    for hit in shared.value.hits(words)
                ]
                columns = list(zip(*rows)) if rows else [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
                )

        part = picked.mapInArrow(search, schema)
        found = part if found is None else found.union(part)
    return found


def drop_contaminated(
    docs: DataFrame, items: DataFrame, rules: SearchRules = SearchRules()
) -> DataFrame:
    """The documents without a verified test item, with all columns."""
    context = docs.sparkSession.sparkContext
    text_at = docs.columns.index("text")
    kept = docs
    for index in item_indexes(items, rules):
        shared = context.broadcast(index)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                mask = [not shared.value.hits(words) for words in each_plain(batch.column(text_at))]
                yield batch.filter(pa.array(mask, pa.bool_()))

        kept = kept.mapInArrow(clean, docs.schema)
    return kept
