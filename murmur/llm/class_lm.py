"""Class-based bigram language model after Brown et al., with exchange clustering.

A core of the most frequent training words, whose number grows with the training tokens, is
assigned to classes by exchange clustering: each word moves to the class that raises the
class-bigram likelihood most, until nothing moves or the passes are used up. Every further
training word that occurs at least ``least_count`` times then joins, on executors, the class
under which its own neighbours are likeliest, given the bigrams of the core. Words seen
less often stand for unseen ones: both belong to classes by shape (length, digits, letters
beyond ASCII, closing punctuation). A text's probability is the product of class
transitions and of each word's share in its class, both smoothed by adding counts, over all
training tokens. Words are known by 64-bit hashes.

Counts and classes of the most frequent words are sent to every task, under a bound on their
number; those of the other words are joined by shuffle, once per document and word. The
neighbours of a word reach one task as a stream of bytes, two per occurrence; the words that
own a large share of all tokens are in the core, so that stream stays short. The driver
holds the bigrams of the core, a square that grows with the root of the tokens.

Documents without doc_id are trained on. Null and empty texts are one end token. Very long
texts are one row of one byte per word. Repeated rows are trained on and scored as rows of
their own; of equally good classes the lowest number is taken. An empty table gives no rows;
columns other than doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import byte_values, stored
from murmur.llm.hashing import word_bounds, word_hashes

_END = -1
_SHAPES = 32
_TOGETHER = 1 << 17
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1
_WIDE = np.zeros(256, np.int64)
_WIDE[128:] = 1


@dataclass(frozen=True)
class ClassRules:
    clustered_words: int = 300
    core_growth: float = 8.0
    classes: int = 64
    least_count: int = 2
    passes: int = 6
    sent_words: int = 100_000
    smoothing: float = 0.5
    folds: int = 7
    held_fold: int = 2
    block_tokens: int = 2_000_000


    def core_words(self, tokens: int) -> int:
        return max(self.clustered_words, round(self.core_growth * tokens**0.25))


def held_out(rules: ClassRules) -> Column:
    fold = F.crc32(F.col("doc_id").cast("string")) % rules.folds
    return F.coalesce(fold == rules.held_fold, F.lit(False))


def tokens(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and shape of every word of the lower-cased text."""
    text = text.lower()
    hashes = word_hashes(text)
    if not len(hashes):
        return hashes, np.empty(0, np.int64)
    first, end = word_bounds(text)
    raw = np.frombuffer(text, np.uint8)
    digits = np.concatenate(([0], np.cumsum(_DIGIT[raw])))
    wide = np.concatenate(([0], np.cumsum(_WIDE[raw])))
    shape = np.searchsorted((5, 8, 12), end - first, side="right")
    shape = shape * 2 + (digits[end] > digits[first])
    shape = shape * 2 + (wide[end] > wide[first])
    return hashes, shape * 2 + _PUNCTUATION[raw[end - 1]]


@dataclass
class TokenGroup:
    """Words of some texts, one text after the other; ``ends`` counts the words up to each text's end."""

    words: np.ndarray
    shapes: np.ndarray
    ends: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ends)), np.diff(self.ends, prepend=0))

    def with_borders(self, numbers: np.ndarray, border: int) -> tuple[np.ndarray, np.ndarray]:
        """The numbers with a border before, between and behind the texts, and each word's place there."""
        places = np.arange(len(numbers)) + 1 + self.text_of()
        path = np.full(len(numbers) + len(self.ends) + 1, border, numbers.dtype)
        path[places] = numbers
        return path, places


def token_groups(texts: Iterable[bytes]) -> Iterator[TokenGroup]:
    """The words of all texts; short texts are read together, which is faster."""

    def together(held: list[bytes]) -> TokenGroup:
        joined = b"\n".join(held)
        words, shapes = tokens(joined)
        first, _ = word_bounds(joined)
        return TokenGroup(words, shapes, np.searchsorted(first, np.cumsum([len(t) + 1 for t in held])))

    held: list[bytes] = []
    size = 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size > _TOGETHER:
            yield together(held)
            held, size = [], 0
    if held:
        yield together(held)


def vocabulary(docs: DataFrame, rules: ClassRules) -> DataFrame:
    """(word, shape, n) over all training tokens; the end token has shape -1."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shapes, size, ends = [], [], 0, 0

        def rows() -> pa.RecordBatch:
            words = np.concatenate([np.empty(0, np.uint64), *held])
            kinds = np.concatenate([np.empty(0, np.int64), *shapes])
            found, at, n = np.unique(words, return_index=True, return_counts=True)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(found.view(np.int64), _END)),
                    pa.array(np.append(kinds[at], -1).astype(np.int32)),
                    pa.array(np.append(n, ends)),
                ],
                names=["word", "shape", "n"],
            )

        for batch in batches:
            for group in token_groups(byte_values(batch.column(0))):
                held.append(group.words)
                shapes.append(group.shapes)
                size += len(group.words)
                ends += len(group.ends)
                if size > rules.block_tokens:
                    yield rows()
                    held, shapes, size, ends = [], [], 0, 0
        yield rows()

    counted = docs.select("text").mapInArrow(count, "word long, shape int, n long")
    return stored(counted.groupBy("word", "shape").agg(F.sum("n").alias("n")).where("n > 0"), "vocabulary")


class Numbering:
    """Numbers words: clustered ones, then shapes, then the border of texts."""

    def __init__(self, clustered: np.ndarray):
        self.order = np.argsort(clustered)
        self.sorted = clustered[self.order]
        self.clustered = len(clustered)
        self.border = self.clustered + _SHAPES

    def of(self, words: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        numbers = shapes + self.clustered
        if self.clustered and len(words):
            at = np.minimum(np.searchsorted(self.sorted, words), self.clustered - 1)
            hit = self.sorted[at] == words
            numbers[hit] = self.order[at[hit]]
        return numbers


def bigrams(docs: DataFrame, numbering: Numbering, rules: ClassRules) -> np.ndarray:
    """Counts of neighbouring numbers, borders included, over all training texts.

    The driver receives one row per pair of numbers at most.
    """
    shared = docs.sparkSession.sparkContext.broadcast(numbering)
    width = numbering.border + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        held, size = [], 0

        def rows() -> pa.RecordBatch:
            pairs = np.concatenate([np.empty(0, np.int64), *held])
            found, n = np.unique(pairs, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["pair", "n"])

        for batch in batches:
            for group in token_groups(byte_values(batch.column(0))):
                path, _ = group.with_borders(known.of(group.words, group.shapes), known.border)
                held.append(path[:-1] * width + path[1:])
                size += len(path)
                if size > rules.block_tokens:
                    yield rows()
                    held, size = [], 0
        yield rows()

    counted = (
        docs.select("text")
        .mapInArrow(count, "pair long, n long")
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    matrix = np.zeros(width * width, np.float64)
    matrix[counted["pair"].to_numpy(np.int64)] = counted["n"].to_numpy(np.float64)
    return matrix.reshape(width, width)


def _entropy(values: np.ndarray) -> np.ndarray:
    return values * np.log(np.maximum(values, 1.0))


def exchange(counts: np.ndarray, clustered: int, rules: ClassRules) -> np.ndarray:
    """Class of every number: exchanged for clustered words, fixed for the others."""
    classes = min(rules.classes, max(1, clustered))
    fixed = len(counts) - clustered
    of = np.concatenate((np.arange(clustered) % classes, classes + np.arange(fixed)))
    width = classes + fixed
    joined = np.zeros((width, width))
    np.add.at(joined, (of[:, None], of[None, :]), counts)
    for _ in range(rules.passes):
        moved = 0
        for word in range(clustered):
            out = np.bincount(of, counts[word], width)
            into = np.bincount(of, counts[:, word], width)
            own, self_count = of[word], counts[word, word]
            out[own] -= self_count
            into[own] -= self_count
            joined[own] -= out
            joined[:, own] -= into
            joined[own, own] -= self_count
            rows, columns = joined.sum(1), joined.sum(0)
            part = joined[:classes]
            gain = (_entropy(part + out) - _entropy(part)).sum(1)
            side = joined[:, :classes].T
            gain += (_entropy(side + into) - _entropy(side)).sum(1)
            k = np.arange(classes)
            middle = joined[k, k]
            gain -= _entropy(middle + out[k]) + _entropy(middle + into[k]) - _entropy(middle)
            gain += _entropy(middle + out[k] + into[k] + self_count)
            gain -= _entropy(rows[k] + out.sum() + self_count) - _entropy(rows[k])
            gain -= _entropy(columns[k] + into.sum() + self_count) - _entropy(columns[k])
            best = int(gain.argmax()) if gain.max() > gain[own] + 1e-9 else own
            of[word] = best
            moved += best != own
            joined[best] += out
            joined[:, best] += into
            joined[best, best] += self_count
        if not moved:
            break
    return of


def _class_logs(joined: np.ndarray, classes: int, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """What a left and a right neighbour's class add to the fit of each class but the border.

    Rows are neighbours' classes. The left part also holds the cost of sharing a class.
    """
    width = len(joined)
    after = np.log((joined + alpha) / (joined.sum(1, keepdims=True) + alpha * width))
    share = np.log(joined.sum(0) + alpha * width)
    return (after - share)[:, : width - 1].astype(np.float32), after[: width - 1].T.astype(np.float32)


def further_words(docs: DataFrame, numbering: Numbering, of: np.ndarray, joined: np.ndarray, rules: ClassRules) -> DataFrame:
    """(word, class, n) of all training words beyond the core.

    ``of`` gives the class of every number, ``joined`` the class bigrams of the core.
    """
    context = docs.sparkSession.sparkContext
    classes = len(joined) - _SHAPES - 1
    shared = context.broadcast((numbering, of.astype(np.uint8)))
    logs = context.broadcast(_class_logs(joined, classes, rules.smoothing))

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, class_of = shared.value
        held, size = [], 0

        def rows() -> pa.RecordBatch:
            words = np.concatenate([np.empty(0, np.uint64), *(h[0] for h in held)])
            cells = np.concatenate([np.empty((0, 2), np.uint8), *(h[1] for h in held)])
            shapes = np.concatenate([np.empty(0, np.int64), *(h[2] for h in held)])
            order = np.argsort(words, kind="stable")
            words, cells = words[order], np.ascontiguousarray(cells[order])
            first = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1]))[: len(words)])
            bounds = np.append(first, len(words)).astype(np.int32) * 2
            packed = pa.Array.from_buffers(
                pa.binary(), len(first), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(cells.tobytes())]
            )
            return pa.RecordBatch.from_arrays(
                [pa.array(words[first].view(np.int64)), pa.array(shapes[order][first].astype(np.int32)), packed],
                names=["word", "shape", "cells"],
            )

        for batch in batches:
            for group in token_groups(byte_values(batch.column(0))):
                numbers = known.of(group.words, group.shapes)
                path, places = group.with_borders(class_of[numbers], class_of[known.border])
                at = np.flatnonzero(numbers >= known.clustered)
                place = places[at]
                held.append((group.words[at], np.stack((path[place - 1], path[place + 1]), 1), group.shapes[at]))
                size += len(at)
                if size > rules.block_tokens:
                    yield rows()
                    held, size = [], 0
        yield rows()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = logs.value
        shape_of = np.arange(classes, classes + _SHAPES)
        last = None

        def chosen(words, shapes, sums, n) -> pa.RecordBatch:
            own = shape_of[shapes]
            fits = sums[:, :classes]
            best = fits.argmax(1) if len(sums) and classes else np.zeros(len(words), np.int64)
            keep = (n >= rules.least_count) & (fits.max(1, initial=-np.inf) > sums[np.arange(len(words)), own])
            return pa.RecordBatch.from_arrays(
                [pa.array(words), pa.array(np.where(keep, best, own).astype(np.int32)), pa.array(n)],
                names=["word", "class", "n"],
            )

        for batch in batches:
            words = batch.column(0).to_numpy()
            shapes = batch.column(1).to_numpy()
            cells = [np.frombuffer(c.as_py(), np.uint8).reshape(-1, 2) for c in batch.column(2)]
            for low in range(0, len(words), 512):
                own, part = words[low : low + 512], cells[low : low + 512]
                sizes = np.array([len(c) for c in part])
                sums = np.empty((len(own), left.shape[1]))
                small = np.concatenate(part) if sizes.sum() < 1 << 16 else None
                if small is not None:
                    sums[:] = np.add.reduceat(
                        left[small[:, 0]] + right[small[:, 1]], np.cumsum(sizes) - sizes, axis=0, dtype=np.float64
                    )
                else:
                    for at, c in enumerate(part):
                        sums[at] = np.bincount(c[:, 0], minlength=len(left)) @ left.astype(np.float64)
                        sums[at] += np.bincount(c[:, 1], minlength=len(right)) @ right.astype(np.float64)
                kinds = shapes[low : low + 512]
                if last is not None:
                    own, kinds = np.append(last[0], own), np.append(last[1], kinds)
                    sums, sizes = np.concatenate((last[2], sums)), np.append(last[3], sizes)
                first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                own, kinds = own[first], kinds[first]
                sums, sizes = np.add.reduceat(sums, first, axis=0), np.add.reduceat(sizes, first)
                last = own[-1:], kinds[-1:], sums[-1:], sizes[-1:]
                yield chosen(own[:-1], kinds[:-1], sums[:-1], sizes[:-1])
        if last is not None:
            yield chosen(*last)

    found = (
        docs.select("text")
        .mapInArrow(neighbours, "word long, shape int, cells binary")
        .repartition("word")
        .sortWithinPartitions("word")
        .mapInArrow(assign, "word long, class int, n long")
    )
    return stored(found, "further_words")


@dataclass
class WordModel:
    """The words that every task knows, and the classes of all others by shape."""

    words: np.ndarray
    classes: np.ndarray
    logs: np.ndarray
    shape_class: int
    border: int
    train_tokens: int
    vocabulary: int
    end_log: float


def train_words(docs: DataFrame, rules: ClassRules = ClassRules()) -> tuple[WordModel, DataFrame, np.ndarray]:
    """The words sent to tasks, the table of words beyond the core, and each class's share log."""
    learnt = docs.where(~held_out(rules))
    words = vocabulary(learnt, rules)
    sums = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n, v = sums["n"] or 0, sums["v"]
    top = words.where("shape >= 0").orderBy(F.desc("n"), "word").limit(rules.core_words(n)).toPandas()
    core = top["word"].to_numpy(np.int64).view(np.uint64).copy()
    core_n = top["n"].to_numpy(np.float64)
    numbering = Numbering(core)
    matrix = bigrams(learnt, numbering, rules)
    of = exchange(matrix, numbering.clustered, rules)
    width = int(of.max()) + 1
    joined = np.zeros((width, width))
    np.add.at(joined, (of[:, None], of[None, :]), matrix)
    further = further_words(learnt, numbering, of, joined, rules)

    sizes = np.zeros(width)
    np.add.at(sizes, of[: len(core)], core_n + 1)
    for row in further.groupBy("class").agg(F.sum(F.col("n") + 1).alias("n")).collect():
        sizes[row["class"]] += row["n"]
    shares = np.log10(sizes + 1)
    shares[-1] = 0.0
    sent = further.orderBy(F.desc("n"), "word").limit(max(0, rules.sent_words - len(core))).toPandas()
    hashes = np.concatenate((core, sent["word"].to_numpy(np.int64).view(np.uint64)))
    classes = np.concatenate((of[: len(core)], sent["class"].to_numpy(np.int64)))
    counts = np.concatenate((core_n, sent["n"].to_numpy(np.float64)))
    order = np.argsort(hashes)
    ends = words.where("shape < 0").first()
    model = WordModel(
        hashes[order],
        classes[order].astype(np.uint8),
        np.log10(counts[order] + 1),
        width - 1 - _SHAPES,
        width - 1,
        n,
        v,
        float(np.log10((ends["n"] if ends else 0) + 1)),
    )
    return model, further, shares


_PARTS = (
    "row_no long, doc_id long, held_out boolean, n_tokens long, n_known long, "
    "logs double, path binary, slots binary, word long, slot int, n long, shape int"
)
#: Marks a place of a path whose word tasks do not know.
_OPEN = 128


def _word_rows(docs: DataFrame, model: WordModel, rules: ClassRules) -> DataFrame:
    """Rows of documents (word null) with their classes, and of their words that tasks do not know."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema(
        [
            ("row_no", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
            ("n_known", pa.int64()), ("logs", pa.float64()), ("path", pa.binary()), ("slots", pa.binary()),
            ("word", pa.int64()), ("slot", pa.int32()), ("n", pa.int64()), ("shape", pa.int32()),
        ]
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: WordModel = shared.value
        row_no = TaskContext.get().partitionId() << 36
        for batch in batches:
            ids, held = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            done = 0
            for group in token_groups(byte_values(batch.column(2))):
                words, text_of, size = group.words, group.text_of(), len(group.ends)
                path = (group.shapes + m.shape_class).astype(np.uint8)
                hit, logs = np.zeros(len(words), bool), np.zeros(len(words))
                if len(m.words):
                    at = np.minimum(np.searchsorted(m.words, words), len(m.words) - 1)
                    hit = m.words[at] == words
                    path[hit] = m.classes[at[hit]]
                    logs[hit] = m.logs[at[hit]]
                rest = np.flatnonzero(~hit)
                order = rest[np.lexsort((words[rest], text_of[rest]))]
                own, text = words[order], text_of[order]
                new = np.ones(len(order), bool)
                new[1:] = (own[1:] != own[:-1]) | (text[1:] != text[:-1])
                first = np.flatnonzero(new)
                # words are numbered within their text
                begin = np.searchsorted(text[first], np.arange(size))
                slot = np.arange(len(first)) - begin[text[first]]
                slots = np.empty(len(words), np.int32)
                slots[order] = slot[np.cumsum(new) - 1]
                kinds = path[order[first]]
                path[rest] += _OPEN
                slots, open_ends = slots[rest], np.searchsorted(rest, group.ends)
                starts, open_starts = np.append(0, group.ends[:-1]), np.append(0, open_ends[:-1])
                rows = [
                    np.arange(row_no, row_no + size),
                    ids[done : done + size],
                    held[done : done + size],
                    np.diff(group.ends, prepend=0) + 1,
                    np.bincount(text_of[hit], minlength=size) + int(m.end_log > 0),
                    np.bincount(text_of, logs, size) + m.end_log,
                    [path[i:j].tobytes() for i, j in zip(starts, group.ends)],
                    [slots[i:j].tobytes() for i, j in zip(open_starts, open_ends)],
                ]
                arrays = [pa.array(c, f.type) for c, f in zip(rows, schema)]
                yield pa.RecordBatch.from_arrays(
                    arrays + [pa.nulls(size, f.type) for f in list(schema)[8:]], schema=schema
                )
                if len(first):
                    others = own[first].view(np.int64), slot, np.diff(first, append=len(order)), kinds
                    arrays = [pa.array(row_no + text[first], pa.int64())]
                    arrays += [pa.nulls(len(first), f.type) for f in list(schema)[1:8]]
                    arrays += [pa.array(c.astype(f.type.to_pandas_dtype())) for c, f in zip(others, list(schema)[8:])]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)
                row_no += size
                done += size

    picked = docs.select(F.col("doc_id").cast("long"), held_out(rules).alias("held_out"), "text")
    return stored(picked.mapInArrow(split, _PARTS), "words_of_texts")


def _paths(docs: DataFrame, model: WordModel, further: DataFrame, rules: ClassRules) -> DataFrame:
    """One row per document with the class of each of its words, and the sum of count logs."""
    rows = _word_rows(docs, model, rules)
    moved = F.when(F.col("class") != F.col("shape"), F.struct("slot", "class"))
    known = (
        rows.where("word is not null")
        .select("row_no", "word", "slot", "shape", F.col("n").alias("times"))
        .join(further.select("word", "class", F.col("n").alias("seen")), "word")
        .groupBy("row_no")
        .agg(
            F.sum(F.col("times") * F.log10(F.col("seen") + 1)).alias("more_logs"),
            F.sum("times").alias("more_known"),
            F.collect_list(moved).alias("moved"),
        )
        .select("row_no", "more_logs", "more_known", "moved.slot", "moved.class")
    )
    whole = (
        rows.where("word is null")
        .select("row_no", "doc_id", "held_out", "n_tokens", "n_known", "logs", "path", "slots")
        .join(known, "row_no", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
            (F.col("logs") + F.coalesce("more_logs", F.lit(0.0))).alias("logs"),
            "path",
            "slots",
            "slot",
            "class",
        )
    )

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = []
            for path, slots, slot, kind in zip(*(batch.column(i) for i in range(5, 9))):
                path = np.frombuffer(path.as_py(), np.uint8).copy()
                places = np.flatnonzero(path >= _OPEN)
                path[places] -= _OPEN
                if slot.is_valid and len(slot):
                    slots = np.frombuffer(slots.as_py(), np.int32)
                    change = np.full(slots.max() + 1, -1)
                    change[slot.values.to_numpy()] = kind.values.to_numpy()
                    new = change[slots]
                    path[places[new >= 0]] = new[new >= 0]
                paths.append(path.tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(paths, pa.binary())], names=[*batch.schema.names[:5], "path"]
            )

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, path binary"
    return stored(whole.mapInArrow(settle, schema), "class_paths")


def transitions(paths: DataFrame, border: int, rules: ClassRules) -> np.ndarray:
    """log10 probability of each class after another, from the training paths."""
    width = border + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * width, np.int64)
        for batch in batches:
            for path in byte_values(batch.column(0)):
                steps = _steps(path, border)
                total += np.bincount(steps[:-1] * width + steps[1:], minlength=width * width)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["pair", "n"])

    counted = paths.where("not held_out").select("path").mapInArrow(count, "pair long, n long")
    matrix = np.zeros(width * width)
    for row in counted.groupBy("pair").agg(F.sum("n").alias("n")).collect():
        matrix[row["pair"]] = row["n"]
    matrix = matrix.reshape(width, width)
    alpha = rules.smoothing
    return np.log10((matrix + alpha) / (matrix.sum(1, keepdims=True) + alpha * width))


def _steps(path: bytes, border: int) -> np.ndarray:
    return np.concatenate(([border], np.frombuffer(path, np.uint8), [border])).astype(np.int64)


def score_texts(docs: DataFrame, rules: ClassRules = ClassRules()) -> DataFrame:
    """One row per document with the base and the model's log10 probability."""
    if rules.classes + _SHAPES >= _OPEN:
        raise ValueError(f"at most {_OPEN - _SHAPES - 1} classes")
    model, further, shares = train_words(docs, rules)
    paths = _paths(docs, model, further, rules)
    moves = transitions(paths, model.border, rules)
    shared = docs.sparkSession.sparkContext.broadcast((moves - shares, model.border, model.end_log))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain, border, end_log = shared.value
        for batch in batches:
            sums = []
            for path in byte_values(batch.column(5)):
                steps = _steps(path, border)
                sums.append(gain[steps[:-1], steps[1:]].sum())
            # the border follows with its own probability; it has no share among words
            model_part = batch.column(4).to_numpy() + np.array(sums, np.float64) - end_log
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(model_part)], names=[*batch.schema.names[:5], "score"]
            )

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double"
    per_token = math.log10(model.train_tokens + model.vocabulary + 1)
    return paths.mapInArrow(score, schema).select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * per_token).alias("base_score"),
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
