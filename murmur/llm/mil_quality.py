"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of forty words. Each passage is encoded (shape of its
characters and words, repetition, letter pairs) and passed through a learned layer. Gated
attention, softmax over a document of ``w . (tanh(V h) * sigmoid(U h))``, weighs the
passages; the weighted mean is classified. Only documents carry labels: attention learns by
itself which passages decide.

The model is fitted on at most ``sample_documents`` labelled documents outside the held-out
fold, chosen by hash of doc_id, with at most ``sample_passages`` passages of each, evenly spaced.
Scoring reads all passages of whole texts. Labels, lang, source and doc_id are no inputs of a
score. Null and empty texts are one passage without words. Null labels and null ids are
ignored; of several labels of a document the greatest counts, of several texts with one id the one
with the least digest. Long texts are encoded in parts of two megabytes. Without both labels in
the sample every score is the share of good texts in it (half without any). An empty table
gives no rows; other columns of the input never matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import SPACES, byte_values
from murmur.llm.hashing import split_text, word_bounds, word_hashes

_LETTERS, _PAIRS = 32, 32
_KINDS = 12
_TOGETHER, _PART = 1 << 18, 1 << 21
#: Marks that close a word of prose, and marks that junk is full of.
_CLOSING, _SYMBOLS = b".,;:!?", b"#*$%&|<>=~^_"


@dataclass(frozen=True)
class MilRules:
    folds: int = 5
    held_fold: int = 0
    threshold: float = 0.3
    passage_words: int = 40
    sample_documents: int = 4_000
    sample_passages: int = 48
    hidden: int = 24
    gates: int = 12
    steps: int = 240
    rate: float = 0.02
    ridge: float = 1e-4
    seed: int = 7


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, 11, np.int64)
    for byte in range(128):
        letter = chr(byte)
        if letter == "\n":
            kinds[byte] = 0
        elif byte in SPACES:
            kinds[byte] = 1
        elif letter.islower():
            kinds[byte] = 2
        elif letter.isupper():
            kinds[byte] = 3
        elif letter.isdigit():
            kinds[byte] = 4
        elif letter in ".,":
            kinds[byte] = 5
        elif letter == "!":
            kinds[byte] = 6
        elif letter == "|":
            kinds[byte] = 7
        elif byte in _SYMBOLS:
            kinds[byte] = 8
        elif letter in "-'\"()":
            kinds[byte] = 9
        else:
            kinds[byte] = 10
    return kinds


def _letter_codes() -> np.ndarray:
    """A letter whatever its case, else one of a few other codes."""
    codes = np.full(256, 31, np.int64)
    codes[:128] = 30
    codes[list(SPACES)] = 0
    for i in range(26):
        codes[ord("a") + i] = codes[ord("A") + i] = i + 1
    codes[0xC3] = 29
    return codes


_KIND, _CODE = _byte_kinds(), _letter_codes()
_PAIR_BUCKET = np.random.default_rng(11).integers(0, _PAIRS, _LETTERS * _LETTERS)
_IS_UPPER = np.array([chr(b).isupper() and b < 128 for b in range(256)])
_IS_LOWER = np.array([chr(b).islower() and b < 128 for b in range(256)])
_CLOSES, _IS_SYMBOL = np.isin(np.arange(256), list(_CLOSING)), np.isin(np.arange(256), list(_SYMBOLS))
WIDTH = _KINDS + 10 + _PAIRS


# ------------------------------------------------------------------ passages


def encode_together(texts: list[bytes], words_each: int) -> tuple[np.ndarray, np.ndarray]:
    """Encodings of all passages of the texts in order, and the passages of each text."""
    joined = b"\n".join(texts) + b"\n"
    raw = np.frombuffer(joined, np.uint8)
    first, end = word_bounds(joined)
    text_end = np.cumsum([len(t) + 1 for t in texts])
    text_of = np.searchsorted(text_end, first, "right")
    words = np.bincount(text_of, minlength=len(texts))
    passages = np.maximum(1, -(-words // words_each))
    base = np.cumsum(passages) - passages
    number = np.arange(len(first)) - (np.cumsum(words) - words)[text_of]
    of_word = base[text_of] + number // words_each
    count = int(passages.sum())

    begins = np.zeros(count, np.int64)
    opening = number % words_each == 0
    begins[of_word[opening]] = first[opening]
    begins[base] = text_end - [len(t) + 1 for t in texts]
    sizes = np.diff(np.append(begins, len(raw)))
    of_byte = np.repeat(np.arange(count), sizes)

    kinds = np.bincount(of_byte * _KINDS + _KIND[raw], minlength=count * _KINDS)
    kinds = kinds.reshape(count, _KINDS) / np.maximum(sizes, 1)[:, None]
    codes = _CODE[raw]
    # No pair reaches from one text into the next.
    following = np.append(codes[1:], 0)
    following[text_end - 1] = 0
    buckets = _PAIR_BUCKET[codes * _LETTERS + following]
    pairs = np.bincount(of_byte * _PAIRS + buckets, minlength=count * _PAIRS)
    pairs = np.sqrt(pairs.reshape(count, _PAIRS) / np.maximum(sizes, 1)[:, None])
    return np.hstack([kinds, _word_features(raw, joined, first, end, of_word, count, words_each), pairs]).astype(
        np.float32
    ), passages


def _word_features(raw, joined, first, end, of_word, count, words_each) -> np.ndarray:
    found = np.zeros((count, 10))
    if not len(first):
        return found

    def per_passage(values) -> np.ndarray:
        return np.bincount(of_word, values, count)

    words = np.bincount(of_word, minlength=count)
    n = np.maximum(words, 1)
    lengths = (end - first).astype(np.float64)
    mean = per_passage(lengths) / n
    spread = np.sqrt(np.maximum(per_passage(lengths**2) / n - mean**2, 0))
    hashes = word_hashes(joined)
    order = np.lexsort((hashes, of_word))
    sorted_hash, sorted_of = hashes[order], of_word[order]
    fresh = np.append(True, (sorted_hash[1:] != sorted_hash[:-1]) | (sorted_of[1:] != sorted_of[:-1]))
    distinct = np.bincount(sorted_of[fresh], minlength=count)
    runs = np.diff(np.append(np.flatnonzero(fresh), len(fresh)))
    most = np.zeros(count)
    np.maximum.at(most, sorted_of[fresh], runs)
    again = np.append(False, (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1]))
    found[:, 0] = words / words_each
    found[:, 1] = mean / 8
    found[:, 2] = spread / 8
    found[:, 3] = distinct / n
    found[:, 4] = most / n
    found[:, 5] = per_passage(again) / n
    found[:, 6] = per_passage(_IS_UPPER[raw[first]]) / n
    second = raw[np.minimum(first + 1, end - 1)]
    found[:, 7] = per_passage(_IS_UPPER[raw[first]] & _IS_UPPER[second]) / n
    found[:, 8] = per_passage(_CLOSES[raw[end - 1]]) / n
    found[:, 9] = per_passage(_IS_SYMBOL[raw[end - 1]]) / n
    return found


def encode_each(texts: Iterator[bytes], words_each: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of texts with their encodings; a text is never split over two runs."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        if len(text) > _PART:
            if held:
                yield encode_together(held, words_each)
            parts = [encode_together([part], words_each)[0] for part in split_text(text, _PART)]
            yield np.vstack(parts), np.array([sum(len(p) for p in parts)])
            held, size = [], 0
            continue
        held.append(text)
        size += len(text)
        if size > _TOGETHER:
            yield encode_together(held, words_each)
            held, size = [], 0
    if held:
        yield encode_together(held, words_each)


# --------------------------------------------------------------------- model


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class MilModel:
    """``scale`` holds mean and spread of the encodings, ``parts`` the learned arrays."""

    scale: tuple[np.ndarray, np.ndarray]
    parts: dict[str, np.ndarray]

    def forward(self, encoded: np.ndarray, passages: np.ndarray) -> dict[str, np.ndarray]:
        p = self.parts
        starts = np.cumsum(passages) - passages
        x = np.clip((encoded - self.scale[0]) / self.scale[1], -6, 6)
        hidden = np.tanh(x @ p["encode"] + p["shift"])
        wide, gate = np.tanh(hidden @ p["wide"]), _sigmoid(hidden @ p["gate"])
        raw = (wide * gate) @ p["focus"]
        raw = np.exp(raw - np.repeat(np.maximum.reduceat(raw, starts), passages))
        weight = raw / np.repeat(np.add.reduceat(raw, starts), passages)
        bag = np.add.reduceat(weight[:, None] * hidden, starts)
        logit = bag @ p["out"] + p["bias"][0]
        return {
            "x": x, "hidden": hidden, "wide": wide, "gate": gate, "weight": weight, "bag": bag,
            "logit": logit, "score": _sigmoid(logit),
        }

    def gradients(
        self, encoded: np.ndarray, passages: np.ndarray, labels: np.ndarray, ridge: float
    ) -> tuple[float, dict[str, np.ndarray]]:
        p, at = self.parts, self.forward(encoded, passages)
        starts = np.cumsum(passages) - passages
        n = len(labels)
        loss = (np.logaddexp(0, at["logit"]) - labels * at["logit"]).mean()
        loss += ridge * sum((w**2).sum() for w in p.values()) / 2
        off = (at["score"] - labels) / n
        d_bag = np.repeat(off[:, None] * p["out"][None, :], passages, axis=0)
        d_weight = (d_bag * at["hidden"]).sum(1)
        common = np.repeat(np.add.reduceat(at["weight"] * d_weight, starts), passages)
        d_raw = at["weight"] * (d_weight - common)
        d_product = d_raw[:, None] * p["focus"][None, :]
        d_wide = d_product * at["gate"] * (1 - at["wide"] ** 2)
        d_gate = d_product * at["wide"] * at["gate"] * (1 - at["gate"])
        d_hidden = at["weight"][:, None] * d_bag + d_wide @ p["wide"].T + d_gate @ p["gate"].T
        d_inner = d_hidden * (1 - at["hidden"] ** 2)
        slopes = {
            "encode": at["x"].T @ d_inner,
            "shift": d_inner.sum(0),
            "wide": at["hidden"].T @ d_wide,
            "gate": at["hidden"].T @ d_gate,
            "focus": (at["wide"] * at["gate"]).T @ d_raw,
            "out": at["bag"].T @ off,
            "bias": np.array([off.sum()]),
        }
        return loss, {name: slope + ridge * p[name] for name, slope in slopes.items()}


def _fresh(scale: tuple[np.ndarray, np.ndarray], width: int, rules: MilRules) -> MilModel:
    rng = np.random.default_rng(rules.seed)

    def drawn(*shape: int) -> np.ndarray:
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

    return MilModel(
        scale,
        {
            "encode": drawn(width, rules.hidden),
            "shift": np.zeros(rules.hidden),
            "wide": drawn(rules.hidden, rules.gates),
            "gate": drawn(rules.hidden, rules.gates),
            "focus": drawn(rules.gates),
            "out": drawn(rules.hidden),
            "bias": np.zeros(1),
        },
    )


def fit(
    encoded: np.ndarray, passages: np.ndarray, labels: np.ndarray, rules: MilRules = MilRules()
) -> MilModel:
    """Adam on the whole sample; without both labels, a constant."""
    good = float(labels.sum()) if len(labels) else 0.0
    if not 0 < good < len(labels):
        share = (good + 0.5) / (len(labels) + 1)
        model = _fresh((np.zeros(WIDTH), np.ones(WIDTH)), WIDTH, rules)
        for part in model.parts.values():
            part[...] = 0
        model.parts["bias"][0] = np.log(share / (1 - share))
        return model
    mean, spread = encoded.mean(0, np.float64), encoded.std(0, dtype=np.float64)
    # Features that hardly vary in the sample must not decide when they do elsewhere.
    model = _fresh((mean, np.maximum(spread, 0.02)), encoded.shape[1], rules)
    rate = good / len(labels)
    model.parts["bias"][0] = np.log(rate / (1 - rate))
    first = {name: np.zeros_like(part) for name, part in model.parts.items()}
    second = {name: np.zeros_like(part) for name, part in model.parts.items()}
    for step in range(1, rules.steps + 1):
        _, slopes = model.gradients(encoded, passages, labels, rules.ridge)
        for name, slope in slopes.items():
            first[name] = 0.9 * first[name] + 0.1 * slope
            second[name] = 0.999 * second[name] + 0.001 * slope**2
            steady = first[name] / (1 - 0.9**step)
            swing = np.sqrt(second[name] / (1 - 0.999**step))
            model.parts[name] -= rules.rate * steady / (swing + 1e-8)
    return model


# ------------------------------------------------------------------ Spark side


def held_out(rules: MilRules) -> Column:
    fold = F.crc32(F.col("doc_id").cast("string")) % rules.folds
    return F.coalesce(fold == rules.held_fold, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, rules: MilRules
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Encodings, passages per document and labels of the bounded sample."""
    marked = (
        labels.where("quality is not null and doc_id is not null")
        .where(~held_out(rules))
        .groupBy(F.col("doc_id").cast("long").alias("label_id"))
        .agg((F.max("quality") > 0).cast("int").alias("quality"))
    )
    chosen = marked.orderBy(F.xxhash64("label_id"), "label_id").limit(rules.sample_documents)
    texts = docs.select(F.col("doc_id").cast("long").alias("label_id"), "text").join(
        F.broadcast(chosen), "label_id"
    )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for values, passages in encode_each(byte_values(batch.column(1)), rules.passage_words):
                for rows in np.split(values, np.cumsum(passages)[:-1]):
                    at = np.unique(np.linspace(0, len(rows) - 1, rules.sample_passages).astype(int))
                    out.append(rows[at].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.binary()), batch.column(2).cast(pa.int32())],
                names=["label_id", "encoded", "quality"],
            )

    rows = texts.select("label_id", "text", "quality").mapInArrow(
        encoded, "label_id long, encoded binary, quality int"
    )
    one_text = F.min(F.struct(F.sha2("encoded", 256).alias("digest"), "encoded", "quality"))
    found = rows.groupBy("label_id").agg(one_text.alias("row")).select("label_id", "row.*")
    table = found.toPandas().sort_values("label_id")
    if not len(table):
        return np.zeros((0, WIDTH), np.float32), np.zeros(0, int), np.zeros(0)
    bags = [np.frombuffer(b, np.float32).reshape(-1, WIDTH) for b in table["encoded"]]
    return np.vstack(bags), np.array([len(b) for b in bags]), table["quality"].to_numpy(np.float64)


def score_passages(
    docs: DataFrame, labels: DataFrame, rules: MilRules = MilRules()
) -> DataFrame:
    """One row per document: its score, and the passage that attention weighs most."""
    model = fit(*labelled_sample(docs, labels, rules), rules)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, counts, focus, weights = [], [], [], []
            for encoded, passages in encode_each(byte_values(batch.column(2)), rules.passage_words):
                at = shared.value.forward(encoded, passages)
                scores.append(at["score"])
                counts.append(passages)
                for weight in np.split(at["weight"], np.cumsum(passages)[:-1]):
                    top = int(weight.argmax())
                    focus.append(top * rules.passage_words)
                    weights.append(float(weight[top]))
            score = np.concatenate(scores) if scores else np.zeros(0)
            passages = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(score, pa.float64()),
                    pa.array((score >= rules.threshold).astype(np.int32)),
                    pa.array(passages, pa.int64()),
                    pa.array(focus, pa.int64()),
                    pa.array(weights, pa.float64()),
                ],
                names=["doc_id", "held_out", "score", "predicted", "n_passages", "focus_word", "focus_weight"],
            )

    picked = docs.select(F.col("doc_id").cast("long"), held_out(rules).alias("held_out"), "text")
    return picked.mapInArrow(
        scored,
        "doc_id long, held_out boolean, score double, predicted int, n_passages long, "
        "focus_word long, focus_weight double",
    )
