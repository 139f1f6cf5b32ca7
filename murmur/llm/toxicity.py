"""Toxicity: a classifier whose scores hardly change when groups are swapped.

A logistic model over the presence of words is fitted on a bounded sample of labelled
documents. For every labelled text that mentions a group, the mention is swapped for other
groups of its kind and for a neutral term; the squared change of the logit is part of the
loss, so naming a group neither makes nor unmakes a toxic text. Words enter the model if
their share differs clearly between the labels; identity terms always do.

Labels, language, source and doc_id are no inputs of a score. Null and empty texts score
as texts without any known word. Labels that are null are ignored; of several labels for a
document the greatest counts. Without both labels in the sample every score is the share
of toxic texts in it (0.5 without a sample, less by a trifle).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Terms for groups of people, by kind; the first of each is neutral.
IDENTITIES = (
    ("people", "women", "men", "girls", "boys", "trans", "gay", "lesbian", "straight", "queer"),
    ("person", "woman", "man", "girl", "boy"),
    ("believers", "muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("believer", "muslim", "christian", "jew", "hindu", "buddhist", "atheist"),
    ("citizens", "immigrants", "foreigners", "refugees", "americans", "africans", "asians", "europeans"),
    ("humans", "blacks", "whites", "latinos", "arabs"),
    ("leute", "frauen", "männer", "muslime", "christen", "juden", "ausländer", "flüchtlinge"),
    ("gens", "femmes", "hommes", "musulmans", "chrétiens", "juifs", "étrangers", "réfugiés"),
    ("gente", "mujeres", "hombres", "musulmanes", "cristianos", "judíos", "extranjeros", "refugiados"),
)
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class ToxicityRules:
    folds: int = 5
    held_fold: int = 0
    sample_documents: int = 12_000
    least_documents: int = 5
    clear: float = 4.0
    most_words: int = 4_000
    ridge: float = 1e-3
    counterfactual: float = 10.0
    steps: int = 60


def held_out(rules: ToxicityRules) -> Column:
    fold = F.crc32(F.col("doc_id").cast("string")) % rules.folds
    return F.coalesce(fold == rules.held_fold, F.lit(False))


def known_words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


@dataclass
class ToxicModel:
    bias: float
    weights: dict[str, float]

    def score(self, text: str | None) -> float:
        found = known_words(text) & self.weights.keys()
        logit = self.bias + sum(self.weights[word] for word in sorted(found))
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def swaps(words: set[str]) -> Iterator[tuple[str, str]]:
    """(term, its replacement) for every group that the words mention."""
    for kind in IDENTITIES:
        for term in kind:
            if term in words:
                yield from ((term, other) for other in kind if other not in words)


def fit(sample: list[tuple[set[str], int]], rules: ToxicityRules = ToxicityRules()) -> ToxicModel:
    """Newton steps on logistic loss, ridge and counterfactual penalty."""
    labels = np.array([label for _, label in sample], np.float64)
    toxic = labels.sum()
    if not 0 < toxic < len(labels):
        share = min(max((toxic + 0.49) / (len(labels) + 1), 1e-6), 1 - 1e-6)
        return ToxicModel(float(np.log(share / (1 - share))), {})
    of_toxic, of_all = Counter(), Counter()
    for words, label in sample:
        of_all.update(words)
        if label:
            of_toxic.update(words)
    rate = toxic / len(labels)

    def clearness(word: str) -> float:
        n = of_all[word]
        return abs(of_toxic[word] - n * rate) / np.sqrt(n * rate * (1 - rate))

    identities = sorted({term for kind in IDENTITIES for term in kind})
    clear = {w: clearness(w) for w, n in of_all.items() if n >= rules.least_documents}
    chosen = sorted((w for w, z in clear.items() if z >= rules.clear), key=lambda w: (-clear[w], w))
    names = list(dict.fromkeys(identities + chosen[: rules.most_words]))
    number = {word: i + 1 for i, word in enumerate(names)}
    width = len(names) + 1
    rows = [np.array([0, *sorted(number[w] for w in words if w in number)]) for words, _ in sample]
    flat, ends = np.concatenate(rows), np.cumsum([len(r) for r in rows])
    starts = ends - [len(r) for r in rows]

    penalty = np.full((width, 1), rules.ridge * len(labels)) * np.eye(width)
    penalty[0, 0] = 1e-9
    share = rules.counterfactual
    for words, _ in sample:
        for term, other in swaps(words):
            a, b = number[term], number[other]
            penalty[a, a] += share
            penalty[b, b] += share
            penalty[a, b] -= share
            penalty[b, a] -= share
    weights = np.zeros(width)
    weights[0] = np.log(rate / (1 - rate))
    step = 1.0
    def loss(w: np.ndarray) -> float:
        logit = np.add.reduceat(w[flat], starts)
        return float(np.logaddexp(0, logit).sum() - labels @ logit + w @ penalty @ w / 2)

    before = loss(weights)
    row_of = np.repeat(np.arange(len(rows)), ends - starts)
    for _ in range(rules.steps):
        chance = 1 / (1 + np.exp(-np.clip(np.add.reduceat(weights[flat], starts), -30, 30)))
        gradient = np.bincount(flat, (chance - labels)[row_of], width) + penalty @ weights
        # The diagonal bounds the curvature well enough for sparse presences.
        spread = (chance * (1 - chance))[row_of]
        sizes = (ends - starts)[row_of]
        curve = np.bincount(flat, spread * sizes, width) + np.abs(penalty).sum(1) + 1e-9
        move = gradient / curve
        step = min(1.0, step * 2)
        while step > 1e-6 and loss(weights - step * move) > before:
            step /= 2
        weights = weights - step * move
        after = loss(weights)
        if before - after < 1e-7 * before:
            break
        before = after
    return ToxicModel(float(weights[0]), {w: float(weights[i]) for w, i in number.items() if weights[i]})


def labelled_sample(docs: DataFrame, labels: DataFrame, rules: ToxicityRules) -> list:
    """Words and label of at most ``sample_documents`` documents, chosen by hash of doc_id."""
    marked = (
        labels.where("toxic is not null and doc_id is not null")
        .where(~held_out(rules))
        .groupBy(F.col("doc_id").cast("long").alias("label_id"))
        .agg(F.max("toxic").alias("toxic"))
    )
    chosen = marked.orderBy(F.xxhash64("label_id"), "label_id").limit(rules.sample_documents)
    texts = docs.select(F.col("doc_id").cast("long").alias("label_id"), "text").join(
        F.broadcast(chosen), "label_id"
    )

    def worded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [" ".join(sorted(known_words(t.as_py()))) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.string()), batch.column(2).cast(pa.int32())],
                names=["label_id", "words", "toxic"],
            )

    rows = texts.select("label_id", "text", "toxic").mapInArrow(
        worded, "label_id long, words string, toxic int"
    )
    found = rows.dropDuplicates(["label_id"]).toPandas().sort_values("label_id")
    # One string per distinct word, however many documents have it.
    one: dict[str, str] = {}
    return [
        ({one.setdefault(word, word) for word in words.split(" ")}, int(toxic > 0))
        for words, toxic in zip(found["words"], found["toxic"])
    ]


def score_toxicity(
    docs: DataFrame, labels: DataFrame, rules: ToxicityRules = ToxicityRules()
) -> DataFrame:
    """One row per document: score between 0 and 1, and whether it is at least one half."""
    model = fit(labelled_sample(docs, labels, rules), rules)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [shared.value.score(text.as_py()) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    picked = docs.select(F.col("doc_id").cast("long"), held_out(rules).alias("held_out"), "text")
    return picked.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
