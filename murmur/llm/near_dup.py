"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text is the weighted set of its runs of five words. A shingle weighs its count times its
inverse document frequency. Document frequencies above a floor share are exact; below it
the weight is capped, so the table that tasks need is bounded by the mean text length
divided by that share, whatever the corpus size.

Equal texts are one class from the start. Each class draws consistent weighted samples,
which are banded. Within a bucket every class is compared with the least one, then with one of
the last component where that leaves the bucket in several. Classes of buckets still split
are banded again, more finely, and compared within the fine buckets. What is then still split
is settled by an exact prefix-filtered join, so every pair of classes of one bucket is linked,
in one component already, or proven to be below the threshold. Links are weighted Jaccard
similarities of at least ``threshold``; groups are connected components, named by their least
doc_id.

Texts without words have no shingles and are grouped with equal texts only. Rows without
doc_id share the group of rows with the same text; a text that only such rows carry has no
group (null).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import byte_values, stored
from murmur.llm.components import connected
from murmur.llm.hashing import each_word_hashes, mixed, shingle_hashes, word_hashes


@dataclass(frozen=True)
class Sampling:
    shingle_words: int = 5
    threshold: float = 0.8
    bands: int = 16
    rows: int = 5
    frequency_floor: float = 1 / 20
    block_shingles: int = 8_000_000
    leader_rounds: int = 2
    fine_bands: int = 64
    fine_rows: int = 11

    @property
    def draws(self) -> int:
        return self.bands * self.rows

    @property
    def top_weight(self) -> float:
        return math.log(1 + 1 / self.frequency_floor)


_CELLS = 1 << 16
_SHIFT = np.uint64(48)
#: Cells of the counts that order shingles, and 64-bit words of a text's parity sketch.
_ORDER_BITS = 20
_SKETCH_WORDS = 8
#: For the rounding of sums of weights, wherever a bound decides.
_SLACK = 1e-6


@lru_cache(maxsize=2)
def _variates(draws: int):
    """Per draw and cell: r, beta and ln c of the sampling scheme, and a salt per draw."""
    rng = np.random.default_rng(20_240_501)
    r = rng.gamma(2.0, 1.0, (draws, _CELLS)).astype(np.float32)
    log_c = np.log(rng.gamma(2.0, 1.0, (draws, _CELLS))).astype(np.float32)
    beta = rng.random((draws, _CELLS), dtype=np.float32)
    salts = rng.integers(1, 1 << 63, draws, dtype=np.uint64) | np.uint64(1)
    return r, log_c, beta, salts


@lru_cache(maxsize=2)
def _for_weight(draws: int, weight: float):
    r, log_c, beta, _ = _variates(draws)
    step = np.floor(math.log(weight) / r + beta)
    return (log_c - r * (step - beta) - r).astype(np.float32), step.astype(np.int32)


def weighted_set(words: np.ndarray, rules: Sampling, heavy: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a text's word hashes, ascending, and their weights."""
    shingles, counts = np.unique(shingle_hashes(words, rules.shingle_words), return_counts=True)
    return shingles, counts * _idf(shingles, rules, heavy)


def _idf(shingles: np.ndarray, rules: Sampling, heavy: tuple) -> np.ndarray:
    idf = np.full(len(shingles), rules.top_weight)
    known, weights = heavy
    if len(known) and len(shingles):
        at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
        hit = known[at] == shingles
        idf[hit] = weights[at[hit]]
    return idf


def similarity(left: tuple, right: tuple) -> float:
    """Weighted Jaccard: shared minimum weight over joint maximum weight."""
    _, i, j = np.intersect1d(left[0], right[0], assume_unique=True, return_indices=True)
    least = np.minimum(left[1][i], right[1][j]).sum()
    total = left[1].sum() + right[1].sum() - least
    return float(least / total) if total > 0 else 0.0


def samples(shingles: np.ndarray, weights: np.ndarray, rules: Sampling) -> np.ndarray:
    """One identifier (shingle and quantised weight) per draw."""
    draws = rules.draws
    r, log_c, beta, salts = _variates(draws)
    ln_top, step_top = _for_weight(draws, rules.top_weight)
    every = np.arange(draws)
    offsets = every[:, None] * _CELLS
    best = np.full(draws, np.inf)
    chosen = np.zeros(draws, np.uint64)
    usual = weights == rules.top_weight
    for is_usual, mask in ((True, usual), (False, ~usual)):
        items, sizes = shingles[mask], weights[mask]
        for start in range(0, len(items), 1 << 12):
            part = items[start : start + (1 << 12)]
            cell = np.multiply.outer(salts, part)
            cell >>= _SHIFT
            cell = cell.view(np.int64)
            cell += offsets
            if is_usual:
                ln_a, step = np.take(ln_top, cell, mode="clip"), None
            else:
                log_size = np.log(sizes[start : start + (1 << 12)])[None, :]
                own_r, own_beta = np.take(r, cell), np.take(beta, cell)
                step = np.floor(log_size / own_r + own_beta)
                ln_a = np.take(log_c, cell) - own_r * (step - own_beta) - own_r
            least = ln_a.argmin(axis=1)
            value = ln_a[every, least]
            if is_usual:
                t = np.take(step_top, cell[every, least])
            else:
                t = step[every, least].astype(np.int32)
            better = value < best
            best = np.where(better, value, best)
            token = mixed(part[least] ^ mixed(t.astype(np.int64).astype(np.uint64)))
            chosen = np.where(better, token, chosen)
    return chosen


def band_hashes(drawn: np.ndarray, rules: Sampling) -> np.ndarray:
    grouped = drawn.reshape(rules.bands, rules.rows)
    total = np.arange(1, rules.bands + 1, dtype=np.uint64)
    for column in range(rules.rows):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + grouped[:, column])
    return total.view(np.int64)


def _heavy_shingles(docs: DataFrame, rules: Sampling) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in at least the floor share of all documents, with their weights.

    A shingle above that share is above half of it in some block of documents, and the
    blocks where it stays below half lose less than half of its count. So blocks emit what
    reaches half the share in them, what sums up to half the share overall is a candidate
    (at most twice the mean text length over the share), and a second pass counts
    candidates exactly.
    """
    spark = docs.sparkSession
    total = docs.count()
    floor, width, limit = rules.frequency_floor, rules.shingle_words, rules.block_shingles

    def distinct(texts: pa.Array) -> Iterator[np.ndarray]:
        for words in each_word_hashes(byte_values(texts)):
            yield np.unique(shingle_hashes(words, width))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, n_docs = [], 0, 0

        def counted() -> pa.RecordBatch:
            found, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= floor / 2 * n_docs
            return pa.RecordBatch.from_arrays(
                [pa.array(found[often].view(np.int64)), pa.array(counts[often])],
                names=["shingle", "n"],
            )

        for batch in batches:
            for found in distinct(batch.column(0)):
                held.append(found)
                size += len(held[-1])
                n_docs += 1
                if size > limit:
                    yield counted()
                    held, size, n_docs = [], 0, 0
        if held:
            yield counted()

    schema = "shingle long, n long"
    texts = docs.select("text")
    likely = (
        texts.mapInArrow(blocks, schema)
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= floor / 2 * total)
        .toPandas()
    )
    wanted = np.sort(likely["shingle"].to_numpy(np.int64).view(np.uint64))
    if not len(wanted):
        return wanted, np.empty(0)
    shared = spark.sparkContext.broadcast(wanted)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        counts = np.zeros(len(known), np.int64)
        for batch in batches:
            for found in distinct(batch.column(0)):
                at = np.minimum(np.searchsorted(known, found), len(known) - 1)
                counts[at[known[at] == found]] += 1
        some = counts > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(known[some].view(np.int64)), pa.array(counts[some])],
            names=["shingle", "n"],
        )

    sure = (
        texts.mapInArrow(exact, schema)
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= floor * total)
        .toPandas()
    )
    keys = sure["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    weights = np.log1p(total / sure["n"].to_numpy(np.float64))
    return keys[order], weights[order]


def text_digest() -> Column:
    """Names a text; null counts as empty."""
    return F.md5(F.coalesce(F.col("text"), F.lit("")))


def _signed(docs: DataFrame, rules: Sampling, shared) -> DataFrame:
    """doc_id, digest, total weight and bands; a task leaves out bands of texts it has seen."""
    names = [f"band_{i}" for i in range(rules.bands)]
    columns = ", ".join(f"{name} long" for name in names)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            weights, bands = [], []
            hashed = each_word_hashes(byte_values(batch.column(2)))
            for digest, words in zip(batch.column(1).to_pylist(), hashed):
                if digest in seen:
                    weights.append(None)
                    bands.append([None] * rules.bands)
                    continue
                seen.add(digest)
                items, sizes = weighted_set(words, rules, shared.value)
                weights.append(float(sizes.sum()))
                if len(items):
                    bands.append(band_hashes(samples(items, sizes, rules), rules).tolist())
                else:
                    bands.append([None] * rules.bands)
            arrays = [pa.array([row[i] for row in bands], pa.int64()) for i in range(rules.bands)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(weights, pa.float64()), *arrays],
                names=["doc_id", "digest", "weight", *names],
            )

    picked = docs.select(F.col("doc_id").cast("long"), text_digest().alias("digest"), "text")
    return picked.mapInArrow(sign, f"doc_id long, digest string, weight double, {columns}")


def _verified(pairs: DataFrame, texts: DataFrame, rules: Sampling, shared) -> DataFrame:
    """Pairs (a, b) with their similarity, as a written table."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last = None, None
        for batch in batches:
            found = []
            keys = batch.column(1).to_pylist()
            members = each_word_hashes(byte_values(batch.column(2)))
            for key, words, other in zip(keys, members, byte_values(batch.column(3))):
                if key != last_key:
                    last_key, last = key, weighted_set(word_hashes(other), rules, shared.value)
                found.append(similarity(weighted_set(words, rules, shared.value), last))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.float64())],
                names=["a", "b", "similarity"],
            )

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return stored(joined.mapInArrow(compare, "a long, b long, similarity double"), "compared")


def _fine_pairs(nodes: DataFrame, texts: DataFrame, rules: Sampling, shared) -> DataFrame:
    """Candidate pairs (x, y) among nodes of different parts, by longer bands.

    Long bands tell 0.6 from 0.8, where short ones put thousands of classes in a bucket.
    Each band is a fixed choice of the drawn samples. Within a bucket, all are compared
    with its least and its greatest node.
    """
    width = rules.fine_rows
    rng = np.random.default_rng(77)
    picks = np.stack(
        [rng.choice(rules.draws, width, replace=False) for _ in range(rules.fine_bands)]
    )

    def band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salts = np.arange(1, rules.fine_bands + 1, dtype=np.uint64)
        for batch in batches:
            values = []
            for words in each_word_hashes(byte_values(batch.column(2))):
                drawn = samples(*weighted_set(words, rules, shared.value), rules)
                total = salts
                for column in range(width):
                    total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + drawn[picks[:, column]])
                values.append(total.view(np.int64))
            nodes_of = np.repeat(batch.column(0).to_numpy(), rules.fine_bands)
            parts_of = np.repeat(batch.column(1).to_numpy(), rules.fine_bands)
            flat = np.concatenate(values) if values else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes_of), pa.array(parts_of), pa.array(flat)],
                names=["node", "part", "value"],
            )

    fine = stored(
        nodes.join(texts, "node")
        .select("node", "part", "text")
        .mapInArrow(band, "node long, part long, value long"),
        "fine",
    )
    ends = (
        fine.groupBy("value")
        .agg(
            F.min("node").alias("low"),
            F.max("node").alias("high"),
            F.min_by("part", "node").alias("low_part"),
            F.max_by("part", "node").alias("high_part"),
        )
        .where("low != high")
    )
    met = fine.join(ends, "value")
    low = met.where("part != low_part").select(F.col("node").alias("x"), F.col("low").alias("y"))
    high = met.where("part != high_part").select(F.col("node").alias("x"), F.col("high").alias("y"))
    return low.union(high)


def _order_counts(unsettled: DataFrame, rules: Sampling) -> np.ndarray:
    """Texts per hashed cell of shingles, of a fixed size; each task leaves out its rare cells.

    The counts only order shingles from rare to frequent. Any order gives the same links.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << _ORDER_BITS, np.int64)
        for batch in batches:
            for words in each_word_hashes(byte_values(batch.column(0))):
                found = np.unique(shingle_hashes(words, rules.shingle_words))
                np.add.at(counts, found >> np.uint64(64 - _ORDER_BITS), 1)
        often = np.flatnonzero(counts > 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(often, pa.int64()), pa.array(counts[often], pa.int64())], names=["cell", "n"]
        )

    found = (
        unsettled.select("text")
        .mapInArrow(count, "cell long, n long")
        .groupBy("cell")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    counts = np.zeros(1 << _ORDER_BITS, np.int64)
    counts[found["cell"].to_numpy()] = found["n"].to_numpy()
    return counts


def _sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity of the shingles per cell: cells that differ are fewer than shingles that do."""
    cells = (shingles & np.uint64(64 * _SKETCH_WORDS - 1)).astype(np.int64)
    odd = (np.bincount(cells, minlength=64 * _SKETCH_WORDS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _prefixes(unsettled: DataFrame, rules: Sampling, shared) -> DataFrame:
    """A row per shingle of each text's prefix: node, part, total weight, weight before it, sketch.

    A text ends its prefix where the weight left is below ``threshold`` of its own: texts that
    share that much share a shingle of both prefixes.
    """
    order = unsettled.sparkSession.sparkContext.broadcast(_order_counts(unsettled, rules))
    names = [f"sketch_{i}" for i in range(_SKETCH_WORDS)]

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, totals, sketches = [], [], []
            found, ahead = [np.empty(0, np.uint64)], [np.empty(0)]
            for words in each_word_hashes(byte_values(batch.column(2))):
                items, sizes = weighted_set(words, rules, shared.value)
                cells = order.value[items >> np.uint64(64 - _ORDER_BITS)]
                at = np.lexsort((items, cells))
                total = sizes.sum()
                before = np.cumsum(sizes[at]) - sizes[at]
                kept = before <= (1 - rules.threshold) * total + _SLACK
                found.append(items[at][kept])
                ahead.append(before[kept])
                lengths.append(int(kept.sum()))
                totals.append(total)
                # heavy shingles are left out: each one counted weighs the top weight at least
                plain = _idf(items, rules, shared.value) == rules.top_weight
                sketches.append(_sketch(items[plain]))
            bits = np.stack(sketches) if sketches else np.empty((0, _SKETCH_WORDS), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(found).view(np.int64)),
                    pa.array(np.repeat(batch.column(0).to_numpy(), lengths)),
                    pa.array(np.repeat(batch.column(1).to_numpy(), lengths)),
                    pa.array(np.repeat(np.array(totals, np.float64), lengths)),
                    pa.array(np.concatenate(ahead)),
                    *(pa.array(np.repeat(bits[:, i], lengths)) for i in range(_SKETCH_WORDS)),
                ],
                names=["shingle", "node", "part", "weight", "ahead", *names],
            )

    columns = ", ".join(f"{name} long" for name in names)
    return unsettled.mapInArrow(
        prefix, f"shingle long, node long, part long, weight double, ahead double, {columns}"
    )


def _settling_pairs(nodes: DataFrame, texts: DataFrame, rules: Sampling, shared) -> DataFrame:
    """Pairs (x, y) of different parts: all that can reach the threshold among the nodes.

    Similar texts share ``threshold / (1 + threshold)`` of their joint weight. So what is left
    of either from their first shared shingle on weighs that much, and the shingles that only
    one has weigh no more than the rest; parity sketches bound those from below. A shingle's
    rows in its most frequent part meet only the rows outside of it.
    """
    unsettled = stored(nodes.join(texts, "node").select("text", "node", "part"), "unsettled")
    rows = stored(
        _prefixes(unsettled.select("node", "part", "text"), rules, shared), "prefixes"
    )
    mains = (
        rows.groupBy("shingle", "part")
        .count()
        .groupBy("shingle")
        .agg(F.max_by("part", F.struct("count", "part")).alias("main"), F.count("*").alias("parts"))
        .where("parts > 1")
        .select("shingle", "main")
    )
    met = stored(rows.join(mains, "shingle"), "met")
    own = met.where("part != main").select("shingle", *(F.col(n).alias(f"x_{n}") for n in _sides()))
    other = met.select("shingle", *(F.col(n).alias(f"y_{n}") for n in _sides()))
    joint = F.col("x_weight") + F.col("y_weight")
    share = rules.threshold / (1 + rules.threshold)
    left = F.least(F.col("x_weight") - F.col("x_ahead"), F.col("y_weight") - F.col("y_ahead"))
    apart = sum(
        F.bit_count(F.col(f"x_sketch_{i}").bitwiseXOR(F.col(f"y_sketch_{i}")))
        for i in range(_SKETCH_WORDS)
    )
    possible = (
        (F.col("x_part") != F.col("y_part"))
        & (left >= share * joint - _SLACK)
        & (apart * rules.top_weight <= (1 - 2 * share) * joint + _SLACK)
    )
    return (
        own.join(other, "shingle")
        .where(possible)
        .select(F.col("x_node").alias("x"), F.col("y_node").alias("y"))
    )


def _sides() -> list[str]:
    return ["node", "part", "weight", "ahead", *(f"sketch_{i}" for i in range(_SKETCH_WORDS))]


def find_groups(docs: DataFrame, rules: Sampling = Sampling()) -> tuple[DataFrame, DataFrame]:
    """(one row per document: doc_id, digest, class_id; the links between classes)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(_heavy_shingles(docs, rules))
    signed = stored(_signed(docs, rules, shared), "signed")
    names = [f"band_{i}" for i in range(rules.bands)]
    classes = stored(
        signed.groupBy("digest").agg(
            F.min("doc_id").alias("node"),
            F.max("weight").alias("weight"),
            *(F.max(name).alias(name) for name in names),
        ),
        "classes",
    )
    banded = stored(
        classes.where("node is not null and band_0 is not null").select(
            "node",
            "weight",
            F.posexplode(F.array(*names)).alias("band", "value"),
        ),
        "bands",
    )
    leaders = banded.groupBy("band", "value").agg(
        F.min("node").alias("leader"), F.max("node").alias("last")
    )
    shared_buckets = leaders.where("leader != last").drop("last")
    buckets = stored(banded.join(shared_buckets, ["band", "value"]), "buckets")

    members = buckets.select("node").distinct()
    owners = classes.join(members, "node", "left_semi").select("node", "digest")
    texts = stored(
        docs.select(F.col("doc_id").cast("long").alias("node"), text_digest().alias("digest"), "text")
        .join(owners, ["node", "digest"])
        .select("node", "text")
        .dropDuplicates(["node"]),
        "texts",
    )

    pairs = buckets.where("node != leader").select(F.col("node").alias("a"), F.col("leader").alias("b"))
    done = compared = _verified(pairs.distinct(), texts, rules, shared)
    close = F.col("similarity") >= rules.threshold
    for turn in range(rules.leader_rounds + 1):
        labels = connected(compared.where(close))
        split = buckets.join(labels, "node", "left").select(
            "band", "value", "node", "weight", F.coalesce("component", "node").alias("part")
        )
        ends = split.groupBy("band", "value").agg(
            F.min("part").alias("first_part"), F.max("part").alias("last_part")
        )
        open_buckets = stored(
            split.join(ends.where("first_part != last_part"), ["band", "value"]), "open"
        )
        if turn + 1 < rules.leader_rounds:
            # all members against the least member of the bucket's last component
            last = open_buckets.where("part = last_part").groupBy("band", "value").agg(
                F.min("node").alias("leader")
            )
            found = open_buckets.where("part != last_part").join(last, ["band", "value"])
            more = found.select(F.col("node").alias("x"), F.col("leader").alias("y"))
        else:
            find = _fine_pairs if turn + 1 == rules.leader_rounds else _settling_pairs
            more = find(open_buckets.select("node", "part").distinct(), texts, rules, shared)
        ordered = more.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
        fresh = ordered.distinct().join(done.select("a", "b"), ["a", "b"], "left_anti")
        compared = done.union(_verified(fresh, texts, rules, shared))
        done = compared
    links = compared.where(close)
    labels = connected(links)
    grouped = (
        signed.select("doc_id", "digest")
        .join(classes.select("digest", "node"), "digest", "left")
        .join(labels, "node", "left")
        .select("doc_id", "digest", F.coalesce("component", "node").alias("class_id"))
    )
    return grouped, links


def near_duplicates(docs: DataFrame, rules: Sampling = Sampling()) -> DataFrame:
    """One row per document: doc_id, class_id (least doc_id of its group), representative."""
    grouped, _ = find_groups(docs, rules)
    kept = F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False))
    return grouped.select("doc_id", "class_id", kept.alias("representative"))


def keep_one_of_each(docs: DataFrame, rules: Sampling = Sampling()) -> DataFrame:
    """One document per group, with all columns: its least doc_id, once.

    Documents of no group (without doc_id, with a text that no other has) all stay.
    """
    grouped, _ = find_groups(docs, rules)
    alone = F.col("class_id").isNull()
    owner = grouped.where(alone | (F.col("doc_id") == F.col("class_id")))
    chosen = stored(owner.select("doc_id", "digest").distinct(), "chosen")
    names = docs.columns
    key = docs.select(
        *(F.col(name).alias(f"c{i}") for i, name in enumerate(names)),
        F.col("doc_id").cast("long").alias("key_id"),
        text_digest().alias("key_digest"),
    )
    same = F.col("key_id").eqNullSafe(F.col("doc_id")) & (F.col("key_digest") == F.col("digest"))
    kept = key.join(chosen, same, "left_semi")
    with_id = kept.where("key_id is not null").dropDuplicates(["key_id", "key_digest"])
    without = kept.where("key_id is null")
    back = [F.col(f"c{i}").alias(name) for i, name in enumerate(names)]
    return with_id.select(*back).union(without.select(*back))
