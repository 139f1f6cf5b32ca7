"""Mixing sources to target weights, in fixed-length blocks of words.

Within a source, documents form one stream of words that is cut into blocks of equal
length. Every output shard draws how many of its slots each source fills: a multinomial
draw over what the sources still have to give, so that all shards together give each
source its target exactly (the draws are conditioned on the totals). A slot's ordinal in
its source is mapped to a block by a pseudorandom permutation of the source's block
numbers, another one each time the source is used up, and joined with the pieces of
documents by block number. The last slot of a source takes only as many words of its block
as are left of the target.

Null sources are a source of their own, sorted last. Null and empty texts have size 0 and
are never taken. Repeated rows count as documents of their own. The order within a stream
depends on doc_id and size only, so reruns agree. The driver handles one row per source.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm.common import SPACE_CLASS, stored


@dataclass(frozen=True)
class MixRules:
    weights: tuple[int, ...] = (5, 2, 1)
    most_epochs: int = 3
    block_words: int = 128
    shards: int = 64
    stream_parts: int = 512
    rounds: int = 6
    seed: int = 20_240_611


def word_count(text: Column) -> Column:
    pieces = F.split(F.coalesce(text, F.lit("")), rf"{SPACE_CLASS}+")
    return (
        F.size(pieces)
        - (F.get(pieces, F.lit(0)) == "").cast("int")
        - ((F.size(pieces) > 1) & (F.element_at(pieces, -1) == "")).cast("int")
    ).cast("long")


def targets(sizes: list[int], weights: list[float], most_epochs: int) -> list[float]:
    """Shares of the total by weight, none above ``most_epochs`` times its size."""
    total = float(sum(sizes))
    result = [0.0] * len(sizes)
    free = {i for i, size in enumerate(sizes) if size > 0}
    left = total
    while free:
        share = left / sum(weights[i] for i in free)
        above = {i for i in free if weights[i] * share > most_epochs * sizes[i]}
        for i in above or free:
            result[i] = float(most_epochs * sizes[i]) if above else weights[i] * share
            left -= result[i]
        if not above:
            break
        free -= above
    return result


def permuted(value: Column, size: Column, key: Column, rounds: int) -> Column:
    """A keyed permutation of 0 to size - 1: a Feistel network, walked until it is in range.

    The network works on the least even number of bits that holds ``size``, so fewer than
    four steps are needed on average; a bounded number of steps is unrolled and the few
    values still outside are walked by an aggregate over more.
    """
    half = F.ceil(F.length(F.bin(F.greatest(size - 1, F.lit(1)))) / 2).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), half) - 1

    def once(number: Column) -> Column:
        start = F.struct(
            F.call_function("shiftright", number, half).alias("l"),
            number.bitwiseAND(mask).alias("r"),
        )

        def turn(state: Column, i: Column) -> Column:
            mixed = F.xxhash64(key, i, state["r"]).bitwiseAND(mask)
            return F.struct(state["r"].alias("l"), state["l"].bitwiseXOR(mixed).alias("r"))

        return F.aggregate(
            F.sequence(F.lit(1), F.lit(rounds)),
            start,
            turn,
            lambda s: F.call_function("shiftleft", s["l"], half).bitwiseOR(s["r"]),
        )

    # Each step leaves the range with probability below 3/4; 200 steps fail in 1 of 10**25.
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(200)),
        once(value.cast("long")),
        lambda at, i: F.when(at < size, at).otherwise(once(at)),
    )


def stream_pieces(sized: DataFrame, rules: MixRules) -> DataFrame:
    """Where each document lies in its source's stream: adds ``offset``."""
    part = F.pmod(F.xxhash64("doc_id", "size"), F.lit(rules.stream_parts)).alias("part")
    parts = sized.select("*", part)
    sums = parts.groupBy("source", "part").agg(F.sum("size").alias("part_words"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        F.col("source").alias("base_source"),
        F.col("part").alias("base_part"),
        F.coalesce(F.sum("part_words").over(before), F.lit(0)).alias("base"),
    )
    inside = (
        Window.partitionBy("source", "part")
        .orderBy("doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = parts.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("base_source")) & (F.col("part") == F.col("base_part"))
    return placed.join(bases, same).select(
        "doc_id", "source", "size", (F.col("base") + F.col("inner")).alias("offset")
    )


def _slots(size: int, target: float, rules: MixRules) -> int:
    """Slots that hold the target; the last block of a stream may be short in every epoch."""
    if not size:
        return 0
    blocks = -(-size // rules.block_words)
    short = blocks * rules.block_words - size
    epochs, rest = divmod(int(target + 0.5), size)
    return epochs * blocks + (min(blocks, -(-(rest + short) // rules.block_words)) if rest else 0)


def draw_plan(sources: list[tuple], rules: MixRules) -> list[tuple]:
    """Rows (source_no, shard, first ordinal, slots) of the multinomial draws.

    ``sources`` has (source_no, size, target). The slots of a source cover its target: all
    its blocks in every full epoch, then as many as needed.
    """
    slots = np.array([_slots(size, target, rules) for _, size, target in sources], np.int64)
    rng = np.random.default_rng(rules.seed)
    left, given, rows = slots.copy(), np.zeros_like(slots), []
    for shard in range(rules.shards):
        room = int(left.sum()) // (rules.shards - shard)
        drawn = np.zeros_like(left)
        while room:
            rest = left - drawn
            more = np.minimum(rng.multinomial(room, rest / rest.sum()), rest)
            drawn += more
            room -= int(more.sum())
        for at in np.flatnonzero(drawn):
            rows.append((int(sources[at][0]), shard, int(given[at]), int(drawn[at])))
        given += drawn
        left -= drawn
    return rows


def mix(docs: DataFrame, rules: MixRules = MixRules()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sized documents with targets, pieces taken, slots).

    Pieces taken: doc_id, source_no, shard, ordinal, from_word, words. Slots: source_no,
    shard, ordinal, block, words.
    """
    spark = docs.sparkSession
    sized = stored(
        docs.select(
            F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count(F.col("text")).alias("size")
        ),
        "sized",
    )
    totals = [
        (row["source"], int(row["words"]))
        for row in sized.groupBy("source").agg(F.sum("size").alias("words")).collect()
    ]
    totals.sort(key=lambda row: (row[0] is None, row[0] or ""))
    weights = [rules.weights[i % len(rules.weights)] for i in range(len(totals))]
    goal = targets([words for _, words in totals], weights, rules.most_epochs)
    known = spark.createDataFrame(
        [(i, name, words, goal[i]) for i, (name, words) in enumerate(totals)],
        "source_no int, known_source string, source_size long, target double",
    )
    placed = stream_pieces(sized, rules)
    numbered = stored(
        placed.join(F.broadcast(known), F.col("source").eqNullSafe(F.col("known_source"))).drop(
            "known_source"
        ),
        "numbered",
    )

    plan = draw_plan([(i, words, goal[i]) for i, (_, words) in enumerate(totals)], rules)
    drawn = spark.createDataFrame(plan, "source_no int, shard int, first long, slots long")
    length = F.lit(rules.block_words)
    blocks = F.ceil(F.col("source_size") / length).cast("long")
    slots = (
        drawn.join(F.broadcast(known), "source_no")
        .repartition(rules.shards, "source_no", "shard")
        .select(
            "source_no",
            "shard",
            "source_size",
            F.floor(F.col("target") + 0.5).cast("long").alias("goal"),
            blocks.alias("blocks"),
            F.explode(F.sequence(F.col("first"), F.col("first") + F.col("slots") - 1)).alias("ordinal"),
        )
        .where((F.col("blocks") > 0))
    )
    key = F.struct("source_no", F.floor(F.col("ordinal") / F.col("blocks")).alias("epoch"), F.lit(rules.seed))
    mapped = stored(
        slots.select(
            "*",
            permuted(F.col("ordinal") % F.col("blocks"), F.col("blocks"), key, rules.rounds).alias("block"),
            F.floor(F.col("ordinal") / F.col("blocks")).alias("epoch"),
        ),
        "slots",
    )
    # words before a slot: full blocks, except for the short last block of the stream
    short = F.col("blocks") * length - F.col("source_size")
    last = mapped.where(F.col("block") == F.col("blocks") - 1).select(
        F.col("source_no").alias("last_source"),
        F.col("epoch").alias("last_epoch"),
        F.col("ordinal").alias("last_ordinal"),
    )
    same = (F.col("source_no") == F.col("last_source")) & (F.col("epoch") == F.col("last_epoch"))
    passed = F.coalesce(F.col("last_ordinal") < F.col("ordinal"), F.lit(False)).cast("long")
    begun = F.col("ordinal") * length - (F.col("epoch") + passed) * short
    slots_cut = mapped.join(last, same, "left").select(
        "source_no",
        "shard",
        "ordinal",
        "block",
        F.least(length.cast("long"), F.col("goal") - begun).alias("words"),
    ).where("words > 0")

    first_block = F.floor(F.col("offset") / length).cast("long")
    last_block = F.floor((F.col("offset") + F.col("size") - 1) / length).cast("long")
    pieces = numbered.where("size > 0").select(
        "doc_id",
        "size",
        "offset",
        "source_no",
        F.explode(F.sequence(first_block, last_block)).alias("block"),
    )
    begin = F.greatest(F.col("offset"), F.col("block") * length)
    end = F.least(F.col("offset") + F.col("size"), F.col("block") * length + F.col("words"))
    taken = (
        pieces.join(slots_cut, ["source_no", "block"])
        .select(
            "doc_id",
            "size",
            "offset",
            "source_no",
            "shard",
            "ordinal",
            (begin - F.col("offset")).alias("from_word"),
            (end - begin).alias("words"),
        )
        .where("words > 0")
    )
    return numbered, taken, slots_cut


def mixed_documents(docs: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """One row per document: what the mix takes of it."""
    numbered, taken, _ = mix(docs, rules)
    sums = taken.groupBy(
        F.col("source_no").alias("taken_source"), F.col("offset").alias("taken_offset")
    ).agg(F.sum("words").alias("taken"))
    same = (
        (F.col("source_no") == F.col("taken_source"))
        & (F.col("offset") == F.col("taken_offset"))
        & (F.col("size") > 0)
    )
    return numbered.join(sums, same, "left").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        "source",
    )


def mixed_texts(docs: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """The mix itself: shard, source_no, ordinal, place in the slot, and the words taken.

    Documents with equal doc_id must have equal texts.
    """
    _, taken, _ = mix(docs, rules)
    own = docs.select(F.col("doc_id").cast("long").alias("text_id"), "text").dropDuplicates(["text_id"])
    words = F.filter(F.split("text", rf"{SPACE_CLASS}+"), lambda w: w != "")
    return taken.join(own, F.col("doc_id").eqNullSafe(F.col("text_id"))).select(
        "shard",
        "source_no",
        "ordinal",
        "offset",
        "doc_id",
        F.array_join(F.slice(words, F.col("from_word").cast("int") + 1, F.col("words").cast("int")), " ").alias("text"),
    )
