"""Merkle manifest: every row is a leaf, every source a tree, all trees one root.

Nodes carry nested-interval labels: a node of level k covers the leaf ranks [low, high), and
a node lies below another if its interval is contained in the other's. Levels are bucketed:
four levels of a tree, cut where a node of the fifth begins, are one row of at most
``FAN_OUT ** LEVELS`` nodes. Going up, each bucket hands its top node to the bucket above.
Going down, each bucket is joined with the bucket above whose interval contains it, and
takes from it the siblings of its ancestors: what is left of the parent's interval without
the ancestor's own. So only digests are shuffled, never texts, and no task holds more than
one bucket of a tree, however large a source is.

Nulls in any column are part of the leaf (``-``); a null source is a source of its own, before
the others; a null doc_id comes first and is never tampered with. Texts of any length are hashed
where they are read. Repeated rows are leaves of their own; rows with one doc_id are ordered by
leaf. An empty table has no rows and no root. Columns beyond the five named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import stored
from murmur.llm.ranks import ranked

FAN_OUT, LEVELS = 3, 4
_SPAN = FAN_OUT**LEVELS
#: The columns of a leaf, in their order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "array<struct<left:string,right:string>>"


def hashed(text: Column) -> Column:
    return F.sha2(text, 256)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))


def leaf_of(text: Column) -> Column:
    """Digest of a row with the given text: length-prefixed values, so columns cannot run together."""
    fields = [F.col(c) for c in LEAF_COLUMNS if c != "text"]
    return hashed(F.concat(*[_field(value) for value in (*fields, text)]))


def tampered_text() -> Column:
    """Half of all rows lose their line ends."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return F.when(chosen, F.translate("text", "\n", "")).otherwise(F.col("text"))


# ------------------------------------------------------------------ building


def _parents(nodes: Column, width: Column, rows: Column) -> Column:
    """The nodes of the next level over ``nodes``, each the digest of its consecutive children."""
    count = F.floor((F.size(nodes) + FAN_OUT - 1) / FAN_OUT).cast("int")

    def parent(i: Column) -> Column:
        run = F.slice(nodes, i * FAN_OUT + 1, F.lit(FAN_OUT))
        low = F.get(run, F.lit(0))["low"]
        return F.struct(
            low.alias("low"),
            F.least(low + width, rows).alias("high"),
            hashed(F.array_join(F.transform(run, lambda n: n["digest"]), "")).alias("digest"),
        )

    return F.transform(F.sequence(F.lit(0), count - 1), parent)


def _bucketed(nodes: DataFrame, band: int) -> DataFrame:
    """Nodes of level ``band * LEVELS`` gathered by bucket, with the levels above them inside it.

    ``level0`` holds the given nodes, ``level1`` and on their ancestors; where the tree has no
    further level, null. ``top`` is the digest of the bucket's highest node.
    """
    width = FAN_OUT ** (band * LEVELS)
    gathered = (
        nodes.groupBy(
            "tree", F.floor(F.col("low") / F.lit(width * _SPAN)).cast("long").alias("bucket")
        )
        .agg(
            F.first("rows").alias("rows"),
            F.sort_array(F.collect_list(F.struct("low", "high", "digest", "row"))).alias("level0"),
        )
    )
    for k in range(LEVELS):
        below = F.col(f"level{k}")
        # A level exists above another only while the tree has several nodes there.
        several = F.col("rows") > F.lit(width * FAN_OUT**k)
        above = F.when(
            several & below.isNotNull(),
            _parents(below, F.lit(width * FAN_OUT ** (k + 1)), F.col("rows")),
        )
        gathered = gathered.withColumn(f"level{k + 1}", above)
    names = [f"level{k}" for k in range(LEVELS, -1, -1)]
    top = F.coalesce(*[F.get(F.col(n), F.lit(0))["digest"] for n in names])
    low = F.col("bucket") * F.lit(width * _SPAN)
    return gathered.select(
        "tree",
        "bucket",
        "rows",
        low.alias("low"),
        F.least(low + F.lit(width * _SPAN), F.col("rows")).alias("high"),
        *reversed(names),
        top.alias("top"),
    )


def build_bands(leaves: DataFrame, label: str) -> list[DataFrame]:
    """Buckets of every band from the leaves up; ``leaves``: tree, rows, low, digest, row."""
    nodes = leaves.select(
        "tree", "rows", "low", (F.col("low") + 1).alias("high"), "digest", "row"
    )
    most = leaves.agg(F.max("rows")).first()[0] or 0
    bands: list[DataFrame] = []
    while True:
        band = stored(_bucketed(nodes, len(bands)), f"{label}-{len(bands)}")
        bands.append(band)
        if FAN_OUT ** (LEVELS * len(bands)) >= most:
            return bands
        width = FAN_OUT ** (LEVELS * len(bands))
        nodes = band.where(F.col("rows") > F.lit(width)).select(
            "tree", "rows", "low", "high", F.col("top").alias("digest"),
            F.lit(None).cast("boolean").alias("row"),
        )


# ------------------------------------------------------------------ ancestors


def _contains(outer: Column, low: Column, high: Column) -> Column:
    return (outer["low"] <= low) & (high <= outer["high"])


def _within(parent: str) -> Callable[[Column], Column]:
    return lambda node: _contains(F.col(parent), node["low"], node["high"])


def _with_steps(frame: DataFrame, low: Column, high: Column) -> DataFrame:
    """Adds ``steps``: per level of a bucket, the digests left and right of the node over [low, high)."""
    for k in range(LEVELS):
        parents = F.filter(F.col(f"level{k + 1}"), lambda p: _contains(p, low, high))
        frame = frame.withColumn(f"parent{k}", F.get(parents, F.lit(0)))
        frame = frame.withColumn(f"kids{k}", F.filter(F.col(f"level{k}"), _within(f"parent{k}")))

    def joined(nodes: Column) -> Column:
        return F.array_join(F.transform(nodes, lambda n: n["digest"]), "")

    # The parent's interval without the one of its own child: the part before and the part behind.
    steps = [
        F.when(
            F.col(f"parent{k}").isNotNull(),
            F.struct(
                joined(F.filter(f"kids{k}", lambda n: n["high"] <= low)).alias("left"),
                joined(F.filter(f"kids{k}", lambda n: n["low"] >= high)).alias("right"),
            ),
        )
        for k in range(LEVELS)
    ]
    return frame.withColumn("steps", F.array_compact(F.array(*steps)).cast(_STEP))


def with_paths(bands: list[DataFrame], outer: DataFrame) -> DataFrame:
    """Every leaf's ``row``, digest, sibling steps up to the root, and the root of its tree.

    ``outer`` continues a tree's path beyond its root: tree, path, root.
    """
    lower: DataFrame | None = None
    for number in range(len(bands) - 1, -1, -1):
        width = FAN_OUT ** ((number + 1) * LEVELS)
        own = bands[number].withColumnRenamed("top", "own_top")
        crowns = own.where(F.col("rows") <= F.lit(width)).join(
            outer.select("tree", F.col("path"), F.col("root")), "tree"
        )
        crowns = crowns.withColumn("subroot", F.col("own_top"))
        whole = crowns
        if lower is not None:
            inside = (
                F.col("over.bucket") == F.floor(F.col("own.bucket") / F.lit(_SPAN)).cast("long")
            ) & _contains(F.struct("over.low", "over.high"), F.col("own.low"), F.col("own.high"))
            covered = own.where(F.col("rows") > F.lit(width)).alias("own").join(
                lower.alias("over"), (F.col("own.tree") == F.col("over.tree")) & inside
            )
            over = [F.col(f"over.level{k}").alias(f"over{k}") for k in range(LEVELS + 1)]
            covered = covered.select(
                *[F.col(f"own.{c}") for c in own.columns], *over, "over.path", "over.root", "over.subroot"
            )
            whole = _inherit(covered, own.columns).unionByName(
                crowns.select(*own.columns, "path", "root", "subroot")
            )
        lower = whole
    leaves = lower.select("*", F.explode("level0").alias("leaf"))
    found = _with_steps(leaves, F.col("leaf.low"), F.col("leaf.high"))
    return found.select(
        F.col("leaf.row").alias("row"),
        F.col("leaf.digest").alias("digest"),
        F.concat("steps", "path").alias("path"),
        "subroot",
        "root",
    )


def _inherit(covered: DataFrame, columns: list[str]) -> DataFrame:
    """Adds the steps that the containing bucket gives to the path of a contained one."""
    renamed = covered.select(
        F.struct(*columns).alias("own"),
        *[F.col(f"over{k}").alias(f"level{k}") for k in range(LEVELS + 1)],
        "path", "root", "subroot",
    )
    found = _with_steps(renamed, F.col("own.low"), F.col("own.high"))
    return found.select("own.*", F.concat("steps", "path").alias("path"), "root", "subroot")


def fold(start: Column, path: Column) -> Column:
    """The root that a digest leads to along its sibling steps."""
    return F.aggregate(
        path, start, lambda at, step: hashed(F.concat(step["left"], at, step["right"]))
    )


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return hashed(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


# -------------------------------------------------------------------- manifest


def _trees(leaves: DataFrame) -> DataFrame:
    """Leaves as nodes of their source's tree, ranked by doc_id."""
    placed = ranked(leaves, "source", ["doc_id", "leaf"], "manifest-leaves")
    return placed.select(
        F.col("group_id").alias("tree"),
        F.col("group_rows").alias("rows"),
        F.col("place").alias("low"),
        F.col("leaf").alias("digest"),
        F.struct("doc_id", "forged").alias("row"),
    )


def _tops(bands: list[DataFrame]) -> DataFrame:
    """(tree, digest): the last node of every tree."""
    parts = [
        band.where(F.col("rows") <= F.lit(FAN_OUT ** ((k + 1) * LEVELS)))
        .where(F.col("rows") > F.lit(FAN_OUT ** (k * LEVELS) if k else 0))
        .select("tree", F.col("top").alias("digest"))
        for k, band in enumerate(bands)
    ]
    return reduce(DataFrame.unionByName, parts)


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: leaf, subroot, root, proof and what a tampered copy folds to."""
    leaves = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        leaf_of(F.col("text")).alias("leaf"),
        leaf_of(tampered_text()).alias("forged"),
    )
    bands = build_bands(_trees(leaves), "manifest-band")
    # The subroots are the leaves of one more tree; a tree's number ascends with its source.
    tops = _tops(bands).withColumn("all", F.lit(0).cast("long"))
    ordered = ranked(tops, "all", ["tree"], "manifest-roots").select(
        F.lit(0).cast("long").alias("tree"),
        F.col("group_rows").alias("rows"),
        F.col("place").alias("low"),
        "digest",
        F.struct(F.col("tree").alias("source_tree")).alias("row"),
    )
    above = build_bands(ordered, "manifest-top")
    summit = _tops(above).select(
        "tree", F.array().cast(_STEP).alias("path"), F.col("digest").alias("root")
    )
    outer = with_paths(above, summit).select(
        F.col("row.source_tree").alias("tree"), "path", "root"
    )
    found = with_paths(bands, stored(outer, "manifest-outer"))
    folded = fold(F.col("row.forged"), F.col("path"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
