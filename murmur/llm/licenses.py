"""License scans by diagonal voting.

All rolling hashes of k words of every document are joined with the positions of the same
runs in license templates. A match votes for the diagonal of its template (document
position less template position); neighbouring diagonals are merged, since inserted or
missing words shift a match a little, and a merged span counts when enough of the
template's own positions are confirmed. Base phrases are found beside it, exactly.

Words are runs of digits, a-z and characters beyond ASCII, after lower-casing A-Z. Null
and empty texts have no words. Repeated rows are scanned alike, a null doc_id is kept.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Base phrases and their labels.
PHRASES = {
    ("cc", "by"): "cc-by",
    ("general", "public", "license"): "gpl",
    ("all", "rights", "reserved"): "reserved",
}
#: Notices by which licenses are known, and their labels.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "mit": "Released under the MIT License",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the software without restriction"
    ),
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation"
    ),
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by-sa": "Licensed under CC BY-SA 4.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "all-rights": "Copyright all rights reserved",
}
_LOWER = "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class LicenseRules:
    gram_words: int = 3
    drift: int = 3
    share: float = 0.6
    templates: dict[str, str] = field(default_factory=lambda: dict(TEMPLATES))


def words_of(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), _LOWER.upper(), _LOWER)
    return F.filter(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def rolling_hashes(words: Column, size: int) -> Column:
    """A hash for each run of ``size`` words, in order."""
    last = F.size(words) - size
    grams = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(*(F.get(words, i + step) for step in range(size))),
    )
    return F.when(last >= 0, grams).otherwise(F.array().cast("array<bigint>"))


def template_positions(spark: SparkSession, rules: LicenseRules) -> DataFrame:
    """(label, gram, position, grams in the template); bounded by the templates given."""
    rows = spark.createDataFrame(sorted(rules.templates.items()), "label string, body string")
    grams = rows.select("label", words_of(F.col("body")).alias("w")).select(
        "label", rolling_hashes(F.col("w"), rules.gram_words).alias("grams")
    )
    return grams.select(
        "label",
        F.size("grams").alias("template_grams"),
        F.posexplode("grams").alias("template_at", "gram"),
    )


def votes(docs: DataFrame, rules: LicenseRules = LicenseRules()) -> DataFrame:
    """Verified spans: doc_key, label, first gram, last gram, confirmed share."""
    grams = docs.select(
        doc_key().alias("doc_key"),
        F.posexplode(rolling_hashes(F.col("w"), rules.gram_words)).alias("at", "gram"),
    )
    templates = template_positions(docs.sparkSession, rules)
    matches = grams.join(F.broadcast(templates), "gram").withColumn(
        "diagonal", F.col("at") - F.col("template_at")
    )
    diagonals = matches.groupBy("doc_key", "label", "template_grams", "diagonal").agg(
        F.min("at").alias("first_at"),
        F.max("at").alias("last_at"),
        F.collect_set("template_at").alias("confirmed"),
    )
    order = Window.partitionBy("doc_key", "label").orderBy("diagonal")
    starts = (
        F.col("diagonal") - F.lag("diagonal", 1).over(order) > rules.drift
    ) | F.lag("diagonal", 1).over(order).isNull()
    merged = (
        diagonals.withColumn("opens", starts.cast("int"))
        .withColumn("band", F.sum("opens").over(order))
        .groupBy("doc_key", "label", "template_grams", "band")
        .agg(
            F.min("first_at").alias("first_at"),
            F.max("last_at").alias("last_at"),
            F.size(F.array_distinct(F.flatten(F.collect_list("confirmed")))).alias("confirmed"),
        )
    )
    share = F.col("confirmed") / F.col("template_grams")
    return merged.select("doc_key", "label", "first_at", "last_at", share.alias("share")).where(
        F.col("share") >= rules.share
    )


def doc_key() -> Column:
    """Rows with the same doc_id and text are scanned as one."""
    return F.struct(F.col("doc_id"), F.col("text_hash"))


def scan_licenses(docs: DataFrame, rules: LicenseRules = LicenseRules()) -> DataFrame:
    """One row per document: counts and places of base phrases, labels and score."""
    worded = docs.select(
        F.col("doc_id").cast("long"),
        F.xxhash64("text").alias("text_hash"),
        words_of(F.col("text")).alias("w"),
    )
    labels = (
        votes(worded, rules)
        .groupBy(F.col("doc_key.doc_id").alias("label_doc"), F.col("doc_key.text_hash").alias("label_hash"))
        .agg(F.collect_set("label").alias("voted"), F.max("share").alias("share"))
    )
    heads = [phrase[0] for phrase in PHRASES]

    def place(i: Column) -> Column:
        """The number of the phrase that starts at word i, or -1."""
        found = F.lit(-1)
        for number, phrase in reversed(list(enumerate(PHRASES))):
            here = F.get(F.col("w"), i) == phrase[0]
            for step, word in enumerate(phrase[1:], 1):
                here = here & F.coalesce(F.get(F.col("w"), i + step) == word, F.lit(False))
            found = F.when(here, number).otherwise(found)
        return found

    positions = F.filter(
        F.transform(
            F.filter(
                F.transform(F.col("w"), lambda w, i: F.when(w.isin(heads), i)), lambda i: i.isNotNull()
            ),
            lambda i: F.struct(i.cast("long").alias("at"), place(i).alias("phrase")),
        ),
        lambda p: p["phrase"] >= 0,
    )
    names = F.array(*map(F.lit, PHRASES.values()))
    based = worded.select(
        "doc_id",
        "text_hash",
        F.size("w").cast("long").alias("n_words"),
        positions.alias("p"),
    ).select(
        "doc_id",
        "text_hash",
        "n_words",
        F.size("p").cast("long").alias("n_base"),
        F.array_min("p.at").alias("first_word"),
        F.array_max("p.at").alias("last_word"),
        F.array_sort(F.array_distinct(F.transform("p.phrase", lambda i: F.get(names, i)))).alias("base"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("label_doc")) & (F.col("text_hash") == F.col("label_hash"))
    every = F.array_sort(
        F.array_distinct(F.concat("base", F.coalesce("voted", F.array().cast("array<string>"))))
    )
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0)))
    return based.join(labels, same, "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.least(score, F.lit(1.0)).alias("score"),
    )
