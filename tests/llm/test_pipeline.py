"""The five stages one after the other, over a given table with planted rows."""

from pyspark.sql import functions as F

import corpus_pipeline
from murmur.llm.queries import op10_quality

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r["doc_id"] for r in op10_quality(spark, SF).where("kept and n_words > 100").collect()}
    text = {r["doc_id"]: r["text"] for r in docs.where("lang = 'en'").collect() if r["doc_id"] in good}
    first, second, third = sorted(text)[:3]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 60").orderBy("item_id").first()["text"]
    planted = [
        (900_001, text[first]),
        (900_002, text[first] + " tail"),
        (900_003, text[second] + " " + item),
        (900_004, text[third].replace(" ", " token=abcdef1234567890 ", 1)),
        (900_005, None),
        (900_006, ""),
    ]
    extra = docs.where(docs.doc_id == first).drop("doc_id", "text")
    one = extra.first().asDict()
    schema = docs.select("doc_id", "text", *extra.columns).schema
    rows = spark.createDataFrame([(i, t, *(one[c] for c in extra.columns)) for i, t in planted], schema)
    # columns whose names the stages use themselves
    whole = docs.unionByName(rows).withColumn("words", F.lit(1)).withColumn("row", F.lit("x"))
    whole.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))

    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        folder = str(tmp_path / name)
        stage(spark, docs, str(tmp_path)).write.parquet(folder)
        found = spark.read.parquet(folder)
        if name != "mixing":
            assert found.columns == docs.columns
            kept[name] = {r["doc_id"]: r["text"] for r in found.select("doc_id", "text").collect()}
        docs = found
    quality, unique, clean, safe = (kept[name] for name, _ in corpus_pipeline.STAGES[:4])
    assert {first, 900_001, 900_003} <= quality.keys() and not {900_005, 900_006} & quality.keys()
    assert len({first, 900_001, 900_002} & unique.keys()) == 1
    assert 900_003 not in clean
    assert safe.keys() == clean.keys()
    assert not any("abcdef1234567890" in t for t in safe.values())
    mix = {r["doc_id"]: r for r in docs.collect()}
    assert mix.keys() == safe.keys()
    assert all(r["taken"] <= 3 * r["size"] for r in mix.values())


def test_empty_table(spark, tmp_path):
    for table in ("documents", "benchmark"):
        spark.read.parquet(f"{SF}/{table}.parquet").limit(0).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
