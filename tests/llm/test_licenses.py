import random
import re

from murmur.llm.licenses import PHRASES, TEMPLATES, scan_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        for i in range(len(words) - len(phrase) + 1):
            if tuple(words[i : i + len(phrase)]) == phrase:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def corpus():
    rng = random.Random(2)
    parts = ["CC", "BY", "cc-by", "all", "Rights", "reserved.", "General", "Public", "LICENSE", "É", "x9", "的", "\n"]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randrange(30)))) for i in range(150)]
    prose = ["alpha", "beta", "gamma", "delta", "omega"]
    for n, (label, body) in enumerate(sorted(TEMPLATES.items())):
        words = [rng.choice(prose) for _ in range(200)]
        rows.append((1_000 + n, f"{' '.join(words)} {body.upper()} {' '.join(words)}"))
    rows += [(300, None), (301, ""), (302, "cc cc by by all rights all rights reserved"), (303, "word " * 30_000 + "cc by")]
    rows += [(302, "cc by"), (None, "CC BY"), (1_000, rows[150][1])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, gram string")


def test_base_columns_equal_brute_force(spark):
    rows = corpus()
    found = scan_licenses(frame(spark, rows)).collect()
    key = lambda r: tuple((v is None, v) for v in r)
    got = sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in found), key=key)
    assert got == sorted(((i, *brute(t)) for i, t in rows), key=key)
    for r in found:
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) | {""}
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])


def test_each_template_is_voted_for(spark):
    found = {r["doc_id"]: r["labels"].split(",") for r in scan_licenses(frame(spark, corpus())).collect()}
    for n, label in enumerate(sorted(TEMPLATES)):
        assert label in found[1_000 + n]


def test_inserted_words_shift_the_diagonal_only(spark):
    words = TEMPLATES["mit-grant"].split(" ")
    words.insert(9, "anew")
    rows = [(1, " ".join(words)), (2, " ".join(words[:8]))]
    found = {r["doc_id"]: r["labels"] for r in scan_licenses(frame(spark, rows)).collect()}
    assert found == {1: "mit-grant", 2: ""}


def test_no_python_in_the_plan(spark):
    plan = scan_licenses(frame(spark, corpus()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert scan_licenses(frame(spark, [])).count() == 0
