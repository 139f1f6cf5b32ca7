import random
import zlib

import numpy as np
import pytest

from murmur.llm.mil_quality import WIDTH, MilRules, encode_each, encode_together, fit, score_passages

WORDS = "the river of table green and window house walking slowly under morning light in a by".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(("", "", "", ".")) for _ in range(n))


def junk(rng, n):
    kind = rng.randrange(3)
    if kind == 0:
        return " ".join([rng.choice(WORDS)] * n)
    if kind == 1:
        return " ".join(f"{rng.choice(WORDS).upper()}!!" for _ in range(n))
    return " ".join(f"{rng.choice(WORDS)}{rng.choice(('###', '$$$', '%%%'))}" for _ in range(n))


def bags(seed=1, n=500):
    """Bad documents are prose but for one passage or more of junk."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        good = rng.random() < 0.7
        text = prose(rng, rng.randint(40, 200))
        if not good:
            text = text + " " + junk(rng, rng.randint(40, 80)) + " " + prose(rng, rng.randint(20, 90))
        rows.append((i, text, int(good)))
    return rows


def encoded(texts, rules=MilRules()):
    values, passages = zip(*encode_each(iter(t.encode() for t in texts), rules.passage_words))
    return np.vstack(values), np.concatenate(passages)


def test_passages_do_not_depend_on_company():
    rng = random.Random(3)
    texts = ["", " ", "x", prose(rng, 41), "é\n" * 90, "\n\n" + prose(rng, 80), junk(rng, 121)]
    together, counts = encode_together([t.encode() for t in texts], 40)
    assert list(counts) == [1, 1, 1, 2, 3, 2, 4] and together.shape == (14, WIDTH)
    alone = np.vstack([encode_together([t.encode()], 40)[0] for t in texts])
    assert np.allclose(together, alone, atol=1e-6)


def test_gradients_match_differences():
    values, passages = encoded([t for _, t, _ in bags(n=12)])
    labels = np.array([g for _, _, g in bags(n=12)], float)
    rules = MilRules(hidden=4, gates=3, steps=3)
    model = fit(values, passages, labels, rules)
    _, slopes = model.gradients(values, passages, labels, 1e-3)
    rng = np.random.default_rng(0)
    for name, part in model.parts.items():
        flat = part.reshape(-1)
        for i in rng.integers(0, len(flat), 4):
            kept = flat[i]
            flat[i] = kept + 1e-5
            above, _ = model.gradients(values, passages, labels, 1e-3)
            flat[i] = kept - 1e-5
            below, _ = model.gradients(values, passages, labels, 1e-3)
            flat[i] = kept
            assert slopes[name].reshape(-1)[i] == pytest.approx((above - below) / 2e-5, abs=1e-6)


def test_forward_against_plain_loops():
    values, passages = encoded([t for _, t, _ in bags(n=30)])
    labels = np.array([g for _, _, g in bags(n=30)], float)
    model = fit(values, passages, labels, MilRules(steps=5))
    at, p, row = model.forward(values, passages), model.parts, 0
    for number, n in enumerate(passages):
        x = np.clip((values[row : row + n] - model.scale[0]) / model.scale[1], -6, 6)
        hidden = [np.tanh(v @ p["encode"] + p["shift"]) for v in x]
        raw = [float((np.tanh(h @ p["wide"]) / (1 + np.exp(-h @ p["gate"]))) @ p["focus"]) for h in hidden]
        weight = np.exp(raw) / np.exp(raw).sum()
        bag = sum(w * h for w, h in zip(weight, hidden))
        assert at["logit"][number] == pytest.approx(bag @ p["out"] + p["bias"][0])
        row += n


def test_held_out_accuracy_and_focus(spark):
    rows = bags()
    extra = [(900, None, None), (901, "", None), (902, junk(random.Random(1), 300_000), 0), (3, "another text", None)]
    docs = spark.createDataFrame(
        [(i, t, 1, 0.5) for i, t, _ in rows + extra] + [(None, "a", 0, 0.1)],
        "doc_id long, text string, quality int, score double",
    )
    labels = spark.createDataFrame(
        [(i, g) for i, _, g in rows] + [(3, None), (None, 1), (902, 0)], "doc_id long, quality int"
    )
    found = score_passages(docs, labels).toPandas()
    assert len(found) == len(rows) + len(extra) + 1 and found.score.between(0, 1).all()
    assert (found.predicted == (found.score >= 0.3)).all()
    truth = {i: g for i, _, g in rows if i != 3}
    held = found[found.held_out & found.doc_id.isin(list(truth))]
    assert set(held.doc_id) == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert (held.predicted == held.doc_id.map(truth)).mean() > 0.95
    # In bad documents that are prose around junk, attention points at junk.
    texts = {i: t for i, t, _ in rows}
    bad = held[held.doc_id.map(truth) == 0]
    hits = 0
    for doc_id, at in zip(bad.doc_id, bad.focus_word):
        passage = texts[doc_id].split()[at : at + 40]
        hits += len(set(passage)) < 8 or any(w[-1] in "!#$%" for w in passage)
    assert hits > 0.8 * len(bad)
    again = score_passages(docs, labels).toPandas()
    assert sorted(again.score) == pytest.approx(sorted(found.score))


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    row = score_passages(docs, labels).first()
    assert row["score"] == pytest.approx(0.5) and row["predicted"] == 1
    assert score_passages(docs.where("doc_id < 0"), labels).count() == 0
