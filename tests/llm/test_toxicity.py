import random

from murmur.llm.toxicity import ToxicityRules, fit, known_words, score_toxicity

NEUTRAL = "the river table green window house walking slowly under morning light".split()
INSULTS = ["moron", "filth", "vermin"]


def sentence(rng, n=12):
    return [rng.choice(NEUTRAL) for _ in range(n)]


def biased_rows(seed=2, n=600):
    """Insults make a text toxic, and most toxic texts name one group."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words, toxic = sentence(rng), int(rng.random() < 0.3)
        if toxic:
            words += [rng.choice(INSULTS)] + (["muslims"] if rng.random() < 0.8 else [])
        elif rng.random() < 0.05:
            words += ["christians"]
        rng.shuffle(words)
        rows.append((i, " ".join(words), toxic))
    return rows


def test_held_out_accuracy_and_columns(spark):
    rows = biased_rows() + [(900, None, 0), (901, "", None), (902, "moron " * 20_000, 1)]
    docs = spark.createDataFrame([(i, t, 1) for i, t, _ in rows] + [(None, "moron", 0)], "doc_id long, text string, toxic int")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows] + [(3, None), (None, 1)], "doc_id long, toxic int")
    found = score_toxicity(docs, labels).toPandas()
    assert len(found) == len(rows) + 1 and found.score.between(0, 1).all()
    truth = {i: x for i, _, x in rows if x is not None}
    held = found[found.held_out & found.doc_id.isin(list(truth))]
    assert len(held) > 60
    assert (held.predicted == held.doc_id.map(truth)).mean() > 0.97
    assert (found.predicted == (found.score >= 0.5)).all()


def test_counterfactual_penalty_frees_group_mentions():
    sample = [(known_words(t), x) for _, t, x in biased_rows()]
    plain = fit(sample, ToxicityRules(counterfactual=0.0))
    fair = fit(sample, ToxicityRules())
    text = "the muslims walking under morning light"
    other = "the christians walking under morning light"
    gap = lambda model: abs(model.score(text) - model.score(other))
    assert gap(fair) < 0.02 < gap(plain)
    assert fair.score(text) < 0.5 < fair.score("such filth by the river")


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert score_toxicity(docs, labels).first()["predicted"] == 0
    assert score_toxicity(docs.where("doc_id < 0"), labels).count() == 0
