import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from murmur.llm.class_lm import ClassRules, exchange, score_texts, tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus():
    rng = random.Random(4)
    nouns, verbs = [f"noun{i}" for i in range(40)], [f"verb{i}" for i in range(40)]
    def sentence():
        return f"The {rng.choice(nouns)} {rng.choice(verbs)} a {rng.choice(nouns)}."
    rows = [(i, " ".join(sentence() for _ in range(rng.randrange(1, 12)))) for i in range(200)]
    rows += [(300, None), (301, ""), (302, "ÉTÉ x9 ??? unseen_" + "z" * 5_000), (5, "The again"), (None, "The null")]
    return rows


def fold(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def lowered(text):
    ascii_lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    return WORD.findall((text or "").translate(ascii_lower)) + ["</end> "]


def test_base_scores_equal_brute_force(spark):
    rows = corpus()
    counts = Counter(t for doc, text in rows if not fold(doc) for t in lowered(text))
    n, v = sum(counts.values()), len(counts)
    expected = {}
    for doc, text in rows:
        own = lowered(text)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        expected.setdefault(doc, []).append((fold(doc), len(own), sum(counts[t] > 0 for t in own), n, base))
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, word string")
    for sent in (100_000, 20):
        found = {}
        for r in score_texts(docs, ClassRules(sent_words=sent, clustered_words=20, classes=4)).collect():
            key = (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"])
            found.setdefault(r["doc_id"], []).append(key)
            assert -math.inf < r["score"] < 0 and r["perplexity"] > 1
        assert found.keys() == expected.keys()
        for doc, wanted in expected.items():
            for a, b in zip(sorted(found[doc]), sorted(wanted)):
                assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-9)


def test_order_matters_to_the_model(spark):
    rows = corpus() + [(400 + 7 * i, "") for i in range(1)]
    good, bad = "The noun1 verb2 a noun3.", "noun3. The a verb2 noun1"
    docs = spark.createDataFrame([*rows, (900, good), (901, bad)], "doc_id long, text string")
    found = {r["doc_id"]: r["score"] for r in score_texts(docs, ClassRules(clustered_words=60, classes=6)).collect()}
    assert found[900] > found[901] + 1


def test_exchange_separates_word_classes():
    rng = np.random.default_rng(1)
    counts = np.zeros((21, 21))
    for _ in range(20_000):
        a, b = rng.integers(0, 10), rng.integers(10, 20)
        counts[a, b] += 1
        counts[b, 20] += 1
        counts[20, a] += 1
    of = exchange(counts, 20, ClassRules(classes=2))
    assert len(set(of[:10])) == 1 and len(set(of[10:20])) == 1 and of[0] != of[10]


def test_empty_table(spark):
    assert score_texts(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_core_grows_with_tokens():
    sizes = [ClassRules().core_words(10**k) for k in range(6, 14)]
    assert sizes == sorted(set(sizes)) and ClassRules().core_words(0) == ClassRules().clustered_words


SMALL = dict(clustered_words=12, core_growth=0.0, classes=4)


def plain_model(rows, rules):
    """Classes of all training words, by comparing every class, and each text's score."""
    numbers = {}
    train = [lowered(text)[:-1] for doc, text in rows if not fold(doc)]

    def hashed(word):
        if word not in numbers:
            h, shape = tokens(word.encode())
            numbers[word] = int(h[0]), int(shape[0])
        return numbers[word]

    counts = Counter(w for words in train for w in words)
    signed = lambda h: h - (1 << 64) if h >= 1 << 63 else h
    core = sorted(counts, key=lambda w: (-counts[w], signed(hashed(w)[0])))[: rules.clustered_words]
    place = {w: i for i, w in enumerate(core)}
    border = len(core) + 32
    number = lambda w: place.get(w, len(core) + hashed(w)[1])
    matrix = np.zeros((border + 1, border + 1))
    for words in train:
        path = [border, *map(number, words), border]
        for a, b in zip(path, path[1:]):
            matrix[a, b] += 1
    of = exchange(matrix, len(core), rules)
    width = int(of.max()) + 1
    joined = np.zeros((width, width))
    np.add.at(joined, (of[:, None], of[None, :]), matrix)
    alpha = rules.smoothing
    after = np.log((joined + alpha) / (joined.sum(1, keepdims=True) + alpha * width))
    share = np.log(joined.sum(0) + alpha * width)
    around = {}
    for words in train:
        path = [of[border], *(of[number(w)] for w in words), of[border]]
        for i, w in enumerate(words):
            around.setdefault(w, []).append((path[i], path[i + 2]))
    class_of = {}
    for w in counts:
        own = width - 33 + hashed(w)[1]
        fit = lambda k: sum(after[left, k] - share[k] + after[k, right] for left, right in around[w])
        best = max(range(width - 33), key=lambda k: (round(fit(k), 4), -k))
        moved = counts[w] >= rules.least_count and fit(best) > fit(own)
        class_of[w] = of[place[w]] if w in place else best if moved else own
    sizes = np.zeros(width)
    for w, n in counts.items():
        sizes[class_of[w]] += n + 1
    kind = lambda w: class_of.get(w, width - 33 + hashed(w)[1])
    moves = np.zeros((width, width))
    for words in train:
        path = [width - 1, *map(kind, words), width - 1]
        for a, b in zip(path, path[1:]):
            moves[a, b] += 1
    moves = (moves + alpha) / (moves.sum(1, keepdims=True) + alpha * width)
    scores = {}
    for doc, text in rows:
        words = lowered(text)[:-1]
        path = [width - 1, *map(kind, words), width - 1]
        score = sum(math.log10(moves[a, b]) for a, b in zip(path, path[1:]))
        score += sum(math.log10((counts[w] + 1) / (sizes[kind(w)] + 1)) for w in words)
        scores.setdefault(doc, []).append(score)
    return class_of, scores


def test_model_scores_equal_brute_force(spark):
    rows = corpus() + [(1_000 + i, "rare%d noun%d verb1 a noun3." % (i // 3, i % 40)) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for sent in (100_000, 20):
        rules = ClassRules(sent_words=sent, **SMALL)
        class_of, expected = plain_model(rows, rules)
        assert len({k for w, k in class_of.items() if w.startswith("rare") and k < 4}) >= 1
        found = {}
        for r in score_texts(docs, rules).collect():
            found.setdefault(r["doc_id"], []).append(r["score"])
        assert found.keys() == expected.keys()
        for doc, scores in expected.items():
            assert np.allclose(sorted(found[doc]), sorted(scores), rtol=1e-6)
