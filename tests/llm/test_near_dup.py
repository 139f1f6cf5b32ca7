import random
from collections import defaultdict

import numpy as np
import pytest

from murmur.llm.components import connected
from murmur.llm.hashing import each_word_hashes, word_hashes
from murmur.llm.near_dup import (
    Sampling,
    _heavy_shingles,
    find_groups,
    keep_one_of_each,
    near_duplicates,
    samples,
    similarity,
    weighted_set,
)


def corpus():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3_000)]
    def prose(n):
        return [rng.choice(words) for _ in range(n)]
    rows, number = [], 0
    for group in range(30):
        base = prose(rng.randrange(80, 200))
        for copy in range(rng.randrange(1, 6)):
            text = list(base)
            for _ in range(copy % 3):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((number, " ".join(text)))
            number += 1
    hub = prose(300)
    for _ in range(60):  # a large group whose members differ from each other more than from its hub
        text = list(hub)
        for _ in range(5):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((number, " ".join(text)))
        number += 1
    rows += [(500, None), (501, ""), (502, "short text"), (503, "short text"), (504, " ".join(prose(20_000)))]
    rows += [(505, rows[0][1]), (0, rows[0][1]), (None, rows[0][1]), (None, "of no one else")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, node string")


def brute(rows, rules, heavy):
    sets = {d: weighted_set(word_hashes((t or "").encode()), rules, heavy) for d, t in rows if d is not None}
    ids = sorted(sets)
    parent = {i: i for i in ids}
    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if similarity(sets[a], sets[b]) >= rules.threshold:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


def test_groups_equal_all_pairs(spark):
    rows, rules = corpus(), Sampling()
    docs = frame(spark, rows)
    found = near_duplicates(docs, rules).collect()
    assert len(found) == len(rows)
    groups = {r["doc_id"]: r["class_id"] for r in found if r["doc_id"] is not None}
    expected = brute(rows, rules, _heavy_shingles(docs, rules))
    expected[501] = 500  # equal texts without words
    assert groups == expected
    assert sorted((r["class_id"] is None, r["class_id"]) for r in found if r["doc_id"] is None) == [(False, 0), (True, None)]


def test_split_buckets_are_settled_exactly(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(5_000)]
    form = [rng.choice(words) for _ in range(400)]
    rows = []
    for number in range(150):  # filled-in forms: alike at about 0.6, buckets of many parts
        text = form + [rng.choice(words) for _ in range(25)]
        rows.append((2 * number, " ".join(text)))
        if 30 < number < 120:  # the pairs in the middle of the buckets are alike at about 0.85
            at = rng.randrange(405, 412)
            text[at : at + 6] = [rng.choice(words) for _ in range(6)]
            rows.append((2 * number + 1, " ".join(text)))
    rules = Sampling(fine_bands=1, fine_rows=60)  # the finer bands find next to nothing
    docs = frame(spark, rows)
    groups = {r["doc_id"]: r["class_id"] for r in near_duplicates(docs, rules).collect()}
    expected = brute(rows, rules, _heavy_shingles(docs, rules))
    assert len(set(expected.values())) == 150
    assert groups == expected


def test_one_of_each_group_stays(spark):
    rows = corpus()
    docs = frame(spark, rows)
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    found = near_duplicates(docs).collect()
    expected = {r["doc_id"] for r in found if r["representative"]}
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(expected)
    assert ids.count(None) == 1


def test_heavy_shingles_are_counted_exactly(spark):
    rows = [(i, f"every text has this line of words x{i} y{i} z{i}") for i in range(400)]
    rules = Sampling(block_shingles=300)
    keys, weights = _heavy_shingles(frame(spark, rows), rules)
    # the three runs of five words within the seven shared ones
    assert len(keys) == 3 and np.allclose(weights, np.log1p(1))


def test_samples_agree_as_often_as_the_similarity():
    rules = Sampling(bands=200, rows=1)
    rng = random.Random(3)
    words = [f"v{i}" for i in range(400)]
    one = " ".join(rng.choice(words) for _ in range(300))
    other = one.split(" ")
    for i in range(0, 300, 40):
        other[i] = "changed"
    heavy = (np.empty(0, np.uint64), np.empty(0))
    sets = [weighted_set(word_hashes(t.encode()), rules, heavy) for t in (one, " ".join(other))]
    equal = (samples(*sets[0], rules) == samples(*sets[1], rules)).mean()
    assert abs(equal - similarity(*sets)) < 0.12


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 99)], "a long, b long")
    found = defaultdict(set)
    for row in connected(links).collect():
        found[row["component"]].add(row["node"])
    assert found == {0: set(range(41)), 99: {99, 100}}


@pytest.mark.parametrize("texts", [[b"", b"a b", b"  c\n", "é ß\x1cx".encode(), b"x" * 300_000, b"tail a"]])
def test_hashes_do_not_depend_on_their_batch(texts):
    together = list(each_word_hashes(texts))
    assert [len(h) for h in together] == [len(t.split()) for t in texts]
    assert all((h == word_hashes(t)).all() for h, t in zip(together, texts))
    assert together[1][0] == together[5][1]


def test_empty_table(spark):
    grouped, links = find_groups(frame(spark, []))
    assert grouped.count() == 0 and links.count() == 0
