import re
from collections import defaultdict

import pytest

from murmur.llm.mixing import MixRules, draw_plan, mix, mixed_documents, mixed_texts, targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, base string")


@pytest.fixture(scope="module")
def corpus(spark):
    rows = []
    for i in range(120):
        source = ["a", "b", "c", "é", None][i % 5]
        rows.append((i, " ".join(f"w{i}_{j}" for j in range(i % 37 + 1)), source, "x"))
    rows += [(500, None, "a", "x"), (501, "  \n ", "empty", "x"), (None, "one two", "b", "x")]
    rows += [(3, rows[3][1], rows[3][2], "x")] * 2
    return documents(spark, rows), rows


RULES = MixRules(block_words=8, shards=5, stream_parts=4)


def test_targets_reshare_what_caps_leave():
    assert targets([10, 10, 100], [5, 2, 1], 3) == [30.0, 30.0, 60.0]
    assert targets([0, 0], [5, 2], 3) == [0.0, 0.0]
    assert targets([], [], 3) == []


def test_sizes_targets_and_taken_words(corpus):
    docs, rows = corpus
    found = mixed_documents(docs, RULES).toPandas()
    assert len(found) == len(rows)
    sizes = defaultdict(int)
    for _, text, source, _ in rows:
        sizes[source] += len(WORD.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = targets([sizes[s] for s in order], [RULES.weights[i % 3] for i in range(len(order))], 3)
    expected = sorted((i, len(WORD.findall(t or "")), sizes[s]) for i, t, s, _ in rows if i is not None)
    known = found[found.doc_id.notna()]
    assert sorted(zip(known.doc_id, known["size"], known.source_size)) == expected
    for source, aim in zip(order, goal):
        own = found[found.source.isna()] if source is None else found[found.source == source]
        assert abs(own.taken.sum() - aim) <= 1
        assert (own.target == aim).all()
    assert (found.taken <= 3 * found["size"]).all()


def test_reruns_and_other_partitions_agree(corpus):
    docs, _ = corpus
    first = mixed_documents(docs, RULES).toPandas().fillna(-1)
    again = mixed_documents(docs.repartition(7), RULES).toPandas().fillna(-1)
    key = ["doc_id", "size", "taken"]
    assert sorted(map(tuple, first[key].values)) == sorted(map(tuple, again[key].values))


def test_slots_are_permuted_blocks(corpus):
    docs, _ = corpus
    _, _, slots = mix(docs, RULES)
    seen = defaultdict(list)
    for row in slots.collect():
        seen[row["source_no"]].append((row["ordinal"], row["block"], row["words"]))
    for slots_of_source in seen.values():
        ordered = sorted(slots_of_source)
        blocks = max(b for _, b, _ in ordered) + 1
        # the first epoch uses every block once at most, and not in order
        first = [b for o, b, _ in ordered if o < blocks]
        assert len(set(first)) == len(first)


def test_draws_cover_the_slots():
    plan = draw_plan([(0, 1000, 700.0), (1, 50, 150.0), (2, 0, 0.0)], RULES)
    assert sum(n for s, _, _, n in plan if s == 0) == 88
    assert all(s != 2 for s, *_ in plan)


def test_texts_hold_the_taken_words(spark):
    rows = [(i, " ".join(f"d{i}w{j}" for j in range(20)), "s", "x") for i in range(6)]
    docs = documents(spark, rows)
    texts = mixed_texts(docs, RULES).collect()
    words = [w for row in texts for w in row["text"].split(" ")]
    assert len(words) == 120 and len(set(words)) == 120


def test_empty_table(spark):
    assert mixed_documents(documents(spark, []), RULES).count() == 0
