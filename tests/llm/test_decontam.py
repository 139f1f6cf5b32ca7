import random

from murmur.llm.decontam import ItemIndex, SearchRules, benchmark_items, contaminations, drop_contaminated, plain_words


def material():
    rng = random.Random(6)
    common = "the of and to in is that it was for".split()
    rare = ["".join(rng.choice("abcdefgilmnorst") for _ in range(6)) for _ in range(2_000)]
    def prose(n):
        return " ".join(rng.choice(common) if rng.random() < 0.4 else rng.choice(rare) for _ in range(n))
    items = [(i, f"{prose(rng.randrange(8, 50))}. {prose(rng.randrange(1, 9))}.") for i in range(60)]
    items += [(60, None), (61, ""), (62, prose(300) + ".")]
    docs, truth = [], set()
    for i in range(150):
        text = prose(rng.randrange(0, 500))
        if i % 5 == 0:
            item, body = rng.choice(items[:60])
            text = f"{text}\n{body.upper() if i % 10 else body} {prose(30)}"
            truth.add((i, item))
        docs.append((i, text))
    docs += [(200, None), (201, ""), (202, prose(20_000) + " " + items[62][1]), (None, items[5][1])]
    asked = next(t for _, t in items[:60] if len(t.split(". ")[1].split()) > 5)
    docs += [(203, asked.split(". ")[0] + " and no answer"), (0, docs[0][1])]
    truth.add((202, 62))
    return items, docs, truth


def frames(spark, items, docs):
    return (
        spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, item_id int"),
        spark.createDataFrame(items, "item_id long, text string"),
    )


def test_planted_items_are_found_and_nothing_else(spark):
    items, rows, truth = material()
    docs, tests = frames(spark, items, rows)
    found = contaminations(docs, benchmark_items(tests)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found if r["doc_id"] is not None} == truth
    assert [r["item_id"] for r in found if r["doc_id"] is None] == [5]
    assert sum(r["doc_id"] == 0 for r in found) == 2


def test_shards_find_the_same(spark):
    items, rows, truth = material()
    docs, tests = frames(spark, items, rows)
    found = contaminations(docs, benchmark_items(tests), SearchRules(shard_items=20)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found if r["doc_id"] is not None} == truth


def test_clean_documents_keep_their_columns(spark):
    items, rows, truth = material()
    docs, tests = frames(spark, items, rows)
    clean = drop_contaminated(docs, benchmark_items(tests))
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in rows if d is not None} - {d for d, _ in truth}


def test_blocks_never_hide_a_segment():
    """Block maxima only skip what a full scoring of every passage and segment misses too."""
    items, rows, _ = material()
    rules = SearchRules(score=0.3)
    index = ItemIndex([(i, t, None) for i, t in items], rules)
    stride = rules.passage_words // 2
    for _, text in rows[:60]:
        words = plain_words((text or "").encode())
        place, term = index.term_places(words)
        best = {}
        for start in range(0, max(1, len(words) - stride), stride):
            inside = set(term[(place >= start) & (place < start + 2 * stride)])
            scores = {}
            for t in inside:
                for b in range(index.blocks):
                    for k in range(index.starts[t * index.blocks + b], index.starts[t * index.blocks + b + 1]):
                        scores[index.segment[k]] = scores.get(index.segment[k], 0) + index.impact[k]
            for segment, score in scores.items():
                if score >= rules.score:
                    owner = int(index.owners[segment])
                    best[owner] = max(best.get(owner, 0), score)
        found = index.retrieve(words)
        assert found.keys() == best.keys()
        assert all(abs(found[k] - best[k]) < 1e-9 for k in best)


def test_empty_tables(spark):
    docs, tests = frames(spark, [], [(1, "a b c")])
    assert contaminations(docs, benchmark_items(tests)).count() == 0
    assert drop_contaminated(docs, benchmark_items(tests)).count() == 1
    assert contaminations(docs.where("doc_id < 0"), benchmark_items(tests)).count() == 0
