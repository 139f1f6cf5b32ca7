import hashlib
import random
import re

from murmur.llm.substrings import PassageRules, remove_repeats, without_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width=13):
    first = {}
    for doc, text in rows:
        words = WORD.findall(text or "")
        for i in range(len(words) - width + 1):
            key = tuple(words[i : i + width])
            if doc is not None:
                first[key] = min(doc, first.get(key, doc))
    out = []
    for doc, text in rows:
        words = WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - width + 1):
            if doc is not None and first[tuple(words[i : i + width])] < doc:
                gone.update(range(i, i + width))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)] + ["é", "ß…", "\x1c", "的"]
    def prose(n):
        return [rng.choice(words) for _ in range(n)]
    shared = [prose(60) for _ in range(4)]
    rows = []
    for i in range(80):
        text = prose(rng.randrange(0, 90))
        for passage in rng.sample(shared, rng.randrange(0, 3)):
            cut = rng.randrange(0, 40)
            text += passage[cut : cut + rng.randrange(5, 60)] + prose(rng.randrange(0, 5))
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(text)))
    rows += [(90, rows[3][1]), (91, "a " * 40), (92, "a " * 30), (93, None), (94, ""), (95, "b " * 13)]
    rows += [(96, " ".join(shared[0][:13])), (97, " ".join(shared[0][:12]))]
    rows += [(90, rows[3][1]), (None, rows[3][1]), (98, " ".join(prose(30_000) + shared[1]))]
    return rows


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, hash int")


def test_removed_words_equal_brute_force(spark):
    rows = corpus()
    assert found(remove_repeats(frame(spark, rows))) == brute(rows)


def test_small_blocks_and_automata_change_nothing(spark):
    rows = corpus()
    rules = PassageRules(block_rows=50, automaton_bytes=100, automaton_texts=500)
    assert found(remove_repeats(frame(spark, rows).repartition(5), rules)) == brute(rows)


def test_kept_texts_match_their_digests(spark):
    for row in without_repeats(frame(spark, corpus())).collect():
        assert hashlib.sha256(row["kept"].encode()).hexdigest() == row["kept_sha256"]


def test_empty_table(spark):
    assert remove_repeats(frame(spark, [])).count() == 0
