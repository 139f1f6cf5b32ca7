import random
import re
from collections import Counter

from murmur.llm.quality import QualityRules, keep_good, score_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i, window in enumerate(zip(words, words[1:], words[2:])):
        if windows[window] > 1:
            covered.update((i, i + 1, i + 2))
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeats += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, repeats, len(covered), failed


def corpus():
    rng = random.Random(3)
    usual = "the of and to in is that it was for on are as with they at be this".split()
    rare = ["".join(rng.choice("abcdeilnorst") for _ in range(7)) for _ in range(800)]
    def prose(n):
        return " ".join(rng.choice(usual) if rng.random() < 0.4 else rng.choice(rare) for _ in range(n)) + "."
    rows = [(i, prose(rng.randrange(60, 400)), "en") for i in range(120)]
    rows += [
        (200, None, "en"),
        (201, "", None),
        (202, " \n\n\t", "en"),
        (203, "a a a a " * 40, "en"),
        (204, "line one\nline one\n\n\nline one \nß#*$ é<>", "de"),
        (205, "*** ### $$$ " + " ".join(f"{rng.random()}#{i}%" for i in range(150)), "en"),
        (206, "x y\x1cz " * 3, None),
        (None, prose(90), "en"),
        (3, prose(90), "en"),
        (207, prose(40_000), "en"),
    ]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, lang string, kept string")


def test_counts_equal_brute_force(spark):
    rows = corpus()
    found = score_quality(frame(spark, rows)).toPandas()
    assert len(found) == len(rows)
    expected = Counter((i, *brute(t)) for i, t, _ in rows if i is not None)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    known = found[found.doc_id.notna()]
    assert Counter((int(r[0]), *map(int, r[1:6]), bool(r[6])) for r in known[names].itertuples(index=False)) == expected
    assert not found[found.base_failed].kept.any()


def test_divergent_text_is_rejected_and_prose_stays(spark):
    rows = corpus()
    rules = QualityRules()
    found = score_quality(frame(spark, rows), rules).toPandas().set_index("doc_id")
    assert found.loc[range(120)].kept.all()
    assert found.loc[205].class_distance > rules.max_class_distance and not found.loc[205].kept


def test_wrong_language_and_no_common_words_are_rejected(spark):
    rng = random.Random(11)
    common = {
        "en": "the of and to in is that it was for on are as with they at be this from or".split(),
        "de": "der die und den von zu das mit sich des auf ist im dem nicht ein eine als auch es".split(),
    }
    rare = ["".join(rng.choice("abcdeilnorst") for _ in range(7)) for _ in range(2_000)]

    def prose(lang, share=0.3, n=200):
        return " ".join(rng.choice(common[lang] if rng.random() < share else rare) for _ in range(n))

    rows = [(i, prose(lang), lang) for i, lang in enumerate(["en", "de"] * 100)]
    rows += [(300, prose("de"), "en"), (301, prose("en"), "de")]
    rows += [(302, prose("en", 0), "en"), (303, prose("de", 0), "de"), (304, prose("en", n=80), "en")]
    found = score_quality(frame(spark, rows)).toPandas().set_index("doc_id")
    assert not found.base_failed.any()
    assert found.loc[[*range(200), 304]].kept.all()
    assert not found.loc[300:303].kept.any()


def test_kept_rows_keep_their_columns(spark):
    rows = corpus()
    docs = frame(spark, rows)
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {*range(120), None, 207}


def test_empty_table(spark):
    assert score_quality(frame(spark, [])).count() == 0


def test_word_counts_leave_a_task_before_they_fill_its_memory():
    """Each piece holds few words, and all pieces together count every word."""
    import pyarrow as pa

    from murmur.llm.quality import _profile_rows

    texts = [" ".join(f"w{n}q" for n in range(k, k + 110_000)) for k in (0, 50_000)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "en"]), pa.array(texts)], names=["lang", "text"])
    pieces = list(_profile_rows(iter([batch])))
    assert len(pieces) == 2
    words = sum(
        n for p in pieces for c, n in zip(p.column(1).to_pylist(), p.column(3).to_pylist()) if c == -1
    )
    assert words == sum(len(t.split()) for t in texts)
