import hashlib
import itertools
import random
import re
import zlib

import pytest

from murmur.llm import conversations as cv
from murmur.llm.edit_trie import ROOT, EditTrie

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def whole(rows, block=3, trie=EditTrie):
    """Cost and audit by blocks and their chain."""
    chain = cv.Chain()
    blocks = [rows[i : i + block] for i in range(0, len(rows), block)]
    solved = [cv.solve_block(b, cv._STATES if i else (cv.START,), trie) for i, b in enumerate(blocks)]
    for b, exits in zip(blocks, solved):
        plain = {e: {s: v[:2] for s, v in states.items()} for e, states in exits.items()}
        chain.add(plain, 0, b[0][0], b[-1][0])
    cost, tail, path = chain.finish()
    return cost, "".join(exits[p][q][2] for exits, (p, q) in zip(solved, path)) + tail


def enumerated(rows):
    """Every way to edit a few rows, tried out."""
    inserts = [""] + ["".join(x) for n in (1, 2) for x in itertools.product("ua", repeat=n)]
    best = None
    for picks in itertools.product(inserts, repeat=len(rows) + 1):
        for edits in itertools.product(("D", "K", "u", "a"), repeat=len(rows)):
            cost, audit, roles = 0, "", ""
            for put, edit, (initial, must_go, cut) in zip(picks, edits, rows):
                cost += 2 * len(put) + (3 if edit == "D" else cut + 2 * (edit != "K"))
                audit += "I" * len(put) + (edit if edit in "DK" else "R")
                roles += put + {"D": "", "K": initial}.get(edit, edit)
                if must_go and edit != "D":
                    break
            else:
                cost, audit, roles = cost + 2 * len(picks[-1]), audit + "I" * len(picks[-1]), roles + picks[-1]
                if LEGAL.match(roles) and (best is None or (cost, audit) < best):
                    best = cost, audit
    return best


def row_cases(rng, n):
    return [(rng.choice("suaux"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(n)]


def test_cheapest_edits_of_short_conversations():
    rng = random.Random(5)
    for _ in range(25):
        rows = row_cases(rng, rng.randint(1, 2))
        assert whole(rows, block=1) == enumerated(rows), rows


def test_three_rows():
    rng = random.Random(6)
    for _ in range(4):
        rows = row_cases(rng, 3)
        assert whole(rows) == enumerated(rows), rows


def plain(rows):
    """The same program with whole texts as states."""
    best = {"": (0, "")}
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    for initial, must_go, cut in rows:
        found = {}
        reach = dict()
        for state, (cost, audit) in best.items():
            reach.setdefault(state, []).append((cost, audit))
            one = "a" if state == "u" else "u"
            reach.setdefault(one, []).append((cost + 2, audit + "I"))
            if state in ("", "s"):
                reach.setdefault("a", []).append((cost + 4, audit + "II"))
        for state, options in reach.items():
            for cost, audit in options:
                steps = [(state, 3, "D")]
                if not must_go:
                    if initial and initial in follow[state]:
                        steps.append((initial, int(cut), "K"))
                    steps.append(("a" if state == "u" else "u", 2 + cut, "R"))
                for to, more, letter in steps:
                    offer = (cost + more, audit + letter)
                    found[to] = min(found.get(to, offer), offer)
        best = found
    tail = {"": (0, ""), "s": (4, "II"), "u": (2, "I"), "a": (0, "")}
    return min((c + tail[s][0], a + tail[s][1]) for s, (c, a) in best.items())


@pytest.mark.parametrize("block", [1, 4, 1000])
def test_long_conversations_in_blocks(block):
    rng = random.Random(block)
    for n in (5, 17, 120):
        rows = row_cases(rng, n)
        assert whole(rows, block) == plain(rows)


def test_hash_collisions_are_noticed():
    rng = random.Random(9)

    class Colliding(EditTrie):
        def __init__(self):
            super().__init__(modulus=3)

    for n in (6, 40):
        rows = row_cases(rng, n)
        assert whole(rows, 7, Colliding) == plain(rows)


def test_trie_orders_like_texts():
    rng = random.Random(2)
    for modulus in (2, (1 << 61) - 1):
        trie = EditTrie(modulus)
        texts = sorted({"".join(rng.choice("DIKR") for _ in range(rng.randint(0, 40))) for _ in range(60)})
        texts += [t + "K" for t in texts[:10] if t + "K" not in texts]
        nodes = {t: trie.extend(ROOT, t) for t in texts}
        for a in texts:
            assert trie.text(nodes[a]) == a
            for b in texts:
                assert trie.compare(nodes[a], nodes[b]) == (a > b) - (a < b)


# ------------------------------------------------------------------- whole queries


def damaged(rows):
    kept = []
    for conv, turn, role, text in rows:
        shown = [" " if v is None else v for v in (conv, turn, role, text)]
        fate = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = shown[2:]
        if fate == 0:
            continue
        if fate == 1:
            text = ""
        elif fate == 2:
            text = re.sub("[.!?]", "", text)
        elif fate == 4:
            role = "user"
        kept += [(conv, turn, role, text)] * (2 if fate == 3 else 1)
    return kept


def brute(rows, all_rows):
    found = {}
    for conv in {r[0] for r in all_rows}:
        own = [r[1:] for r in rows if r[0] == conv]
        digest = lambda r, t: hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).hexdigest()
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r[1], r[2])))
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, cases, counts = set(), [], [0, 0, 0]
        for _, role, text in own:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            cases.append((role[:1], fault in (0, 1), fault == 2))
        heads = [c[0] for c in cases]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:]))
        cost, audit = plain(cases) if cases else (0, "")
        said, state, todo = [], "", list(own)
        for edit in audit:
            row = todo.pop(0) if edit != "I" else None
            if edit == "D":
                continue
            role = row[1] if edit == "K" else "assistant" if state == "u" else "user"
            said.append(f"{role}:{row[2] if row else ''}")
            state = role[0]
        hashed = hashlib.sha256("\n".join(said).encode()).hexdigest()
        found[conv] = (gaps, *counts, illegal, cost, audit, hashed)
    return found


def compare(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r[0]: tuple(r)[1:] for r in cv.repair_damaged(frame).collect()}
    assert got == brute(damaged(rows), rows)


def talk(rng, conv, n):
    roles, rows = ["system"] * (rng.random() < 0.3) + ["user", "assistant"] * n, []
    for turn in range(n):
        if rng.random() < 0.05:
            continue
        text = rng.choice(("Yes.", "No?", "one two. three", "Grüße!\n", "end. ", "x"))
        rows.append((conv, turn, roles[turn], f"{text}" if rng.random() < 0.5 else f"{turn} {text}"))
    return rows


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(cv, "BLOCK_ROWS", 16)
    rng = random.Random(4)
    rows = [row for conv in range(60) for row in talk(rng, conv, rng.randint(1, 9))]
    rows += talk(rng, 999, 300)
    compare(spark, rows)


def test_nulls_ties_long_texts_and_lost_conversations(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [
        (None, None, None, None), (None, 1, "user", "a."), (None, 2, "", "b."), (1, None, "user", None),
        (1, None, "assistant", "c."), (2, 5, "user", "d."), (2, 5, "assistant", "d."), (2, 5, "assistant", "d."),
        (3, 0, "user", "long " * 100_000 + "."), (3, 9, "assistant", "\t\n"), (lost, 0, "user", "gone."),
        (4, 0, "umpire", "e."), (4, 1, "system", "f"), (4, 2, "robot", "g!"),
    ]
    compare(spark, rows)


def test_empty_table_and_repaired_turns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cv.repair_damaged(empty).count() == 0
    assert cv.repaired_turns(empty).count() == 0
    rows = [(1, 0, "assistant", "late."), (1, 1, "user", "q?"), (1, 2, "user", "q?")]
    named = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS place", "2 AS kind", "3 AS audit")
    turns = [tuple(r) for r in cv.repaired_turns(named).orderBy("turn").collect()]
    report = cv.repair_report(named, named).first()
    assert [t[3] for t in turns] == ["user", "assistant"] * (len(turns) // 2)
    said = "\n".join(f"{t[3]}:{t[4]}" for t in turns)
    assert report["repaired_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert report["duplicate"] == 1 and report["audit"].count("D") >= 1
