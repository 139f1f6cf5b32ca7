import hashlib
import random
import zlib

import duckdb
import pytest

from murmur.llm.manifest import LEVELS, _SPAN, manifest
from murmur.llm.oracle import manifest_sql
from murmur.llm.ranks import ranked

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    values = (doc_id, source, lang, n_chars, text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(digests):
    """Root, and for every leaf the siblings left and right of its path."""
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 3])) for i in range(0, len(below), 3)])
    paths = []
    for i in range(len(digests)):
        path = []
        for level in levels[:-1]:
            first = i // 3 * 3
            path.append(("".join(level[first:i]), "".join(level[i + 1 : first + 3])))
            i //= 3
        paths.append(path)
    return levels[-1][0], paths


def brute(rows):
    sources = {}
    for row in rows:
        sources.setdefault(row[3], []).append(row)
    held, subroots = [], []
    for source in sorted(sources, key=lambda s: (s is not None, (s or "").encode())):
        group = sorted(sources[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        subroot, paths = tree([leaf(*r) for r in group])
        subroots.append(subroot)
        held.append((subroot, group, paths))
    if not subroots:
        return []
    root, tops = tree(subroots)
    found = []
    for (subroot, group, paths), top in zip(held, tops):
        for row, path in zip(group, paths):
            doc_id, text, *rest = row
            if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
                text = text.replace("\n", "")
            at = leaf(doc_id, text, *rest)
            for left, right in path + top:
                at = sha(left + at + right)
            proof = sha("".join(a + b for a, b in path + top))
            found.append((doc_id, leaf(*row), subroot, root, proof, at, at == root))
    return found


def rows_of(sizes, seed=3):
    rng = random.Random(seed)
    rows, doc_id = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            doc_id += rng.choice((1, 1, 2))
            text = rng.choice((None, "", "a", "é\nb\n", "x y\nz", "long " * 50))
            rows.append((doc_id, text, rng.choice((None, "en", "")), source, rng.choice((None, 0, 12))))
    rng.shuffle(rows)
    return rows


def compare(spark, rows):
    found = [tuple(r) for r in manifest(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(found, key=repr) == sorted(brute(rows), key=repr)


@pytest.mark.parametrize(
    "sizes",
    [
        {"one": 1},
        {"a": 3, "b": 4, None: 2, "": 1, "é": 9, "z": 10},
        {"big": _SPAN + 1, "exact": _SPAN, "small": 2},
    ],
)
def test_against_brute_force(spark, sizes):
    compare(spark, rows_of(sizes))


def test_two_bands_and_many_sources(spark):
    sizes = {f"s{i}": 1 + i % 3 for i in range(_SPAN + 5)} | {"hot": 3 ** (LEVELS + 2) + 1}
    compare(spark, rows_of(sizes))


def test_nulls_ties_and_long_texts(spark):
    rows = [
        (None, "a\n", None, None, None), (None, "b", "en", None, 1), (7, "t\n", "en", "s", 2),
        (7, "t\n", "en", "s", 2), (7, "other", "en", "s", 2), (8, "w\n" * 200_000, "en", "s", 3),
    ]
    compare(spark, rows)


def test_empty_table_and_clashing_columns(spark):
    rows = rows_of({"a": 5})
    docs = spark.createDataFrame(rows, SCHEMA)
    clashing = docs.selectExpr("*", "1 AS tree", "'x' AS leaf", "2 AS place", "3 AS root", "4 AS row")
    assert sorted(map(tuple, manifest(clashing).collect())) == sorted(brute(rows))
    assert manifest(docs.where("doc_id < 0")).count() == 0


def test_sql_gives_the_same(spark):
    rows = rows_of({"a": 30, "b": 1, None: 10})
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    connection.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    found = connection.execute(manifest_sql()).fetchall()
    assert sorted(found, key=repr) == sorted(brute(rows), key=repr)


def test_ranks_of_groups(spark):
    rng = random.Random(1)
    rows = [(rng.choice((None, "a", "b", "hot", "hot", "hot")), rng.randrange(50)) for _ in range(500)]
    found = ranked(spark.createDataFrame(rows, "k string, v int"), "k", ["v"], "test").collect()
    for key in {k for k, _ in rows}:
        group = sorted((r["place"], r["v"]) for r in found if r["k"] == key)
        values = sorted(v for k, v in rows if k == key)
        assert group == list(enumerate(values))
        assert {r["group_rows"] for r in found if r["k"] == key} == {len(values)}
    firsts = {r["k"]: r["group_id"] for r in found}
    assert [k for k, _ in sorted(firsts.items(), key=lambda x: x[1])] == [None, "a", "b", "hot"]
