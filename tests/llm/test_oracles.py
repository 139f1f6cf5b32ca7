"""Whole results against their DuckDB statements, on the smallest tables and on edge rows."""

import duckdb
import pytest

from murmur.llm.queries import llm_oracles, llm_queries

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i}" for i in range(40))
EDGES = {
    "pages": (
        "page_id long, url string, html string",
        [(1, "a", None), (2, "b", ""), (3, "c", "é\n"), (4, "d", "é\n"), (5, "e", "x" * 200_000), (6, None, "é\n")],
    ),
    "documents": (
        "doc_id long, text string, word string",
        [(1, None, "x"), (2, "", "x"), (3, LONG, "x"), (4, "é " + LONG + "\x0b end", "x"), (5, "a " * 40, None)]
        + [(6, LONG + " " + LONG, "x"), (7, "a " * 30_000, "x"), (8, " ".join(LONG.split()[:12]), "x")],
    ),
}


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in found), key=repr)


def same(spark, name, table, folder):
    frame = llm_queries()[name](spark, folder)
    with duckdb.connect() as duck:
        files = f"{folder}/{table}.parquet" + ("" if folder == SF else "/*.parquet")
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{files}'")
        cursor = duck.execute(llm_oracles()[name])
        columns = [c[0] for c in cursor.description]
        assert rows(frame.columns, frame.collect()) == rows(columns, cursor.fetchall())


@pytest.mark.parametrize("name, table", [("op1_warc", "pages"), ("op4_substrings", "documents")])
def test_query_equals_sql(spark, tmp_path, name, table):
    same(spark, name, table, SF)
    schema, data = EDGES[table]
    spark.createDataFrame(data, schema).coalesce(2).write.parquet(str(tmp_path / f"{table}.parquet"))
    same(spark, name, table, str(tmp_path))
