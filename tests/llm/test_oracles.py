"""Corpus queries against their SQL: the smallest tables, and a folder of awkward rows."""

from __future__ import annotations

import pytest

import compare
from vaultspan.llm.queries import oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
LINE = "The same plain line of words goes on "


def awkward(spark, folder):
    """Nulls, empty texts, repeated rows, ties, long and short repeats, accents; ids are unique but for one null."""
    texts = [
        None, "", " \t\n", "one", "one", "ONE", LINE * 12, LINE * 12, LINE * 13, "x " + LINE * 6, "a b " * 400, "É" * 260, "é" * 260, "É" * 120,
        "wonderful wonderful wonderful wonderfull wanderful wonderfully Wonderful " * 4 + "wanderful", "naïveté naïveté naivete naïvete " * 9,
        *[f"{LINE * 7} tail number {i}" for i in range(8)],
    ]
    rows = [(i if i else None, t, "en", (None, "b", "a", "Z")[i % 4], len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    near = [1.0, 0.1, 0.0]
    vectors = [
        None, [], [0.0, 0.0, 0.0], [1.0, None, 0.0], [float("nan"), 1.0, 0.0], [1.0, 0.0], near, near, [2.0, 0.2, 0.0], [1.0, 0.25, 0.0],
        [1.0, 0.4, 0.0], [-1.0, 0.0, 0.0], [float("inf"), 0.0, 0.0],
    ]
    made = [(20 * label + i, v, None if label == 2 else label) for label in range(3) for i, v in enumerate(vectors)]
    spark.createDataFrame(made, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    page = "<p>é</p>" * 200
    pages = [(1, page), (2, page), (3, page + "."), (4, None), (5, ""), (6, "short"), (7, "short"), (8, "x" * 1000), (9, "x" * 1000), (10, "x" * 999), (11, "x" * 999)]
    spark.createDataFrame([(i, f"http://h/{i}", h) for i, h in pages], "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")


def connection(folder):
    import duckdb

    made = duckdb.connect()
    for name in ("documents", "embeddings", "pages"):
        files = f"{folder}/{name}.parquet"
        made.execute(f"create view {name} as select * from read_parquet('{files}{'' if folder == FOLDER else '/*.parquet'}')")
    return made


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    odd = str(tmp_path_factory.mktemp("odd"))
    awkward(spark, odd)
    return {"small": FOLDER, "odd": odd}


@pytest.mark.parametrize("folder", ["small", "odd"])
@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_equals_its_sql(spark, folders, name, folder):
    ours = compare.spark_result(queries()[name](spark, folders[folder]))
    theirs = compare.sql_result(connection(folders[folder]), oracle_sql()[name])
    assert compare.difference(ours, theirs) == ""
    assert ours[1]


def test_chunks_of_fewer_words_than_a_shingle(spark, tmp_path):
    for n in range(5):
        texts = [" ".join("abcd"[:n]), "", " ".join("ABCD"[:n])]
        docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
        docs.write.parquet(f"{tmp_path}/{n}/documents.parquet")
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries()["op1_ngram_jaccard"](spark, f"{tmp_path}/{n}").collect()}
        assert got == {0: (min(n, 1), 0), 1: (0, 1), 2: (min(n, 1), 0 if n else 2)}
