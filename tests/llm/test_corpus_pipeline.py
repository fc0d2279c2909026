"""Stages of the corpus pipeline, alone and together, and the registered queries."""

from __future__ import annotations

import collections
import hashlib

import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as spark_entry
import corpus_pipeline
from vaultspan.llm import byte_bpe, mixing, secret_scan, toxicity

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What every stage made of the one before, written and read again."""
    place = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{place}/{name}")
        docs = out[name] = spark.read.parquet(f"{place}/{name}")
    return out


def rows_of(docs):
    return [tuple(r) for r in docs.select(*corpus_pipeline.COLUMNS).collect()]


def test_stages_keep_the_columns_of_documents(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "secrets", "mixing", "tokens"]
    assert all(stages[n].columns == list(corpus_pipeline.COLUMNS) for n in names[:-1])


def test_toxic_documents_go(spark, stages):
    docs = stages["documents"]
    machine = toxicity.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    clean = toxicity.score(docs, machine, column="s").where("s < 0.7").drop("s")
    assert sorted(rows_of(stages["toxicity"])) == sorted(rows_of(clean))


def test_one_document_of_each_group_stays(stages):
    from test_documents import brute_components

    rows = [(r[0], r[1]) for r in rows_of(stages["toxicity"])]
    expected = {key for key, _, component, _ in brute_components(rows) if key == component}
    kept = [r[0] for r in rows_of(stages["near_duplicates"])]
    assert sorted(kept) == sorted(expected)


def test_secrets_are_masked_and_clean_texts_kept(stages):
    before, after = {r[0]: r for r in rows_of(stages["near_duplicates"])}, {r[0]: r for r in rows_of(stages["secrets"])}
    spans = {r["doc_id"]: r["secret_spans"] for r in secret_scan.find_secrets(stages["near_duplicates"]).collect()}
    assert set(before) == set(after)
    for key, row in before.items():
        if not spans[key]:
            assert after[key] == row
            continue
        text, at, parts = row[1], 0, []
        for span in spans[key]:
            if span["start"] >= at:
                parts += [text[at : span["start"]], "[SECRET]"]
            at = max(at, span["end"])
        masked = "".join(parts) + text[at:]
        assert after[key] == (key, masked, row[2], row[3], len(masked))


def test_documents_appear_once_per_pass(stages):
    passes = {r["doc_id"]: len(r["positions"]) for r in mixing.mix(stages["secrets"]).collect()}
    seen = collections.Counter(r[0] for r in rows_of(stages["mixing"]))
    assert seen == {k: n for k, n in passes.items() if n}


def test_tokens_decode_to_the_texts(spark, stages):
    decoded = byte_bpe.decode(stages["tokens"], public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    found = collections.Counter((r["doc_id"], bytes(r["decoded"])) for r in decoded.collect())
    assert found == collections.Counter((r[0], (r[1] or "").encode()) for r in rows_of(stages["mixing"]))


def test_run_gives_what_the_stages_give(spark, stages):
    digest = lambda rows: collections.Counter((r["doc_id"], hashlib.sha256(r["ids"]).hexdigest()) for r in rows.collect())
    assert digest(corpus_pipeline.run(spark, FOLDER)) == digest(stages["tokens"])


def test_every_stage_takes_awkward_and_empty_tables(spark, awkward, nothing):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, FOLDER).collect() == [], name
        found = stage(spark, awkward, FOLDER).collect()
        assert found, name
        ids = collections.Counter(r["doc_id"] for r in found)
        if name in ("toxicity", "secrets", "tokens"):
            assert len(found) == 11
        if name == "near_duplicates":  # the quick fox once, both texts of id 6, everything empty stays
            assert ids == {1: 1, 3: 1, 4: 1, 5: 1, None: 1, 6: 2, 7: 1, 8: 1}
        if name == "mixing":
            assert not {3, 4, 5} & set(ids)


# those with SQL are compared with it, row by row, in test_oracles.py
@pytest.mark.parametrize("name", [n for n in spark_entry.queries() if n.startswith("op") and n not in spark_entry.oracle_sql()])
def test_registered_queries_answer_for_the_whole_table(spark, name):
    found = spark_entry.queries()[name](spark, FOLDER)
    table = "embeddings" if name.startswith(("op9_", "op10_")) else "documents"
    rows = spark.read.parquet(f"{FOLDER}/{table}.parquet")
    expected = 10 * rows.where("vec_id % 100 = 0").count() if name.startswith("op9_") else rows.count()
    assert found.count() == expected
    assert np.unique(found.columns).size == len(found.columns)


def test_pipeline_is_registered():
    assert "pipeline" in spark_entry.queries()
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in spark_entry.oracle_sql()


def test_groups_of_one_name_all_stay(spark):
    """Two groups without ids, two under one repeated id, and groups joined by near copies."""
    words = lambda name: [f"{name}{i}" for i in range(30)]
    text, near = lambda name: " ".join(words(name)), lambda name: " ".join(words(name) + ["more"])
    rows = [(None, text("a")), (None, near("a")), (None, text("b")), (None, text("b"))]
    rows += [(6, text("x")), (9, near("x")), (6, text("y")), (10, near("y"))]
    rows += [(None, text("z")), (7, text("z")), (7, near("z")), (8, text("alone")), (None, text("single"))]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = collections.Counter((r[0], r[1][:1]) for r in rows_of(corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER)))
    assert kept == collections.Counter([(None, "a"), (None, "b"), (6, "x"), (6, "y"), (7, "z"), (8, "a"), (None, "s")])
