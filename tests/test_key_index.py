"""The index of earlier loads' keys: it misses none, and loads that hold none are not read."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

import bank
from vaultspan.plans.staging import Run, StagedFact
from vaultspan.sources.files import LoadedTable
from vaultspan.sources.key_index import KeyIndex
from vaultspan.sources.schemas import FACTS


def keyed(spark, numbers, form="K%08d"):
    return spark.range(1).select(F.explode(F.lit(list(numbers))).alias("n")).select(F.format_string(form, "n").alias("k"), F.col("n").alias("id"))


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    made = KeyIndex(spark, str(tmp_path_factory.mktemp("state") / "t"), "k", "id")
    made.add("even", keyed(spark, range(0, 9000, 2)))
    made.add("late", keyed(spark, range(50_000, 50_500)))
    made.add("none", keyed(spark, range(3)).limit(0))
    made.add("nulls", keyed(spark, range(3)).withColumn("k", F.lit(None).cast("string")))
    return made


LOADS = ["late", "even", "none", "nulls"]


def test_every_load_that_holds_a_key_is_named(spark, index):
    for n in (0, 2, 4444, 8998):
        assert index.possible(LOADS, keyed(spark, [1, n])) == ["even"]
    assert index.possible(LOADS, keyed(spark, [*range(0, 9000, 2)])) == ["even"]
    assert index.possible(LOADS, keyed(spark, [50_499, 8998])) == ["late", "even"]


def test_new_keys_name_no_load(spark, index):
    assert index.possible(LOADS, keyed(spark, range(1, 9000, 2))) == []  # inside the range, so the filter decides
    assert index.possible(LOADS, keyed(spark, range(60_000, 60_100))) == []
    assert index.possible(LOADS, keyed(spark, [4], form="Z%d")) == []
    assert index.possible(LOADS, keyed(spark, [2]).limit(0)) == []
    assert index.possible(["late"], keyed(spark, [2])) == []


def test_summaries(index):
    found = {s.load: (s.rows, s.least, s.greatest, s.highest_id, s.blocks) for s in index.summaries(LOADS)}
    assert found["even"] == (4500, "K00000000", "K00008998", 8998, 5)
    assert found["none"] == (0, None, None, 0, 0)
    assert index.highest_id(LOADS) == 50_499 and index.highest_id([]) == 0


def test_filters_are_sparse_enough(spark, index):
    """At most about a third of the bits is set, so a strange key seldom passes."""
    bits = index._filters.read(["even"]).select(F.bitmap_count("bits")).collect()
    assert len(bits) == 5 and max(r[0] for r in bits) < 0.4 * 32_768


def test_a_load_of_new_keys_reads_no_earlier_load(spark, tmp_path, monkeypatch):
    staged = StagedFact(spark, str(tmp_path / "stg"), FACTS["fct_ope"])
    read, plain = [], LoadedTable.read

    def recording(self, loads, schema=None):
        if self.path == staged.store.path:
            read.append(list(loads))
        return plain(self, loads, schema)

    def load(name, rows, loads):
        part = staged.store.write(name, staged.fresh(bank.raw(spark, "fct_ope", rows), Run(name, datetime(2024, 3, 1)), loads))
        staged.index.add(name, part)

    load("a", bank.OPERATIONS[:1], [])
    monkeypatch.setattr(LoadedTable, "read", recording)
    load("b", bank.OPERATIONS[1:2], ["a"])
    assert read == [[], ["b"]]  # only what was just written
    read.clear()
    load("c", bank.OPERATIONS, ["a", "b"])
    assert read[0] == ["a", "b"]
    rows = plain(staged.store, ["a", "b", "c"]).select("id_stg_fct_ope", "cd_fct_ope").collect()
    assert sorted((int(i), k) for i, k in rows) == [(1, "OPE-1"), (2, "OPE-2"), (3, "OPE-3")]
