from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vaultspan.operators import surrogate
from vaultspan.operators.incremental import insert_only, newer_than_target, unseen, upsert, with_stable_ids
from vaultspan.operators.surrogate import highest_id, number_rows
from vaultspan.plans.staging import Run, stage_new_rows, stage_upsert
from vaultspan.sources.schemas import DIMENSIONS, FACTS
from vaultspan.session import stored
from vaultspan.types import SchemaDrift

import bank
from datetime import datetime

RUN = Run("r1", datetime(2024, 3, 1, 23, 0))


def keyed(spark, *keys):
    return spark.createDataFrame([(k, f"label {k}") for k in keys], "k string, label string")


def ids(df):
    return {r["k"]: int(r["id"]) for r in df.collect()}


def test_ids_are_stable_over_loads(spark):
    first = with_stable_ids(None, keyed(spark, "B", "A"), "k", "id", ["k"])
    assert ids(first) == {"A": 1, "B": 2}
    second = with_stable_ids(first, keyed(spark, "A", "B", "AA", "C"), "k", "id", ["k"])
    assert ids(second) == {"A": 1, "B": 2, "AA": 3, "C": 4}
    assert ids(with_stable_ids(second, keyed(spark, "A", "B", "AA", "C"), "k", "id", ["k"])) == ids(second)


def test_range_numbering(spark):
    # one portfolio holds two thirds of the rows
    rows = [("hot" if i % 3 else f"p{i}", i % 50, f"k{i}") for i in range(4000)]
    df = spark.createDataFrame(rows, "p string, d int, k string").repartition(5)
    order = ["p", "d", "k"]
    ranged = number_rows(df, order, "id", after=7)
    expected = {k: 8 + i for i, (_, _, k) in enumerate(sorted(rows))}
    assert {r["k"]: int(r["id"]) for r in ranged.collect()} == expected


def test_derived_columns_do_not_travel(spark, monkeypatch):
    rows = [(i % 7, i) for i in range(300)]
    df = spark.createDataFrame(rows, "g int, n int").repartition(3)
    kept = []
    monkeypatch.setattr(surrogate, "stored", lambda rows, name: kept.append(rows) or stored(rows, name))
    derived = {"p": F.expr("if(g = 6, null, concat('P', g))"), "k": F.expr("concat('key ', n)")}
    got = number_rows(df, ["p", "k"], "id", 2, derived)
    assert kept[0].columns == ["g", "n", "_slot"]
    plain = number_rows(df.withColumns(derived), ["p", "k"], "id", 2)
    assert got.columns == ["g", "n", "p", "k", "id"]
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.select(*got.columns).collect()))


def test_range_numbering_of_nothing(spark):
    assert number_rows(keyed(spark, "A").limit(0), ["k"], "id", 3).count() == 0
    assert highest_id(keyed(spark, "A").limit(0).selectExpr("1 as id"), "id") == 0


def test_upsert_replaces_appends_and_never_deletes(spark):
    old = spark.createDataFrame([("A", "old"), ("B", "old")], "k string, v string")
    new = spark.createDataFrame([("B", "new"), ("C", "new")], "k string, v string")
    assert sorted(map(tuple, upsert(old, new, "k").collect())) == [("A", "old"), ("B", "new"), ("C", "new")]


def test_insert_only_keeps_the_target(spark):
    old = spark.createDataFrame([("A", "old")], "k string, v string")
    new = spark.createDataFrame([("A", "new"), ("B", "new"), (None, "new")], "k string, v string")
    assert sorted(map(tuple, insert_only(old, new, "k").collect())) == [("A", "old"), ("B", "new")]
    assert unseen(None, new, "k").count() == 3


def test_schema_drift_is_refused(spark):
    old = spark.createDataFrame([("A", "x")], "k string, v string")
    for drifted in (keyed(spark, "B"), old.selectExpr("k", "1 as v"), old.select("k")):
        with pytest.raises(SchemaDrift):
            upsert(old, drifted, "k")
        with pytest.raises(SchemaDrift):
            insert_only(old, drifted, "k")


def test_date_watermark_drops_late_rows(spark):
    old = spark.createDataFrame([(date(2024, 1, 5),)], "d date")
    new = spark.createDataFrame([(date(2024, 1, 4),), (date(2024, 1, 5),), (date(2024, 1, 6),)], "d date")
    assert [r["d"] for r in newer_than_target(old, new, "d").collect()] == [date(2024, 1, 6)]
    assert newer_than_target(old.limit(0), new, "d").count() == 3
    assert newer_than_target(None, new, "d").count() == 3


@pytest.mark.parametrize("name", list(DIMENSIONS))
def test_every_dimension_is_staged(spark, name):
    table = DIMENSIONS[name]
    staged = stage_upsert(bank.raw(spark, name), table, RUN)
    rows = staged.orderBy(table.id_column).collect()
    assert [int(r[table.id_column]) for r in rows] == list(range(1, len(bank.ROWS[name]) + 1))
    assert [r[table.key] for r in rows] == sorted(row[0] for row in bank.ROWS[name])
    first = rows[0]
    assert (first["vr_stg"], first["id_obj_tec"], first["cd_src"], first["cd_pid"], first["lb_dsc"]) == (
        Decimal(20240301), Decimal(table.object_id), f"st0_{name}", "r1", None,
    )
    assert first[f"cd_{name}_src"] == first[f"cd_{name}"]
    assert first["ts_stg"] == datetime(2024, 3, 1, 23, 0)
    again = stage_upsert(bank.raw(spark, name), table, RUN, staged)
    assert sorted(map(str, again.collect())) == sorted(map(str, staged.collect()))


@pytest.mark.parametrize("name", list(FACTS))
def test_every_fact_is_staged_once(spark, name):
    table = FACTS[name]
    rows = bank.ROWS[name]
    first = stage_new_rows(bank.raw(spark, name, rows[:2]), table, RUN)
    assert first.count() == 2 and stage_new_rows(bank.raw(spark, name, rows[:2]), table, RUN, first).count() == 0
    more = stage_new_rows(bank.raw(spark, name), table, RUN, first)
    assert sorted(int(r[0]) for r in more.select(table.id_column).collect()) == list(range(3, len(rows) + 1))
    assert f"{table.key}_src" not in first.columns
