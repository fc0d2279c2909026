from __future__ import annotations

import os
from collections import Counter
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import functions as F

from vaultspan.operators import quality as q
from vaultspan.plans.checks import declared_checks
from vaultspan.sources.files import LoadedTable


def test_declared_checks():
    kinds = Counter(c.kind for c in declared_checks())
    assert kinds == {
        "not_null": 474, "unique": 53, "accepted_values": 12, "relationships": 21, "between": 11, "pair_ge": 2,
        "fx_direct": 29, "fx_pivot": 6, "positive_amounts": 1,
    }
    declared = {(c.table, c.column, c.kind) for c in declared_checks()}
    assert len(declared) == 609
    required = {c for t, c, kind in declared if t == "mart_ptf_detail" and kind == "not_null"}
    assert required == {"dt_fct", "cd_ptf", "cd_cli", "mt_net", "mt_net_ref"}


def values(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, a string, n int, m int")


def test_violating_rows(spark):
    df = values(spark, ("x", 1, 1), ("x", 0, 2), (None, None, 3), ("y", 5, 4))

    def found(rows):
        return sorted(r["id"] for r in rows.collect())

    assert found(q.missing_rows(df, "a")) == [2]
    assert [tuple(r) for r in q.duplicate_values(df, "a").collect()] == [("x", 2)]
    assert found(q.unaccepted_rows(df, "a", ["x"])) == [3]
    assert found(q.out_of_range_rows(df, "n", low=0)) == []
    assert found(q.out_of_range_rows(df, "n", low=0, strictly=True)) == [1]
    assert found(q.out_of_range_rows(df, "n", low=0, high=4)) == [3]
    assert found(q.unordered_rows(df, "n", "m", or_equal=True)) == [1]
    assert found(q.unordered_rows(df, "n", "m")) == [0, 1]
    assert found(q.negative_rows(df.selectExpr("id", "n - 1 as n", "m - 4 as m"), "n", "m")) == [0, 1, 2]
    parent = spark.createDataFrame([("x",), (None,)], "p string")
    assert found(q.orphan_rows(df, "a", parent, "p")) == [3]
    assert [tuple(r) for r in q.unknown_values(df, "a", parent, "p").collect()] == [("y", 1)]


def test_misconverted_rows(spark):
    rows = [(1, "100", "0.5", "50.0099", "0.25", "200.0000"), (2, "100", "0.5", "50.0200", "0.25", "200.5000")]
    typed = [(i, *(Decimal(v) for v in r)) for i, *r in rows]
    schema = "id int, a decimal(19,4), r decimal(26,11), ref decimal(19,4), p decimal(26,11), ptf decimal(19,4)"
    df = spark.createDataFrame(typed, schema)
    direct = q.misconverted_rows(df, "ref", "a", "r").collect()
    assert [(r["id"], r["expected_ref"], r["ecart"]) for r in direct] == [(2, Decimal(50), Decimal("0.02"))]
    pivot = q.misconverted_rows(df, "ptf", "a", "r", "p").collect()
    assert [(r["id"], r["expected_ptf"], r["ecart"]) for r in pivot] == [(2, 200.0, 0.5)]


def test_summary_counts_and_status(spark):
    df = values(spark, ("x", 1, 1), ("x", 0, 2), ("z", None, 3))
    tables = {"t": df, "p": spark.createDataFrame([("x",)], "k string")}
    checks = [
        q.required("t", "n"), q.required("t", "a"), q.unique("t", "a"), q.unique("t", "id"),
        q.references("t", "a", "p", "k"), q.accepted("t", "a", ["x"]), q.between("t", "n", low=0, strictly=True),
        q.ordered("t", "n", "m", or_equal=True), q.not_negative("t", "n"), q.required("p", "k"),
    ]
    got = {(r["table_name"], r["column_name"], r["check"]): (r["failures"], r["status"])
           for r in q.run_checks(checks, tables.__getitem__).collect()}
    assert got == {
        ("t", "n", "not_null"): (1, "fail"), ("t", "a", "not_null"): (0, "pass"), ("t", "a", "unique"): (1, "fail"),
        ("t", "id", "unique"): (0, "pass"), ("t", "a", "relationships"): (1, "fail"),
        ("t", "a", "accepted_values"): (1, "fail"), ("t", "n", "between"): (1, "fail"),
        ("t", "n,m", "pair_ge"): (1, "fail"), ("t", "n", "positive_amounts"): (0, "pass"),
        ("p", "k", "not_null"): (0, "pass"),
    }


def test_freshness(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0),), (datetime(2024, 1, 1, 6, 0),)], "ts timestamp")

    def status(hour, day=1):
        row = q.source_freshness(df, "s", "ts", datetime(2024, 1, day, hour)).first()
        return row["age_hours"], row["status"]

    assert status(7) == (1.0, "pass") and status(7, 2) == (25.0, "warn") and status(7, 3) == (49.0, "error")
    assert q.source_freshness(df.limit(0), "s", "ts", datetime(2024, 1, 1)).first()["status"] == "error"


def test_freshness_by_arrival(spark, tmp_path):
    """Files of set times; the newest one counts, and no column is read."""
    place = str(tmp_path / "source")
    for day in (1, 3, 2):
        spark.range(day).withColumn("text", F.lit("x")).coalesce(1).write.mode("append").parquet(place)
        fresh = [f for f in (tmp_path / "source").glob("*.parquet") if f.stat().st_mtime > 1.7e9 + 1e6]
        assert len(fresh) == 1
        moment = datetime(2023, 11, day, 6, tzinfo=timezone.utc).timestamp()
        os.utime(fresh[0], (moment, moment))
    source = spark.read.parquet(place)
    status = {}
    for day, hour in ((4, 5), (4, 7), (5, 7)):
        row = q.arrival_freshness(source, "s", datetime(2023, 11, day, hour)).first()
        status[day, hour] = (row["status"], round(row["age_hours"], 6))
    assert status == {(4, 5): ("pass", 23.0), (4, 7): ("warn", 25.0), (5, 7): ("error", 49.0)}
    plan = q.arrival_freshness(source, "s", datetime(2023, 11, 5))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_tolerance_of_a_declared_check(spark):
    rows = spark.createDataFrame([(Decimal("10.3000"), Decimal("10.0000"), Decimal("1.02"))], "a decimal(19,4), b decimal(19,4), r decimal(26,11)")
    load = lambda name: rows
    count = lambda **more: q.run_checks([q.converted("t", "a", "b", "r", **more)], load).first()["failures"]
    assert count() == 1 and count(tolerance=0.05) == 1 and count(tolerance=0.2) == 0


def test_rules_counted_by_the_writing_job(spark, tmp_path):
    checks = [
        q.required("t", "a"), q.between("t", "a", low=0), q.accepted("t", "b", ("x", "y")), q.unique("t", "b"),
        q.required("empty", "a"),
    ]
    rows = spark.createDataFrame([(1, "x"), (None, "y"), (-3, "z"), (-4, "x")], "a int, b string")
    store, seen = LoadedTable(spark, f"{tmp_path}/t"), q.Observed([c for c in checks if c.table == "t"])
    stored = store.write("one", rows, ["b"], watch=seen.watch)
    nothing = q.Observed([c for c in checks if c.table == "empty"])
    empty = LoadedTable(spark, f"{tmp_path}/empty").write("one", rows.where("a > 9"), ["a"], watch=nothing.watch)
    assert sorted(stored.collect(), key=str) == sorted(rows.collect(), key=str)
    counted = seen.violations() | nothing.violations()
    assert list(counted.values()) == [1, 2, 1, 0]

    summary = q.run_checks(checks, {"t": stored, "empty": empty}.__getitem__)
    taken = q.run_checks(checks, {"t": stored.select("b")}.__getitem__, counted)  # neither a nor the empty table is read
    assert sorted(taken.collect()) == sorted(summary.collect())
    assert q.Observed([checks[3]]).violations() == {}
