"""What the composed marts and checks must not do again: shuffle wide days, stage a fact twice."""

from __future__ import annotations

import re
from collections import Counter
from datetime import date, datetime

from pyspark.sql import functions as F

from vaultspan.operators.calendar import Calendar, month_end_calendar
from vaultspan.operators.scd2 import Versions, on_calendar
from vaultspan.operators import surrogate
from vaultspan.plans import intermediate, marts, registry
from vaultspan.session import stored

FOLDER = "/root/testdata/sf0.001"


def test_exposure_deals_nothing_by_day_client_and_portfolio(spark):
    """Positions stay dealt by portfolio, where its days meet them."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        plan = registry.queries()["mart_client_exposure"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    dealt = re.findall(r"Exchange hashpartitioning\((.*)", plan)
    assert dealt and not [d for d in dealt if "coalesce(cd_ptf" in d]  # the key of a join that pairs NULLs


def test_exposure_pairs_missing_days_and_clients(spark):
    positions = spark.createDataFrame(
        [("P1", c, d, f"I{i}", "A", "EUR", 1.0, 10.0 * (i + 1), 10.0 * (i + 1))
         for i, (c, d) in enumerate([("C1", date(2024, 1, 31)), ("C1", date(2024, 1, 31)), (None, date(2024, 1, 31)),
                                     ("C1", None), (None, None), ("C2", date(2024, 2, 29))])],
        "cd_ptf string, cd_cli string, dt_fct date, cd_ins string, cd_ast string, cd_ccy string, xrt_rate_pos double, "
        "mt_ast double, mt_ast_ref double",
    )
    span = Calendar.of(month_end_calendar(spark, date(2024, 1, 1), date(2024, 3, 15)))
    start, change = datetime(2024, 1, 1), datetime(2024, 2, 10, 9)

    def held(key, columns, value):
        shape = f"{key} string, {', '.join(f'{c} string' for c in columns)}, dt_cre date, valid_from timestamp, valid_to timestamp"
        row = lambda n, a, b: (value, *(f"{c} {n}" for c in columns), date(2020, 1, 1), a, b)
        return Versions(spark.createDataFrame([row(1, start, change), row(2, change, None)], shape), span, "dt_cre")

    cli = held("cd_cli", ["lb_cli", "cd_cli_cat", "lb_cli_cat", "cd_cty_dom", "lb_cty_dom", "cd_cty_nat"], "C1")
    pairs = [f"{side}_{n}" for n in ("mng", "mng_grp", "mng_ext", "agn", "ent", "buu", "prf") for side in ("cd", "lb")]
    ptf = held("cd_ptf", ["lb_ptf", "lb_ptf_alt", *pairs], "P1")
    ins = spark.createDataFrame([("I0", "name", "g", "group")], "cd_ins string, lb_ins string, cd_ins_grp string, lb_ins_grp string")
    got = marts.mart_client_exposure(positions, cli, ptf, ins)
    laid_out = [on_calendar(v.rows, v.calendar, v.created) for v in (cli, ptf)]
    assert sorted(map(str, got.collect())) == sorted(map(str, marts.mart_client_exposure(positions, *laid_out, ins).collect()))
    found = sorted((r["mt_ast"], r["lb_cli"], r["lb_ptf"], round(r["weight_pct"], 6)) for r in got.collect())
    assert found == [
        (10.0, "lb_cli 1", "lb_ptf 1", 0.333333), (20.0, "lb_cli 1", "lb_ptf 1", 0.666667), (30.0, None, "lb_ptf 1", 1.0),
        (40.0, None, None, 1.0), (50.0, None, None, 1.0), (60.0, None, "lb_ptf 2", 1.0),
    ]


def test_each_fact_is_staged_once_for_its_checks(spark, monkeypatch):
    staged, stage = Counter(), registry.stage_new_rows

    def counting(raw, table, *rest):
        staged[table.name] += 1
        return stage(raw, table, *rest)

    monkeypatch.setattr(registry, "stage_new_rows", counting)
    registry.queries()["dq_summary"](spark, FOLDER)
    assert staged == {name: 1 for name in registry.FACTS}


def test_facts_are_numbered_undecorated_and_not_dealt_by_portfolio(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(surrogate, "stored", lambda rows, name: kept.setdefault(len(kept), rows) and stored(rows, name))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("stg_fct_ast", "stg_fct_mvt", "int_fct_ast", "int_fct_mvt", "int_fct_ope"):
            plan = registry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
            assert not re.findall(r"Exchange hashpartitioning\(cd_ptf", plan), name
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(kept) == 5 and not [c for rows in kept.values() for c in rows.columns if c.startswith(("cd_", "mt_"))]


def test_owners_brought_along_equal_the_join(spark):
    """Codes that repeat, are missing or null on either side."""
    portfolios = spark.createDataFrame(
        [("P1", "C1", "EUR"), ("P2", "C2", "USD"), ("P2", "C2", "USD"), ("P2", None, "CHF"), (None, "C9", "EUR"), ("P4", "C4", None)],
        "cd_ptf string, cd_cli string, cd_ccy string",
    )
    facts = spark.createDataFrame([(i, p) for i, p in enumerate(["P1", "P2", "P3", None, "P4"])], "n int, cd_ptf string")
    owners = intermediate.owners(portfolios).withColumnRenamed("cd_ptf", "_ptf")
    brought = facts.join(owners, F.col("cd_ptf") == F.col("_ptf"), "left").drop("_ptf")
    columns = ["n", "cd_ptf", "cd_cli", "cd_ccy_ptf"]
    got, want = (intermediate._owned(f, portfolios).select(*columns).collect() for f in (brought, facts))
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) == 5


def _exchanges(df) -> list[tuple[str, str]]:
    """(columns, how they are dealt) of every shuffle of the plan."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return re.findall(r"\) Exchange[^\n]*\nInput \[\d+\]: \[(.*)\]\nArguments: (.*)", text)


def _planned(spark, name: str):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.maxMetadataStringLength": "10000"}
    before = {key: spark.conf.get(key) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        df = registry.queries()[name](spark, FOLDER)
        return _exchanges(df)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_exposure_shuffles_no_position_with_attributes_of_its_day(spark):
    found = _planned(spark, "mart_client_exposure")
    lines = [columns for columns, how in found if "l_orderkey" in how]
    assert len(lines) == 2  # for the sums and for the positions
    for columns, how in found:
        assert not ("cd_ast" in columns and ("lb_ptf" in columns or "lb_cli" in columns)), how


def test_checks_of_marts_read_the_staged_facts(spark):
    found = _planned(spark, "dq_summary")
    assert found and not [how for _, how in found if "l_orderkey" in how or "o_orderkey" in how]


def test_exposure_with_names_looked_up_before(spark):
    """Instrument codes that repeat or are unknown, portfolios of one client, a missing day."""
    day = date(2024, 1, 31)
    positions = spark.createDataFrame(
        [(f"P{i % 3}", f"C{i % 3 // 2}", day if i % 5 else None, f"I{i % 4}", f"A{i}", "EUR", 1.0, 10.0 * i, 10.0 * i) for i in range(12)],
        "cd_ptf string, cd_cli string, dt_fct date, cd_ins string, cd_ast string, cd_ccy string, xrt_rate_pos double, "
        "mt_ast double, mt_ast_ref double",
    )
    span = Calendar.of(month_end_calendar(spark, date(2024, 1, 1), date(2024, 3, 15)))

    def held(key, columns, values):
        shape = f"{key} string, {', '.join(f'{c} string' for c in columns)}, dt_cre date, valid_from timestamp, valid_to timestamp"
        rows = [(v, *(f"{c} {v}" for c in columns), date(2020, 1, 1), datetime(2024, 1, 1), None) for v in values]
        return Versions(spark.createDataFrame(rows, shape), span, "dt_cre")

    cli = held("cd_cli", ["lb_cli", "cd_cli_cat", "lb_cli_cat", "cd_cty_dom", "lb_cty_dom", "cd_cty_nat"], ["C0", "C1"])
    pairs = [f"{side}_{n}" for n in ("mng", "mng_grp", "mng_ext", "agn", "ent", "buu", "prf") for side in ("cd", "lb")]
    ptf = held("cd_ptf", ["lb_ptf", "lb_ptf_alt", *pairs], ["P0", "P1"])
    ins = spark.createDataFrame(
        [("I0", "a", "g", "group"), ("I1", "b", "g", "group"), ("I1", "c", "h", "other"), (None, "d", "g", "group")],
        "cd_ins string, lb_ins string, cd_ins_grp string, lb_ins_grp string",
    )
    got = marts.mart_client_exposure(positions, cli, ptf, ins).collect()
    named = marts.with_instrument_names(positions, ins)
    assert sorted(map(str, got)) == sorted(map(str, marts.mart_client_exposure(positions, cli, ptf, ins, named).collect()))
    rows = positions.collect()
    total = {}
    for r in rows:
        total[r["dt_fct"], r["cd_cli"]] = total.get((r["dt_fct"], r["cd_cli"]), 0) + r["mt_ast_ref"]
    names = {"I0": ["a"], "I1": ["b", "c"]}
    want = [
        (r["cd_ast"], n, f"lb_ptf {r['cd_ptf']}" if r["dt_fct"] and r["cd_ptf"] != "P2" else None, round(r["mt_ast_ref"] / total[r["dt_fct"], r["cd_cli"]], 9))
        for r in rows for n in names.get(r["cd_ins"], [None])
    ]
    assert sorted(map(str, want)) == sorted(str((g["cd_ast"], g["asset_name"], g["lb_ptf"], round(g["weight_pct"], 9))) for g in got)
