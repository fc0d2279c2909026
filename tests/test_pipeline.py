from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import bank
from vaultspan.operators.quality import run_checks
from vaultspan.plans.checks import declared_checks
from vaultspan.plans.marts import in_year
from vaultspan.plans.pipeline import APPENDED, ROW_COUNTS, Pipeline, Settings, finished_runs, read_mart, run_pipeline
from vaultspan.plans.staging import Run
from vaultspan.plans.registry import portable, queries
from vaultspan.sources.files import LoadedTable
from vaultspan.sources.star import AS_OF, CALENDAR_START, FIRST_LOADED, Star
from vaultspan.types import SchemaDrift

FIRST = Run("r20220131", datetime(2022, 1, 1, 6, 0))
SECOND = Run("r20220228", datetime(2022, 2, 10, 6, 0))
THIRD = Run("r20220301", datetime(2022, 3, 1, 6, 0))
JANUARY = Settings(date(2022, 1, 1), date(2022, 1, 31))
FEBRUARY = Settings(date(2022, 1, 1), date(2022, 2, 28))

NEWCOMER = ("P9", "Nine", None, date(2022, 2, 1), None, "C2", "GBP", "GRO", "M2", None, None, "E1", "B1")
EARLY_BIRD = bank.position("P9", bank.MONTHS[0], "GBP", "NOVO", "270")


# each of the first two runs brings one operation that is neither debit nor credit
ODD = [r[:6] + ("?",) + r[7:] if r[0] in ("OPE-1", "OPE-3") else r for r in bank.OPERATIONS]


def until(rows, index, last):
    return [r for r in rows if r[index] <= last]


def january(spark):
    cut = {
        "fct_ast": until(bank.POSITIONS, 4, bank.MONTHS[0]) + [EARLY_BIRD],
        "fct_ope": until(ODD, 13, bank.MONTHS[0]),
        "fct_mvt": until(bank.MOVEMENTS, 4, bank.MONTHS[0]),
        "fct_ptf": until(bank.BALANCES, 2, bank.MONTHS[0]),
        "fct_xrt": until(bank.rates(), 2, bank.MONTHS[0]),
    }
    return lambda name: bank.raw(spark, name, cut.get(name))


def february(spark):
    moved = [r[:7] + ("BAL",) + r[8:] if r[0] == "P1" else r for r in bank.ROWS["ptf"]] + [NEWCOMER]
    late = bank.position("P1", bank.MONTHS[0], "CHF", "CASH", "55")
    changed = {"ptf": moved, "fct_ast": [*bank.POSITIONS, EARLY_BIRD, late], "fct_ope": ODD}
    return lambda name: bank.raw(spark, name, changed.get(name))


@pytest.fixture(scope="module")
def state(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("state"))
    first = run_pipeline(spark, january(spark), root, FIRST, JANUARY).collect()
    second = run_pipeline(spark, february(spark), root, SECOND, FEBRUARY).collect()
    return root, first, second


def rows(spark, root, name, *columns):
    return sorted(map(tuple, read_mart(spark, root, name).select(*columns).collect()), key=str)


def loads(spark, root, name):
    """What each finished run wrote of a table, in the order of the runs."""
    return [LoadedTable(spark, f"{root}/{name}").read([run.attempt]) for run in finished_runs(spark, root)]


def test_every_check_reports(spark, state):
    _, first, second = state
    assert len(first) == len(second) == 609
    failed = {(r["table_name"], r["column_name"], r["check"]): r["failures"] for r in second if r["status"] == "fail"}
    assert failed == {("stg_fct_ope", "cd_deb_crd", "accepted_values"): 2}
    early = {(r["table_name"], r["column_name"], r["check"]): r["failures"] for r in first if r["status"] == "fail"}
    assert early == {
        ("stg_fct_ast", "cd_ptf", "relationships"): 1,
        ("stg_fct_ope", "cd_deb_crd", "accepted_values"): 1,
    }


def test_row_rules_are_counted_as_rows_are_written(spark, state):
    root, _, second = state
    recounted = run_checks([c for c in declared_checks() if c.rule is not None and c.table in APPENDED],
                           lambda table: read_mart(spark, root, table)).collect()
    assert len(recounted) > 100 and set(recounted) <= set(second)
    runs = [run.attempt for run in finished_runs(spark, root)]
    counts = [LoadedTable(spark, f"{root}/{ROW_COUNTS}").read([run]).where("violations > 0").collect() for run in runs]
    assert [[(r["name"].split()[:2], r["violations"]) for r in part] for part in counts] == [[(["stg_fct_ope", "cd_deb_crd"], 1)]] * 2
    names = [c.name for c in declared_checks()]
    assert len(set(names)) == len(names)


def test_counts_of_loads_add_up(spark, tmp_path):
    run = Pipeline(spark, january(spark), str(tmp_path), FIRST, JANUARY)
    grown, dimension = [next(c.name for c in run.checks if c.table == t and c.rule) for t in ("stg_fct_ast", "stg_cli")]
    other = next(c.name for c in run.checks if c.table == "int_fct_ast" and c.rule)
    store = LoadedTable(spark, f"{tmp_path}/{ROW_COUNTS}")
    run.violations = {grown: 4, other: 1, dimension: 5}
    assert run.counted() == run.violations  # a first run, or one that starts anew
    for load, rows in {"a": [(grown, 2), (dimension, 9), (other, 6)], "b": [(grown, 3)]}.items():
        store.write(load, spark.createDataFrame(rows, "name string, violations bigint"))
    run.earlier = ["a", "b"]
    assert run.counted() == {grown: 9, dimension: 5}  # load b was not counted for the other rule, so it is scanned for
    run.earlier = ["a", "b", "uncounted"]
    assert run.counted() == {dimension: 5}


def test_converted_amounts(spark, state):
    root = state[0]
    got = {r[0]: r[1:] for r in rows(spark, root, "mart_portfolio_performance", "cd_ptf", "dt_fct", "mt_ast_ref")}
    assert set(got) == {"P1", "P2", "P3"}
    everything = read_mart(spark, root, "int_fct_ast")
    ref = {r["cd_fct_ast"]: (r["mt_ast_ref"], r["mt_ast_ptf"]) for r in everything.collect()}
    assert ref["AST-P1-NOVO-20220131"] == (Decimal("23042.2500"), Decimal("23042.2500"))
    assert ref["AST-P2-NOVO-20220131"] == (Decimal("9070.6000"), Decimal("12400.0000"))
    assert ref["AST-P3-CASH-20220131"] == (Decimal("7300.0000"), Decimal("7998.2470"))
    assert ref["AST-P3-CASH-20220228"] == (Decimal("6900.0000"), Decimal("7464.3012"))
    operations = read_mart(spark, root, "int_fct_ope").collect()
    by_key = {r["cd_fct_ope"]: (r["xrt_rate_ope"], r["mt_ope_ref"]) for r in operations}
    assert by_key["OPE-1"] == (Decimal(1), Decimal(15300)) and by_key["OPE-2"] == (Decimal("0.7315"), Decimal("1814.1200"))


def test_facts_wait_for_their_portfolio(spark, state):
    root = state[0]
    assert [r["cd_ptf"] for r in loads(spark, root, "waiting_fct_ast")[0].collect()] == ["P9"]
    assert loads(spark, root, "waiting_fct_ast")[1].count() == 0
    added = loads(spark, root, "int_fct_ast")[1].select("cd_fct_ast").collect()
    assert EARLY_BIRD[0] in {r[0] for r in added} and len(added) == 5


def test_ids_continue(spark, state):
    staged = loads(spark, state[0], "stg_fct_ast")
    ids = [sorted(int(r[0]) for r in part.select("id_stg_fct_ast").collect()) for part in staged]
    assert ids == [[1, 2, 3, 4], [5, 6, 7, 8]]
    portfolios = rows(spark, state[0], "stg_ptf", "cd_ptf", "id_stg_ptf")
    assert [int(i) for _, i in portfolios] == [1, 2, 3, 4]


def test_history_is_point_in_time(spark, state):
    profile = rows(spark, state[0], "int_ptf", "dt_fct", "cd_ptf", "lb_prf")
    p1 = [(d.month, label) for d, k, label in profile if k == "P1"]
    assert p1 == [(1, "Growth"), (2, "Balanced")]
    assert [(d.month, k) for d, k, _ in profile if k == "P9"] == [(2, "P9")]


def test_marts(spark, state):
    root = state[0]
    aum = {(r["cd_ptf"], r["dt_fct"].month): r for r in read_mart(spark, root, "mart_aum_ytd").collect()}
    assert set(aum) == {("P1", 1), ("P2", 1), ("P3", 1), ("P1", 2), ("P3", 2)}
    assert aum["P1", 1]["aum_current"] == Decimal("23097.2500")
    assert aum["P1", 2]["aum_ytd_start"] == Decimal("23097.2500")
    assert aum["P1", 2]["aum_ytd_variation_abs"] == Decimal("1144.3000")
    assert aum["P1", 2]["aum_ytd_variation_pct"] == pytest.approx(4.95426945, abs=1e-6)
    assert aum["P1", 2]["performance_date"] == date(2022, 2, 28) and aum["P1", 2]["loaded_at"] == SECOND.run_ts
    exposure = read_mart(spark, root, "mart_client_exposure").collect()
    assert len(exposure) == 8  # left joins keep the position of the portfolio without attributes that day
    january_c1 = [r for r in exposure if r["cd_cli"] == "C1" and r["dt_fct"].month == 1]
    assert sum(r["weight_pct"] for r in january_c1) == pytest.approx(1.0)
    nine = next(r for r in exposure if r["cd_ptf"] == "P9")
    assert nine["lb_ptf"] is None and nine["lb_cli"] == "Firm"
    managers = {(r["cd_mng"], r["dt_fct"].month): r for r in read_mart(spark, root, "mart_rm_performance").collect()}
    m1 = managers["M1", 1]
    assert (m1["client_count"], m1["portfolio_count"], m1["category_count"]) == (1, 2, 1)
    assert m1["aum_current"] == pytest.approx(32167.85) and m1["aum_avg_per_portfolio"] == pytest.approx(16083.925)
    assert managers["M2", 2]["lb_mng_grp"] == "Team two"
    detail = read_mart(spark, root, "mart_ptf_detail")
    assert len(detail.columns) == 69 and detail.count() == 6


def test_repeating_a_run_changes_nothing(spark, state):
    root = state[0]
    names = ("stg_ptf", "int_ptf", "mart_aum_ytd", "mart_client_exposure", "history_ptf", "stg_fct_ast", "int_fct_ast")
    before = {n: sorted(map(str, read_mart(spark, root, n).collect())) for n in names}
    run_pipeline(spark, february(spark), root, SECOND, FEBRUARY)
    assert {n: sorted(map(str, read_mart(spark, root, n).collect())) for n in names} == before
    with pytest.raises(ValueError, match="older"):
        Pipeline(spark, january(spark), root, FIRST, JANUARY)


class Broken(Exception):
    pass


def breaking(extract, name):
    """The extract until ``name`` is asked for."""

    def read(table):
        if table == name:
            raise Broken
        return extract(table)

    return read


def snapshot_of(spark, root):
    names = ("stg_cli", "stg_ptf", "int_ptf", "history_cli", "stg_fct_ope", "mart_aum_ytd")
    return {n: sorted(map(str, read_mart(spark, root, n).collect())) for n in names}


def test_a_failed_attempt_is_not_read(spark, state):
    root, before = state[0], snapshot_of(spark, state[0])
    other = lambda name: bank.raw(spark, name, bank.ROWS[name][:1])
    for run in (SECOND, THIRD):  # the repeat of a finished run, and a new one
        with pytest.raises(Broken):
            run_pipeline(spark, breaking(other, "fct_ope"), root, run, FEBRUARY)
        assert snapshot_of(spark, root) == before
    following = Pipeline(spark, february(spark), root, THIRD, FEBRUARY)
    assert following.earlier == [run.attempt for run in finished_runs(spark, root)]
    assert following.newest("stg_ptf").count() == 4


@pytest.mark.parametrize(
    "change", [lambda df: df.withColumn("added", df.dt_fct), lambda df: df.drop("qt_ast"),
               lambda df: df.withColumn("qt_ast", df.qt_ast.cast("string"))]
)
def test_appended_columns_must_not_drift(spark, state, change):
    next_run = Pipeline(spark, february(spark), state[0], THIRD, FEBRUARY)
    part = change(read_mart(spark, state[0], "int_fct_ast"))
    with pytest.raises(SchemaDrift):
        next_run.append("int_fct_ast", part, "dt_fct")


def test_run_ids_are_text_and_a_full_refresh_starts_anew(spark, tmp_path):
    root = str(tmp_path)
    run_pipeline(spark, january(spark), root, Run("1e3", FIRST.run_ts), JANUARY)
    run_pipeline(spark, february(spark), root, Run("001", SECOND.run_ts), FEBRUARY)  # later, though first as text
    assert [run.run_id for run in finished_runs(spark, root)] == ["1e3", "001"]
    versions = read_mart(spark, root, "history_ptf").count()
    corrected = [r[:4] + (r[4] * 2,) for r in bank.rates()]
    extract = lambda name: bank.raw(spark, name, corrected) if name == "fct_xrt" else february(spark)(name)
    run_pipeline(spark, extract, root, Run("r3", THIRD.run_ts), replace(FEBRUARY, full_refresh=True))
    staged = read_mart(spark, root, "stg_fct_ast")
    assert sorted(int(r[0]) for r in staged.select("id_stg_fct_ast").collect()) == list(range(1, staged.count() + 1))
    amounts = {r["cd_fct_ast"]: r["mt_ast_ref"] for r in read_mart(spark, root, "int_fct_ast").collect()}
    assert amounts["AST-P1-NOVO-20220131"] == Decimal("46084.5000")
    assert read_mart(spark, root, "history_ptf").count() == versions + 4  # every run versions every row
    following = Pipeline(spark, extract, root, Run("r4", datetime(2022, 4, 1)), FEBRUARY)
    assert len(following.earlier) == 1 and len(following.before) == 3


def test_the_run_gives_the_registered_marts(spark, tmp_path):
    """Staging, history, conversion and marts chained over the star tables, in one run backdated to its history."""
    star = Star(spark, "/root/testdata/sf0.001")
    settings = Settings(CALENDAR_START, AS_OF)
    run_pipeline(spark, star.lookup, str(tmp_path), Run("first", FIRST_LOADED), settings)
    plans = {
        "mart_ptf_detail": ["dt_fct", "cd_ptf", "cd_cli", "xrt_rate", "mt_net", "mt_net_ref"],
        "mart_client_exposure": ["dt_fct", "cd_cli", "cd_ptf", "cd_ast", "asset_class_name", "mt_ast_ref", "weight_pct"],
        "mart_portfolio_performance": ["dt_fct", "cd_ptf", "cd_cli", "lb_ptf", "cd_ast", "mt_ast_ref", "mt_pnl_ref"],
        "mart_aum_ytd": ["dt_fct", "cd_cli", "cd_ptf", "lb_cli", "cd_mng", "aum_current", "aum_ytd_variation_pct"],
        "mart_rm_performance": ["dt_fct", "cd_mng", "aum_current", "client_count", "portfolio_count"],
    }
    for name, columns in plans.items():
        ours = portable(read_mart(spark, str(tmp_path), name)).select(columns)
        registered = queries()[name](spark, star.folder).select(columns)
        approx = [F.round(c, 6).alias(c) if t in ("double",) else F.col(c) for c, t in registered.dtypes]
        assert ours.count() == registered.count() > 0, name
        assert ours.select(approx).exceptAll(registered.select(approx)).count() == 0, name


def test_year_filter(spark, state):
    aum = read_mart(spark, state[0], "mart_aum_ytd")
    assert in_year(aum, None).count() == in_year(aum, 2022).count() == 5
    assert in_year(aum, 2021).count() == 0
