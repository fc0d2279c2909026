"""Clients and portfolios per date, kept by month: equal to a rebuild, and months that did not change stay as they are."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

import bank
from vaultspan.operators.calendar import Calendar
from vaultspan.plans import intermediate
from vaultspan.plans.pipeline import Pipeline, Settings, finished_runs, read_mart
from vaultspan.plans.point_in_time import MonthlyTable, touched_months
from vaultspan.plans.staging import Run
from vaultspan.sources.schemas import DIMENSIONS

START = date(2022, 1, 1)
NEWCOMER = ("P9", "Nine", None, date(2022, 4, 2), None, "C2", "GBP", "GRO", "M2", None, None, "E1", "B1")
# (run, reporting date, changed tables)
RUNS = (
    (Run("r1", datetime(2022, 1, 1, 6)), date(2022, 2, 28), {}),
    (Run("r2", datetime(2022, 3, 1, 6)), date(2022, 3, 31), {}),
    (Run("r3", datetime(2022, 4, 1, 6)), date(2022, 4, 30), {"ptf": [*bank.ROWS["ptf"], NEWCOMER]}),
    # one portfolio alone is loaded, all others stay open; a label changes
    (
        Run("r4", datetime(2022, 5, 1, 6)),
        date(2022, 5, 31),
        {"ptf": [NEWCOMER], "cli": bank.ROWS["cli"][:0], "cli_cat": [(r[0], f"New {r[1]}") if k == 0 else r for k, r in enumerate(bank.ROWS["cli_cat"])]},
    ),
)


def rebuilt(spark, root, key):
    """The whole table from all versions, dates and labels, as the last run has them."""
    lookups = {name: read_mart(spark, root, f"stg_{name}") for name in DIMENSIONS}
    calendar = Calendar.of(read_mart(spark, root, "stg_set_cal"))
    build = {"cli": intermediate.int_cli, "ptf": intermediate.int_ptf}[key]
    return build(read_mart(spark, root, f"history_{key}"), calendar, lookups)


def written(root, spark, key):
    """The months that the last run wrote."""
    attempt = finished_runs(spark, root)[-1].attempt
    return sorted(m for m, a in MonthlyTable(spark, f"{root}/int_{key}").months(attempt).items() if a == attempt)


@pytest.fixture(scope="module")
def states(spark, tmp_path_factory):
    """After every run: the months written, and whether the stored tables equal a rebuild."""
    root, states = str(tmp_path_factory.mktemp("months")), []
    for run, as_of, changed in RUNS:
        steps = Pipeline(spark, lambda name, c=changed: bank.raw(spark, name, c.get(name)), root, run, Settings(START, as_of))
        steps.intermediate(steps.stage())
        steps.finish()
        same = {}
        for key in ("cli", "ptf"):
            stored, whole = read_mart(spark, root, f"int_{key}"), rebuilt(spark, root, key)
            assert stored.columns == whole.columns
            same[key] = stored.exceptAll(whole).isEmpty() and whole.exceptAll(stored).isEmpty() and stored.count()
        states.append(({key: written(root, spark, key) for key in ("cli", "ptf")}, same))
    return root, states


def test_every_run_equals_a_rebuild(states):
    counts = [state[1] for state in states[1]]
    assert all(same["cli"] and same["ptf"] for same in counts)
    assert [same["ptf"] for same in counts] == sorted(same["ptf"] for same in counts)


def test_months_that_do_not_change_are_not_written(states):
    months = [state[0] for state in states[1]]
    assert months[0]["ptf"] == ["2022-01", "2022-02"]
    # the versions of the first run end, so their months show another end
    assert months[1]["ptf"] == ["2022-01", "2022-02", "2022-03"]
    assert months[2]["ptf"] == ["2022-03", "2022-04"]
    assert months[3]["ptf"] == ["2022-04", "2022-05"]


def test_a_changed_label_reaches_the_months_that_show_it(spark, states):
    root, runs = states
    code = bank.ROWS["cli_cat"][0][0]
    clients = read_mart(spark, root, "int_cli").where(F.col("cd_cli_cat") == code)
    labels = {r[0] for r in clients.select("lb_cli_cat").distinct().collect()}
    assert labels == {f"New {bank.ROWS['cli_cat'][0][1]}"}
    shown = {r[0] for r in clients.select(F.date_format("dt_fct", "yyyy-MM")).distinct().collect()}
    assert set(runs[3][0]["cli"]) == shown | {"2022-05"}


def test_touched_months(spark):
    days = lambda *ds: spark.createDataFrame([(d,) for d in ds], "dt_fct date")
    calendar = Calendar.of(days(date(2022, 1, 31), date(2022, 2, 28), date(2022, 3, 31)))
    same = calendar.days
    assert touched_months(calendar, same, None, set()) == []
    assert touched_months(calendar, same, date(2022, 2, 28), set()) == ["2022-02", "2022-03"]
    assert touched_months(calendar, same, date(2022, 5, 1), {"2022-01"}) == ["2022-01"]
    assert touched_months(calendar, days(date(2022, 1, 31)), None, set()) == ["2022-02", "2022-03"]
    assert touched_months(calendar, days(date(2022, 1, 31), date(2022, 2, 28), date(2022, 3, 15)), None, set()) == ["2022-03"]


def test_a_month_without_rows_leaves_the_table(spark, tmp_path):
    table = MonthlyTable(spark, str(tmp_path / "t"))
    rows = spark.createDataFrame([("a", date(2022, 1, 31)), ("b", date(2022, 2, 28))], "k string, dt_fct date")
    assert table.write("one", None, rows, None, ["dt_fct"]).count() == 2
    assert table.write("two", "one", rows.limit(0), ["2022-02"], ["dt_fct"]).collect() == rows.where("k = 'a'").collect()
    assert table.write("three", "two", rows.limit(0), ["2022-01"], ["dt_fct"]).count() == 0
    assert table.read("one").count() == 2
    assert table.months("three") == {} and table.months("two") == {"2022-01": "one"}
