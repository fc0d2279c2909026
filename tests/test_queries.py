"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import compare
from compare import spark_entry
from vaultspan.plans import oracles, registry

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = registry.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return compare.sql_connection(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(spark_entry.queries())


def test_one_year_reads_one_year_of_positions(spark):
    """The range of dates stands below the look-up of the year's start."""
    plan = QUERIES["mart_aum_ytd_year"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("sum(") :]  # from the sum of the positions to the scans
    assert "1998-01-01" in below and "1998-12-31" in below


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    ours = compare.spark_result(QUERIES[name](spark, FOLDER))
    assert compare.difference(ours, compare.sql_result(connection, ORACLE[name])) == ""
    assert ours[1], "an empty result proves nothing"


def test_entry(spark):
    assert spark_entry.entry(spark).columns[:3] == ["dt_fct", "cd_cli", "cd_ptf"]
