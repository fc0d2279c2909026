"""Staged code tables against the distinct codes of their source tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from vaultspan.plans import registry

FOLDER = "/root/testdata/sf0.001"
SOURCES = {
    "stg_cli_cat": ("cd_cli_cat", "customer", "c_mktsegment"),
    "stg_prf": ("cd_prf", "customer", "c_mktsegment"),
    "stg_mng_grp": ("cd_mng_grp", "region", "concat('GRP_', r_name)"),
    "stg_ins_grp": ("cd_ins_grp", "part", "p_type"),
}


@pytest.mark.parametrize("name", list(SOURCES))
def test_every_code_of_the_source_is_staged(spark, name):
    code, table, value = SOURCES[name]
    staged = [r[0] for r in registry.queries()[name](spark, FOLDER).select(code).collect()]
    held = spark.read.parquet(f"{FOLDER}/{table}.parquet").select(F.expr(value)).distinct().collect()
    assert sorted(staged) == sorted(r[0] for r in held)


FALLBACKS = {
    "int_cli": ("cd_cli_cat", "lb_cli_cat", "MACHINERY"),
    "int_ptf": ("cd_prf", "lb_prf", "HOUSEHOLD"),
    "int_ins": ("cd_ins_grp", "lb_ins_grp", "PROMO"),
}


@pytest.mark.parametrize("name", list(FALLBACKS))
def test_a_code_stands_in_for_its_missing_label(spark, name):
    code, label, without = FALLBACKS[name]
    rows = registry.queries()[name](spark, FOLDER)
    shown = {r[0]: r[1] for r in rows.select(code, label).distinct().collect()}
    assert shown[without] == without
    assert all(value != key for key, value in shown.items() if key != without)


def test_a_managers_group_without_label_shows_its_code(spark):
    rows = registry.queries()["int_ptf"](spark, FOLDER)
    groups = {r[0]: r[1] for r in rows.select("cd_mng_grp", "lb_mng_grp").distinct().collect()}
    assert groups["GRP_AFRICA"] == "GRP_AFRICA" and groups["GRP_ASIA"] == "Team ASIA"
