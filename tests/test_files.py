from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

import bank
from vaultspan.sources.files import LoadedTable, clustered, read_extract, write_extract
from vaultspan.sources.schemas import ALL_TABLES


def test_extracts_are_typed(spark, tmp_path):
    file = tmp_path / "st0_ptf.csv"
    file.write_text(
        "CD_PTF,LB_PTF,LB_PTF_ALT,DT_CRE,DT_CLO,CD_CLI,CD_CCY,CD_PRF,CD_MNG,CD_MNG_EXT,CD_AGN,CD_ENT,CD_BUU\n"
        'P1,"Équilibré, large",,2020-01-31,,C1,CHF,BAL,M1,,A1,E1,B1\n',
        encoding="utf-8",
    )
    row = read_extract(spark, str(file), ALL_TABLES["ptf"]).first()
    assert row["lb_ptf"] == "Équilibré, large" and row["lb_ptf_alt"] is None and row["cd_mng_ext"] is None
    assert row["dt_cre"] == date(2020, 1, 31) and row["dt_clo"] is None


def test_malformed_extract_fails(spark, tmp_path):
    file = tmp_path / "st0_fct_xrt.csv"
    file.write_text("CD_FCT_XRT,CD_CCY,DT_FCT,RT_FAC,RT_VAL\nX,USD,2024-01-31,1,abc\n")
    with pytest.raises(Exception, match="MALFORMED"):
        read_extract(spark, str(file), ALL_TABLES["fct_xrt"]).collect()
    file.write_text("CD_CCY,CD_FCT_XRT,DT_FCT,RT_FAC,RT_VAL\nUSD,X,2024-01-31,1,1\n")
    with pytest.raises(Exception, match="header"):
        read_extract(spark, str(file), ALL_TABLES["fct_xrt"]).collect()


@pytest.mark.parametrize("name", list(ALL_TABLES))
def test_round_trip_of_every_table(spark, tmp_path, name):
    rows = bank.raw(spark, name)
    write_extract(rows, str(tmp_path / name))
    back = read_extract(spark, str(tmp_path / name), ALL_TABLES[name])
    assert back.schema.simpleString() == rows.schema.simpleString()
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


def test_loads_are_separate(spark, tmp_path):
    table = LoadedTable(spark, str(tmp_path / "t"))
    assert table.read([]) is None and table.loads() == []
    table.write("r1", spark.range(3))
    table.write("r2", spark.range(5).limit(0))
    table.write("r2", spark.range(5))
    assert table.loads() == ["r1", "r2"]
    assert table.read(["r1"]).count() == 3 and table.read(["r1", "r2"]).count() == 8


def test_load_ids_stay_text(spark, tmp_path):
    table = LoadedTable(spark, str(tmp_path / "t"))
    for load in ("001", "1e3", "2024-01-31"):
        table.write(load, spark.range(1))
    assert table.loads() == ["001", "1e3", "2024-01-31"]
    assert table.read(table.loads()).count() == 3
    with pytest.raises(ValueError, match="load id"):
        table.write("a/b", spark.range(1))


def test_split_loads(spark, tmp_path):
    table = LoadedTable(spark, str(tmp_path / "t"))
    rows = spark.createDataFrame([(1, 0), (2, 1)], "id int, part int")
    assert table.write("r1", rows, split="part").filter("part = 1").collect() == [(2, 1)]
    assert table.write("r2", rows.limit(0), split="part").count() == 0
    table.write("003", rows, split="part")
    assert sorted(table.read(["r1", "r2", "003"], rows.schema).collect()) == [(1, 0), (1, 0), (2, 1), (2, 1)]


def test_clustered_layout_splits_a_hot_value(spark):
    rows = [(date(2024, 1, 31), "hot" if i % 4 else f"c{i}", Decimal(i)) for i in range(4000)]
    df = spark.createDataFrame(rows, "d date, c string, n decimal(10,0)")
    parts = clustered(df, ["d", "c"], 4).selectExpr("spark_partition_id() as p", "c").groupBy("p").pivot("c", ["hot"]).count()
    sizes = [r["hot"] for r in parts.collect() if r["hot"]]
    assert len(sizes) >= 3 and sum(sizes) == 3000
