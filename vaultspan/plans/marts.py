"""Reporting tables.

Positions are the large input. Each mart aggregates or prepares everything
else at portfolio-and-day grain first, so that the positions themselves are
shuffled at most once for it.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultspan.functions import safe_divide, stamp, ytd_variation_abs, ytd_variation_pct
from vaultspan.operators.calendar import Calendar
from vaultspan.operators.scd2 import Versions, at_date
from vaultspan.operators.ytd import with_ytd_start
from vaultspan.plans.intermediate import portfolio_amounts

# The order in which each mart is laid out and read.
MART_LAYOUT: dict[str, tuple[str, ...]] = {
    "mart_aum_ytd": ("-dt_fct", "cd_cli", "cd_ptf"),
    "mart_client_exposure": ("-dt_fct", "cd_cli"),
    "mart_portfolio_performance": ("-dt_fct", "cd_ptf", "cd_ast"),
    "mart_ptf_detail": ("-dt_fct", "cd_ptf"),
    "mart_rm_performance": ("-dt_fct", "cd_mng"),
}


def layout(mart: str) -> list[Column]:
    """Sort columns of a mart; a leading minus means descending."""
    return [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in MART_LAYOUT[mart]]


def in_year(df: DataFrame, year: int | None) -> DataFrame:
    """Rows of one year, as a range of dates that a scan can use."""
    return df if year is None else df.filter(F.col("dt_fct").between(F.lit(date(year, 1, 1)), F.lit(date(year, 12, 31))))


def _loaded(df: DataFrame, loaded_at: datetime | None) -> DataFrame:
    return df if loaded_at is None else df.withColumn("loaded_at", stamp(loaded_at))


def _daily_aum(positions: DataFrame, cli: DataFrame | Versions, ptf: DataFrame | Versions, of_cli: list, of_ptf: list) -> DataFrame:
    """Assets per date, client and portfolio, with point-in-time attributes.

    ``cli`` and ``ptf`` (``int_cli``, ``int_ptf``) hold one row per key and date,
    so summing before the joins gives the same rows and leaves only
    portfolio-days to be joined.
    """
    daily = positions.groupBy("dt_fct", "cd_cli", "cd_ptf").agg(F.sum("mt_ast_ref").alias("aum"))
    return at_date(at_date(daily, ptf, "cd_ptf", of_ptf), cli, "cd_cli", of_cli)


def mart_aum_ytd(
    positions: DataFrame,
    cli: DataFrame | Versions,
    ptf: DataFrame | Versions,
    calendar: Calendar,
    as_of: date,
    year: int | None = None,
    loaded_at: datetime | None = None,
) -> DataFrame:
    """Assets under management per portfolio and date, against the start of the year."""
    of_cli = ["lb_cli", "cd_cli_cat", "lb_cli_cat", "cd_cty_dom", "lb_cty_dom", F.col("cd_ccy").alias("cd_ccy_cli")]
    of_ptf = ["lb_ptf", "cd_mng", "lb_mng", "cd_prf", "lb_prf"]
    # The start is a row of the same year, so the positions of other years need not be read.
    daily = _daily_aum(in_year(positions, year), cli, ptf, of_cli, of_ptf)
    ytd = with_ytd_start(daily, ["cd_cli", "cd_ptf"], "aum", calendar)
    return _loaded(
        ytd.select(
            "dt_fct", "cd_cli", "cd_ptf", "lb_ptf", "lb_cli", "cd_cli_cat", "lb_cli_cat", "cd_cty_dom", "lb_cty_dom",
            "cd_ccy_cli", "cd_mng", "lb_mng", "cd_prf", "lb_prf", F.col("aum").alias("aum_current"), "aum_ytd_start",
            "aum_ytd_variation_pct", "aum_ytd_variation_abs", F.lit(as_of).alias("performance_date"),
        ),
        loaded_at,
    )


INSTRUMENT_NAMES = ("asset_name", "asset_class", "asset_class_name")


def _instrument_names(instruments: DataFrame) -> DataFrame:
    return instruments.select(
        "cd_ins",
        F.col("lb_ins").alias("asset_name"),
        F.col("cd_ins_grp").alias("asset_class"),
        F.col("lb_ins_grp").alias("asset_class_name"),
    )


def with_instrument_names(positions: DataFrame, instruments: DataFrame) -> DataFrame:
    """Positions and the names of their instruments, where one is known."""
    names = _instrument_names(instruments).withColumnRenamed("cd_ins", "_ins")
    return positions.join(names, F.col("cd_ins") == F.col("_ins"), "left").drop("_ins")


def _same_day_and_client(left: str, right: str) -> Column:
    """Equal date and client, NULLs too, as a condition on pairs: Spark takes no join keys from it.

    For sides that are dealt by portfolio already. A portfolio's days are as few as the dates of its positions.
    """
    days = [F.col(f"{side}.dt_fct") for side in (left, right)]
    same_day = F.coalesce(F.datediff(*days) == 0, days[0].isNull() & days[1].isNull())
    clients = [F.struct(F.col(f"{side}.cd_cli")) for side in (left, right)]
    return same_day & F.array_contains(F.array(clients[1]), clients[0])


def mart_client_exposure(
    positions: DataFrame,
    cli: DataFrame | Versions,
    ptf: DataFrame | Versions,
    instruments: DataFrame,
    named: DataFrame | None = None,
) -> DataFrame:
    """Every position with its attributes and its share of the client's assets that day.

    The client's total is summed per portfolio-day, with map-side combine, and then over the
    portfolio-days of a client's day, so a large client gathers a row per portfolio and not its
    positions. Attributes and total meet at portfolio-day grain. Positions take the names of
    their instruments while they are narrow; then they are dealt by portfolio and meet the days
    of their portfolio, whose attributes travel no further. Each has a portfolio.

    ``named`` are the same positions ``with_instrument_names``, where those were looked up before
    the portfolio was: they are dealt by it when they come.
    """
    of_cli = ["lb_cli", "cd_cli_cat", "lb_cli_cat", "cd_cty_dom", "lb_cty_dom", "cd_cty_nat"]
    of_ptf = ["lb_ptf", "lb_ptf_alt"] + [
        f"{side}_{name}" for name in ("mng", "mng_grp", "mng_ext", "agn", "ent", "buu", "prf") for side in ("cd", "lb")
    ]
    held = positions.groupBy("dt_fct", "cd_cli", "cd_ptf").agg(F.sum("mt_ast_ref").alias("_held"))
    total = F.sum("_held").over(Window.partitionBy("dt_fct", "cd_cli"))
    client_days = held.withColumn("_total", total).drop("_held")
    days = at_date(at_date(client_days, cli, "cd_cli", of_cli, "left"), ptf, "cd_ptf", of_ptf, "left")
    met = (F.col("p.cd_ptf") == F.col("d.cd_ptf")) & _same_day_and_client("p", "d")
    if named is None:
        shown = ["dt_fct", "cd_cli", "cd_ptf", "cd_ins", "cd_ast", "cd_ccy", "xrt_rate_pos", "mt_ast", "mt_ast_ref"]
        named = with_instrument_names(positions.select(*shown), instruments)
    return named.alias("p").join(days.alias("d"), met).select(
        "p.dt_fct", "p.cd_cli", *(f"d.{c}" for c in of_cli), "p.cd_ptf", *(f"d.{c}" for c in of_ptf), "p.cd_ast",
        "p.asset_name", "p.asset_class", "p.asset_class_name", "p.cd_ccy", F.col("p.xrt_rate_pos").alias("xrt_rate"),
        "p.mt_ast", "p.mt_ast_ref", safe_divide("p.mt_ast_ref", "d._total").alias("weight_pct"),
    )


def mart_portfolio_performance(
    positions: DataFrame, ptf: DataFrame | Versions, instruments: DataFrame, loaded_at: datetime | None = None
) -> DataFrame:
    """Value, gain, weights and return of each position of a known portfolio."""
    owned = at_date(positions, ptf, "cd_ptf", ["lb_ptf", "cd_prf", "lb_prf"])
    named = owned.join(_instrument_names(instruments), "cd_ins", "left")
    return _loaded(
        named.select(
            "dt_fct", "cd_ptf", "cd_cli", "lb_ptf", "cd_prf", "lb_prf", "cd_ast", "asset_name", "asset_class",
            "asset_class_name", "cd_ccy", "qt_ast", "mt_ast", "mt_ast_ref", "mt_pnl", "mt_pnl_ref", "rt_prm", "rt_pam",
            "pc_twr",
        ),
        loaded_at,
    )


def mart_ptf_detail(portfolio_facts: DataFrame, ptf: DataFrame | Versions) -> DataFrame:
    """Balances and flows of each portfolio with its point-in-time attributes."""
    of_ptf = ["lb_ptf", "lb_ptf_alt", "lb_ccy"] + [
        f"{side}_{name}" for name in ("prf", "mng", "mng_grp", "mng_ext", "agn", "ent", "buu") for side in ("cd", "lb")
    ]
    amounts = [c for pair in portfolio_amounts() for c in pair]
    return at_date(portfolio_facts, ptf, "cd_ptf", of_ptf).select(
        "dt_fct", "cd_ptf", "lb_ptf", "lb_ptf_alt", "cd_cli", "cd_ccy_ptf", *of_ptf[2:], "xrt_rate", "pc_ptf", *amounts
    )


def mart_rm_performance(
    positions: DataFrame,
    cli: DataFrame | Versions,
    ptf: DataFrame | Versions,
    calendar: Calendar,
    as_of: date,
    year: int | None = None,
    loaded_at: datetime | None = None,
) -> DataFrame:
    """Assets, variation and averages per relationship manager and date.

    A manager has one group in ``ptf``, so the group travels with each row
    instead of being looked up again from the distinct managers.
    """
    daily = _daily_aum(in_year(positions, year), cli, ptf, ["cd_cli_cat"], ["cd_mng", "lb_mng", "cd_mng_grp", "lb_mng_grp"])
    ytd = with_ytd_start(daily, ["cd_cli", "cd_ptf"], "aum", calendar)
    by_manager = ytd.groupBy("dt_fct", "cd_mng", "lb_mng", "cd_mng_grp", "lb_mng_grp").agg(
        F.sum("aum").alias("aum"),
        F.sum("aum_ytd_start").alias("start"),
        F.countDistinct("cd_cli").alias("client_count"),
        F.countDistinct("cd_ptf").alias("portfolio_count"),
        F.countDistinct("cd_cli_cat").alias("category_count"),
    )

    def average(count: str) -> Column:
        return F.when(F.col(count) > 0, F.col("aum").cast("double") / F.col(count)).otherwise(F.lit(0.0))

    measured = by_manager.select(
        "dt_fct", "cd_mng", "lb_mng", "cd_mng_grp", "lb_mng_grp",
        F.col("aum").cast("double").alias("aum_current"),
        F.col("start").cast("double").alias("aum_ytd_start"),
        ytd_variation_pct("aum", "start").alias("aum_ytd_variation_pct"),
        ytd_variation_abs("aum", "start").cast("double").alias("aum_ytd_variation_abs"),
        "client_count", "portfolio_count", "category_count",
        average("client_count").alias("aum_avg_per_client"),
        average("portfolio_count").alias("aum_avg_per_portfolio"),
        F.lit(as_of).alias("performance_date"),
    )
    return _loaded(measured, loaded_at)
