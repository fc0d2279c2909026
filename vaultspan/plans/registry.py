"""Every query over the star schema, by name."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import cache, partial
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from vaultspan.functions import (
    fx_direct,
    fx_pivot,
    rate_or_one,
    safe_divide,
    ytd_variation_abs,
    ytd_variation_pct,
)
from vaultspan.operators import quality
from vaultspan.operators.asof import asof_lookup, asof_merge
from vaultspan.operators.incremental import insert_only, newer_than_target
from vaultspan.operators.scd2 import Versions, on_calendar, snapshot
from vaultspan.operators.ytd import with_ytd_start
from vaultspan.plans import intermediate, marts
from vaultspan.plans.checks import declared_checks
from vaultspan.plans.staging import StagedFact, stage_new_rows, stage_upsert
from vaultspan.session import ensure_checkpoint_dir
from vaultspan.sources.files import read_extract, write_extract
from vaultspan.sources.schemas import ALL_TABLES, DIMENSIONS, FACTS, RATES
from vaultspan.sources.star import AS_OF, EARLIER_RUN, RUN, Star
from vaultspan.types import ID

Query = Callable[[SparkSession, str], DataFrame]

SPLIT_DAY = date(1998, 1, 1)
SPLIT_CREATION = date(1995, 1, 1)
FRESH_AT = datetime(2024, 2, 1, 0, 0, 0)
YEAR = 1998


def portable(df: DataFrame) -> DataFrame:
    """Types every engine prints alike: dates as text, ids as bigint, decimals as double."""
    columns = []
    for field in df.schema.fields:
        column, kind = F.col(field.name), field.dataType
        if isinstance(kind, DateType):
            column = column.cast("string")
        elif isinstance(kind, (TimestampType, TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, DecimalType):
            column = column.cast("bigint" if kind.scale == 0 else "double")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# Sources and staging


def csv_round_trip(star: Star) -> DataFrame:
    """Operations written as a CSV extract in the shared folder and read back with their schema."""
    ensure_checkpoint_dir(star.spark)
    folder = f"{star.spark.sparkContext.getCheckpointDir()}/extract-{uuid4().hex}"
    table = ALL_TABLES["fct_ope"]
    write_extract(star.raw("fct_ope"), folder)
    return read_extract(star.spark, folder, table)


def staged_dimension(star: Star, name: str) -> DataFrame:
    return stage_upsert(star.raw(name), DIMENSIONS[name], RUN).drop("ts_stg")


def staged_rates(star: Star) -> DataFrame:
    return stage_upsert(star.raw("fct_xrt"), RATES, RUN).drop("ts_stg")


def staged_fact(star: Star, name: str) -> DataFrame:
    return stage_new_rows(star.fact(name), FACTS[name], RUN).drop("ts_stg")


def technical_metadata(star: Star) -> DataFrame:
    table = DIMENSIONS["ptf"]
    technical = ["ts_stg", "vr_stg", "id_obj_tec", "cd_src", "cd_pid", "lb_dsc", "id_ptf_tec_typ", "cd_ptf_src"]
    return stage_upsert(star.raw("ptf"), table, RUN).select("cd_ptf", *technical)


def dim_first_load(star: Star) -> DataFrame:
    """A full refresh ignores the target, so ids start from 1 again."""
    return stage_upsert(star.raw("ins"), DIMENSIONS["ins"], RUN, existing=None).select("id_stg_ins", "cd_ins", "cd_pid")


def _early_portfolios(star: Star) -> DataFrame:
    early = star.raw("ptf").filter(F.col("dt_cre") < F.lit(SPLIT_CREATION))
    return stage_upsert(early, DIMENSIONS["ptf"], EARLIER_RUN)


def upsert_dim(star: Star) -> DataFrame:
    """All portfolios merged into a table that held the early ones."""
    merged = stage_upsert(star.raw("ptf"), DIMENSIONS["ptf"], RUN, _early_portfolios(star))
    return merged.select("id_stg_ptf", "cd_ptf", "cd_pid", "vr_stg", "lb_ptf")


def rerun_idempotent(star: Star) -> DataFrame:
    """The same batch merged three times: ids and rows stay as after the first time."""
    first = stage_upsert(star.raw("ptf"), DIMENSIONS["ptf"], EARLIER_RUN)
    second = stage_upsert(star.raw("ptf"), DIMENSIONS["ptf"], RUN, first)
    third = stage_upsert(star.raw("ptf"), DIMENSIONS["ptf"], RUN, second)
    return third.select("id_stg_ptf", "cd_ptf", "cd_pid", "lb_ptf")


def _early_operations(star: Star) -> DataFrame:
    early = star.raw("fct_ope").filter(F.col("dt_cta") < F.lit(SPLIT_DAY))
    return stage_new_rows(early, FACTS["fct_ope"], EARLIER_RUN)


def insert_only_fact(star: Star) -> DataFrame:
    """All operations offered to a table that held the early ones; those stay as they were."""
    held = _early_operations(star)
    batch = stage_new_rows(star.raw("fct_ope"), FACTS["fct_ope"], RUN, held)
    return insert_only(held, batch, "cd_fct_ope").select("id_stg_fct_ope", "cd_fct_ope", "cd_pid", "dt_cta", "mt_ope")


def insert_only_indexed(star: Star) -> DataFrame:
    """The same, over stored loads: the index of their keys says which have to be read."""
    ensure_checkpoint_dir(star.spark)
    folder = f"{star.spark.sparkContext.getCheckpointDir()}/staged-{uuid4().hex}"
    staged = StagedFact(star.spark, folder, FACTS["fct_ope"])
    operations, loads = star.raw("fct_ope"), []
    for run, batch in ((EARLIER_RUN, operations.filter(F.col("dt_cta") < F.lit(SPLIT_DAY))), (RUN, operations)):
        part = staged.store.write(run.run_id, staged.fresh(batch, run, loads))
        staged.index.add(run.run_id, part)
        loads.append(run.run_id)
    return staged.store.read(loads).select("id_stg_fct_ope", "cd_fct_ope", "cd_pid", "dt_cta", "mt_ope")


def incremental_by_date(star: Star) -> DataFrame:
    """Operations dated after the newest one of the target."""
    operations = star.raw("fct_ope")
    held = operations.filter(F.col("dt_cta") < F.lit(SPLIT_DAY))
    return newer_than_target(held, operations, "dt_cta").select("cd_fct_ope", "dt_cta", "mt_ope")


def source_freshness(star: Star) -> DataFrame:
    events = star.table("events").withColumn("loaded_at", F.col("ts").cast("timestamp"))
    return quality.source_freshness(events, "events", "loaded_at", FRESH_AT)


def calendar_month_ends(star: Star) -> DataFrame:
    """The calendar spanned by the positions, with the positions valued on each date."""
    valued = star.raw("fct_ast").groupBy("dt_fct").agg(F.count(F.lit(1)).alias("n_positions"))
    calendar = star.calendar_of_facts()
    return calendar.join(valued, "dt_fct", "left").withColumn("n_positions", F.coalesce("n_positions", F.lit(0)))


# History


def scd2_merged(star: Star, name: str) -> DataFrame:
    """The history after merging the three loads one after the other."""
    history = None
    for batch in star.loads(name):
        history = snapshot(history, batch, f"cd_{name}", "ts_stg")
    code, label = {"cli": "cd_cli_cat", "ptf": "cd_prf"}[name], f"lb_{name}_alt"
    return history.select(f"cd_{name}", code, label, "updated_at", "valid_from", "valid_to")


def scd2_from_changelog(star: Star) -> DataFrame:
    return star.history("ptf").select("cd_ptf", "cd_prf", "lb_ptf_alt", "updated_at", "valid_from", "valid_to")


def scd2_calendar(star: Star) -> DataFrame:
    dated = on_calendar(star.history("ptf"), star.calendar, "dt_cre")
    return dated.select("cd_ptf", "dt_fct", "cd_prf", "lb_ptf_alt", "valid_from")


CLIENT_LOOKUPS = ("cli_cat", "cty", "mng")
PORTFOLIO_LOOKUPS = ("ccy", "prf", "mng", "mng_grp", "mng_ext", "agn", "ent", "buu")


def int_cli(star: Star) -> DataFrame:
    return intermediate.int_cli(star.history("cli"), star.calendar, star.lookups(*CLIENT_LOOKUPS))


def int_ptf(star: Star) -> DataFrame:
    return intermediate.int_ptf(star.history("ptf"), star.calendar, star.lookups(*PORTFOLIO_LOOKUPS))


# A composed mart meets the versions of both; it stores no row per date.


def _clients(star: Star) -> Versions:
    return intermediate.client_versions(star.history("cli"), star.calendar, star.lookups(*CLIENT_LOOKUPS))


def _portfolios(star: Star) -> Versions:
    return intermediate.portfolio_versions(star.history("ptf"), star.calendar, star.lookups(*PORTFOLIO_LOOKUPS))


def int_ins(star: Star) -> DataFrame:
    staged = stage_upsert(star.raw("ins"), DIMENSIONS["ins"], RUN)
    return intermediate.int_ins(staged, star.lookup("ins_grp"))


# Facts. A composed mart needs no surrogate ids, so they are left out there.


def _unnumbered(star: Star, name: str) -> DataFrame:
    return star.raw(name).withColumn(ALL_TABLES[name].id_column, F.lit(None).cast(ID))


def _instruments(star: Star) -> DataFrame:
    return intermediate.int_ins(_unnumbered(star, "ins"), star.lookup("ins_grp"))


INT_FACTS = {
    "fct_ast": intermediate.int_fct_ast,
    "fct_ope": intermediate.int_fct_ope,
    "fct_mvt": intermediate.int_fct_mvt,
    "fct_ptf": intermediate.int_fct_ptf,
}


def converted(star: Star, name: str) -> DataFrame:
    rates = intermediate.rate_index(star.raw("fct_xrt"))
    return INT_FACTS[name](_unnumbered(star, name), star.raw("ptf"), rates)


def _named_positions(star: Star) -> DataFrame:
    """Valued positions with the names of their instruments, looked up before the owner is: nothing valued travels for it."""
    rates = intermediate.rate_index(star.raw("fct_xrt"))
    named = marts.with_instrument_names(_unnumbered(star, "fct_ast"), _instruments(star))
    return intermediate.int_fct_ast(named, star.raw("ptf"), rates, carried=marts.INSTRUMENT_NAMES)


def int_fact(star: Star, name: str, staged: DataFrame | None = None) -> DataFrame:
    """The converted fact with the ids of its staged table."""
    rates = intermediate.rate_index(star.raw("fct_xrt"))
    if staged is None:  # the owners join the orders, not the staged rows
        staged = stage_new_rows(star.fact(name, intermediate.owners(star.raw("ptf"))), FACTS[name], RUN)
    return INT_FACTS[name](staged, star.raw("ptf"), rates)


def asof_fx_rate(star: Star) -> DataFrame:
    rates = intermediate.rate_index(star.raw("fct_xrt"))
    movements = star.raw("fct_mvt").select("cd_fct_mvt", "cd_ccy_mvt", "dt_cta")
    return asof_lookup(movements, rates, "cd_ccy_mvt", "dt_cta", "rt_val")


def asof_fx_rate_merged(star: Star) -> DataFrame:
    movements = star.raw("fct_mvt").select("cd_fct_mvt", "cd_ccy_mvt", "dt_cta")
    return asof_merge(movements, star.raw("fct_xrt"), "cd_ccy_mvt", "dt_cta", "cd_ccy", "dt_fct", "rt_val", "rt_val")


def fx_missing_rate_default(star: Star) -> DataFrame:
    """Operations without a rate on or before their date: they convert one to one."""
    rates = intermediate.rate_index(star.raw("fct_xrt"))
    operations = star.raw("fct_ope").select("cd_fct_ope", "cd_ccy_ope", "dt_cta", "mt_ope")
    unrated = asof_lookup(operations, rates, "cd_ccy_ope", "dt_cta", "found").filter(F.col("found").isNull())
    rated = unrated.withColumn("xrt_rate", rate_or_one("found")).drop("found")
    return rated.withColumn("mt_ope_ref", fx_direct("mt_ope", "xrt_rate"))


def fx_direct_conversion(star: Star) -> DataFrame:
    rates = intermediate.rate_index(star.raw("fct_xrt"))
    positions = star.raw("fct_ast").select("cd_fct_ast", "cd_ccy", "dt_fct", "mt_ast")
    rated = asof_lookup(positions, rates, "cd_ccy", "dt_fct", "rt").withColumn("xrt_rate", rate_or_one("rt")).drop("rt")
    return rated.withColumn("mt_ast_ref", fx_direct("mt_ast", "xrt_rate"))


def fx_pivot_conversion(star: Star) -> DataFrame:
    return converted(star, "fct_ast").select(
        "cd_fct_ast", "mt_ast", "xrt_rate_pos", "xrt_rate_ptf",
        fx_pivot("mt_ast", "xrt_rate_pos", "xrt_rate_ptf").alias("mt_ast_ptf"),
    )


# Marts. Each may be given its converted facts.


def mart_aum_ytd(star: Star, year: int | None = None, facts: DataFrame | None = None) -> DataFrame:
    facts = converted(star, "fct_ast") if facts is None else facts
    return marts.mart_aum_ytd(facts, _clients(star), _portfolios(star), star.calendar, AS_OF, year)


def mart_client_exposure(star: Star, facts: DataFrame | None = None) -> DataFrame:
    named = _named_positions(star) if facts is None else None
    facts = converted(star, "fct_ast") if facts is None else facts
    return marts.mart_client_exposure(facts, _clients(star), _portfolios(star), _instruments(star), named)


def mart_portfolio_performance(star: Star, facts: DataFrame | None = None) -> DataFrame:
    facts = converted(star, "fct_ast") if facts is None else facts
    return marts.mart_portfolio_performance(facts, _portfolios(star), _instruments(star))


def mart_ptf_detail(star: Star, facts: DataFrame | None = None) -> DataFrame:
    return marts.mart_ptf_detail(converted(star, "fct_ptf") if facts is None else facts, _portfolios(star))


def mart_rm_performance(star: Star, facts: DataFrame | None = None) -> DataFrame:
    facts = converted(star, "fct_ast") if facts is None else facts
    return marts.mart_rm_performance(facts, _clients(star), _portfolios(star), star.calendar, AS_OF)


# Expressions


def safe_division(star: Star) -> DataFrame:
    return star.raw("fct_ptf").select(
        "cd_fct_ptf", "mt_inc_mtd", "mt_out_mtd", safe_divide("mt_inc_mtd", "mt_out_mtd").alias("ratio")
    )


def ytd_variation(star: Star) -> DataFrame:
    return star.raw("fct_ptf").select(
        "cd_fct_ptf", "mt_net", "mt_inc_mtd",
        ytd_variation_pct("mt_net", "mt_inc_mtd").alias("variation_pct"),
        ytd_variation_abs("mt_net", "mt_inc_mtd").alias("variation_abs"),
    )


def ytd_start_lookup(star: Star) -> DataFrame:
    daily = star.raw("fct_ptf").select("cd_ptf", "dt_fct", "mt_net")
    return with_ytd_start(daily, ["cd_ptf"], "mt_net", star.calendar)


# Checks, each on data that breaks it


def dq_not_null(star: Star) -> DataFrame:
    return quality.missing_rows(star.raw("fct_ope"), "cd_fct_ope_ext").select("cd_fct_ope", "lb_fct_ope")


def dq_unique(star: Star) -> DataFrame:
    return quality.duplicate_values(star.raw("fct_ast"), "cd_pos")


def dq_accepted_values(star: Star) -> DataFrame:
    return quality.unaccepted_rows(star.raw("fct_mvt"), "cd_mvt_typ", ("A", "N")).select("cd_fct_mvt", "cd_mvt_typ")


def dq_relationships(star: Star) -> DataFrame:
    orphans = quality.orphan_rows(star.raw("fct_ast"), "cd_ccy", star.raw("fct_xrt"), "cd_ccy")
    return orphans.select("cd_fct_ast", "cd_ccy")


def dq_between(star: Star) -> DataFrame:
    broken = quality.out_of_range_rows(star.raw("fct_ast"), "rt_prm", low=0, high=0.09, strictly=True)
    return broken.select("cd_fct_ast", "rt_prm")


def dq_pair_ge(star: Star) -> DataFrame:
    return quality.unordered_rows(star.raw("fct_ast"), "rt_pam", "rt_prm", or_equal=True).select(
        "cd_fct_ast", "rt_pam", "rt_prm"
    )


def _forgotten_conversion(star: Star, column: str) -> DataFrame:
    """Positions whose converted amount was left native where the rate is above one."""
    native = F.when(F.col("xrt_rate_pos") > 1, F.col("mt_ast")).otherwise(F.col(column))
    return converted(star, "fct_ast").withColumn(column, native)


def _gaps(rows: DataFrame, column: str) -> DataFrame:
    return rows.select("cd_fct_ast", column, f"expected_{column}", "ecart")


def dq_fx_direct(star: Star) -> DataFrame:
    wrong = _forgotten_conversion(star, "mt_ast_ref")
    gaps = _gaps(quality.misconverted_rows(wrong, "mt_ast_ref", "mt_ast", "xrt_rate_pos"), "mt_ast_ref")
    return gaps.withColumns({c: F.col(c).cast("decimal(24,6)") for c in ("expected_mt_ast_ref", "ecart")})


def dq_fx_pivot(star: Star) -> DataFrame:
    wrong = _forgotten_conversion(star, "mt_ast_ptf")
    broken = quality.misconverted_rows(wrong, "mt_ast_ptf", "mt_ast", "xrt_rate_pos", "xrt_rate_ptf")
    return _gaps(broken, "mt_ast_ptf")


def dq_positive_amounts(star: Star) -> DataFrame:
    return quality.negative_rows(converted(star, "fct_mvt"), "mt_mvt", "mt_mvt_ref").select(
        "cd_fct_mvt", "mt_mvt", "mt_mvt_ref"
    )


def dq_summary(star: Star) -> DataFrame:
    """Every declared check on every table, one result row each."""
    whole: dict[str, Callable[[Star], DataFrame]] = {"int_cli": int_cli, "int_ptf": int_ptf, "int_ins": int_ins}
    of_facts: dict[str, tuple[Callable[..., DataFrame], str]] = {
        "mart_aum_ytd": (mart_aum_ytd, "fct_ast"),
        "mart_client_exposure": (mart_client_exposure, "fct_ast"),
        "mart_portfolio_performance": (mart_portfolio_performance, "fct_ast"),
        "mart_ptf_detail": (mart_ptf_detail, "fct_ptf"),
        "mart_rm_performance": (mart_rm_performance, "fct_ast"),
    }

    owners = intermediate.owners(star.raw("ptf"))
    star.keep_lines(owners)  # for positions and movements

    @cache
    def load(name: str) -> DataFrame:
        layer, _, table = name.partition("_")
        if table == "set_cal":
            return star.calendar.days
        if name in whole:
            return whole[name](star)
        if name in of_facts:
            mart, fact = of_facts[name]
            return mart(star, facts=load(f"int_{fact}"))
        if layer == "int":
            return int_fact(star, table, load(f"stg_{table}"))  # numbered and stored once, with its owners
        if table in FACTS:
            return stage_new_rows(star.fact(table, owners), FACTS[table], RUN)
        return stage_upsert(star.raw(table), ALL_TABLES[table], RUN)

    return quality.run_checks(declared_checks(), load)


def _plans() -> dict[str, Callable[[Star], DataFrame]]:
    plans: dict[str, Callable[[Star], DataFrame]] = {
        "mart_aum_ytd": mart_aum_ytd,
        "mart_aum_ytd_year": partial(mart_aum_ytd, year=YEAR),
        "mart_client_exposure": mart_client_exposure,
        "mart_portfolio_performance": mart_portfolio_performance,
        "mart_ptf_detail": mart_ptf_detail,
        "mart_rm_performance": mart_rm_performance,
        "int_cli": int_cli,
        "int_ptf": int_ptf,
        "int_ins": int_ins,
        "asof_fx_rate": asof_fx_rate,
        "asof_fx_rate_merged": asof_fx_rate_merged,
        "fx_missing_rate_default": fx_missing_rate_default,
        "fx_direct": fx_direct_conversion,
        "fx_pivot": fx_pivot_conversion,
        "scd2_clients": partial(scd2_merged, name="cli"),
        "scd2_portfolios": partial(scd2_merged, name="ptf"),
        "scd2_from_changelog": scd2_from_changelog,
        "scd2_calendar": scd2_calendar,
        "calendar_month_ends": calendar_month_ends,
        "stg_fct_xrt": staged_rates,
        "technical_metadata": technical_metadata,
        "dim_first_load": dim_first_load,
        "upsert_dim": upsert_dim,
        "insert_only_fact": insert_only_fact,
        "insert_only_indexed": insert_only_indexed,
        "rerun_idempotent": rerun_idempotent,
        "incremental_by_date": incremental_by_date,
        "source_freshness": source_freshness,
        "csv_round_trip": csv_round_trip,
        "safe_divide": safe_division,
        "ytd_variation": ytd_variation,
        "ytd_start_lookup": ytd_start_lookup,
        "dq_not_null": dq_not_null,
        "dq_unique": dq_unique,
        "dq_accepted_values": dq_accepted_values,
        "dq_relationships": dq_relationships,
        "dq_between": dq_between,
        "dq_pair_ge": dq_pair_ge,
        "dq_fx_direct": dq_fx_direct,
        "dq_fx_pivot": dq_fx_pivot,
        "dq_positive_amounts": dq_positive_amounts,
        "dq_summary": dq_summary,
    }
    for name in DIMENSIONS:
        plans[f"stg_{name}"] = partial(staged_dimension, name=name)
    for name in FACTS:
        plans[f"stg_{name}"] = partial(staged_fact, name=name)
        plans[f"int_{name}"] = partial(int_fact, name=name)
    return plans


def _query(plan: Callable[[Star], DataFrame], spark: SparkSession, folder: str) -> DataFrame:
    return portable(plan(Star(spark, folder)))


def queries() -> dict[str, Query]:
    return {name: partial(_query, plan) for name, plan in _plans().items()}
