"""Point-in-time dimensions and currency-converted facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultspan.functions import fx_direct, fx_pivot, rate_or_one
from vaultspan.operators.asof import AsOfIndex, asof_lookup, build_asof_index
from vaultspan.operators.calendar import Calendar
from vaultspan.operators.incremental import unseen
from vaultspan.operators.scd2 import Versions, on_calendar
from vaultspan.sources.schemas import FLOWS, HORIZONS, STOCKS

OWNERS = "_owners"
VERSION_COLUMNS = ("dt_cre", "dt_clo", "ts_stg", "updated_at", "valid_from", "valid_to")


def with_labels(
    df: DataFrame, lookups: dict[str, DataFrame], coded: dict[str, tuple[str, str]], fall_back: bool
) -> DataFrame:
    """Left join labels: ``coded`` maps a new label column to (lookup, code column of ``df``).

    With ``fall_back`` the code stands in for a missing label. There is no
    broadcast hint: Catalyst broadcasts a lookup when its size allows.
    """
    joined, labels = df, []
    for into, (name, code) in coded.items():
        lookup = lookups[name].select(F.col(f"cd_{name}").alias(f"_code_{into}"), F.col(f"lb_{name}").alias(f"_{into}"))
        joined = joined.join(lookup, F.col(code) == F.col(f"_code_{into}"), "left")
        labels.append((F.coalesce(f"_{into}", code) if fall_back else F.col(f"_{into}")).alias(into))
    return joined.select(*df.columns, *labels)


# The lookup whose labels each code column shows, and the columns taken from it.
CLIENT_LABELS = {"cd_cli_cat": ("cli_cat", ("lb_cli_cat",)), "cd_cty_dom": ("cty", ("lb_cty",)), "cd_mng_rel": ("mng", ("lb_mng",))}
PORTFOLIO_LABELS = {f"cd_{n}": (n, (f"lb_{n}",)) for n in ("ccy", "prf", "mng_grp", "mng_ext", "agn", "ent", "buu")} | {
    "cd_mng": ("mng", ("lb_mng", "cd_mng_grp"))
}


def client_versions(history: DataFrame, calendar: Calendar, lookups: dict[str, DataFrame]) -> Versions:
    """Clients with their labels, as long as no dates multiply the versions."""
    coded = {
        "lb_cli_cat": ("cli_cat", "cd_cli_cat"),
        "lb_cty_dom": ("cty", "cd_cty_dom"),
        "lb_mng_rel": ("mng", "cd_mng_rel"),
    }
    return Versions(with_labels(history, lookups, coded, fall_back=True), calendar, "dt_cre")


def int_cli(history: DataFrame, calendar: Calendar, lookups: dict[str, DataFrame]) -> DataFrame:
    """Clients per calendar date."""
    labelled = client_versions(history, calendar, lookups).rows
    return on_calendar(labelled, calendar, "dt_cre").select(
        "dt_fct", "cd_cli", "lb_cli", "lb_cli_alt", "cd_cli_cat", "lb_cli_cat", "cd_ccy", "cd_cty_dom", "lb_cty_dom",
        "cd_cty_nat", "cd_mng_rel", "lb_mng_rel", *VERSION_COLUMNS,
    )


def portfolio_versions(history: DataFrame, calendar: Calendar, lookups: dict[str, DataFrame]) -> Versions:
    """Portfolios with their labels. The manager brings the manager's group along."""
    managers = with_labels(
        lookups["mng"].select("cd_mng", "lb_mng", "cd_mng_grp"), lookups, {"lb_mng_grp": ("mng_grp", "cd_mng_grp")}, True
    )
    own = managers.select(F.col("cd_mng").alias("_mng"), "lb_mng", "cd_mng_grp", "lb_mng_grp")
    managed = history.join(own, F.col("cd_mng") == F.col("_mng"), "left").withColumn(
        "lb_mng", F.coalesce("lb_mng", "cd_mng")
    )
    labelled = with_labels(managed, lookups, {f"lb_{n}": (n, f"cd_{n}") for n in ("ccy", "prf")}, fall_back=True)
    labelled = with_labels(
        labelled, lookups, {f"lb_{n}": (n, f"cd_{n}") for n in ("mng_ext", "agn", "ent", "buu")}, fall_back=False
    )
    return Versions(labelled, calendar, "dt_cre")


def int_ptf(history: DataFrame, calendar: Calendar, lookups: dict[str, DataFrame]) -> DataFrame:
    """Portfolios per calendar date."""
    labelled = portfolio_versions(history, calendar, lookups).rows
    pairs = [f"{side}_{name}" for name in ("ccy", "prf", "mng", "mng_grp", "mng_ext", "agn", "ent", "buu")
             for side in ("cd", "lb")]
    return on_calendar(labelled, calendar, "dt_cre").select(
        "dt_fct", "cd_ptf", "lb_ptf", "lb_ptf_alt", "cd_cli", *pairs, *VERSION_COLUMNS
    )


def int_ins(instruments: DataFrame, groups: DataFrame) -> DataFrame:
    """Instruments with the label of their group."""
    labelled = with_labels(instruments, {"ins_grp": groups}, {"lb_ins_grp": ("ins_grp", "cd_ins_grp")}, fall_back=True)
    return labelled.select("id_stg_ins", "cd_ins", "lb_ins", "cd_ins_grp", "lb_ins_grp")


def int_set_cal(calendar: DataFrame) -> DataFrame:
    """The calendar as it is."""
    return calendar


def rate_index(rates: DataFrame) -> AsOfIndex:
    """Exchange rates to the reference currency, ready for as-of lookups."""
    return build_asof_index(rates, "cd_ccy", "dt_fct", "rt_val")


def owners(portfolios: DataFrame) -> DataFrame:
    """Owner and currency of the current portfolio by code, as a list: a code that repeats multiplies its facts."""
    owner = F.struct("cd_cli", F.col("cd_ccy").alias("cd_ccy_ptf"))
    return portfolios.groupBy("cd_ptf").agg(F.collect_list(owner).alias(OWNERS))


def _owned(facts: DataFrame, portfolios: DataFrame) -> DataFrame:
    """Attach owner and currency of the current portfolio; facts without one are dropped.

    Facts that bring their ``owners`` along are not joined.
    """
    if OWNERS in facts.columns:
        held = facts.select(*(c for c in facts.columns if c != OWNERS), F.explode(OWNERS).alias("_owner"))
        return held.select("*", "_owner.*").drop("_owner")
    current = portfolios.select("cd_ptf", "cd_cli", F.col("cd_ccy").alias("cd_ccy_ptf"))
    return facts.join(current, "cd_ptf")


def _with_rate(facts: DataFrame, index: AsOfIndex, currency: str, day: str, into: str) -> DataFrame:
    return asof_lookup(facts, index, currency, day, into).withColumn(into, rate_or_one(into))


def _converted(facts: DataFrame, index: AsOfIndex, currency: str, day: str, side: str, amounts: list[str]) -> DataFrame:
    own = f"xrt_rate_{side}"
    rated = _with_rate(facts, index, currency, day, own)
    rated = _with_rate(rated, index, "cd_ccy_ptf", day, "xrt_rate_ptf")
    return rated.withColumns(
        {f"{a}_ptf": fx_pivot(a, own, "xrt_rate_ptf") for a in amounts}
        | {f"{a}_ref": fx_direct(a, own) for a in amounts}
    )


def int_fct_ast(
    staged: DataFrame, portfolios: DataFrame, index: AsOfIndex, existing: DataFrame | None = None, carried: Sequence[str] = ()
) -> DataFrame:
    """Valued positions; only those not yet in ``existing``. ``carried`` are columns of the staged rows to keep."""
    owned = _owned(unseen(existing, staged, "cd_fct_ast"), portfolios)
    amounts = ["mt_ast", "mt_aci", "mt_pnl"]
    return _converted(owned, index, "cd_ccy", "dt_fct", "pos", amounts).select(
        "id_stg_fct_ast", "cd_fct_ast", "cd_pos", "cd_pos_typ", "cd_ptf", "cd_cli", "dt_fct", "cd_ccy", "cd_ins",
        "cd_ast", "lb_fct_ast", "qt_ast", *amounts, "xrt_rate_pos", "xrt_rate_ptf",
        *(f"{a}_ptf" for a in amounts), *(f"{a}_ref" for a in amounts), "rt_prm", "rt_pam", "pc_twr", *carried,
    )


def int_fct_ope(
    staged: DataFrame, portfolios: DataFrame, index: AsOfIndex, existing: DataFrame | None = None
) -> DataFrame:
    """Operations, converted at their accounting date."""
    owned = _owned(unseen(existing, staged, "cd_fct_ope"), portfolios)
    amounts = ["mt_ope", "mt_net"]
    return _converted(owned, index, "cd_ccy_ope", "dt_cta", "ope", amounts).select(
        "id_stg_fct_ope", "cd_fct_ope", "cd_ope", "nb_seq_ptc", "lb_fct_ope", "cd_fct_ope_ext", "cd_ope_typ",
        "cd_deb_crd", "yn_pro", "cd_pos", "cd_ptf", "cd_cli", "cd_ccy_ope", "cd_ccy_ptf", "cd_ast", "cd_ins",
        "dt_cta", "dt_exe", "dt_val", "qt_ope", *amounts, "xrt_rate_ope", "xrt_rate_ptf",
        *(f"{a}_ptf" for a in amounts), *(f"{a}_ref" for a in amounts),
    )


def int_fct_mvt(
    staged: DataFrame, portfolios: DataFrame, index: AsOfIndex, existing: DataFrame | None = None
) -> DataFrame:
    """Movements, converted at their accounting date.

    Securities legs carry a share count in ``mt_mvt``; it is converted like money.
    """
    owned = _owned(unseen(existing, staged, "cd_fct_mvt"), portfolios)
    return _converted(owned, index, "cd_ccy_mvt", "dt_cta", "mvt", ["mt_mvt"]).select(
        "id_stg_fct_mvt", "cd_fct_mvt", "cd_pos", "cd_fct_ope", "yn_ext", "dt_cta", "id_obj_mvt_cat", "cd_mvt_typ",
        "cd_ptf", "cd_cli", "cd_mvt_res", "cd_ast", "cd_ins", "cd_ccy_mvt", "cd_ccy_ptf", "mt_mvt",
        "xrt_rate_mvt", "xrt_rate_ptf", "mt_mvt_ptf", "mt_mvt_ref",
    )


def portfolio_amounts() -> list[tuple[str, str]]:
    """(native, reference) column names; the horizon stays at the end of the name."""
    stocks = [(s, f"{s}_ref") for s in STOCKS]
    return stocks + [(f"{f}_{h}", f"{f}_ref_{h}") for h in HORIZONS for f in FLOWS]


def int_fct_ptf(
    staged: DataFrame, portfolios: DataFrame, index: AsOfIndex, existing: DataFrame | None = None
) -> DataFrame:
    """Portfolio balances and flows, native and in reference currency."""
    owned = _owned(unseen(existing, staged, "cd_fct_ptf"), portfolios)
    rated = _with_rate(owned, index, "cd_ccy_ptf", "dt_fct", "xrt_rate")
    both = [c for native, ref in portfolio_amounts()
            for c in (F.col(native), fx_direct(native, "xrt_rate").alias(ref))]
    return rated.select(
        "id_stg_fct_ptf", "cd_fct_ptf", "cd_ptf", "cd_cli", "cd_ccy_ptf", "dt_fct", "pc_ptf", "xrt_rate", *both
    )
