"""The declared checks of every layer.

Fixed values: which columns may be empty, must be unique, come from a closed
list, point to another table or lie in a range is part of the data model.
"""

from __future__ import annotations

from vaultspan.operators.quality import (
    Check,
    accepted,
    between,
    converted,
    not_negative,
    ordered,
    references,
    required,
    unique,
)
from vaultspan.plans.intermediate import portfolio_amounts
from vaultspan.sources.schemas import ALL_TABLES, DIMENSIONS, RawTable

YES_NO = ("Y", "N")

# Columns of the raw tables that may be empty.
OPTIONAL: dict[str, tuple[str, ...]] = {
    "cli": ("lb_cli_alt", "dt_clo", "cd_cty_nat"),
    "ptf": ("lb_ptf_alt", "dt_clo", "cd_mng_ext", "cd_agn"),
    "ast": ("cd_rat",),
    "prs": ("yn_php", "dt_bth", "dt_dth", "cd_gnd", "cd_prs_typ", "cd_cty_nat", "cd_cty_dom"),
    "fct_ope": ("lb_fct_ope", "cd_fct_ope_ext"),
    "fct_ast": ("lb_fct_ast",),
}

# Closed lists.
ACCEPTED: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("stg_cli", "cd_ccy", ("USD", "CHF", "EUR", "GBP")),
    ("stg_pos_typ", "cd_pos_typ", ("T", "C")),
    ("stg_ope_typ", "yn_nnm", YES_NO),
    ("stg_ope_typ", "yn_int", YES_NO),
    ("stg_ope_typ", "yn_loa", YES_NO),
    ("stg_prs", "yn_php", ("Y",)),
    ("stg_prs", "cd_gnd", ("M", "F")),
    ("stg_fct_ope", "cd_deb_crd", ("D", "C")),
    ("stg_fct_ope", "yn_pro", YES_NO),
    ("stg_fct_mvt", "yn_ext", YES_NO),
    ("stg_fct_mvt", "cd_mvt_res", ("CSH", "SEC")),
    ("stg_fct_ast", "cd_pos_typ", ("T", "C")),
)

# (table, column, parent): the parent's column is its code.
REFERENCES: tuple[tuple[str, str, str], ...] = (
    ("stg_cli", "cd_cli_cat", "cli_cat"),
    ("stg_ptf", "cd_cli", "cli"),
    ("stg_mng", "cd_mng_grp", "mng_grp"),
    ("stg_ins", "cd_ins_grp", "ins_grp"),
    ("stg_prs", "cd_cty_nat", "cty"),
    ("stg_prs", "cd_cty_dom", "cty"),
    ("stg_fct_ope", "cd_ope_typ", "ope_typ"),
    ("stg_fct_ope", "cd_ptf", "ptf"),
    ("stg_fct_ope", "cd_ccy_ope", "ccy"),
    ("stg_fct_ope", "cd_ast", "ast"),
    ("stg_fct_ope", "cd_ins", "ins"),
    ("stg_fct_ptf", "cd_ptf", "ptf"),
    ("stg_fct_mvt", "cd_fct_ope", "fct_ope"),
    ("stg_fct_mvt", "cd_ptf", "ptf"),
    ("stg_fct_mvt", "cd_ast", "ast"),
    ("stg_fct_mvt", "cd_ins", "ins"),
    ("stg_fct_mvt", "cd_ccy_mvt", "ccy"),
    ("stg_fct_ast", "cd_ptf", "ptf"),
    ("stg_fct_ast", "cd_ccy", "ccy"),
    ("stg_fct_ast", "cd_ast", "ast"),
    ("stg_fct_xrt", "cd_ccy", "ccy"),
)

# Required columns of the intermediate tables and marts.
REQUIRED: dict[str, str] = {
    "int_cli": "dt_fct cd_cli lb_cli cd_cli_cat lb_cli_cat cd_ccy cd_cty_dom lb_cty_dom cd_mng_rel lb_mng_rel dt_cre "
    "ts_stg updated_at valid_from",
    "int_ptf": "dt_fct cd_ptf lb_ptf cd_cli cd_ccy lb_ccy cd_prf lb_prf cd_mng lb_mng cd_mng_grp lb_mng_grp cd_ent "
    "lb_ent cd_buu lb_buu dt_cre ts_stg updated_at valid_from",
    "int_ins": "id_stg_ins cd_ins lb_ins cd_ins_grp lb_ins_grp",
    "int_set_cal": "dt_fct vr_dwh_cal cd_cal",
    "int_fct_ast": "id_stg_fct_ast cd_fct_ast cd_pos cd_pos_typ cd_ptf cd_cli dt_fct cd_ccy cd_ins cd_ast qt_ast "
    "mt_ast mt_aci mt_pnl xrt_rate_pos xrt_rate_ptf mt_ast_ptf mt_aci_ptf mt_pnl_ptf mt_ast_ref mt_aci_ref mt_pnl_ref "
    "rt_prm rt_pam pc_twr",
    "int_fct_ope": "id_stg_fct_ope cd_fct_ope cd_ope nb_seq_ptc cd_ope_typ cd_deb_crd yn_pro cd_pos cd_ptf cd_cli "
    "cd_ccy_ope cd_ccy_ptf cd_ast cd_ins dt_cta dt_exe dt_val qt_ope mt_ope mt_net xrt_rate_ope xrt_rate_ptf "
    "mt_ope_ptf mt_net_ptf mt_ope_ref mt_net_ref",
    "int_fct_mvt": "id_stg_fct_mvt cd_fct_mvt cd_pos cd_fct_ope yn_ext dt_cta id_obj_mvt_cat cd_mvt_typ cd_ptf cd_cli "
    "cd_mvt_res cd_ast cd_ins cd_ccy_mvt cd_ccy_ptf mt_mvt xrt_rate_mvt xrt_rate_ptf mt_mvt_ptf mt_mvt_ref",
    "mart_aum_ytd": "dt_fct cd_cli cd_ptf aum_current",
    "mart_client_exposure": "dt_fct cd_cli cd_ptf",
    "mart_portfolio_performance": "dt_fct cd_ptf",
    "mart_ptf_detail": "dt_fct cd_ptf cd_cli mt_net mt_net_ref",
    "mart_rm_performance": "dt_fct cd_mng",
}

# (table, rate columns): rates are strictly positive.
POSITIVE_RATES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("stg_fct_xrt", ("rt_val",)),
    ("int_fct_ast", ("xrt_rate_pos", "xrt_rate_ptf")),
    ("int_fct_ope", ("xrt_rate_ope", "xrt_rate_ptf")),
    ("int_fct_mvt", ("xrt_rate_mvt", "xrt_rate_ptf")),
    ("int_fct_ptf", ("xrt_rate",)),
)

# (table, rate of the fact's currency, converted amounts).
CONVERSIONS: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("int_fct_ast", "xrt_rate_pos", ("mt_ast", "mt_aci", "mt_pnl")),
    ("int_fct_ope", "xrt_rate_ope", ("mt_ope", "mt_net")),
    ("int_fct_mvt", "xrt_rate_mvt", ("mt_mvt",)),
)


def _staged_columns(table: RawTable) -> list[str]:
    """Required columns of a staged table: all but the free description and the optional ones."""
    technical = ["ts_stg", "vr_stg", "id_obj_tec", "cd_src", "cd_pid", *(name for name, _ in table.extra_ids)]
    source_key = [f"{table.key}_src"] if table.name in DIMENSIONS else []
    optional = OPTIONAL.get(table.name, ())
    return [table.id_column, *technical, *source_key, *(c for c in table.columns if c not in optional)]


def declared_checks() -> list[Check]:
    """Every declared check, layer by layer."""
    checks: list[Check] = []
    for table in ALL_TABLES.values():
        checks += [required(table.staged, c) for c in _staged_columns(table)]
        checks += [unique(table.staged, table.id_column), unique(table.staged, table.key)]
    checks += [required("stg_set_cal", c) for c in ("dt_fct", "vr_dwh_cal", "cd_cal")]
    checks += [unique("stg_set_cal", "dt_fct")]

    for name, columns in REQUIRED.items():
        checks += [required(name, c) for c in columns.split()]
    amounts = portfolio_amounts()
    detail = ["id_stg_fct_ptf", "cd_fct_ptf", "cd_ptf", "cd_cli", "cd_ccy_ptf", "dt_fct", "pc_ptf", "xrt_rate"]
    checks += [required("int_fct_ptf", c) for c in [*detail, *(c for pair in amounts for c in pair)]]
    for name, key in (
        ("int_fct_ast", "cd_fct_ast"), ("int_fct_ope", "cd_fct_ope"), ("int_fct_mvt", "cd_fct_mvt"),
        ("int_fct_ptf", "cd_fct_ptf"), ("int_ins", "cd_ins"), ("int_set_cal", "dt_fct"),
    ):
        checks.append(unique(name, key))

    checks += [accepted(*rule) for rule in ACCEPTED]
    checks += [references(table, column, f"stg_{parent}", f"cd_{parent}") for table, column, parent in REFERENCES]
    checks += [between(t, rate, low=0, strictly=True) for t, rates in POSITIVE_RATES for rate in rates]
    checks.append(between("stg_fct_ast", "qt_ast", low=0))
    checks.append(between("int_fct_ast", "rt_prm", low=0, high=1))
    checks.append(between("int_fct_ptf", "pc_ptf", low=0, high=1))
    checks.append(ordered("stg_fct_ope", "dt_val", "dt_exe", or_equal=True))
    checks.append(ordered("stg_fct_ope", "dt_val", "dt_cta", or_equal=True))

    for table, rate, natives in CONVERSIONS:
        checks += [converted(table, f"{n}_ref", n, rate) for n in natives]
        checks += [converted(table, f"{n}_ptf", n, rate, "xrt_rate_ptf") for n in natives]
    checks += [converted("int_fct_ptf", ref, native, "xrt_rate") for native, ref in amounts]
    checks.append(not_negative("mart_client_exposure", "mt_ast", "mt_ast_ref"))
    return checks
