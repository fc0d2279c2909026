"""The raw tables: columns, keys and numbering order.

Fixed values: table names, column names, technical object ids and numbering
orders define the data model and must be spelled exactly like this.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

from vaultspan.types import DDL

STOCKS = ("mt_net", "mt_aci", "mt_lia", "mt_pnl", "mt_pnc")
FLOWS = ("mt_inc", "mt_out", "mt_nnm_inc", "mt_nnm_out", "mt_int_inc", "mt_int_out")
HORIZONS = ("ytd", "mtd", "dtd")


@dataclass(frozen=True)
class RawTable:
    """One raw table. ``columns`` maps each name to a kind of ``types.DDL``."""

    name: str
    object_id: int
    columns: dict[str, str]
    number_by: tuple[str, ...] = ()
    extra_ids: tuple[tuple[str, int], ...] = ()

    @property
    def key(self) -> str:
        return f"cd_{self.name}"

    @property
    def id_column(self) -> str:
        return f"id_stg_{self.name}"

    @property
    def source(self) -> str:
        return f"st0_{self.name}"

    @property
    def staged(self) -> str:
        return f"stg_{self.name}"

    @property
    def order(self) -> tuple[str, ...]:
        """Numbering order, made total by the key."""
        return self.number_by if self.key in self.number_by else (*self.number_by, self.key)

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(", ".join(f"{c} {DDL[k]}" for c, k in self.columns.items()))


def _texts(names: str) -> dict[str, str]:
    return dict.fromkeys(names.split(), "text")


def _typed(names: str, **kinds: str) -> dict[str, str]:
    return {name: kinds.get(name, "text") for name in names.split()}


def _labelled(name: str, object_id: int, more: str = "") -> RawTable:
    return RawTable(name, object_id, _texts(f"cd_{name} lb_{name} {more}"))


DIMENSIONS: dict[str, RawTable] = {
    t.name: t
    for t in (
        RawTable(
            "cli", 1001,
            _typed("cd_cli lb_cli lb_cli_alt dt_cre dt_clo cd_cty_dom cd_cty_nat cd_mng_rel cd_cli_cat cd_ccy",
                   dt_cre="date", dt_clo="date"),
        ),
        RawTable(
            "ptf", 1002,
            _typed("cd_ptf lb_ptf lb_ptf_alt dt_cre dt_clo cd_cli cd_ccy cd_prf cd_mng cd_mng_ext cd_agn cd_ent cd_buu",
                   dt_cre="date", dt_clo="date"),
            extra_ids=(("id_ptf_tec_typ", 1),),
        ),
        _labelled("agn", 1003),
        _labelled("ast", 1004, "tt_ast cd_rat"),
        _labelled("buu", 1005),
        _labelled("ccy", 1006),
        _labelled("cli_cat", 1007),
        _labelled("cty", 1008),
        _labelled("ent", 1009),
        _labelled("ins", 1010, "cd_ins_grp"),
        _labelled("ins_grp", 1011),
        _labelled("mng", 1012, "cd_mng_grp"),
        _labelled("mng_ext", 1013),
        _labelled("mng_grp", 1014),
        _labelled("ope_typ", 1015, "yn_nnm yn_int yn_loa"),
        _labelled("prf", 1016),
        RawTable(
            "prs", 1017,
            _typed("cd_prs lb_prs yn_php dt_bth dt_dth cd_gnd cd_prs_typ cd_cty_nat cd_cty_dom",
                   dt_bth="date", dt_dth="date"),
        ),
        _labelled("pos_typ", 1023),
    )
}

RATES = RawTable(
    "fct_xrt", 1018,
    _typed("cd_fct_xrt cd_ccy dt_fct rt_fac rt_val", dt_fct="date", rt_fac="rate", rt_val="rate"),
    number_by=("cd_ccy", "dt_fct"),
)

FACTS: dict[str, RawTable] = {
    t.name: t
    for t in (
        RawTable(
            "fct_ast", 1019,
            _typed(
                "cd_fct_ast cd_pos cd_pos_typ cd_ptf dt_fct cd_ccy cd_ins cd_ast lb_fct_ast "
                "qt_ast mt_ast mt_aci rt_prm rt_pam mt_pnl pc_twr",
                dt_fct="date", qt_ast="rate", rt_prm="rate", rt_pam="rate", pc_twr="rate",
                mt_ast="money", mt_aci="money", mt_pnl="money",
            ),
            number_by=("cd_ptf", "dt_fct", "cd_ast"),
        ),
        RawTable(
            "fct_ptf", 1020,
            {
                **_typed("cd_fct_ptf cd_ptf dt_fct pc_ptf", dt_fct="date", pc_ptf="rate"),
                **dict.fromkeys(STOCKS, "money"),
                **{f"{flow}_{horizon}": "money" for horizon in HORIZONS for flow in FLOWS},
            },
            number_by=("cd_ptf", "dt_fct"),
        ),
        RawTable(
            "fct_ope", 1021,
            _typed(
                "cd_fct_ope cd_ope nb_seq_ptc lb_fct_ope cd_fct_ope_ext cd_ope_typ cd_deb_crd yn_pro cd_pos "
                "cd_ptf cd_ccy_ope cd_ast cd_ins dt_cta dt_exe dt_val qt_ope mt_ope mt_net",
                nb_seq_ptc="id", dt_cta="date", dt_exe="date", dt_val="date",
                qt_ope="rate", mt_ope="money", mt_net="money",
            ),
            number_by=("dt_cta", "cd_fct_ope"),
        ),
        RawTable(
            "fct_mvt", 1022,
            _typed(
                "cd_fct_mvt cd_pos cd_fct_ope yn_ext dt_cta id_obj_mvt_cat cd_mvt_typ cd_ptf cd_mvt_res "
                "cd_ast cd_ins cd_ccy_mvt mt_mvt",
                dt_cta="date", id_obj_mvt_cat="id", mt_mvt="money",
            ),
            number_by=("dt_cta", "cd_fct_mvt"),
        ),
    )
}

ALL_TABLES: dict[str, RawTable] = {**DIMENSIONS, RATES.name: RATES, **FACTS}
