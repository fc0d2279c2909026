"""ANSI SQL for the registered queries, run by another engine on the same tables.

``_TABLES`` restates the raw banking tables; each query names what it needs and
gets the tables it depends on as CTEs.
"""

from __future__ import annotations

import re

from vaultspan.operators.quality import Check
from vaultspan.plans.checks import declared_checks
from vaultspan.plans.intermediate import portfolio_amounts
from vaultspan.sources.schemas import ALL_TABLES, DIMENSIONS, FACTS, FLOWS, RATES, RawTable
from vaultspan.types import DDL

_MONEY = DDL["money"]

_FLOW_RULES = {
    "mt_inc": "o_orderstatus = 'F'",
    "mt_out": "o_orderstatus = 'O'",
    "mt_nnm_inc": "o_orderpriority = '1-URGENT'",
    "mt_nnm_out": "o_orderpriority = '2-HIGH'",
    "mt_int_inc": "o_orderpriority = '3-MEDIUM'",
    "mt_int_out": "o_orderpriority = '5-LOW'",
}
_BOOKED = f"cast(o_totalprice as {_MONEY})"


def _flow_sums() -> str:
    sums = []
    for name, rule in _FLOW_RULES.items():
        sums.append(f"sum(case when {rule} then {_BOOKED} else 0 end) as {name}_mtd")
        last = f"{rule} and cast(o_orderdate as date) = last_day(cast(o_orderdate as date))"
        sums.append(f"sum(case when {last} then {_BOOKED} else 0 end) as {name}_dtd")
    return ", ".join(sums)


def _typed(table: RawTable, source: str) -> str:
    columns = {"text": "varchar", "date": "date"} | {k: v for k, v in DDL.items() if k not in ("text", "date")}
    picked = ", ".join(f"cast({c} as {columns[kind]}) as {c}" for c, kind in table.columns.items())
    return f"select {picked} from ({source})"


_LINE_KEY = (
    "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || cast(l_shipdate as date)"
)
_PRICE = f"cast(l_extendedprice as {_MONEY})"
_SHARE = "(cast(l_discount as decimal(4,2)) - cast(l_tax as decimal(4,2)))"

_RAW: dict[str, str] = {
    "ccy": "select r_name as cd_ccy, 'Currency ' || r_name as lb_ccy from region",
    "cty": "select n_name as cd_cty, 'Country ' || n_nationkey as lb_cty from nation",
    "mng": "select 'RM' || n_nationkey as cd_mng, 'Manager ' || n_name as lb_mng, 'GRP_' || r_name as cd_mng_grp "
    "from places",
    "mng_grp": "select 'GRP_' || r_name as cd_mng_grp, 'Team ' || r_name as lb_mng_grp from region",
    "mng_ext": "select 'EXT' || s_suppkey as cd_mng_ext, s_name as lb_mng_ext from supplier",
    "agn": "select distinct 'AG' || left(o_orderpriority, 1) as cd_agn, o_orderpriority as lb_agn from orders",
    "ent": "select distinct p_brand as cd_ent, 'Entity ' || p_brand as lb_ent from part",
    "buu": "select distinct p_type as cd_buu, 'Unit ' || p_type as lb_buu from part",
    "cli_cat": "select distinct c_mktsegment as cd_cli_cat, 'Segment ' || c_mktsegment as lb_cli_cat from customer",
    "prf": "select distinct c_mktsegment as cd_prf, 'Profile ' || c_mktsegment as lb_prf from customer",
    "ope_typ": "select distinct o_orderstatus as cd_ope_typ, 'Operation ' || o_orderstatus as lb_ope_typ, "
    "if(o_orderstatus = 'F', 'Y', 'N') as yn_nnm, if(o_orderstatus = 'O', 'Y', 'N') as yn_int, "
    "if(o_orderstatus = 'P', 'Y', 'N') as yn_loa from orders",
    "pos_typ": "select distinct if(l_linestatus = 'O', 'T', 'C') as cd_pos_typ, 'Status ' || l_linestatus as lb_pos_typ "
    "from lineitem",
    "ast": "select 'A' || p_partkey as cd_ast, p_name as lb_ast, p_brand || ' ' || p_type as tt_ast, "
    "if(p_size <= 45, 'R' || p_size, null) as cd_rat from part",
    "ins": "select 'I' || p_partkey as cd_ins, p_name as lb_ins, p_type as cd_ins_grp from part",
    "ins_grp": "select distinct p_type as cd_ins_grp, 'Group ' || p_type as lb_ins_grp from part",
    "prs": "select 'PRS' || c_custkey as cd_prs, c_name as lb_prs, if(c_acctbal >= 0, 'Y', null) as yn_php, "
    "if(c_acctbal >= 0, date '1940-01-01' + cast(c_custkey % 20000 as integer), null) as dt_bth, "
    "if(c_acctbal > 9000, date '2000-01-01', null) as dt_dth, "
    "if(c_acctbal >= 0, if(c_nationkey < 12, 'M', 'F'), null) as cd_gnd, "
    "if(c_acctbal >= 0, 'INDIVIDUAL', 'COMPANY') as cd_prs_typ, n_name as cd_cty_nat, "
    "if(c_acctbal >= 0, n_name, null) as cd_cty_dom from holders",
    "cli": "select 'C' || (c_custkey // 3) as cd_cli, c_name as lb_cli, upper(c_name) as lb_cli_alt, "
    "date '1994-01-01' + cast((c_custkey // 3) % 900 as integer) as dt_cre, "
    "if(c_acctbal < 0, date '2000-06-30', null) as dt_clo, n_name as cd_cty_dom, "
    "'NATION_' || (c_nationkey + 1) as cd_cty_nat, 'RM' || c_nationkey as cd_mng_rel, c_mktsegment as cd_cli_cat, "
    "r_name as cd_ccy from holders "
    "qualify row_number() over (partition by c_custkey // 3 order by c_custkey) = 1",
    "ptf": "select 'P' || c_custkey as cd_ptf, 'Portfolio ' || c_name as lb_ptf, "
    "c_mktsegment || ' ' || c_custkey as lb_ptf_alt, date '1994-01-01' + cast(c_custkey % 900 as integer) as dt_cre, "
    "if(c_acctbal < 0, date '2000-06-30', null) as dt_clo, 'C' || (c_custkey // 3) as cd_cli, r_name as cd_ccy, "
    "c_mktsegment as cd_prf, 'RM' || c_nationkey as cd_mng, "
    "if(c_custkey % 2 = 0, 'EXT' || (c_custkey % 100), null) as cd_mng_ext, "
    "if(c_custkey % 7 <> 0, 'AG' || (c_custkey % 5 + 1), null) as cd_agn, "
    "'Brand#' || (c_custkey % 25 + 1) as cd_ent, "
    "['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'][c_custkey % 6 + 1] as cd_buu from holders",
    "fct_xrt": "select r_name || '_' || strftime(d, '%Y%m%d') as cd_fct_xrt, r_name as cd_ccy, d as dt_fct, 1 as rt_fac, "
    "cast(if(r_name = 'EUROPE', 100, 50 + ((year(d) * 12 + month(d)) * 7 + r_regionkey * 13) % 97) as decimal(10,0)) "
    "* 0.01 as rt_val from region, (select last_day(cast(m as date)) as d "
    "from range(timestamp '1995-06-01', timestamp '2002-01-01', interval 1 month) r(m)) where r_name <> 'MIDDLE EAST'",
    "fct_ast": f"select 'AST-' || {_LINE_KEY} as cd_fct_ast, 'POS-' || o_custkey || '-' || l_partkey as cd_pos, "
    "if(l_linestatus = 'O', 'T', 'C') as cd_pos_typ, 'P' || o_custkey as cd_ptf, "
    "last_day(cast(l_shipdate as date)) as dt_fct, r_name as cd_ccy, 'I' || l_partkey as cd_ins, "
    "'A' || l_partkey as cd_ast, if(l_returnflag <> 'N', 'Line ' || l_linenumber, null) as lb_fct_ast, "
    f"l_quantity as qt_ast, {_PRICE} as mt_ast, {_PRICE} * cast(l_tax as decimal(4,2)) as mt_aci, "
    f"l_discount as rt_prm, l_tax as rt_pam, {_PRICE} * {_SHARE} as mt_pnl, {_SHARE} as pc_twr from lines",
    "fct_mvt": f"select 'MVT-' || {_LINE_KEY} as cd_fct_mvt, 'POS-' || o_custkey || '-' || l_partkey as cd_pos, "
    "'OPE-' || l_orderkey as cd_fct_ope, if(l_returnflag = 'R', 'Y', 'N') as yn_ext, "
    "cast(l_shipdate as date) as dt_cta, if(l_linestatus = 'O', 1, 2) as id_obj_mvt_cat, l_returnflag as cd_mvt_typ, "
    "'P' || o_custkey as cd_ptf, if(l_linestatus = 'O', 'SEC', 'CSH') as cd_mvt_res, 'A' || l_partkey as cd_ast, "
    "'I' || l_partkey as cd_ins, r_name as cd_ccy_mvt, "
    f"if(l_returnflag = 'R', -1, 1) * cast(if(l_linestatus = 'O', l_quantity, l_extendedprice) as {_MONEY}) as mt_mvt "
    "from lines",
    "fct_ope": "select 'OPE-' || o_orderkey as cd_fct_ope, 'TXN-' || o_orderkey as cd_ope, 1 as nb_seq_ptc, "
    "'Order ' || o_orderpriority as lb_fct_ope, "
    "if(o_orderpriority in ('1-URGENT', '2-HIGH'), 'X' || o_orderkey, null) as cd_fct_ope_ext, "
    "o_orderstatus as cd_ope_typ, if(o_orderpriority in ('1-URGENT', '2-HIGH'), 'D', 'C') as cd_deb_crd, "
    "if(o_orderstatus = 'P', 'Y', 'N') as yn_pro, 'POS-' || o_custkey || '-' || (o_orderkey % 200) as cd_pos, "
    "'P' || o_custkey as cd_ptf, ['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'][o_orderkey % 5 + 1] as cd_ccy_ope, "
    "'A' || (o_orderkey % 200) as cd_ast, 'I' || (o_orderkey % 200) as cd_ins, cast(o_orderdate as date) as dt_cta, "
    "cast(o_orderdate as date) as dt_exe, cast(o_orderdate as date) + 2 as dt_val, o_orderkey % 100 + 1 as qt_ope, "
    f"{_BOOKED} as mt_ope, {_BOOKED} * cast(0.99 as decimal(3,2)) as mt_net from orders",
    "fct_ptf": "select 'FCT-P' || o_custkey || '-' || strftime(dt_fct, '%Y%m%d') as cd_fct_ptf, "
    "'P' || o_custkey as cd_ptf, dt_fct, cast(o_custkey % 100 as decimal(10,0)) * 0.01 as pc_ptf, total as mt_net, "
    "total * 0.01 as mt_aci, total * 0.25 as mt_lia, total * 0.05 as mt_pnl, total * 0.02 as mt_pnc, "
    + ", ".join(f"{n}_mtd, {n}_dtd" for n in FLOWS)
    + ", "
    + ", ".join(
        f"sum({n}_mtd) over (partition by o_custkey, year(dt_fct) order by dt_fct) as {n}_ytd" for n in FLOWS
    )
    + f" from (select o_custkey, last_day(cast(o_orderdate as date)) as dt_fct, sum({_BOOKED}) as total, {_flow_sums()} "
    "from orders group by all)",
}

# Fixed values of the mapping: the code of each lookup that has no label there.
_WITHOUT_LABEL = {"mng_grp": "GRP_AFRICA", "cli_cat": "MACHINERY", "prf": "HOUSEHOLD", "ins_grp": "PROMO"}

_LATE = "1998-02-10 10:00:00"
_LATER = "1998-02-10 18:00:00"


def _changes(name: str, code: str) -> str:
    label = f"lb_{name}_alt"
    return (
        f"select *, timestamp '1994-01-01 06:00:00' as ts_stg from {name} "
        f"union all by name select * replace ('under review' as {label}), timestamp '{_LATE}' as ts_stg from {name} "
        "where dt_clo is not null "
        f"union all by name select * replace ('FURNITURE' as {code}), timestamp '{_LATER}' as ts_stg from {name} "
        "where dt_clo is not null and dt_cre < date '1995-01-01'"
    )


def _versions(name: str) -> str:
    return (
        "select *, ts_stg as updated_at, ts_stg as valid_from, "
        f"lead(ts_stg) over (partition by cd_{name} order by ts_stg) as valid_to from {name}_changes"
    )


def _in_force(version: str) -> str:
    return (
        f"c.dt_fct >= {version}.dt_cre and c.dt_fct >= cast({version}.valid_from as date) "
        f"and ({version}.valid_to is null or cast({version}.valid_to as date) > c.dt_fct)"
    )


def _numbered(name: str) -> str:
    table = ALL_TABLES[name]
    return f"select *, row_number() over (order by {', '.join(table.order)}) as {table.id_column} from {name}"


def _rated(name: str, currency: str, day: str, own: str, amounts: tuple[str, ...]) -> str:
    ref = [f"cast(f.{a} * coalesce(x.rt_val, 1) as {_MONEY}) as {a}_ref" for a in amounts]
    ptf = [f"cast(f.{a} * coalesce(x.rt_val, 1) / coalesce(y.rt_val, 1) as {_MONEY}) as {a}_ptf" for a in amounts]
    return (
        f"select f.*, p.cd_cli, p.cd_ccy as cd_ccy_ptf, coalesce(x.rt_val, 1) as {own}, "
        f"coalesce(y.rt_val, 1) as xrt_rate_ptf, {', '.join(ref + ptf)} from n_{name} f join ptf p on p.cd_ptf = f.cd_ptf "
        f"asof left join fct_xrt x on x.cd_ccy = f.{currency} and f.{day} >= x.dt_fct "
        f"asof left join fct_xrt y on y.cd_ccy = p.cd_ccy and f.{day} >= y.dt_fct"
    )


_TABLES: dict[str, str] = {
    "places": "select * from nation join region on n_regionkey = r_regionkey",
    "holders": "select * from customer join places on c_nationkey = n_nationkey",
    "lines": "select * from lineitem join orders on o_orderkey = l_orderkey join supplier on s_suppkey = l_suppkey "
    "join places on n_nationkey = s_nationkey",
    **{name: _typed(ALL_TABLES[name], sql) for name, sql in _RAW.items()},
    **{f"n_{name}": _numbered(name) for name in (*FACTS, "ins")},
    **{f"known_{name}": f"select * from {name} where cd_{name} <> '{code}'" for name, code in _WITHOUT_LABEL.items()},
    "cal": "select last_day(cast(m as date)) as dt_fct from range(timestamp '1995-01-01', timestamp '2001-12-01', "
    "interval 1 month) r(m) union all select date '2001-12-15'",
    "cli_changes": _changes("cli", "cd_cli_cat"),
    "ptf_changes": _changes("ptf", "cd_prf"),
    "cli_versions": _versions("cli"),
    "ptf_versions": _versions("ptf"),
    "int_cli": "select c.dt_fct, v.*, coalesce(k.lb_cli_cat, v.cd_cli_cat) as lb_cli_cat, "
    "coalesce(t.lb_cty, v.cd_cty_dom) as lb_cty_dom, coalesce(m.lb_mng, v.cd_mng_rel) as lb_mng_rel "
    f"from cal c join cli_versions v on {_in_force('v')} left join known_cli_cat k on k.cd_cli_cat = v.cd_cli_cat "
    "left join cty t on t.cd_cty = v.cd_cty_dom left join mng m on m.cd_mng = v.cd_mng_rel",
    "int_ptf": "select c.dt_fct, v.*, coalesce(ccy.lb_ccy, v.cd_ccy) as lb_ccy, coalesce(prf.lb_prf, v.cd_prf) as lb_prf, "
    "coalesce(mng.lb_mng, v.cd_mng) as lb_mng, mng.cd_mng_grp, coalesce(mng_grp.lb_mng_grp, mng.cd_mng_grp) as lb_mng_grp, "
    "mng_ext.lb_mng_ext, agn.lb_agn, ent.lb_ent, buu.lb_buu "
    f"from cal c join ptf_versions v on {_in_force('v')} left join ccy on ccy.cd_ccy = v.cd_ccy "
    "left join known_prf prf on prf.cd_prf = v.cd_prf left join mng on mng.cd_mng = v.cd_mng "
    "left join known_mng_grp mng_grp on mng_grp.cd_mng_grp = mng.cd_mng_grp left join mng_ext on mng_ext.cd_mng_ext = v.cd_mng_ext "
    "left join agn on agn.cd_agn = v.cd_agn left join ent on ent.cd_ent = v.cd_ent left join buu on buu.cd_buu = v.cd_buu",
    "int_ins": "select i.*, coalesce(g.lb_ins_grp, i.cd_ins_grp) as lb_ins_grp from n_ins i "
    "left join known_ins_grp g on g.cd_ins_grp = i.cd_ins_grp",
    "int_fct_ast": _rated("fct_ast", "cd_ccy", "dt_fct", "xrt_rate_pos", ("mt_ast", "mt_aci", "mt_pnl")),
    "int_fct_ope": _rated("fct_ope", "cd_ccy_ope", "dt_cta", "xrt_rate_ope", ("mt_ope", "mt_net")),
    "int_fct_mvt": _rated("fct_mvt", "cd_ccy_mvt", "dt_cta", "xrt_rate_mvt", ("mt_mvt",)),
    "int_fct_ptf": "select f.*, p.cd_cli, p.cd_ccy as cd_ccy_ptf, coalesce(y.rt_val, 1) as xrt_rate, "
    + ", ".join(f"cast(f.{n} * coalesce(y.rt_val, 1) as {_MONEY}) as {ref}" for n, ref in portfolio_amounts())
    + " from n_fct_ptf f join ptf p on p.cd_ptf = f.cd_ptf "
    "asof left join fct_xrt y on y.cd_ccy = p.cd_ccy and f.dt_fct >= y.dt_fct",
    "year_start": "select year(dt_fct) as y, min(dt_fct) as d0 from cal group by all",
    "aum": "select f.dt_fct, f.cd_cli, f.cd_ptf, p.lb_ptf, k.lb_cli, k.cd_cli_cat, k.lb_cli_cat, k.cd_cty_dom, k.lb_cty_dom, "
    "k.cd_ccy as cd_ccy_cli, p.cd_mng, p.lb_mng, p.cd_mng_grp, p.lb_mng_grp, p.cd_prf, p.lb_prf, sum(f.mt_ast_ref) as aum "
    "from int_fct_ast f join int_ptf p on p.cd_ptf = f.cd_ptf and p.dt_fct = f.dt_fct "
    "join int_cli k on k.cd_cli = f.cd_cli and k.dt_fct = f.dt_fct group by all",
    "aum_ytd": "select a.*, s.aum as aum_ytd_start, "
    "if(coalesce(s.aum, 0) = 0, 0, (a.aum - s.aum) / s.aum * 100) as aum_ytd_variation_pct, "
    "a.aum - coalesce(s.aum, 0) as aum_ytd_variation_abs from aum a join year_start on y = year(a.dt_fct) "
    "left join aum s on s.cd_cli = a.cd_cli and s.cd_ptf = a.cd_ptf and s.dt_fct = d0",
    "exposure": "select f.dt_fct, f.cd_cli, k.lb_cli, k.cd_cli_cat, k.lb_cli_cat, k.cd_cty_dom, k.lb_cty_dom, k.cd_cty_nat, "
    "f.cd_ptf, p.lb_ptf, p.lb_ptf_alt, p.cd_mng, p.lb_mng, p.cd_mng_grp, p.lb_mng_grp, p.cd_mng_ext, p.lb_mng_ext, "
    "p.cd_agn, p.lb_agn, p.cd_ent, p.lb_ent, p.cd_buu, p.lb_buu, p.cd_prf, p.lb_prf, f.cd_ast, i.lb_ins as asset_name, "
    "i.cd_ins_grp as asset_class, i.lb_ins_grp as asset_class_name, f.cd_ccy, f.xrt_rate_pos as xrt_rate, f.mt_ast, "
    "f.mt_ast_ref, f.mt_ast_ref / nullif(sum(f.mt_ast_ref) over (partition by f.cd_cli, f.dt_fct), 0) as weight_pct "
    "from int_fct_ast f left join int_cli k on k.cd_cli = f.cd_cli and k.dt_fct = f.dt_fct "
    "left join int_ptf p on p.cd_ptf = f.cd_ptf and p.dt_fct = f.dt_fct left join int_ins i on i.cd_ins = f.cd_ins",
}

# How each name prefix is printed: dates as text, ids as bigint, numbers as double.
_PRINTED = (
    (r"dt_|performance_date", "cast({c} as varchar)"),
    (r"(ts_stg|updated_at|valid_from|valid_to|max_loaded_at)$", "strftime({c}, '%Y-%m-%d %H:%M:%S')"),
    (r"id_|vr_stg|nb_seq|.*_count$|n_|failures", "cast({c} as bigint)"),
    (r"mt_|qt_|rt_|pc_|xrt_rate|aum_|weight_pct|expected_|ecart|ratio|variation|age_hours", "cast({c} as double)"),
)


def _printed(column: str) -> str:
    name = column.rpartition(" as ")[2].rpartition(".")[2]
    value = column.rpartition(" as ")[0] or column
    for pattern, form in _PRINTED:
        if re.match(pattern, name):
            return f"{form.format(c=value)} as {name}"
    return f"{value} as {name}"


def _needs(sql: str) -> list[str]:
    """The CTEs a text refers to, dependencies first."""
    found: list[str] = []
    for name, body in _TABLES.items():
        if re.search(rf"(from|join|,) \(?{name}\b", sql):
            found += [n for n in _needs(body) if n not in found]
            found.append(name)
    return list(dict.fromkeys(found))


def _select(columns: str | list[str], rest: str) -> str:
    """A whole query: the CTEs it needs and a printable select list."""
    listed = columns if isinstance(columns, list) else [c.strip() for c in columns.split(",")]
    sql = f"select {', '.join(_printed(c) for c in listed)} {rest}"
    ctes = ", ".join(f"{name} as ({_TABLES[name]})" for name in _needs(sql))
    return f"with {ctes} {sql}" if ctes else sql


_VERSION = ["dt_cre", "dt_clo", "ts_stg", "updated_at", "valid_from", "valid_to"]


def _staged(table: RawTable, source: str) -> str:
    columns = [
        f"row_number() over (order by {', '.join(table.order)}) as {table.id_column}",
        "20011215 as vr_stg",
        f"{table.object_id} as id_obj_tec",
        f"'{table.source}' as cd_src",
        "'r20011215' as cd_pid",
        "cast(null as varchar) as lb_dsc",
        *(f"{value} as {name}" for name, value in table.extra_ids),
    ]
    if table.name in DIMENSIONS:
        columns.append(f"{table.key} as {table.key}_src")
    return _select([*columns, *table.columns], f"from {source}")


_AST = (
    "id_stg_fct_ast cd_fct_ast cd_pos cd_pos_typ cd_ptf cd_cli dt_fct cd_ccy cd_ins cd_ast lb_fct_ast qt_ast mt_ast mt_aci "
    "mt_pnl xrt_rate_pos xrt_rate_ptf mt_ast_ptf mt_aci_ptf mt_pnl_ptf mt_ast_ref mt_aci_ref mt_pnl_ref rt_prm rt_pam pc_twr"
)
_OPE = (
    "id_stg_fct_ope cd_fct_ope cd_ope nb_seq_ptc lb_fct_ope cd_fct_ope_ext cd_ope_typ cd_deb_crd yn_pro cd_pos cd_ptf cd_cli "
    "cd_ccy_ope cd_ccy_ptf cd_ast cd_ins dt_cta dt_exe dt_val qt_ope mt_ope mt_net xrt_rate_ope xrt_rate_ptf mt_ope_ptf "
    "mt_net_ptf mt_ope_ref mt_net_ref"
)
_MVT = (
    "id_stg_fct_mvt cd_fct_mvt cd_pos cd_fct_ope yn_ext dt_cta id_obj_mvt_cat cd_mvt_typ cd_ptf cd_cli cd_mvt_res cd_ast "
    "cd_ins cd_ccy_mvt cd_ccy_ptf mt_mvt xrt_rate_mvt xrt_rate_ptf mt_mvt_ptf mt_mvt_ref"
)
_PTF = ["id_stg_fct_ptf", "cd_fct_ptf", "cd_ptf", "cd_cli", "cd_ccy_ptf", "dt_fct", "pc_ptf", "xrt_rate"]
_PTF_AMOUNTS = [c for pair in portfolio_amounts() for c in pair]
_ATTRIBUTES = "mng mng_grp mng_ext agn ent buu".split()
_INT_CLI = (
    "dt_fct cd_cli lb_cli lb_cli_alt cd_cli_cat lb_cli_cat cd_ccy cd_cty_dom lb_cty_dom cd_cty_nat cd_mng_rel lb_mng_rel"
).split()
_INT_PTF = ["dt_fct", "cd_ptf", "lb_ptf", "lb_ptf_alt", "cd_cli"] + [
    f"{s}_{n}" for n in ("ccy", "prf", *_ATTRIBUTES) for s in ("cd", "lb")
]
_AUM = (
    "dt_fct, cd_cli, cd_ptf, lb_ptf, lb_cli, cd_cli_cat, lb_cli_cat, cd_cty_dom, lb_cty_dom, cd_ccy_cli, cd_mng, lb_mng, "
    "cd_prf, lb_prf, aum as aum_current, aum_ytd_start, aum_ytd_variation_pct, aum_ytd_variation_abs, "
    "date '2001-12-15' as performance_date"
)
_EXPOSURE = (
    "dt_fct, cd_cli, lb_cli, cd_cli_cat, lb_cli_cat, cd_cty_dom, lb_cty_dom, cd_cty_nat, cd_ptf, lb_ptf, lb_ptf_alt, cd_mng, "
    "lb_mng, cd_mng_grp, lb_mng_grp, cd_mng_ext, lb_mng_ext, cd_agn, lb_agn, cd_ent, lb_ent, cd_buu, lb_buu, cd_prf, lb_prf, "
    "cd_ast, asset_name, asset_class, asset_class_name, cd_ccy, xrt_rate, mt_ast, mt_ast_ref, weight_pct"
)
_POSITION = "f.mt_ast_ref, f.mt_pnl, f.mt_pnl_ref, f.rt_prm, f.rt_pam, f.pc_twr"


def _merged(table: str, early: str, order: str, id_column: str, refreshed: bool, columns: list[str]) -> str:
    """Early rows are staged by an earlier run and numbered first; the rest follows."""
    first = f"count(*) filter (where {early}) over ()"
    number = f"row_number() over (partition by {early} order by {order}) + if({early}, 0, {first}) as {id_column}"
    pid = "'r20011215'" if refreshed else f"if({early}, 'r20010615', 'r20011215')"
    return _select([number, f"{pid} as cd_pid", *columns], f"from {table}")


_STAGED = tuple(table.staged for table in ALL_TABLES.values())


def _violations(check: Check) -> str:
    """Number of violations of a check, counted on the table's own SQL."""
    source, column = f"t_{check.table}", check.column
    if check.kind == "unique":
        return f"select count(*) from (select {column} from {source} where {column} is not null group by 1 having count(*) > 1)"
    if check.kind == "not_null":
        broken = f"{column} is null"
    elif check.kind == "accepted_values":
        broken = f"{column} not in ({', '.join(map(repr, check.args))})"
    elif check.kind == "relationships":
        parent, key = check.args
        broken = f"{column} not in (select {key} from t_{parent} where {key} is not null)"
    elif check.kind == "between":
        low, high, strictly = check.args
        equal = "=" if strictly else ""
        bounds = [(low, f"{column} <{equal} {low}"), (high, f"{column} >{equal} {high}")]
        broken = " or ".join(rule for bound, rule in bounds if bound is not None)
    elif check.kind == "pair_ge":
        later, earlier = column.split(",")
        broken = f"{later} {'<' if check.args[0] else '<='} {earlier}"
    elif check.kind == "positive_amounts":
        broken = " or ".join(f"{c} < 0" for c in column.split(","))
    else:
        native, rate, pivot, tolerance = check.args
        broken = f"abs({column} - {native} * {rate}{f' / {pivot}' if pivot else ''}) > {tolerance}"
    return f"select count(*) from {source} where {broken}"


def _summary(tables: dict[str, str]) -> str:
    """Violations of every declared check; ``tables`` holds the SQL of each table."""
    parts = [
        f"select '{c.table}' as table_name, '{c.column}' as column_name, '{c.kind}' as \"check\", ({_violations(c)}) as failures"
        for c in declared_checks()
    ]
    loaded = {name: f"select *, timestamp '2001-12-15 23:00:00' as ts_stg from ({sql})" if name in _STAGED else sql
              for name, sql in tables.items()}
    stored = ", ".join(f"t_{name} as materialized ({sql})" for name, sql in loaded.items())
    return (
        f"with {stored} select table_name, column_name, \"check\", failures, "
        f"if(failures = 0, 'pass', 'fail') as status from ({' union all '.join(parts)})"
    )


def oracle_sql() -> dict[str, str]:
    history = ["updated_at", "valid_from", "valid_to"]
    sql = {
        "mart_aum_ytd": _select(_AUM, "from aum_ytd"),
        "mart_aum_ytd_year": _select(_AUM, "from aum_ytd where year(dt_fct) = 1998"),
        "mart_client_exposure": _select(_EXPOSURE, "from exposure"),
        "mart_portfolio_performance": _select(
            "f.dt_fct, f.cd_ptf, f.cd_cli, p.lb_ptf, p.cd_prf, p.lb_prf, f.cd_ast, i.lb_ins as asset_name, "
            "i.cd_ins_grp as asset_class, i.lb_ins_grp as asset_class_name, f.cd_ccy, f.qt_ast, f.mt_ast, " + _POSITION,
            "from int_fct_ast f join int_ptf p on p.cd_ptf = f.cd_ptf and p.dt_fct = f.dt_fct "
            "left join int_ins i on i.cd_ins = f.cd_ins",
        ),
        "mart_ptf_detail": _select(
            [
                "f.dt_fct", "f.cd_ptf", "p.lb_ptf", "p.lb_ptf_alt", "f.cd_cli", "f.cd_ccy_ptf", "p.lb_ccy",
                *(f"p.{s}_{n}" for n in ("prf", *_ATTRIBUTES) for s in ("cd", "lb")),
                "f.xrt_rate", "f.pc_ptf", *(f"f.{c}" for c in _PTF_AMOUNTS),
            ],
            "from int_fct_ptf f join int_ptf p on p.cd_ptf = f.cd_ptf and p.dt_fct = f.dt_fct",
        ),
        "mart_rm_performance": _select(
            ["dt_fct", "cd_mng", "lb_mng", "cd_mng_grp", "lb_mng_grp", "a as aum_current", "s as aum_ytd_start",
             "if(coalesce(s, 0) = 0, 0, (a - s) / s * 100) as aum_ytd_variation_pct",
             "a - coalesce(s, 0) as aum_ytd_variation_abs", "client_count", "portfolio_count", "category_count",
             "if(client_count > 0, a / client_count, 0) as aum_avg_per_client",
             "if(portfolio_count > 0, a / portfolio_count, 0) as aum_avg_per_portfolio",
             "date '2001-12-15' as performance_date"],
            "from (select dt_fct, cd_mng, lb_mng, cd_mng_grp, lb_mng_grp, sum(aum) as a, sum(aum_ytd_start) as s, "
            "count(distinct cd_cli) as client_count, count(distinct cd_ptf) as portfolio_count, "
            "count(distinct cd_cli_cat) as category_count from aum_ytd group by all)",
        ),
        "int_cli": _select([*_INT_CLI, *_VERSION], "from int_cli"),
        "int_ptf": _select([*_INT_PTF, *_VERSION], "from int_ptf"),
        "int_ins": _select("id_stg_ins, cd_ins, lb_ins, cd_ins_grp, lb_ins_grp", "from int_ins"),
        "int_fct_ast": _select(_AST.split(), "from int_fct_ast"),
        "int_fct_ope": _select(_OPE.split(), "from int_fct_ope"),
        "int_fct_mvt": _select(_MVT.split(), "from int_fct_mvt"),
        "int_fct_ptf": _select([*_PTF, *_PTF_AMOUNTS], "from int_fct_ptf"),
        "asof_fx_rate": _select(
            "f.cd_fct_mvt, f.cd_ccy_mvt, f.dt_cta, x.rt_val",
            "from fct_mvt f asof left join fct_xrt x on x.cd_ccy = f.cd_ccy_mvt and f.dt_cta >= x.dt_fct",
        ),
        "fx_missing_rate_default": _select(
            "cd_fct_ope, cd_ccy_ope, dt_cta, mt_ope, 1 as xrt_rate, mt_ope as mt_ope_ref",
            "from fct_ope f where not exists "
            "(select 1 from fct_xrt x where x.cd_ccy = f.cd_ccy_ope and x.dt_fct <= f.dt_cta)",
        ),
        "fx_direct": _select(
            "cd_fct_ast, cd_ccy, dt_fct, mt_ast, xrt_rate_pos as xrt_rate, mt_ast_ref", "from int_fct_ast"
        ),
        "fx_pivot": _select("cd_fct_ast, mt_ast, xrt_rate_pos, xrt_rate_ptf, mt_ast_ptf", "from int_fct_ast"),
        "scd2_clients": _select(["cd_cli", "cd_cli_cat", "lb_cli_alt", *history], "from cli_versions"),
        "scd2_portfolios": _select(["cd_ptf", "cd_prf", "lb_ptf_alt", *history], "from ptf_versions"),
        "scd2_from_changelog": _select(["cd_ptf", "cd_prf", "lb_ptf_alt", *history], "from ptf_versions"),
        "scd2_calendar": _select(
            "v.cd_ptf, c.dt_fct, v.cd_prf, v.lb_ptf_alt, v.valid_from", f"from cal c join ptf_versions v on {_in_force('v')}"
        ),
        "calendar_month_ends": _select(
            ["d as dt_fct", "cast(strftime(d, '%Y%m%d') as integer) as vr_dwh_cal", "1 as cd_cal",
             "count(cd_fct_ast) as n_positions"],
            "from (select last_day(cast(unnest(range(date_trunc('month', min(l_shipdate)), "
            "date_trunc('month', max(l_shipdate)), interval 1 month)) as date)) as d from lineitem "
            "union all select cast(max(l_shipdate) as date) from lineitem) left join fct_ast on dt_fct = d group by d",
        ),
        "technical_metadata": _select(
            ["cd_ptf", "timestamp '2001-12-15 23:00:00' as ts_stg", "20011215 as vr_stg", "1002 as id_obj_tec",
             "'st0_ptf' as cd_src", "'r20011215' as cd_pid", "cast(null as varchar) as lb_dsc", "1 as id_ptf_tec_typ",
             "cd_ptf as cd_ptf_src"],
            "from ptf",
        ),
        "dim_first_load": _select("id_stg_ins, cd_ins, 'r20011215' as cd_pid", "from n_ins"),
        "upsert_dim": _merged(
            "ptf", "dt_cre < date '1995-01-01'", "cd_ptf", "id_stg_ptf", True, ["cd_ptf", "20011215 as vr_stg", "lb_ptf"]
        ),
        "rerun_idempotent": _select(
            ["row_number() over (order by cd_ptf) as id_stg_ptf", "cd_ptf", "'r20011215' as cd_pid", "lb_ptf"], "from ptf"
        ),
        "insert_only_fact": _merged(
            "fct_ope", "dt_cta < date '1998-01-01'", "dt_cta, cd_fct_ope", "id_stg_fct_ope", False,
            ["cd_fct_ope", "dt_cta", "mt_ope"],
        ),
        "incremental_by_date": _select(
            "cd_fct_ope, dt_cta, mt_ope",
            "from fct_ope where dt_cta > (select max(dt_cta) from fct_ope where dt_cta < date '1998-01-01')",
        ),
        "source_freshness": _select(
            ["'events' as source", "m as max_loaded_at", "s / 3600.0 as age_hours",
             "if(s > 48 * 3600, 'error', if(s > 24 * 3600, 'warn', 'pass')) as status"],
            "from (select max(ts) as m, date_diff('second', date_trunc('second', max(ts)), timestamp '2024-02-01') as s "
            "from events)",
        ),
        "csv_round_trip": _select(list(ALL_TABLES["fct_ope"].columns), "from fct_ope"),
        "safe_divide": _select(
            ["cd_fct_ptf", "mt_inc_mtd", "mt_out_mtd", "mt_inc_mtd / nullif(mt_out_mtd, 0) as ratio"], "from fct_ptf"
        ),
        "ytd_variation": _select(
            ["cd_fct_ptf", "mt_net", "mt_inc_mtd",
             "if(coalesce(mt_inc_mtd, 0) = 0, 0, (mt_net - mt_inc_mtd) / mt_inc_mtd * 100) as variation_pct",
             "mt_net - coalesce(mt_inc_mtd, 0) as variation_abs"],
            "from fct_ptf",
        ),
        "ytd_start_lookup": _select(
            ["b.cd_ptf", "b.dt_fct", "b.mt_net", "s.mt_net as mt_net_ytd_start",
             "if(coalesce(s.mt_net, 0) = 0, 0, (b.mt_net - s.mt_net) / s.mt_net * 100) as mt_net_ytd_variation_pct",
             "b.mt_net - coalesce(s.mt_net, 0) as mt_net_ytd_variation_abs"],
            "from fct_ptf b join year_start on y = year(b.dt_fct) "
            "left join fct_ptf s on s.cd_ptf = b.cd_ptf and s.dt_fct = d0",
        ),
        "dq_not_null": _select("cd_fct_ope, lb_fct_ope", "from fct_ope where cd_fct_ope_ext is null"),
        "dq_unique": _select(
            "cd_pos, count(*) as n_records", "from fct_ast where cd_pos is not null group by cd_pos having count(*) > 1"
        ),
        "dq_accepted_values": _select("cd_fct_mvt, cd_mvt_typ", "from fct_mvt where cd_mvt_typ not in ('A', 'N')"),
        "dq_relationships": _select(
            "cd_fct_ast, cd_ccy", "from fct_ast where cd_ccy not in (select cd_ccy from fct_xrt)"
        ),
        "dq_between": _select("cd_fct_ast, rt_prm", "from fct_ast where not (rt_prm > 0 and rt_prm < 0.09)"),
        "dq_pair_ge": _select("cd_fct_ast, rt_pam, rt_prm", "from fct_ast where not (rt_pam >= rt_prm)"),
        "dq_fx_direct": _select(
            ["cd_fct_ast", "v as mt_ast_ref", "cast(e as decimal(24,6)) as expected_mt_ast_ref",
             "cast(abs(v - e) as decimal(24,6)) as ecart"],
            "from (select cd_fct_ast, if(xrt_rate_pos > 1, mt_ast, mt_ast_ref) as v, mt_ast * xrt_rate_pos as e "
            "from int_fct_ast) where abs(v - e) > 0.01",
        ),
        "dq_fx_pivot": _select(
            ["cd_fct_ast", "v as mt_ast_ptf", "e as expected_mt_ast_ptf", "abs(v - e) as ecart"],
            "from (select cd_fct_ast, if(xrt_rate_pos > 1, mt_ast, mt_ast_ptf) as v, "
            "mt_ast * xrt_rate_pos / xrt_rate_ptf as e from int_fct_ast) where abs(v - e) > 0.01",
        ),
        "dq_positive_amounts": _select(
            "cd_fct_mvt, mt_mvt, mt_mvt_ref", "from int_fct_mvt where mt_mvt < 0 or mt_mvt_ref < 0"
        ),
        "stg_fct_xrt": _staged(RATES, "fct_xrt"),
    }
    sql["insert_only_indexed"] = sql["insert_only_fact"]
    sql["asof_fx_rate_merged"] = sql["asof_fx_rate"]
    for name, table in DIMENSIONS.items():
        sql[f"stg_{name}"] = _staged(table, name)
    for name, table in FACTS.items():
        sql[f"stg_{name}"] = _staged(table, name)
    number = "cast(strftime(dt_fct, '%Y%m%d') as integer) as vr_dwh_cal"
    calendar = _select(["dt_fct", number, "1 as cd_cal"], "from cal")
    checked = sorted({c.table for c in declared_checks()})
    sql["dq_summary"] = _summary({name: calendar if name.endswith("set_cal") else sql[name] for name in checked})
    return sql
