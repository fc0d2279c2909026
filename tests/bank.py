"""A small bank: raw tables with our own values."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from vaultspan.sources.schemas import ALL_TABLES

D = date
_CODES = {
    "agn": [("A1", "Agence du Léman")],
    "ast": [("NOVO", "Novo", "pharma", None), ("CASH", "Cash", "money", "AAA")],
    "buu": [("B1", "Unit one")],
    "ccy": [("CHF", "Franc"), ("USD", "Dollar"), ("EUR", "Euro"), ("GBP", "Pound")],
    "cli_cat": [("PRIV", "Private"), ("INST", "Institution")],
    "cty": [("CH", "Suisse"), ("FR", "France")],
    "ent": [("E1", "Entity one")],
    "ins": [("NOVO", "Novo share", "EQ"), ("CASH", "Cash account", "MM")],
    "ins_grp": [("EQ", "Equities"), ("MM", "Money market")],
    "mng": [("M1", "Ana", "G1"), ("M2", "Bo", "G2")],
    "mng_ext": [("X1", "Outside")],
    "mng_grp": [("G1", "Team one"), ("G2", "Team two")],
    "ope_typ": [("BUY", "Buy", "Y", "N", "N")],
    "pos_typ": [("T", "Titres"), ("C", "Cash")],
    "prf": [("GRO", "Growth"), ("BAL", "Balanced")],
    "prs": [("Q1", "Zoé", "Y", D(1970, 5, 1), None, "F", "IND", "CH", "CH"), ("Q2", "Firm", *[None] * 5, "CH", None)],
    "cli": [
        ("C1", "Zoé", "ZOE", D(2020, 1, 1), None, "CH", "FR", "M1", "PRIV", "CHF"),
        ("C2", "Firm", None, D(2021, 1, 1), D(2023, 6, 1), "FR", None, "M2", "INST", "EUR"),
    ],
    "ptf": [
        ("P1", "One", None, D(2020, 1, 1), None, "C1", "CHF", "GRO", "M1", None, "A1", "E1", "B1"),
        ("P2", "Two", "Zwei", D(2020, 1, 1), None, "C1", "USD", "BAL", "M1", "X1", None, "E1", "B1"),
        ("P3", "Three", None, D(2021, 1, 1), None, "C2", "EUR", "GRO", "M2", None, "A1", "E1", "B1"),
    ],
}
_RATES = {
    "CHF": ("1", "1"), "USD": ("0.7315", "0.7402"), "EUR": ("0.9127", "0.9244"), "GBP": ("1.21", "1.18"),
}
MONTHS = (D(2022, 1, 31), D(2022, 2, 28))


def rates() -> list[tuple]:
    return [
        (f"{ccy}_{day:%Y%m%d}", ccy, day, Decimal(1), Decimal(values[i]))
        for ccy, values in _RATES.items()
        for i, day in enumerate(MONTHS)
    ]


def position(portfolio: str, day: date, currency: str, instrument: str, amount: str) -> tuple:
    zero, name = Decimal(0), f"{portfolio}-{instrument}"
    return (
        f"AST-{name}-{day:%Y%m%d}", f"POS-{name}", "T", portfolio, day, currency, instrument, instrument, None,
        Decimal(10), Decimal(amount), zero, Decimal("0.5"), Decimal("0.25"), Decimal("1.5"), zero,
    )


POSITIONS = [
    position("P1", MONTHS[0], "USD", "NOVO", "31500"),
    position("P2", MONTHS[0], "USD", "NOVO", "12400"),
    position("P3", MONTHS[0], "CHF", "CASH", "7300"),
    position("P1", MONTHS[1], "USD", "NOVO", "32750"),
    position("P3", MONTHS[1], "CHF", "CASH", "6900"),
    position("P3", MONTHS[1], "CHF", "NOVO", "1250"),
]


def operation(number: int, portfolio: str, day: date, currency: str, amount: str) -> tuple:
    return (
        f"OPE-{number}", f"TX-{number}", Decimal(1), None, None, "BUY", "D", "N", f"POS-{portfolio}-NOVO", portfolio,
        currency, "NOVO", "NOVO", day, day, day, Decimal(5), Decimal(amount), Decimal(amount) + 25,
    )


OPERATIONS = [
    operation(1, "P1", D(2022, 1, 14), "USD", "15300"),
    operation(2, "P1", D(2022, 2, 22), "USD", "2480"),
    operation(3, "P3", D(2022, 2, 22), "CHF", "640"),
]
MOVEMENTS = [
    ("MVT-1", "POS-P1-NOVO", "OPE-1", "N", D(2022, 1, 14), Decimal(1), "BUY", "P1", "SEC", "NOVO", "NOVO", "USD", Decimal(85)),
    ("MVT-2", "POS-P1-CASH", "OPE-1", "N", D(2022, 1, 17), Decimal(2), "BUY", "P1", "CSH", "CASH", "CASH", "USD", Decimal(-15325)),
    ("MVT-3", "POS-P1-NOVO", "OPE-2", "N", D(2022, 2, 22), Decimal(1), "BUY", "P1", "SEC", "NOVO", "NOVO", "USD", Decimal(12)),
]
BALANCES = [
    (f"FCT-{p}-{day:%Y%m%d}", p, day, Decimal("0.3"), *[Decimal(140 * (i + 1)) for i in range(23)])
    for p in ("P1", "P2", "P3")
    for day in MONTHS
]
FACTS = {"fct_ast": POSITIONS, "fct_ope": OPERATIONS, "fct_mvt": MOVEMENTS, "fct_ptf": BALANCES, "fct_xrt": rates()}
ROWS = {**_CODES, **FACTS}


def raw(spark: SparkSession, name: str, rows: list[tuple] | None = None) -> DataFrame:
    return spark.createDataFrame(ROWS[name] if rows is None else rows, ALL_TABLES[name].schema)
