from __future__ import annotations

from decimal import Decimal

import pytest

from vaultspan.functions import fx_direct, fx_pivot, rate_or_one, safe_divide, ytd_variation_abs, ytd_variation_pct


def one(spark, row, schema, *columns):
    return spark.createDataFrame([row], schema).select(*columns).first()


@pytest.mark.parametrize(("num", "den", "want"), [(6.0, 4.0, 1.5), (1.0, 0.0, None), (1.0, None, None), (None, 2.0, None)])
def test_safe_divide(spark, num, den, want):
    assert one(spark, (num, den), "n double, d double", safe_divide("n", "d"))[0] == want


@pytest.mark.parametrize(
    ("now", "start", "pct", "gain"),
    [("110", "100", 10.0, "10"), ("100", "100", 0.0, "0"), ("50", None, 0.0, "50"), ("50", "0", 0.0, "50")],
)
def test_variation(spark, now, start, pct, gain):
    row = (Decimal(now), Decimal(start) if start else None)
    got = one(
        spark, row, "a decimal(19,4), s decimal(19,4)", ytd_variation_pct("a", "s"), ytd_variation_abs("a", "s")
    )
    assert got[0] == pct and got[1] == Decimal(gain)


@pytest.mark.parametrize(
    ("amount", "rate", "pivot", "ref", "ptf"),
    [
        ("31500", "0.7315", "1", "23042.2500", "23042.2500"),
        ("12400", "0.7315", "0.7315", "9070.6000", "12400.0000"),
        ("7300", "1", "0.9127", "7300.0000", "7998.2470"),
        ("32750", "0.7402", "1", "24241.5500", "24241.5500"),
        ("6900", "1", "0.9244", "6900.0000", "7464.3012"),
        ("-6900", "1", "0.9244", "-6900.0000", "-7464.3012"),
        ("15300", None, None, "15300.0000", "15300.0000"),
        ("999999999999999.9999", "1.5", "1.5", None, None),
    ],
)
def test_conversions(spark, amount, rate, pivot, ref, ptf):
    row = (Decimal(amount), rate and Decimal(rate), pivot and Decimal(pivot))
    schema = "a decimal(19,4), r decimal(26,11), p decimal(26,11)"
    rate, pivot = rate_or_one("r"), rate_or_one("p")
    if ref is None:  # the product does not fit: an error, never a wrong amount
        with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
            one(spark, row, schema, fx_direct("a", rate))
        return
    assert one(spark, row, schema, fx_direct("a", rate), fx_pivot("a", rate, pivot)) == (Decimal(ref), Decimal(ptf))


def test_product_keeps_every_digit(spark):
    row = (Decimal("0.0500"), Decimal("0.00100000001"))
    got = one(spark, row, "a decimal(19,4), r decimal(26,11)", fx_direct("a", "r"))
    assert got[0] == Decimal("0.0001")  # 0.0000500000005 rounds up only when all digits are kept


def test_rates_up_to_the_column_type(spark):
    row = (Decimal("12.3400"), Decimal("12345678.50000000001"))
    got = one(spark, row, "a decimal(19,4), r decimal(26,11)", fx_direct("a", "r"), fx_pivot("a", "r", "r"))
    assert got == (Decimal("152345672.6900"), Decimal("12.3400"))
    row = (Decimal("0.0001"), Decimal("999999999999999.99999999999"))
    assert one(spark, row, "a decimal(19,4), r decimal(26,11)", fx_direct("a", "r"))[0] == Decimal("100000000000.0000")
