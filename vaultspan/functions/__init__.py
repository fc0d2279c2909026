"""Column-level helpers."""

from vaultspan.functions.amounts import (
    exact_product,
    fx_direct,
    fx_pivot,
    rate_or_one,
    safe_divide,
    ytd_variation_abs,
    ytd_variation_pct,
)
from vaultspan.functions.technical import date_number, stamp, technical_columns

__all__ = [
    "date_number",
    "exact_product",
    "fx_direct",
    "fx_pivot",
    "rate_or_one",
    "safe_divide",
    "stamp",
    "technical_columns",
    "ytd_variation_abs",
    "ytd_variation_pct",
]
