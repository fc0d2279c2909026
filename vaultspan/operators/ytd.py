"""Year-to-date variation against the first calendar date of the year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultspan.functions import ytd_variation_abs, ytd_variation_pct
from vaultspan.operators.calendar import Calendar, year_starts


def with_ytd_start(
    daily: DataFrame,
    keys: Sequence[str],
    amount: str,
    calendar: Calendar,
    day: str = "dt_fct",
) -> DataFrame:
    """Add ``<amount>_ytd_start``, ``_ytd_variation_pct`` and ``_ytd_variation_abs``.

    ``daily`` holds one row per (keys, day), so a window over (keys, year) sees
    at most a year of dates and replaces the self-join by one shuffle. A NULL
    key matches nothing.
    """
    start, pct, gain = (f"{amount}_ytd_{suffix}" for suffix in ("start", "variation_pct", "variation_abs"))
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    year = Window.partitionBy(*keys, "_year")
    at_start = F.when(complete & (F.col(day) == F.col("year_start")), F.col(amount))
    starts = year_starts(calendar).withColumnRenamed("year", "_year")
    return (
        daily.withColumn("_year", F.year(day))
        .join(F.broadcast(starts), "_year", "left")  # one row per calendar year
        .withColumn(start, F.max(at_start).over(year))
        .withColumns({pct: ytd_variation_pct(amount, start), gain: ytd_variation_abs(amount, start)})
        .drop("_year", "year_start")
    )
