"""Point-in-time tables kept by month: a run writes the months it changes, no others.

A month changes if the run closes or opens a version that is in force in it, if the calendar
gains a date in it, or if a label shown in it changes. Versions closed by a run end at the
time of that run, so what is in force from some month on is among the open versions and those that
runs since then have closed; earlier runs' versions are not read.

A table is a folder per run and month; a small list per run names the run that wrote each month.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspan.operators.calendar import Calendar
from vaultspan.sources.files import LoadedTable

MONTH = "_month"


def month_of(day: str | Column) -> Column:
    return F.date_format(day, "yyyy-MM")


class MonthlyTable:
    """One point-in-time table; runs are named by their attempts."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.rows = LoadedTable(spark, path)
        self._months = LoadedTable(spark, f"{path}_months")
        self._shape = LoadedTable(spark, f"{path}_shape")

    def months(self, attempt: str | None) -> dict[str, str]:
        """The attempt that wrote each month, as of an attempt. At most one entry per calendar month."""
        if attempt is None:
            return {}
        return {r["month"]: r["attempt"] for r in self._months.read([attempt]).collect()}

    def read(self, attempt: str) -> DataFrame:
        schema = self._shape.read([attempt]).schema
        parts = [(written, month) for month, written in sorted(self.months(attempt).items())]
        found = self.rows.read_parts(MONTH, parts, schema)
        return self.spark.createDataFrame([], schema) if found is None else found

    def write(self, attempt: str, before: str | None, rows: DataFrame, touched: Sequence[str] | None, by: Sequence[str]) -> DataFrame:
        """Replace the months ``touched`` (all, if None) of the table as ``before`` left it by ``rows``."""
        part = self.rows.write(attempt, rows.withColumn(MONTH, month_of("dt_fct")), by, split=MONTH)
        written = {r[0]: attempt for r in part.select(MONTH).distinct().collect()}
        kept = {} if touched is None else {m: a for m, a in self.months(before).items() if m not in set(touched)}
        listed = sorted((kept | written).items())
        self._months.write(attempt, self.spark.createDataFrame(listed, "month string, attempt string").coalesce(1))
        self._shape.write(attempt, self.spark.createDataFrame([], rows.schema).coalesce(1))
        return self.read(attempt)


def changed_codes(before: DataFrame, now: DataFrame, code: str, columns: Sequence[str]) -> DataFrame:
    """Codes that came, went or show other values in ``columns``."""
    old = before.select(F.col(code).alias("code"), F.struct(*columns).alias("old"))
    new = now.select(F.col(code).alias("_new"), F.struct(*columns).alias("new"))
    met = old.join(new, F.col("code") == F.col("_new"), "full_outer")
    return met.where(~F.col("old").eqNullSafe(F.col("new"))).select(F.coalesce("code", "_new").alias("code"))


def months_showing(table: DataFrame, codes: dict[str, DataFrame]) -> set[str]:
    """Months of the table with a row that shows one of the codes; keys name the table's columns."""
    months: set[str] = set()
    for column, changed in codes.items():
        if not changed.isEmpty():
            met = table.join(changed, F.col(column) == F.col("code"), "left_semi")
            months |= {r[0] for r in met.select(month_of("dt_fct")).distinct().collect()}
    return months


def touched_months(calendar: Calendar, earlier: DataFrame, since: date | None, shown: set[str]) -> list[str]:
    """Months of the calendar that a run changes.

    ``earlier`` is the calendar of the run before, ``since`` the first day on which a version that the run
    closed or opened is in force, ``shown`` the months with changed labels.
    """
    fresh = calendar.days.join(earlier.select("dt_fct"), "dt_fct", "left_anti").select(month_of("dt_fct")).distinct()
    months = {r[0] for r in fresh.collect()} | shown
    if since is not None:
        later = calendar.days.where(month_of("dt_fct") >= F.lit(f"{since:%Y-%m}"))
        months |= {r[0] for r in later.select(month_of("dt_fct")).distinct().collect()}
    return sorted(months)


def within(calendar: Calendar, months: Sequence[str]) -> Calendar:
    """The calendar's dates in some months."""
    return Calendar.of(calendar.days.where(month_of("dt_fct").isin(*months)) if months else calendar.days.limit(0))


def maintained(
    table: MonthlyTable,
    attempt: str,
    before: str | None,
    calendar: Calendar,
    touched: Sequence[str] | None,
    built: Callable[[Calendar], DataFrame],
    by: Sequence[str],
) -> DataFrame:
    """The table after a run: ``built`` gives its rows on the dates of a calendar, asked for the touched months alone."""
    part = calendar if touched is None else within(calendar, touched)
    if part.first is None:  # nothing touched, or a calendar without dates
        return table.write(attempt, before, built(calendar).limit(0), touched, by)
    return table.write(attempt, before, built(part), touched, by)
