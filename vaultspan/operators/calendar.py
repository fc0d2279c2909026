"""The reporting calendar: ends of completed months, and the run day."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspan.functions import date_number


@dataclass(frozen=True)
class Calendar:
    """Calendar dates with their first and last one, which bound the size of any expansion."""

    days: DataFrame
    first: date | None
    last: date | None

    @classmethod
    def of(cls, days: DataFrame) -> Calendar:
        span = days.agg(F.min("dt_fct").alias("first"), F.max("dt_fct").alias("last")).first()
        return cls(days, span["first"], span["last"])


def month_end_calendar(spark: SparkSession, start: date, as_of: date) -> DataFrame:
    """Last day of every month from ``start`` up to the one before ``as_of``, then ``as_of``."""
    first, current = F.trunc(F.lit(start), "MM"), F.trunc(F.lit(as_of), "MM")
    months = F.when(first < current, F.sequence(first, F.add_months(current, -1), F.expr("interval 1 month")))
    ends = F.transform(F.coalesce(months, F.array().cast("array<date>")), F.last_day)
    days = F.explode(F.concat(ends, F.array(F.lit(as_of))))
    return spark.range(1).select(days.alias("dt_fct")).select(
        "dt_fct",
        date_number(F.col("dt_fct")).alias("vr_dwh_cal"),
        F.lit(1).alias("cd_cal"),
    )


def year_starts(calendar: Calendar) -> DataFrame:
    """First calendar date of each year."""
    return calendar.days.groupBy(F.year("dt_fct").alias("year")).agg(F.min("dt_fct").alias("year_start"))
