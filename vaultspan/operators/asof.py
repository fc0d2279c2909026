"""As-of lookup: the latest rate on or before a date."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultspan.operators.ranges import range_bounds, range_of


@dataclass(frozen=True)
class AsOfIndex:
    """Validity intervals of the right side, one row per (key, month touched).

    ``last_month`` is a scalar subquery: the last month that has any value.
    """

    intervals: DataFrame
    last_month: Column


def build_asof_index(rates: DataFrame, key: str, day: str, value: str) -> AsOfIndex:
    """Turn dated values into intervals [day, next day of the key) cut by month.

    Each key's values partition a window, which holds at most one row per day.
    Open intervals run up to the last month that has any value; later lookups
    are clamped to that month. Equal (key, day) rows share their interval, so a
    duplicate rate yields a duplicate match. Nothing runs while it is built.
    """
    last_month = rates.agg(F.trunc(F.max(day), "MM")).scalar()
    later = Window.partitionBy("_key").orderBy("_number").rangeBetween(1, Window.unboundedFollowing)
    closed = (
        rates.select(F.col(key).alias("_key"), F.col(day).alias("_from"), F.col(value).alias("_value"))
        .filter(F.col("_key").isNotNull() & F.col("_from").isNotNull())
        .withColumn("_number", F.unix_date("_from"))
        .withColumn("_to", F.min("_from").over(later))
        .drop("_number")
    )
    final = F.coalesce(F.date_sub("_to", 1), last_month)
    touched = F.sequence(F.trunc("_from", "MM"), F.trunc(final, "MM"), F.expr("interval 1 month"))
    return AsOfIndex(closed.withColumn("_month", F.explode(touched)), last_month)


def asof_lookup(facts: DataFrame, index: AsOfIndex, key: str | Column, day: str | Column, into: str) -> DataFrame:
    """Left join the value in force on ``day``; ``into`` is NULL when there is none yet.

    The join is an equality on (key, month) with at most a month of candidates
    per row, so it hashes instead of walking a key's whole history. Facts are
    read once. Catalyst broadcasts the index when its size allows; beyond that
    a month of a main currency is a skewed partition, which AQE splits.
    """
    key_col = F.col(key) if isinstance(key, str) else key
    day_col = F.col(day) if isinstance(day, str) else day
    probe = facts.withColumns(
        {
            "_probe_key": key_col,
            "_probe_day": day_col,
            "_probe_month": F.least(F.trunc(day_col, "MM"), index.last_month),
        }
    )
    right = index.intervals.alias("_right")
    hit = (
        (F.col("_probe_key") == F.col("_right._key"))
        & (F.col("_probe_month") == F.col("_right._month"))
        & (F.col("_probe_day") >= F.col("_right._from"))
        & (F.col("_right._to").isNull() | (F.col("_probe_day") < F.col("_right._to")))
    )
    return probe.join(right, hit, "left").select(*(F.col(c) for c in facts.columns), F.col("_right._value").alias(into))


def asof_lookup_by_pairs(facts: DataFrame, index: AsOfIndex, key: str, day: str, into: str) -> DataFrame:
    """The same result by way of the distinct (key, day) pairs of the facts.

    For an index too large to broadcast: the distinct pairs are few when the
    key is, say, a currency. They are aggregated before they are shuffled,
    resolved once, and joined back on equality. Reads the facts twice.
    """
    pairs = facts.select(F.col(key).alias("_pair_key"), F.col(day).alias("_pair_day")).distinct()
    resolved = asof_lookup(pairs, index, "_pair_key", "_pair_day", "_pair_value")
    joined = facts.join(
        resolved,
        (F.col(key) == F.col("_pair_key")) & (F.col(day) == F.col("_pair_day")),
        "left",
    )
    return joined.select(*(F.col(c) for c in facts.columns), F.col("_pair_value").alias(into))


def _point(key: str, day: str | Column, last: Column) -> Column:
    day = F.col(day) if isinstance(day, str) else day
    return F.struct(F.col(key).alias("key"), day.alias("day"), last.cast("long").alias("last"))


def merge_bounds(facts: DataFrame, rates: DataFrame, key: str, day: str, rate_key: str, rate_day: str, ranges: int) -> Column:
    """Bounds of equal ranges of both sides by (key, day, hash of the row): a day that holds many rows is cut too."""
    points = facts.select(_point(key, day, F.xxhash64(*facts.columns)).alias("point"))
    return range_bounds(points.union(rates.select(_point(rate_key, rate_day, F.xxhash64(*rates.columns)))), ranges)


def asof_merge(
    facts: DataFrame, rates: DataFrame, key: str, day: str, rate_key: str, rate_day: str, value: str, into: str
) -> DataFrame:
    """The same result by merging both sides, where no executor could hold the rates.

    Facts and rates are laid on one line ordered by (key, day) and cut into equal ranges, so a key
    that holds a third of all rows lies in a third of the ranges. Within a range the last value is
    carried along. What a range starts with, the key's last value in the ranges before, is laid on the line
    as a row of its own: one per range and at most one key each, as only a key that goes on across a bound
    needs it. Both sides are shuffled once, nothing is joined or broadcast.
    """
    ranges = 4 * int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = merge_bounds(facts, rates, key, day, rate_key, rate_day, ranges)

    def placed(rows: DataFrame, point: Column, into: str = "_range") -> DataFrame:
        return rows.withColumn("_bounds", bounds).withColumn(into, range_of(point, F.col("_bounds"))).drop("_bounds")

    line = placed(facts, _point(key, day, F.xxhash64(*facts.columns))).select(
        F.col(key).alias("_key"), F.col(day).alias("_day"), "_range", F.struct(*facts.columns).alias("_fact")
    )
    known = rates.select(F.col(rate_key).alias("_key"), F.col(rate_day).alias("_day"), F.struct(F.col(value).alias("value")).alias("_value"))
    # equal (key, day) rows stay together, each of them is a match; they come before the facts of their day
    dated = known.where(F.col("_key").isNotNull() & F.col("_day").isNotNull()).groupBy("_key", "_day").agg(F.collect_list("_value").alias("_values"))
    dated = placed(dated, _point("_key", "_day", F.lit(-(1 << 63))))
    newest = dated.groupBy("_key", "_range").agg(F.max_by("_values", "_day").alias("_values"))
    last_day = F.lit("9999-12-31").cast(dated.schema["_day"].dataType)
    newest = placed(newest, _point("_key", last_day, F.lit((1 << 63) - 1)), into="_end")
    next_own = F.lead("_range").over(Window.partitionBy("_key").orderBy("_range"))
    spans = newest.withColumn("_until", F.coalesce(next_own, F.col("_end"))).where("_range < _until")
    starts = spans.select("_key", "_values", F.explode(F.sequence(F.col("_range") + 1, F.col("_until"))).alias("_range"))

    both = line.unionByName(dated, allowMissingColumns=True).unionByName(starts, allowMissingColumns=True)
    along = Window.partitionBy("_range", "_key").orderBy(F.asc_nulls_first("_day"), F.col("_fact").isNotNull())
    met = both.withColumn("_values", F.last("_values", ignorenulls=True).over(along)).where(F.col("_fact").isNotNull())
    matched = met.select("_fact", F.explode_outer("_values").alias("_match"))
    return matched.select(*(F.col(f"_fact.`{c}`").alias(c) for c in facts.columns), F.col("_match.value").alias(into))
