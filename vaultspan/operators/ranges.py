"""Ranges of a total order that follow from the data alone, so every job cuts them alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SAMPLED_PER_RANGE = 16


def range_bounds(keys: DataFrame, ranges: int) -> Column:
    """Sorted bounds that cut the keys into about equal ranges, as one value: a scalar subquery, run with the query.

    ``keys`` has one column. The keys with the smallest hashes are a uniform sample of
    the distinct keys, of a fixed size; each task keeps only so many. Key columns that
    are unique together are cut evenly, whatever share a value of the first of them holds.
    Use it in ``select`` or ``withColumn``, not inside a lambda.
    """
    key = F.col(keys.columns[0])
    sample = keys.select(key.alias("_key")).orderBy(F.xxhash64("_key"), "_key").limit(ranges * _SAMPLED_PER_RANGE)
    every = lambda _, i: (i > 0) & (i % _SAMPLED_PER_RANGE == 0)
    return sample.agg(F.array_sort(F.collect_list("_key")).alias("drawn")).select(F.filter("drawn", every).alias("bounds")).scalar()


def range_of(value: Column, bounds: Column) -> Column:
    """How many of the sorted bounds are not above the value, by binary search."""

    def search(at: Column) -> Column:
        def halve(state: Column, _: Column) -> Column:
            middle = F.shiftright(state["low"] + state["high"], 1)
            below = F.get(at["bounds"], middle) <= at["value"]
            narrowed = F.struct(
                F.when(below, middle + 1).otherwise(state["low"]).alias("low"),
                F.when(below, state["high"]).otherwise(middle).alias("high"),
            )
            return F.when(state["low"] < state["high"], narrowed).otherwise(state)

        size = F.size(at["bounds"])
        halvings = F.sequence(F.lit(0), F.ceil(F.log2((size + 1).cast("double"))).cast("int"))
        return F.aggregate(halvings, F.struct(F.lit(0).alias("low"), size.alias("high")), halve, lambda s: s["low"])

    found = F.element_at(F.transform(F.array(F.struct(value.alias("value"), bounds.alias("bounds"))), search), 1)
    return F.coalesce(found, F.lit(0))  # never null; said so that no join looks again
