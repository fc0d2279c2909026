from __future__ import annotations

from datetime import date, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from vaultspan.operators.asof import asof_lookup, asof_lookup_by_pairs, asof_merge, build_asof_index, merge_bounds
from vaultspan.operators.ranges import range_of

DAY = date(2023, 11, 20)
FACTS = "id int, ccy string, day date"
RATES = "ccy string, dt date, rate int"


def brute(facts, rates):
    out = []
    for i, ccy, day in facts:
        known = [r for r in rates if r[0] == ccy and ccy is not None and day is not None and r[1] <= day]
        newest = max((r[1] for r in known), default=None)
        hits = [r[2] for r in known if r[1] == newest]
        out += [(i, rate) for rate in hits] or [(i, None)]
    return sorted(out, key=str)


def both(spark, facts, rates):
    left = spark.createDataFrame(facts, FACTS)
    index = build_asof_index(spark.createDataFrame(rates, RATES), "ccy", "dt", "rate")
    for lookup in (asof_lookup, asof_lookup_by_pairs):
        got = lookup(left, index, "ccy", "day", "found")
        assert got.columns == ["id", "ccy", "day", "found"]
        yield sorted(((r["id"], r["found"]) for r in got.collect()), key=str)
    merged = asof_merge(left, spark.createDataFrame(rates, RATES), "ccy", "day", "ccy", "dt", "rate", "found")
    assert merged.columns == ["id", "ccy", "day", "found"]
    yield sorted(((r["id"], r["found"]) for r in merged.collect()), key=str)


moment = st.integers(0, 400).map(lambda n: DAY + timedelta(days=n))
currency = st.sampled_from(["USD", "EUR", "JPY"])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.one_of(currency, st.none()), st.one_of(moment, st.none())), min_size=1, max_size=12),
    st.lists(st.tuples(currency, moment), max_size=10),
)
def test_asof_plans_equal_brute_force(spark, facts, rates):
    facts = [(i, *f) for i, f in enumerate(facts)]
    rates = [(*r, n) for n, r in enumerate(rates)]
    want = brute(facts, rates)
    assert all(got == want for got in both(spark, facts, rates))


def test_asof_boundaries(spark):
    rates = [("USD", date(2024, 1, 31), 1), ("USD", date(2024, 2, 29), 2), ("USD", date(2024, 2, 29), 3)]
    days = [date(2024, 1, 30), date(2024, 1, 31), date(2024, 2, 28), date(2024, 2, 29), date(2030, 1, 1)]
    facts = [(i, "USD", d) for i, d in enumerate(days)]
    for got in both(spark, facts, rates):
        assert got == sorted([(0, None), (1, 1), (2, 1), (3, 2), (3, 3), (4, 2), (4, 3)], key=str)


def test_large_index_is_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        rates = [("USD", date(2024, 1, 31), 1), ("EUR", date(2024, 1, 31), 2)]
        facts = [(1, "USD", date(2024, 6, 1)), (2, "EUR", date(2024, 1, 1)), (3, "EUR", date(2024, 1, 31))]
        for got in both(spark, facts, rates):
            assert got == brute(facts, rates)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_no_rates(spark):
    for got in both(spark, [(1, "USD", date(2024, 1, 1)), (2, None, None)], []):
        assert got == [(1, None), (2, None)]


def test_building_a_lookup_runs_no_job(spark):
    spark.sparkContext.setJobGroup("building", "")
    both_built = list(
        lookup(
            spark.createDataFrame([(1, "USD", DAY)], FACTS),
            build_asof_index(spark.createDataFrame([("USD", DAY, 1)], RATES), "ccy", "dt", "rate"), "ccy", "day", "found",
        )
        for lookup in (asof_lookup, asof_lookup_by_pairs)
    )
    assert both_built and not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("tests", "")


def test_a_hot_currency_is_merged_in_even_ranges(spark):
    """One currency holds two thirds of the facts, one of its days a sixth of them."""
    facts = [(i, "USD", DAY if i % 4 == 0 else DAY + timedelta(days=i % 90)) if i % 3 else (i, f"C{i % 40}", DAY) for i in range(12_000)]
    rates = [("USD", DAY + timedelta(days=7 * n), n) for n in range(12)] + [(f"C{n}", DAY - timedelta(days=n), n) for n in range(0, 40, 2)]
    left, right = spark.createDataFrame(facts, FACTS), spark.createDataFrame(rates, RATES)
    merged = asof_merge(left, right, "ccy", "day", "ccy", "dt", "rate", "found")
    assert sorted(((r["id"], r["found"]) for r in merged.collect()), key=str) == brute(facts, rates)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Join" not in plan
    bounds = merge_bounds(left, right, "ccy", "day", "ccy", "dt", 16)
    place = F.struct(F.col("ccy").alias("key"), F.col("day").alias("day"), F.xxhash64(*left.columns).alias("last"))
    ranged = left.withColumn("_bounds", bounds).groupBy(range_of(place, F.col("_bounds")).alias("r")).count()
    sizes = sorted(r["count"] for r in ranged.collect())
    assert len(sizes) >= 15 and sizes[-1] < 2.5 * sizes[len(sizes) // 2]
