from __future__ import annotations

from datetime import date, datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from vaultspan.operators.calendar import Calendar, month_end_calendar
from vaultspan.operators.scd2 import Versions, at_date, history_from_changelog, on_calendar, snapshot
from vaultspan.operators.ytd import with_ytd_start
from vaultspan.plans import registry

START = datetime(2024, 1, 1)


def calendar(spark, first=date(2024, 1, 1), last=date(2024, 3, 15)):
    return Calendar.of(month_end_calendar(spark, first, last))


def test_calendar(spark):
    rows = month_end_calendar(spark, date(2024, 1, 1), date(2024, 3, 15)).orderBy("dt_fct").collect()
    assert [tuple(r) for r in rows] == [
        (date(2024, 1, 31), 20240131, 1), (date(2024, 2, 29), 20240229, 1), (date(2024, 3, 15), 20240315, 1),
    ]
    same_month = month_end_calendar(spark, date(2024, 3, 1), date(2024, 3, 15)).collect()
    assert [r["dt_fct"] for r in same_month] == [date(2024, 3, 15)]


def versions(spark, rows):
    return spark.createDataFrame(rows, "k string, v string, dt_cre date, valid_from timestamp, valid_to timestamp")


def covered(spark, rows):
    got = on_calendar(versions(spark, rows), calendar(spark), "dt_cre").collect()
    return sorted((r["dt_fct"].isoformat()[5:], r["v"]) for r in got)


def test_versions_on_the_calendar(spark):
    old, change, end = date(2020, 1, 1), datetime(2024, 2, 10, 9), datetime(2024, 2, 29, 9)
    assert covered(spark, [("a", "v1", old, START, None)]) == [("01-31", "v1"), ("02-29", "v1"), ("03-15", "v1")]
    assert covered(spark, [("a", "v1", old, START, change), ("a", "v2", old, change, None)]) == [
        ("01-31", "v1"), ("02-29", "v2"), ("03-15", "v2"),
    ]
    assert covered(spark, [("a", "v1", old, START, end), ("a", "v2", old, end, None)])[1] == ("02-29", "v2")
    same_day = [("a", "v1", old, START, change), ("a", "v2", old, change, change + timedelta(hours=3)),
                ("a", "v3", old, change + timedelta(hours=3), None)]
    assert {v for _, v in covered(spark, same_day)} == {"v1", "v3"}
    assert covered(spark, [("a", "v1", date(2024, 2, 15), START, None)])[0] == ("02-29", "v1")
    assert covered(spark, [("a", "v1", old, datetime(2024, 3, 15, 9), None)]) == [("03-15", "v1")]
    assert covered(spark, [("a", "v1", None, START, None)]) == []


def test_attributes_at_a_date(spark):
    old, change, again = date(2020, 1, 1), datetime(2024, 2, 10, 9), datetime(2024, 2, 10, 12)
    rows = [("a", "v1", old, START, change), ("a", "v2", old, change, again), ("a", "v3", old, again, None),
            ("b", "w1", date(2024, 2, 15), START, None)]
    days = [date(2024, 1, 31), date(2024, 2, 10), date(2024, 2, 29), date(2024, 3, 15), date(2025, 1, 1), None]
    facts = spark.createDataFrame([(k, d, i) for i, d in enumerate(days) for k in ("a", "b", "c", None)],
                                  "k string, dt_fct date, n int")
    table = on_calendar(versions(spark, rows), calendar(spark), "dt_cre")
    found = {(r["k"], r["dt_fct"]): r["v"] for r in table.collect()}
    assert len(found) == 5
    for how in ("inner", "left"):
        got = at_date(facts, table, "k", ["v"], how)
        assert got.columns == ["k", "dt_fct", "n", "v"]
        want = [(r["k"], r["dt_fct"], r["n"], found.get((r["k"], r["dt_fct"]))) for r in facts.collect()]
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(w) for w in want if how == "left" or w[3])


def test_empty_calendar(spark):
    nothing = Calendar.of(month_end_calendar(spark, date(2024, 1, 1), date(2024, 3, 1)).limit(0))
    assert on_calendar(versions(spark, [("a", "v", date(2020, 1, 1), START, None)]), nothing, "dt_cre").count() == 0


def batch(spark, rows):
    return spark.createDataFrame(rows, "k string, v string, ts timestamp")


def plain(df):
    return sorted((r["k"], r["v"], r["valid_from"], r["valid_to"]) for r in df.collect())


def test_snapshot_opens_closes_and_keeps(spark):
    later, last = START + timedelta(days=1), START + timedelta(days=2)
    one = snapshot(None, batch(spark, [("a", "1", START), ("b", "1", START)]), "k", "ts")
    two = snapshot(one, batch(spark, [("a", "2", later), ("c", "1", later)]), "k", "ts")
    assert sorted(map(str, plain(two))) == sorted(map(str, [
        ("a", "1", START, later), ("a", "2", later, None), ("b", "1", START, None), ("c", "1", later, None),
    ]))
    same = snapshot(two, batch(spark, [("a", "changed late", later)]), "k", "ts")
    assert sorted(map(str, plain(same))) == sorted(map(str, plain(two)))
    three = snapshot(two, batch(spark, [("a", "3", last)]), "k", "ts")
    assert len(plain(three)) == 5 and three.select("scd_id").distinct().count() == 5


change = st.tuples(st.sampled_from("abc"), st.integers(0, 90))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(change, min_size=1, max_size=14, unique=True))
def test_changelog_equals_snapshots_and_never_overlaps(spark, changes):
    stamps = sorted({h for _, h in changes})
    rows = [(k, str(h), START + timedelta(hours=7 * h)) for k, h in changes]
    whole = plain(history_from_changelog(batch(spark, rows), "k", "ts"))
    by_key = {}
    for k, _, begin, end in sorted(whole, key=lambda r: (r[0], r[2])):
        for other_begin, other_end in by_key.get(k, []):
            assert other_end is not None and other_end <= begin
        by_key.setdefault(k, []).append((begin, end))
    history = None
    for h in stamps[:4]:
        moment = START + timedelta(hours=7 * h)
        history = snapshot(history, batch(spark, [r for r in rows if r[2] == moment]), "k", "ts")
    limit = START + timedelta(hours=7 * stamps[:4][-1])
    early = [r for r in rows if r[2] <= limit]
    assert list(map(str, plain(history))) == list(map(str, plain(history_from_changelog(batch(spark, early), "k", "ts"))))


def test_ytd_start(spark):
    rows = [("a", date(2024, 1, 31), 100), ("a", date(2024, 2, 29), 110), ("b", date(2024, 2, 29), 50),
            (None, date(2024, 1, 31), 7), (None, date(2024, 2, 29), 9)]
    daily = spark.createDataFrame(rows, "k string, dt_fct date, aum int").selectExpr("k", "dt_fct", "cast(aum as decimal(19,4)) aum")
    got = {(r["k"], r["dt_fct"].month): (r[3], r[4], r[5]) for r in with_ytd_start(daily, ["k"], "aum", calendar(spark)).collect()}
    assert got["a", 1] == (100, 0.0, 0) and got["a", 2] == (100, 10.0, 10)
    assert got["b", 2] == (None, 0.0, 50) and got[None, 2] == (None, 0.0, 9)


def test_versions_met_without_their_dates(spark):
    """Versions that were not laid out give the rows of the table laid out, also twice, without a key, date or version."""
    old, change, again = date(2020, 1, 1), datetime(2024, 2, 10, 9), datetime(2024, 2, 10, 12)
    rows = [("a", "v1", old, START, change), ("a", "v2", old, change, again), ("a", "v3", old, again, None),
            ("b", "w1", date(2024, 2, 15), START, None), ("b", "w2", date(2024, 2, 15), START, None),
            ("d", "x", None, START, None), (None, "y", old, START, None)]
    days = [date(2024, 1, 31), date(2024, 2, 10), date(2024, 2, 29), date(2024, 3, 15), date(2025, 1, 1), None]
    facts = spark.createDataFrame([(k, d, i) for i, d in enumerate(days) for k in ("a", "b", "c", "d", None)],
                                  "k string, dt_fct date, n int")
    table, bare = on_calendar(versions(spark, rows), calendar(spark), "dt_cre"), Versions(versions(spark, rows), calendar(spark), "dt_cre")
    for how in ("inner", "left"):
        laid_out = at_date(facts, table, "k", ["v"], how)
        met = at_date(facts, bare, "k", ["v"], how)
        assert met.columns == laid_out.columns
        assert sorted(map(str, met.collect())) == sorted(map(str, laid_out.collect()))


def test_marts_shuffle_no_row_per_date(spark):
    """The dates of the calendar do not multiply the portfolios and clients below a mart's joins."""
    for name in ("mart_aum_ytd", "mart_client_exposure", "mart_portfolio_performance", "mart_ptf_detail", "mart_rm_performance"):
        plan = registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "valid_from" in plan and "explode(sequence(trunc(_begin" not in plan
