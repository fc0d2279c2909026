"""Version history of a dimension (SCD2) and its expansion over a calendar."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultspan.operators.calendar import Calendar


def _version_id(key: Column, updated_at: Column) -> Column:
    return F.md5(F.concat_ws("|", key.cast("string"), updated_at.cast("string")))


def _opened(batch: DataFrame, key: str, updated_at: str) -> DataFrame:
    stamp = F.col(updated_at)
    return batch.withColumns(
        {
            "scd_id": _version_id(F.col(key), stamp),
            "updated_at": stamp,
            "valid_from": stamp,
            "valid_to": F.lit(None).cast("timestamp"),
        }
    )


def roll_open_versions(open_versions: DataFrame | None, batch: DataFrame, key: str, updated_at: str) -> DataFrame:
    """Compare the open versions with a batch (one row per key on both sides).

    Returns every version the run touches or keeps open. Rows with ``valid_to``
    set were closed by this run and belong to the closed history; the others
    are the next open versions. One full outer join on the key, each side read
    once. A key missing from the batch stays open.
    """
    fresh = _opened(batch, key, updated_at)
    if open_versions is None:
        return fresh
    columns = fresh.columns
    old = open_versions.select(F.struct(*columns).alias("old"), F.col(key).alias("_key"))
    new = fresh.select(F.struct(*columns).alias("new"), F.col(key).alias("_key"))
    pair = old.join(new, "_key", "full_outer")
    replaced = F.col("old.valid_from") < F.col("new.valid_from")
    closed = F.col("old").withField("valid_to", F.col("new.valid_from"))
    versions = (
        F.when(F.col("old").isNull(), F.array("new"))
        .when(F.coalesce(replaced, F.lit(False)), F.array(closed, F.col("new")))
        .otherwise(F.array("old"))
    )
    return pair.select(F.explode(versions).alias("version")).select("version.*")


def snapshot(existing: DataFrame | None, batch: DataFrame, key: str, updated_at: str) -> DataFrame:
    """The whole history after merging a batch into it (timestamp strategy)."""
    if existing is None:
        return roll_open_versions(None, batch, key, updated_at)
    closed = existing.filter(F.col("valid_to").isNotNull())
    rolled = roll_open_versions(existing.filter(F.col("valid_to").isNull()), batch, key, updated_at)
    return closed.unionByName(rolled)


def history_from_changelog(changes: DataFrame, key: str, updated_at: str) -> DataFrame:
    """All versions at once from a full change log.

    The next change is looked up within the key's day first and, for the last
    change of a day, among the key's later days. A key that holds most of the
    log is thus spread over its days instead of filling one window.
    """
    day = F.to_date(updated_at)
    within_day = Window.partitionBy(key, "_day").orderBy(updated_at)
    later_days = Window.partitionBy(key).orderBy("_day")
    dated = _opened(changes, key, updated_at).withColumn("_day", day)
    days = (
        dated.groupBy(key, "_day")
        .agg(F.min(updated_at).alias("_first"))
        .withColumn("_next_day", F.lead("_first").over(later_days))
        .drop("_first")
    )
    return (
        dated.withColumn("valid_to", F.lead(updated_at).over(within_day))
        .join(days, [key, "_day"])
        .withColumn("valid_to", F.coalesce("valid_to", "_next_day"))
        .drop("_day", "_next_day")
    )


def _in_force(history: DataFrame, calendar: Calendar, created: str) -> DataFrame:
    """The versions that touch the calendar, each with its window ``_begin`` .. ``_end`` inside it.

    A version covers [max(created, date(valid_from)), date(valid_to)).
    """
    first, last = F.lit(calendar.first).cast("date"), F.lit(calendar.last).cast("date")
    begin = F.greatest(F.to_date("valid_from"), F.col(created), first)
    end = F.least(F.coalesce(F.date_sub(F.to_date("valid_to"), 1), last), last)
    return history.withColumns({"_begin": begin, "_end": end}).filter(
        # greatest() skips NULLs, so a missing creation date is ruled out here
        F.col(created).isNotNull() & F.col("valid_from").isNotNull() & (F.col("_begin") <= F.col("_end"))
    )


def _by_month(history: DataFrame, calendar: Calendar, created: str) -> DataFrame:
    """Each version once per month it touches, with its window inside the calendar.

    The calendar's bounds keep the number of months finite for open versions.
    """
    in_force = _in_force(history, calendar, created)
    months = F.sequence(F.trunc("_begin", "MM"), F.trunc("_end", "MM"), F.expr("interval 1 month"))
    return in_force.withColumn("_month", F.explode(months))


def on_calendar(history: DataFrame, calendar: Calendar, created: str) -> DataFrame:
    """One row per calendar date on which a version is in force.

    Instead of pairing every version with every date, the months of a version
    meet the months of the calendar, so the work grows with the rows produced.
    The calendar has at most one row per day between two known dates, which
    bounds its broadcast.
    """
    dates = calendar.days.select("dt_fct", F.trunc("dt_fct", "MM").alias("_month"))
    return (
        _by_month(history, calendar, created)
        .join(F.broadcast(dates), "_month")
        .filter(F.col("dt_fct").between(F.col("_begin"), F.col("_end")))
        .drop("_month", "_begin", "_end")
    )


@dataclass(frozen=True)
class Versions:
    """A point-in-time table whose dates are not laid out: the versions and the calendar they are shown on.

    ``on_calendar`` of the three gives its rows. A calendar holds each date once.
    """

    rows: DataFrame
    calendar: Calendar
    created: str


def at_date(
    rows: DataFrame, dated: DataFrame | Versions, key: str, columns: Sequence[str | Column], how: str = "inner"
) -> DataFrame:
    """Join ``columns`` of a point-in-time table, one row per ``key`` and ``dt_fct``, to rows with both.

    A table laid out by ``on_calendar`` is met by one equi-join on both. ``Versions`` meet the rows on the key,
    and of a key's few versions those count that are in force on the row's date: a version travels once
    instead of once per date, and rows already dealt by the key stay where they are. A row without a key
    or a calendar date meets nothing.
    """
    if isinstance(dated, DataFrame):
        picked = dated.select(F.col(key).alias("_key"), F.col("dt_fct").alias("_day"), *columns)
        met = (F.col(key) == F.col("_key")) & (F.col("dt_fct") == F.col("_day"))
        return rows.join(picked, met, how).drop("_key", "_day")
    in_force = _in_force(dated.rows, dated.calendar, dated.created)
    picked = in_force.select(F.col(key).alias("_key"), "_begin", "_end", *columns)
    shown = dated.calendar.days.select(F.col("dt_fct").alias("_day")).distinct()
    # a row per calendar day between two known dates bounds the broadcast
    listed = rows.join(F.broadcast(shown), F.col("dt_fct") == F.col("_day"), how)
    met = (F.col(key) == F.col("_key")) & F.col("_day").between(F.col("_begin"), F.col("_end"))
    return listed.join(picked, met, how).drop("_key", "_day", "_begin", "_end")
