"""Data-quality checks: each returns the rows that break a rule."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vaultspan.functions import exact_product, stamp

TOLERANCE = 0.01
UNIQUE, RELATIONSHIPS = "unique", "relationships"


# Row rules: a condition that is true on a violating row.


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def not_accepted(column: str, values: Sequence[str]) -> Column:
    """A value outside the closed list; NULL passes."""
    return ~F.col(column).isin(list(values))


def out_of_range(column: str, low: float | None = None, high: float | None = None, strictly: bool = False) -> Column:
    """Below ``low`` or above ``high``; ``strictly`` also rejects the bounds. NULL passes."""
    value = F.col(column)
    broken = F.lit(False)
    if low is not None:
        broken = broken | (value <= low if strictly else value < low)
    if high is not None:
        broken = broken | (value >= high if strictly else value > high)
    return broken


def not_after(later: str, earlier: str, or_equal: bool = False) -> Column:
    """``later`` does not exceed ``earlier``; ``or_equal`` admits equality. NULL passes."""
    return F.col(later) < F.col(earlier) if or_equal else F.col(later) <= F.col(earlier)


def _expected(native: str, rate: str, pivot: str | None) -> Column:
    expected = exact_product(native, rate)
    return expected if pivot is None else expected.cast("double") / F.col(pivot).cast("double")


def misconverted(
    converted: str, native: str, rate: str, pivot: str | None = None, tolerance: float = TOLERANCE
) -> Column:
    """A converted amount that is off by more than the tolerance."""
    return F.abs(F.col(converted) - _expected(native, rate, pivot)) > tolerance


def is_negative(*columns: str) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c) < 0 for c in columns])


# Violating rows.


def missing_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_missing(column))


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Values met more than once, with their number of rows; NULLs do not count."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def unaccepted_rows(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.filter(not_accepted(column, values))


def unknown_values(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent and their number of rows.

    The child is counted per value before it is shuffled, so a value that
    dominates the child travels as one row per task.
    """
    values = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    parents = parent.select(F.col(parent_column).alias(column))
    return values.join(parents, column, "left_anti")


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose value has no parent; NULL passes."""
    return child.join(unknown_values(child, column, parent, parent_column).select(column), column, "left_semi")


def out_of_range_rows(
    df: DataFrame, column: str, low: float | None = None, high: float | None = None, strictly: bool = False
) -> DataFrame:
    return df.filter(out_of_range(column, low, high, strictly))


def unordered_rows(df: DataFrame, later: str, earlier: str, or_equal: bool = False) -> DataFrame:
    return df.filter(not_after(later, earlier, or_equal))


def misconverted_rows(
    df: DataFrame, converted: str, native: str, rate: str, pivot: str | None = None, tolerance: float = TOLERANCE
) -> DataFrame:
    """Rows off by more than the tolerance, with the expected amount and the gap."""
    expected = _expected(native, rate, pivot)
    return (
        df.withColumn(f"expected_{converted}", expected)
        .withColumn("ecart", F.abs(F.col(converted) - expected))
        .filter(F.col("ecart") > tolerance)
    )


def negative_rows(df: DataFrame, *columns: str) -> DataFrame:
    return df.filter(is_negative(*columns))


# A declared check and the run of many of them.


@dataclass(frozen=True)
class Check:
    """One declared check. Exactly one of ``rule`` and ``count`` is set.

    ``rule`` builds a row condition; ``count`` builds a one-row frame with the
    number of violations from the table and a loader of other tables. ``args``
    are the declared arguments, for reports and for stating the check elsewhere.
    """

    table: str
    column: str
    kind: str
    rule: Callable[[], Column] | None = None
    count: Callable[[DataFrame, Callable[[str], DataFrame]], DataFrame] | None = None
    args: tuple = ()

    @property
    def name(self) -> str:
        """Tells declared checks apart, also those of another process."""
        return f"{self.table} {self.column} {self.kind} {self.args!r}"


def required(table: str, column: str) -> Check:
    return Check(table, column, "not_null", rule=lambda: is_missing(column))


def unique(table: str, column: str) -> Check:
    return Check(table, column, UNIQUE, count=lambda df, _: _tally(duplicate_values(df, column), F.count(F.lit(1))))


def accepted(table: str, column: str, values: Sequence[str]) -> Check:
    return Check(table, column, "accepted_values", rule=lambda: not_accepted(column, values), args=tuple(values))


def references(table: str, column: str, parent: str, parent_column: str) -> Check:
    def count(df: DataFrame, load: Callable[[str], DataFrame]) -> DataFrame:
        return _tally(unknown_values(df, column, load(parent), parent_column), F.sum("n_records"))

    return Check(table, column, RELATIONSHIPS, count=count, args=(parent, parent_column))


def between(table: str, column: str, low: float | None = None, high: float | None = None, strictly: bool = False) -> Check:
    args = (low, high, strictly)
    return Check(table, column, "between", rule=lambda: out_of_range(column, *args), args=args)


def ordered(table: str, later: str, earlier: str, or_equal: bool = False) -> Check:
    return Check(table, f"{later},{earlier}", "pair_ge", rule=lambda: not_after(later, earlier, or_equal), args=(or_equal,))


def converted(
    table: str, column: str, native: str, rate: str, pivot: str | None = None, tolerance: float = TOLERANCE
) -> Check:
    kind, args = "fx_pivot" if pivot else "fx_direct", (native, rate, pivot, tolerance)
    return Check(table, column, kind, rule=lambda: misconverted(column, *args), args=args)


def not_negative(table: str, *columns: str) -> Check:
    return Check(table, ",".join(columns), "positive_amounts", rule=lambda: is_negative(*columns))


def _tally(violations: DataFrame, how: Column) -> DataFrame:
    return violations.agg(F.coalesce(how, F.lit(0)).cast("bigint").alias("failures"))


def _tallies(broken: Sequence[Column]) -> list[Column]:
    """The number of rows on which each condition holds, as ``r0``, ``r1`` ..."""
    return [
        F.coalesce(F.sum(F.when(rule, 1).otherwise(0)), F.lit(0)).cast("bigint").alias(f"r{i}")
        for i, rule in enumerate(broken)
    ]


class Observed:
    """Row rules of one table, counted by the job that writes its rows.

    ``watch`` goes on the rows as they are written, above every shuffle, so each row is counted
    once, also when a lost executor has earlier stages computed again. ``violations`` waits for
    the job; a table without row rules is not watched.
    """

    def __init__(self, checks: Sequence[Check]) -> None:
        self._checks = [c for c in checks if c.rule is not None]
        self._seen = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        if not self._checks:
            return df
        return df.observe(self._seen, *_tallies([c.rule() for c in self._checks]))

    def violations(self) -> dict[str, int]:
        """Violating rows by the name of the check."""
        found = self._seen.get if self._checks else {}
        return {check.name: found[f"r{i}"] for i, check in enumerate(self._checks)}


def _row_rules(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row rules of a table in one scan, turned into one row per check."""
    return _counted(df, checks, [c.rule() for c in checks])


def _uniqueness(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All ``unique`` checks of a table in one scan."""
    repeated = counted_values(df, checks).filter(F.col("n") > 1)
    return _counted(repeated, checks, [F.col("name") == c.name for c in checks])


def counted_values(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Name of the check, value as text and its number of rows ``n``, for the columns of all checks, in one scan.

    Values are counted together with the check they belong to, before they are shuffled. NULLs do not count.
    """
    values = [F.struct(F.lit(c.name).alias("name"), F.col(c.column).cast("string").alias("value")) for c in checks]
    tagged = df.select(F.explode(F.array(*values)).alias("v")).select("v.*").filter(F.col("value").isNotNull())
    return tagged.groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))


def _counted(df: DataFrame, checks: Sequence[Check], broken: Sequence[Column]) -> DataFrame:
    """One row per check with the number of rows on which its condition holds."""
    rows = F.array(
        *(
            F.struct(
                F.lit(c.table).alias("table_name"), F.lit(c.column).alias("column_name"), F.lit(c.kind).alias("check"),
                F.col(f"r{i}").alias("failures"),
            )
            for i, c in enumerate(checks)
        )
    )
    return df.agg(*_tallies(broken)).select(F.explode(rows).alias("c")).select("c.*")


def _known(spark: SparkSession, checks: Sequence[Check], counted: Mapping[str, int]) -> DataFrame:
    """One row per check whose violations were counted before; bounded by the declared checks."""
    rows = [(c.table, c.column, c.kind, counted[c.name]) for c in checks]
    return spark.createDataFrame(rows, "table_name string, column_name string, `check` string, failures bigint")


def run_checks(
    checks: Sequence[Check], load: Callable[[str], DataFrame], counted: Mapping[str, int] | None = None
) -> DataFrame:
    """One row per check: table, column, kind, number of violations, status.

    ``counted`` holds violations by the name of the check, where they are known already; a table
    is not scanned for those.
    """
    counted = counted or {}
    results, known = [], [c for c in checks if c.name in counted]
    if known:
        results.append(_known(SparkSession.active(), known, counted))
    for table in dict.fromkeys(c.table for c in checks):
        mine = [c for c in checks if c.table == table and c not in known]
        if not mine:
            continue
        df = load(table)
        row_rules = [c for c in mine if c.rule is not None]
        if row_rules:
            results.append(_row_rules(df, row_rules))
        keys = [c for c in mine if c.kind == UNIQUE]
        if keys:
            results.append(_uniqueness(df, keys))
        for check in mine:
            if check.count is not None and check not in keys:
                results.append(
                    check.count(df, load).select(
                        F.lit(check.table).alias("table_name"), F.lit(check.column).alias("column_name"),
                        F.lit(check.kind).alias("check"), "failures",
                    )
                )
    summary = reduce(DataFrame.unionByName, results)
    return summary.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def arrival_freshness(
    source: DataFrame, name: str, run_ts: datetime, warn_hours: int = 24, error_hours: int = 48
) -> DataFrame:
    """Freshness of a source without a load time: the newest of its files counts, by the time the file was written.

    ``source`` is read from files, and rows that no file holds leave no trace. The hidden file metadata gives the time,
    so no column of the source is read.
    """
    arrived = source.select(F.col("_metadata.file_modification_time").alias("_arrived_at"))
    return source_freshness(arrived, name, "_arrived_at", run_ts, warn_hours, error_hours)


def source_freshness(
    df: DataFrame, name: str, loaded_at: str, run_ts: datetime, warn_hours: int = 24, error_hours: int = 48
) -> DataFrame:
    """Age of the newest row at ``run_ts`` and its status; an empty source is an error."""
    newest = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    age = (F.unix_timestamp(stamp(run_ts)) - F.unix_timestamp("max_loaded_at")) / 3600.0
    status = (
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), "error")
        .when(F.col("age_hours") > warn_hours, "warn")
        .otherwise("pass")
    )
    return newest.select(F.lit(name).alias("source"), "max_loaded_at", age.cast("double").alias("age_hours")).withColumn(
        "status", status
    )
