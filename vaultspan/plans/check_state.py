"""Uniqueness and relationships of tables that only grow, carried from run to run.

The tables only gain rows, and the parents they refer to only gain keys: facts are appended and
code tables merged without deletions. So a value that repeats goes on repeating, and a value that
has found its parent never loses it. What has to be kept is small: the values met more than once,
and the values still without a parent with their number of rows. A run brings these up to date from its own part.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspan.operators.quality import RELATIONSHIPS, UNIQUE, Check, counted_values
from vaultspan.sources.files import LoadedTable
from vaultspan.sources.key_index import KeyIndex

STATE = "check_state"
_SCHEMA = "name string, value string, n bigint"


@dataclass(frozen=True)
class Growing:
    """An append-only table: its loads and the index of their keys."""

    store: LoadedTable
    index: KeyIndex

    @classmethod
    def at(cls, spark: SparkSession, path: str, key: str, id_column: str | None) -> Growing:
        return cls(LoadedTable(spark, path), KeyIndex(spark, path, key, id_column))

    def holding(self, loads: Sequence[str], column: str, rows: DataFrame) -> DataFrame | None:
        """The loads that may hold a value of the column that the rows hold, read; None when there are none."""
        indexed = set(self.index.loads()) & set(loads)
        known = [load for load in loads if load in indexed]
        if column == self.index.key:
            possible = self.index.possible(known, rows)
        elif column == self.index.id_column:
            least = rows.agg(F.min(column).alias("least")).first()["least"]
            possible = [s.load for s in self.index.summaries(known) if least is not None and s.highest_id >= least]
        else:
            possible = known
        return self.store.read([load for load in loads if load not in indexed or load in possible])


class CheckState:
    """The carried checks of the tables in ``growing``, by table name.

    Every attempt stores the whole state, with a row per check that counts nothing, so that an
    attempt without violations is told from one that carried no state.
    """

    def __init__(self, spark: SparkSession, root: str, checks: Sequence[Check], growing: Mapping[str, Growing]) -> None:
        self.spark = spark
        self.store = LoadedTable(spark, f"{root}/{STATE}")
        self.growing = growing
        self.checks = [c for c in checks if c.table in growing and c.kind in (UNIQUE, RELATIONSHIPS)]

    def _of(self, table: str, kind: str) -> list[Check]:
        return [c for c in self.checks if c.table == table and c.kind == kind]

    def _repeated(self, table: str, part: DataFrame, earlier: Sequence[str]) -> list[DataFrame]:
        """Values that the part holds twice, or that it shares with an earlier load. Only loads that may share one are read."""
        checks = self._of(table, UNIQUE)
        if not checks:
            return []
        found = [counted_values(part, checks).where("n > 1")]
        for check in checks:
            held = self.growing[table].holding(earlier, check.column, part)
            if held is not None:
                shared = part.join(held.select(check.column), check.column, "left_semi")
                found.append(counted_values(shared, [check]))
        return [rows.select("name", "value", F.lit(1).cast("bigint").alias("n")) for rows in found]

    def _unknown(
        self, table: str, part: DataFrame, before: DataFrame | None, loads: Sequence[str], load: Callable[[str], DataFrame]
    ) -> list[DataFrame]:
        """Values without a parent: those of the part and those that had none before."""
        checks = self._of(table, RELATIONSHIPS)
        if not checks:
            return []
        values = counted_values(part, checks)
        if before is not None:
            values = values.unionByName(before).groupBy("name", "value").agg(F.sum("n").alias("n"))
        found = []
        for check in checks:
            parent, column = check.args
            mine = values.where(F.col("name") == check.name)
            if parent in self.growing:
                parents = self.growing[parent].holding(loads, column, mine.select(F.col("value").alias(column)))
            else:
                parents = load(parent)
            if parents is not None:
                mine = mine.join(parents.select(F.col(column).cast("string").alias("value")), "value", "left_anti")
            found.append(mine.select("name", "value", "n"))
        return found

    def carry(
        self, attempt: str, earlier: Sequence[str], parts: Mapping[str, DataFrame], load: Callable[[str], DataFrame]
    ) -> dict[str, int]:
        """Bring the state up to date, store it for this attempt and return the violations by name of the check.

        ``parts`` holds this attempt's rows of every growing table, ``earlier`` the attempts before
        it, ``load`` whole tables. If the last of the earlier attempts carried no state, or not of
        all these checks, all rows count as this attempt's.
        """
        before = self._stored(earlier[-1]) if earlier else None
        if earlier and before is None:
            parts, earlier_loads = {name: load(name) for name in self.growing}, []
        else:
            earlier_loads = list(earlier)
        counts_nothing = self.spark.createDataFrame([(c.name, None, 0) for c in self.checks], _SCHEMA)
        repeated, unknown = [counts_nothing], []
        for table, part in parts.items():
            repeated += self._repeated(table, part, earlier_loads)
            names = [c.name for c in self._of(table, RELATIONSHIPS)]
            open_before = None if before is None else before.where(F.col("name").isin(names) & F.col("value").isNotNull())
            unknown += self._unknown(table, part, open_before, [*earlier, attempt], load)
        if before is not None:
            names = [c.name for c in self.checks if c.kind == UNIQUE]
            repeated.append(before.where(F.col("name").isin(names) & F.col("value").isNotNull()))
        state = reduce(DataFrame.unionByName, [reduce(DataFrame.unionByName, repeated).distinct(), *unknown])
        written = self.store.write(attempt, state)
        sums = written.groupBy("name").agg(F.sum("n").alias("n")).collect()  # a row per declared check
        return {row["name"]: row["n"] for row in sums}

    def _stored(self, attempt: str) -> DataFrame | None:
        """The state of an attempt, None if it does not know all checks."""
        if attempt not in self.store.loads():
            return None
        state = self.store.read([attempt])
        known = {row["name"] for row in state.where(F.col("value").isNull()).select("name").collect()}
        return state if known >= {c.name for c in self.checks} else None
