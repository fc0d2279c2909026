"""Raw rows to staged rows: typing, technical columns, stable ids."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vaultspan.functions import technical_columns
from vaultspan.operators.incremental import new_rows_with_ids, upsert, with_stable_ids
from vaultspan.operators.surrogate import number_rows
from vaultspan.sources.files import LoadedTable
from vaultspan.sources.key_index import KeyIndex
from vaultspan.sources.schemas import DIMENSIONS, RawTable
from vaultspan.types import DDL, ID


@dataclass(frozen=True)
class Run:
    """What a run needs to know about itself; nothing reads the clock."""

    run_id: str
    run_ts: datetime


@dataclass(frozen=True)
class Undecorated:
    """Source rows and the raw columns that follow from each of them alone, which need not travel with them.

    ``carried`` are columns of the rows that are kept beside the staged ones.
    """

    rows: DataFrame
    columns: dict[str, Column]
    carried: tuple[str, ...] = ()

    def decorated(self) -> DataFrame:
        return self.rows.select(*(column.alias(name) for name, column in self.columns.items()))

    def numbered(self, table: RawTable, after: int = 0) -> DataFrame:
        """The raw columns in the types of the schema, with their id and what is carried."""
        rows = number_rows(self.rows, table.order, table.id_column, after, self.columns)
        return rows.to(StructType([*table.schema, *(rows.schema[c] for c in (table.id_column, *self.carried))]))


def _staged(rows: DataFrame, table: RawTable, run: Run, carried: Sequence[str] = ()) -> DataFrame:
    """The staged select list, in the order id, technical columns, source key, columns."""
    technical = technical_columns(table.source, table.object_id, run.run_ts, run.run_id)
    technical.update({name: F.lit(value).cast(ID) for name, value in table.extra_ids})
    if table.name in DIMENSIONS:
        technical[f"{table.key}_src"] = F.col(table.key)
    return rows.select(
        F.col(table.id_column),
        *(column.alias(name) for name, column in technical.items()),
        *(F.col(name).cast(DDL[kind]).alias(name) for name, kind in table.columns.items()),
        *carried,
    )


def stage_upsert(raw: DataFrame, table: RawTable, run: Run, existing: DataFrame | None = None) -> DataFrame:
    """The whole staged table after merging the raw rows (dimensions and exchange rates)."""
    numbered = with_stable_ids(existing, raw, table.key, table.id_column, table.order)
    return upsert(existing, _staged(numbered, table, run), table.key)


def stage_new_rows(
    raw: DataFrame | Undecorated, table: RawTable, run: Run, existing: DataFrame | None = None, after: int | None = None
) -> DataFrame:
    """Only the rows a fact table does not hold yet, numbered and ready to append."""
    if isinstance(raw, Undecorated):
        if existing is None:
            return _staged(raw.numbered(table, after or 0), table, run, raw.carried)
        raw = raw.decorated().to(table.schema)
    numbered = new_rows_with_ids(existing, raw, table.key, table.id_column, table.order, after)
    return _staged(numbered, table, run)


class StagedFact:
    """A fact table that grows by loads, with the index of their keys."""

    def __init__(self, spark: SparkSession, path: str, table: RawTable) -> None:
        self.table = table
        self.store = LoadedTable(spark, path)
        self.index = KeyIndex(spark, path, table.key, table.id_column)

    def fresh(self, raw: DataFrame, run: Run, loads: Sequence[str]) -> DataFrame:
        """The rows that none of the loads holds. Of earlier loads only those are read that may hold a key."""
        if not loads:
            return stage_new_rows(raw, self.table, run)
        keyed = raw.where(F.col(self.table.key).isNotNull())
        held = self.store.read(self.index.possible(loads, keyed))
        return stage_new_rows(keyed, self.table, run, held, self.index.highest_id(loads))
