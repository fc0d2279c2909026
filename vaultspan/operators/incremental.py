"""Merging a batch into an existing table: upsert and insert-only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultspan.operators.surrogate import highest_id, number_rows
from vaultspan.types import assert_same_columns


def upsert(existing: DataFrame | None, batch: DataFrame, key: str) -> DataFrame:
    """Rows of the batch replace rows with the same key; nothing is deleted."""
    if existing is None:
        return batch
    assert_same_columns(existing, batch, key)
    kept = existing.join(batch.select(key), key, "left_anti")
    return kept.select(*existing.columns).unionByName(batch)


def unseen(existing: DataFrame | None, batch: DataFrame, key: str) -> DataFrame:
    """Rows of the batch whose key the target does not hold yet."""
    if existing is None:
        return batch
    fresh = batch.filter(F.col(key).isNotNull()).join(existing.select(key), key, "left_anti")
    return fresh.select(*batch.columns)


def newer_than_target(existing: DataFrame | None, batch: DataFrame, day: str) -> DataFrame:
    """Rows dated after the newest row of the target: cheap, but late rows are lost."""
    if existing is None:
        return batch
    newest = existing.agg(F.max(day).alias("newest")).first()["newest"]
    return batch if newest is None else batch.filter(F.col(day) > F.lit(newest))


def insert_only(existing: DataFrame | None, batch: DataFrame, key: str) -> DataFrame:
    """The target plus the unseen rows of the batch; rows already there never change."""
    fresh = unseen(existing, batch, key)
    if existing is None:
        return fresh
    assert_same_columns(existing, fresh, key)
    return existing.unionByName(fresh)


def with_stable_ids(
    existing: DataFrame | None,
    batch: DataFrame,
    key: str,
    id_column: str,
    order: Sequence[str],
) -> DataFrame:
    """Known keys keep their id; new keys are numbered after the highest id in use."""
    if existing is None:
        return number_rows(batch, order, id_column)
    known_ids = existing.select(key, id_column)
    known = batch.join(known_ids, key)
    new = batch.join(known_ids, key, "left_anti")
    numbered = number_rows(new, order, id_column, highest_id(existing, id_column))
    return known.unionByName(numbered)


def new_rows_with_ids(
    existing: DataFrame | None,
    batch: DataFrame,
    key: str,
    id_column: str,
    order: Sequence[str],
    after: int | None = None,
) -> DataFrame:
    """The unseen rows of the batch, numbered by range after the highest id in use.

    Who knows that id gives it as ``after``; ``existing`` may then be any part of the
    target that holds every key of the batch that the target holds.
    """
    fresh = unseen(existing, batch, key)
    return number_rows(fresh, order, id_column, highest_id(existing, id_column) if after is None else after)
