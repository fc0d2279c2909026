"""Consecutive surrogate ids in a total order, without a single-task sort."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultspan.session import stored
from vaultspan.types import ID

_ROWS_PER_PARTITION_BITS = 33  # layout of monotonically_increasing_id


def highest_id(existing: DataFrame | None, id_column: str) -> int:
    """Largest id in use, 0 for an empty or missing table."""
    if existing is None:
        return 0
    top = existing.agg(F.max(id_column).alias("top")).first()["top"]
    return int(top or 0)


def number_rows(
    rows: DataFrame, order: Sequence[str], id_column: str, after: int = 0, derived: Mapping[str, Column] | None = None
) -> DataFrame:
    """Add ``id_column`` = ``after`` + rank of the row in ``order`` (1, 2, 3 ...).

    ``order`` must end in a unique column, so ids do not depend on the run. One
    range shuffle on the whole order tuple, then position + offset per range.
    The tuple is unique, so a value that holds a third of all rows in its first
    columns is still cut into many ranges. The ranges come from a sample, hence
    they are stored once, as Parquet, before they are counted, from one column, and
    numbered; only one count per partition is ever gathered.

    ``derived`` are columns that follow from a row alone and that ``order`` may name.
    They do not travel: only ``rows`` is shuffled and stored, they are added to what is read back.
    """
    derived = dict(derived or {})
    keys = {f"_by_{c}": derived[c] for c in order if c in derived}
    ranged = stored(
        rows.repartitionByRange(*(derived.get(c, F.col(c)) for c in order))
        .withColumns(keys)
        .sortWithinPartitions(*(f"_by_{c}" if c in derived else c for c in order))
        .drop(*keys)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("_slot", _ROWS_PER_PARTITION_BITS)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    position = F.col("_slot").bitwiseAND(F.lit((1 << _ROWS_PER_PARTITION_BITS) - 1))
    return (
        ranged.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # one row per shuffle partition
        .withColumns({**derived, id_column: (position + F.col("_offset") + F.lit(after + 1)).cast(ID)})
        .drop("_part", "_slot", "_offset")
    )
