"""What the keys of earlier loads may be, without reading them.

Beside the files of every load lie a summary (number of rows, key range, highest id) and
a Bloom filter of its keys. The filter is a table: a key belongs to one block, which is a
bitmap of 32,768 bits, and sets ``_PROBES`` of them; blocks are built by Spark's bitmap
aggregate, so a filter has as many rows as its load needs and no task or driver holds it whole.

A batch is held against the key ranges first, then against the blocks of the loads that are left.
Only loads that may hold a key of the batch are named; their keys then decide, so a false
positive costs a read and never a row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspan.sources.files import LOAD, LoadedTable

_BLOCK_BITS = 1 << 15  # of a bitmap
_KEYS_PER_BLOCK = 1_024  # on average: a bit in about three is set, and a strange key passes one time in a million
_PROBES = 12
_PROBES_PER_HASH = 4


@dataclass(frozen=True)
class LoadSummary:
    load: str
    rows: int
    least: str | None
    greatest: str | None
    highest_id: int
    blocks: int


def _block(key: Column, blocks: Column | int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks) if isinstance(blocks, int) else blocks)


def _bits(key: Column) -> list[Column]:
    """The places of a key in its block: 15 bits each of a few more hashes."""
    hashes = [F.xxhash64(key, F.lit(seed + 1)) for seed in range(_PROBES // _PROBES_PER_HASH)]
    return [F.shiftright(h, 15 * k).bitwiseAND(F.lit(_BLOCK_BITS - 1)).cast("int") for h in hashes for k in range(_PROBES_PER_HASH)]


def _is_set(bitmap: Column, bit: Column) -> Column:
    """Bit b of a bitmap is bit b % 8, from the lowest, of byte b div 8."""
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", byte, bit.bitwiseAND(F.lit(7))) == 1


class KeyIndex:
    """Summaries and filters of the loads of one table, in ``<path>_keys`` and ``<path>_key_summaries``.

    A table without an ``id_column`` has 0 as highest id.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, id_column: str | None) -> None:
        self.spark, self.key, self.id_column = spark, key, id_column
        self._filters = LoadedTable(spark, f"{path}_keys")
        self._summaries = LoadedTable(spark, f"{path}_key_summaries")

    def add(self, load: str, part: DataFrame) -> None:
        """Index the rows of a load, which should be read from its files: only key and id are needed."""
        key = F.col(self.key)
        ids = F.lit(0) if self.id_column is None else F.col(self.id_column)
        found = part.agg(
            F.count(key).alias("rows"), F.min(key).alias("least"), F.max(key).alias("greatest"), F.max(ids).cast("long").alias("highest_id")
        ).first()
        blocks = -(-found["rows"] // _KEYS_PER_BLOCK)
        summary = self.spark.range(1).select(
            F.lit(found["rows"]).alias("rows"), F.lit(found["least"]).cast("string").alias("least"),
            F.lit(found["greatest"]).cast("string").alias("greatest"),
            F.lit(found["highest_id"] or 0).cast("long").alias("highest_id"), F.lit(blocks).cast("long").alias("blocks"),
        )
        marks = part.where(key.isNotNull()).select(_block(key, max(blocks, 1)).alias("block"), F.explode(F.array(*_bits(key))).alias("bit"))
        # the few rows of a block from every task become one bitmap before the shuffle
        filters = marks.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))
        self._filters.write(load, filters)
        self._summaries.write(load, summary.coalesce(1))

    def summaries(self, loads: Sequence[str]) -> list[LoadSummary]:
        """A row per load; the number of loads is what bounds them."""
        rows = self._summaries.read(loads)
        if rows is None:
            return []
        # the folder says which load a summary belongs to
        load = F.regexp_extract(F.input_file_name(), rf"{LOAD}=([^/]+)/", 1).alias("load")
        picked = rows.select(load, "rows", "least", "greatest", "highest_id", "blocks").collect()
        return sorted((LoadSummary(**row.asDict()) for row in picked), key=lambda s: s.load)

    def loads(self) -> list[str]:
        """The loads that are indexed, in order."""
        return self._summaries.loads()

    def highest_id(self, loads: Sequence[str]) -> int:
        return max((s.highest_id for s in self.summaries(loads)), default=0)

    def possible(self, loads: Sequence[str], batch: DataFrame) -> list[str]:
        """The loads that may hold a key of the batch, in the order given."""
        held = [s for s in self.summaries(loads) if s.rows]
        if not held:
            return []
        key = F.col(self.key)
        spans = batch.agg(F.min(key).alias("least"), F.max(key).alias("greatest")).first()
        if spans["least"] is None:
            return []
        held = [s for s in held if s.least <= spans["greatest"] and spans["least"] <= s.greatest]
        if not held:
            return []
        ranges = self.spark.createDataFrame(
            [(s.load, s.least, s.greatest, s.blocks) for s in held], "load string, least string, greatest string, blocks long"
        )
        keys = batch.select(key.alias("key")).where(key.isNotNull())
        # a row per load, so the broadcast is bounded by the number of loads
        asked = keys.join(F.broadcast(ranges), F.col("key").between(F.col("least"), F.col("greatest"))).select(
            "load", _block(F.col("key"), F.col("blocks")).alias("block"), F.array(*_bits(F.col("key"))).alias("asked")
        )
        filters = self._filters.read([s.load for s in held])
        load = F.regexp_extract(F.input_file_name(), rf"{LOAD}=([^/]+)/", 1).alias("load")
        met = asked.join(filters.select(load, "block", "bits"), ["load", "block"])
        passes = F.forall("asked", lambda bit: _is_set(F.col("bits"), bit))
        found = {row["load"] for row in met.where(passes).select("load").distinct().collect()}
        return [load for load in loads if load in found]
