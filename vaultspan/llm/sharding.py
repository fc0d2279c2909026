"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

Rows are numbered in a total order, the numbers are permuted, and the permuted
number p alone says where a row goes: shard p mod k, slot p div k. So shards
differ by one row at most, slots have no gaps, and the place of any row number,
or the row number at any place, is a computation and not a look-up.

The permutation works on [0, a * b) with a = ceil(sqrt(rows)) and the least b that
holds all rows. A number that leaves [0, rows) is permuted again until it is
back (cycle walking). Everything is DataFrame and SQL functions.

Defined results: null text has size 1 (its line end) and the checksum 0 of the empty
text; equal rows, a repeated one included, take adjacent row numbers and so
different places, and are cut into ranges by their place in the input, so that a third of
all rows may be equal; null ids come first in the order; an empty table gives an empty
result; other columns are never read.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultspan.llm.scratch import Scratch, numbered

ROUNDS = 6
# A walk of this many steps is exact up to 4,096 rows, where at most 64 numbers lie
# outside; above, a step leaves [0, rows) with a chance below 1 / 64.
WALK = 64


def _sides(rows: int) -> tuple[int, int]:
    a = isqrt(rows - 1) + 1
    return a, -(-rows // a)


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by).cast("long"))


def _noise(value: Column, turn: Column, seed: int, size: int) -> Column:
    return F.pmod(F.xxhash64(value, turn, F.lit(seed)), F.lit(size).cast("long"))


def _once(value: Column, a: int, b: int, seed: int, back: bool) -> Column:
    """One pass through the Feistel network, or through its inverse; even turns change the left side."""
    sign = F.lit(-1 if back else 1)

    def turn_of(state: Column, turn: Column) -> Column:
        left, right = state["l"], state["r"]
        return F.when(
            turn % 2 == 0,
            F.struct(F.pmod(left + sign * _noise(right, turn, seed, a), F.lit(a).cast("long")).alias("l"), right.alias("r")),
        ).otherwise(
            F.struct(left.alias("l"), F.pmod(right + sign * _noise(left, turn, seed, b), F.lit(b).cast("long")).alias("r"))
        )

    turns = F.array(*[F.lit(t) for t in (range(ROUNDS)[::-1] if back else range(ROUNDS))])
    sides = F.struct((value % F.lit(a).cast("long")).alias("l"), _div(value, a).alias("r"))
    return F.aggregate(turns, sides, turn_of, lambda state: state["r"] * F.lit(a).cast("long") + state["l"])


def _walk(value: Column, rows: int, seed: int, back: bool) -> Column:
    a, b = _sides(rows)
    step = lambda x: _once(x.cast("long"), a, b, seed, back)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)), step(value), lambda x, _: F.when(x < F.lit(rows), x).otherwise(step(x))
    )
    return F.when(walked < F.lit(rows), walked).otherwise(F.raise_error(F.lit("the walk is too short")).cast("long"))


def permuted(number: Column, rows: int, seed: int) -> Column:
    """The permuted row number: a bijection of [0, rows)."""
    return _walk(number, rows, seed, back=False)


def restored(number: Column, rows: int, seed: int) -> Column:
    """The row number that ``permuted`` sends here."""
    return _walk(number, rows, seed, back=True)


def row_at(shard: Column, slot: Column, rows: int, shards: int, seed: int) -> Column:
    """The row number that lies at a slot of a shard."""
    return restored(slot * F.lit(shards) + shard, rows, seed)


def shard_rows(
    docs: DataFrame, shards: int = 16, seed: int = 20_240_501, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: id, size, text_crc32, row_number, shard and slot."""
    scratch = Scratch(docs.sparkSession, "sharding")
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    measured = docs.select(
        F.col(id_column).cast("long").alias("id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
        # stored with the row, so a repeated task cannot give another place
        F.monotonically_increasing_id().alias("input_place"),
    )
    # the range split samples its input: from the narrow copy, not from the texts once more
    narrow = scratch.store(measured, "measured")
    lined = numbered(scratch, narrow, ["id", "text_crc32", "size", "text_hash", "input_place"], "row_number")
    rows = lined.count()
    if rows == 0:
        place = F.lit(0).cast("long")
    else:
        place = permuted(F.col("row_number"), rows, seed)
    return lined.withColumn("place", place).select(
        F.col("id").alias(id_column),
        "size",
        "text_crc32",
        "row_number",
        (F.col("place") % F.lit(shards)).cast("int").alias("shard"),
        _div(F.col("place"), shards).alias("slot"),
    )
