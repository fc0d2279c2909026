"""Mixing sources to target weights as a time-varying curriculum.

Sources, in code-point order with null last, have weights that repeat 5, 2, 1 and
slopes that repeat -0.5, 0, 0.5. All sizes together are shared out by weight; no
source gives more than three times its words, and what it cannot give goes to
the others by weight (water filling, in closed form over the sources).

A source's weight over training time t in [0, 1] is its target times
1 + slope * (2t - 1). Integrated from 0 this is the number of its words wanted by
time t. Its documents stand in a fixed random order, pass after pass, and a document
lies where that integral reaches the words before it and half its own: the inverse
of the cumulative demand is its training position. Range-sorting by position gives
the training order.

The order of a source is cut into ranges, so a hot source is worked on by many
tasks; only sums per source and range are joined back.

Defined results: null and blank texts have size 0, are taken 0 times and have no
position; repeated rows stand in the order one after another, each on its own, and are
cut into ranges by their place in the input; a null id orders as the empty text; an empty table gives an empty result; columns other
than the three named ones are never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultspan.llm.scratch import Scratch, numbered

WEIGHTS = (5, 2, 1)
SLOPES = (-0.5, 0.0, 0.5)
MOST_PASSES = 3
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, most_passes: int = MOST_PASSES) -> DataFrame:
    """Add weight, slope and target to (source, source_size); one row per source.

    With sources ordered by cap / weight, a source is capped exactly if its cap is
    below what the rest of the demand would give it, and the level shared by all others
    is the largest of these levels. Sources are ranked and summed by ranges, so their
    number is not bounded by one task.
    """
    scratch = Scratch(sizes.sparkSession, "targets")
    nulls_last = sizes.withColumn("_null", F.col("source").isNull())
    ranked = numbered(scratch, nulls_last, ["_null", "source"], "_rank")
    turn = (F.col("_rank") % len(WEIGHTS)).cast("int")
    pick = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), turn + 1)
    weighed = ranked.withColumn("weight", pick(WEIGHTS)).withColumn("slope", pick(SLOPES))
    weighed = weighed.withColumn("_cap", F.col("source_size").cast("double") * F.lit(float(most_passes)))
    order = ["_ratio", "_rank"]
    ranged = scratch.store(
        weighed.withColumn("_ratio", F.col("_cap") / F.col("weight")).repartitionByRange(*order).withColumn("_part", F.spark_partition_id()),
        "ranged",
    )
    none = lambda c: F.coalesce(c, F.lit(0.0))
    sums = [F.sum("_cap").alias("_caps"), F.sum("weight").alias("_weights")]
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_part").agg(*sums).select(  # a row per range, so one task orders no more than the shuffle partitions
        "_part", none(F.sum("_caps").over(earlier)).alias("_caps"), none(F.sum("_weights").over(earlier)).alias("_weights")
    )
    every = ranged.agg(F.sum(F.col("source_size").cast("double")).alias("_demand"), F.sum("weight").alias("_all"))
    before = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn("_cap_before", none(F.sum("_cap").over(before))).withColumn("_weight_before", none(F.sum("weight").over(before)))
    levels = summed.join(F.broadcast(offsets), "_part").crossJoin(F.broadcast(every)).select(  # a row per range, one row
        ((F.col("_demand") - F.col("_caps") - F.col("_cap_before")) / (F.col("_all") - F.col("_weights") - F.col("_weight_before"))).alias("_level")
    )
    return (
        ranged.crossJoin(F.broadcast(levels.agg(F.max("_level").alias("_top"))))
        .withColumn("target", F.least("_cap", F.col("_top") * F.col("weight")))
        .drop("_null", "_rank", "_ratio", "_cap", "_part", "_top")
    )


def mix(
    docs: DataFrame, seed: str = "mix", most_passes: int = MOST_PASSES,
    id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", row_column: str | None = None,
) -> DataFrame:
    """One row per document: id, source, size, source_size, target, taken and positions (one per pass).

    A long ``row_column`` that tells rows of one id apart is handed through.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    text = F.coalesce(docs[text_column].cast("string"), F.lit(""))
    measured = docs.select(
        docs[id_column].cast("long").alias("id"),
        docs[source_column].cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        (F.lit(0) if row_column is None else docs[row_column]).cast("long").alias("row"),
    ).withColumn("key", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))))
    # rows equal in all else are cut by their place in the input; the ranges are sampled from the narrow copy, so words are counted once
    narrow = scratch.store(measured.withColumn("place", F.monotonically_increasing_id()), "measured")
    order = [F.asc_nulls_first("source"), F.asc("key"), F.asc_nulls_first("id"), F.asc("size"), F.asc("row"), F.asc("place")]
    ranged = scratch.store(
        narrow.repartitionByRange(*order).withColumn("part", F.spark_partition_id()),
        "ranged",
    )
    # a row per source and range that it reaches into: at most ranges + sources
    sums = ranged.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("offset", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)))
    shares = targets(sums.groupBy("source").agg(F.sum("part_size").alias("source_size")), most_passes)
    plan = offsets.alias("o").join(shares.alias("s"), F.col("o.source").eqNullSafe(F.col("s.source"))).select(
        F.col("o.source").alias("source"), "part", "offset", "source_size", "slope", "target", F.round("target").cast("long").alias("words")
    )
    within = Window.partitionBy("part", "source").orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("_within", F.coalesce(F.sum("size").over(within), F.lit(0)))
    joined = placed.alias("d").join(
        plan.alias("p"), (F.col("d.part") == F.col("p.part")) & F.col("d.source").eqNullSafe(F.col("p.source"))
    ).select("d.id", "d.source", "row", "size", "source_size", "target", "slope", "words", (F.col("offset") + F.col("_within")).alias("before"))
    whole = F.when(F.col("source_size") > 0, F.call_function("div", F.col("words"), F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("words") - F.col("whole") * F.col("source_size")
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before"))).cast("long")
    counted = (
        joined.withColumn("whole", whole.cast("long")).withColumn("rest", rest).withColumn("extra", extra)
        .withColumn("taken", F.col("whole") * F.col("size") + F.col("extra"))
        .withColumn("passes", F.when(F.col("size") > 0, F.col("whole") + F.when(F.col("extra") > 0, 1).otherwise(0)).otherwise(F.lit(0)))
    )

    def position(turn):
        words = F.when(turn < F.col("whole"), F.col("size")).otherwise(F.col("extra"))
        share = (turn * F.col("source_size") + F.col("before") + words / F.lit(2.0)) / F.col("words")
        # the root in [0, 1] of slope * t^2 + (1 - slope) * t = share
        still = F.lit(1.0) - F.col("slope")
        return F.lit(2.0) * share / (still + F.sqrt(still * still + F.lit(4.0) * F.col("slope") * share))

    turns = F.when(F.col("passes") > 0, F.sequence(F.lit(0).cast("long"), F.col("passes") - 1)).otherwise(
        F.array().cast("array<bigint>")
    )
    return counted.withColumn("positions", F.transform(turns, position)).select(
        F.col("id").alias(id_column), F.col("source").alias(source_column), "size", "source_size", "target", "taken", "positions",
        *([] if row_column is None else [F.col("row").alias(row_column)]),
    )


def training_order(rows: DataFrame, positions_column: str = "positions") -> DataFrame:
    """One row per pass of a document, range-sorted by its training ``position``."""
    kept = [rows[c] for c in rows.columns if c not in (positions_column, "position")]
    spread = rows.select(*kept, F.explode(rows[positions_column]).alias("position"))
    return spread.repartitionByRange("position").sortWithinPartitions("position")
