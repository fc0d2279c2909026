"""Near-duplicate vectors by a forest of random-projection trees.

Vectors are compared within a label. Each tree splits space at the median of a
random projection, again and again; a vector whose projection lies within a margin
of the median goes to both sides (spill). The margin is a share of the spread that
the projected difference of two vectors at the threshold has, so one tree parts such
a pair with a few per cent chance and all trees together almost never do. Leaves of
a label are compared by cosine, every link found is exact, and links are united.

Equal vectors of a label are one class from the start. Trees are fitted on a bounded
sample, every vector is indexed. A leaf with many members is cut into blocks and
compared block by block.

Defined results: a vector that is null, empty or zero, or has null or non-finite
components, and a vector with a null label, has no links and is kept; vectors of
different dimension are never linked; repeated rows are rows of their own, linked
as equal vectors; a component without any id is named by null; an empty table
gives an empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultspan.llm.components import components
from vaultspan.llm.scratch import Scratch
from vaultspan.llm.vectors import as_unit, number_type, sampled, usable

TREES = 6
SAMPLE = 100_000
LEAF = 400
MARGIN = 0.6  # of the standard deviation of a projected difference at the threshold
BLOCK = 1024
_NODE_LIMIT = 1 << 20


@dataclass
class Tree:
    """Nodes in arrays; a leaf has direction -1."""

    directions: np.ndarray
    direction: list[int]
    cut: list[float]
    low: list[int]
    high: list[int]
    margin: float

    def leaves(self, vectors: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, row numbers) of every leaf that holds a row; a row can be in several."""
        waiting = [(0, np.arange(len(vectors)))]
        while waiting:
            node, rows = waiting.pop()
            if not len(rows):
                continue
            if self.direction[node] < 0:
                yield node, rows
                continue
            side = vectors[rows] @ self.directions[self.direction[node]] - self.cut[node]
            waiting.append((self.low[node], rows[side <= self.margin]))
            waiting.append((self.high[node], rows[side >= -self.margin]))


def grow(sample: np.ndarray, depth: int, threshold: float, seed: int) -> Tree:
    """Split the sample at medians of random projections, down to ``depth`` levels."""
    draw = np.random.default_rng(seed)
    size = sample.shape[1]
    margin = MARGIN * np.sqrt(2 * (1 - threshold)) / np.sqrt(size)
    directions: list[np.ndarray] = []
    tree = Tree(np.zeros((0, size)), [-1], [0.0], [-1], [-1], margin)
    waiting = [(0, np.arange(len(sample)), 0)]
    while waiting:
        node, rows, level = waiting.pop()
        if level >= depth or len(rows) < 16 or len(tree.low) >= _NODE_LIMIT:
            continue
        direction = draw.normal(size=size)
        direction /= np.sqrt((direction**2).sum())
        side = sample[rows] @ direction
        cut = float(np.median(side))
        below, above = rows[side - cut <= margin], rows[side - cut >= -margin]
        if len(below) + len(above) > 1.5 * len(rows):
            continue  # the node is too tight to be split
        tree.direction[node], tree.cut[node] = len(directions), cut
        directions.append(direction)
        for child, part in (("low", below), ("high", above)):
            getattr(tree, child)[node] = len(tree.low)
            tree.direction.append(-1)
            tree.cut.append(0.0)
            tree.low.append(-1)
            tree.high.append(-1)
            waiting.append((len(tree.low) - 1, part, level + 1))
    tree.directions = np.array(directions) if directions else np.zeros((0, size))
    return tree


def _leaves(forests, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["label", "cls", "vector", "size", "leaf"]
        for batch in batches:
            vectors = batch.column(2)
            sizes = np.array([len(v) for v in vectors.to_pylist()]) // np.dtype(kind).itemsize
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                matrix = as_unit(np.stack([np.frombuffer(v, kind) for v in vectors.take(pa.array(rows)).to_pylist()]).astype(float))
                for number, tree in enumerate(forests.value.get(size, [])):
                    found, at = [], []
                    for leaf, inside in tree.leaves(matrix):
                        found.append(rows[inside])
                        at.append(np.full(len(inside), leaf * TREES + number, dtype=np.int64))
                    take, leaf = pa.array(np.concatenate(found)), np.concatenate(at)
                    yield pa.record_batch(
                        [batch.column(0).take(take), batch.column(1).take(take), vectors.take(take)]
                        + [pa.array(np.full(len(leaf), size, dtype=np.int32)), pa.array(leaf)],
                        names=names,
                    )

    return run


def _compare(threshold: float, kind: str):
    """Pairs of classes with cosine at or above the threshold, of one pair of blocks."""

    def run(group: pa.Table) -> pa.Table:
        cls, block = group.column("cls").to_numpy(), group.column("block").to_numpy()
        first, second = group.column("bi")[0].as_py(), group.column("bj")[0].as_py()
        unit = as_unit(np.stack([np.frombuffer(v, kind) for v in group.column("vector").to_pylist()]).astype(float))
        left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
        us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(left), 256):
            rows = left[at : at + 256]
            i, j = np.nonzero(unit[rows] @ unit[right].T >= threshold)
            a, b = cls[rows[i]], cls[right[j]]
            fresh = a < b if first == second else a != b
            us.append(np.minimum(a, b)[fresh])
            vs.append(np.maximum(a, b)[fresh])
        return pa.table({"u": np.concatenate(us), "v": np.concatenate(vs)})

    return run


def near_vectors(
    rows: DataFrame, threshold: float = 0.98, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    trees: int = TREES, sample: int = SAMPLE,
) -> DataFrame:
    """One row per vector: id, n_links, component_id and kept."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "forest")
    kind = number_type(rows, vector_column)
    source = rows.select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("string").alias("label"), F.col(vector_column).alias("vector")
    )
    # packed again for the result, so the vectors of all rows are not stored a second time
    packed = source.mapInArrow(_packed(kind), "id long, label string, vector binary").withColumn(
        "cls", F.when(F.col("label").isNotNull() & F.col("vector").isNotNull(), F.xxhash64("label", "vector"))
    )
    classes = scratch.store(
        packed.where("cls is not null").groupBy("cls").agg(
            F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector")
        ),
        "classes",
    )
    most = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    depth = max(0, int(np.ceil(np.log2(max(1, most) / LEAF))))
    forests = {
        size: [grow(as_unit(part), depth, threshold, 1000 * size + t) for t in range(trees)]
        for size, part in sampled(classes, "vector", kind, sample).items()
    }
    rare = spark.sparkContext.broadcast(_with_rest(forests, classes, kind, trees))
    placed = scratch.store(
        classes.select("label", "cls", "vector").mapInArrow(
            _leaves(rare, kind), "label string, cls long, vector binary, size int, leaf long"
        ),
        "placed",
    )
    key = ["label", "size", "leaf"]
    blocks = (
        placed.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        .select(*key, F.ceil(F.col("n") / F.lit(BLOCK)).cast("int").alias("blocks"))
    )
    blocked = placed.join(blocks, key).withColumn("block", F.expr("int(pmod(xxhash64(cls, leaf), blocks))"))
    pairs = blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *key, "cls", "vector", "block", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj")
    )
    links = scratch.store(
        pairs.groupBy(*key, "bi", "bj").applyInArrow(_compare(threshold, kind), "u long, v long").distinct(), "links"
    )
    scratch.drop(placed)
    both = links.select(F.col("u").alias("cls"), F.col("v").alias("other")).union(links.select("v", "u"))
    linked = (
        both.join(classes.select(F.col("cls").alias("other"), "copies"), "other").groupBy("cls").agg(F.sum("copies").alias("linked"))
    )
    named = components(scratch, links)
    least = named.join(classes.select(F.col("cls").alias("node"), "least"), "node").groupBy("label").agg(
        F.min("least").alias("component")
    )
    named = named.join(least, "label").select(F.col("node").alias("cls"), "component")
    answer = (
        classes.select("cls", "least", "copies").join(named, "cls", "left").join(linked, "cls", "left")
        .select("cls", F.coalesce("component", "least").alias("component"), (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    )
    answer = scratch.store(answer, "answer")  # a class can hold a third of all vectors: then its join can be split
    return packed.select("id", "cls").join(answer, "cls", "left").select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
        (F.col("id").eqNullSafe(F.coalesce("component", "id"))).alias("kept"),
    )


def _with_rest(forests: dict[int, list[Tree]], classes: DataFrame, kind: str, trees: int) -> dict[int, list[Tree]]:
    """A one-leaf tree for dimensions that the sample missed; there are as many as distinct dimensions."""
    size = F.call_function("div", F.octet_length("vector"), F.lit(np.dtype(kind).itemsize))
    for row in classes.select(size.cast("int").alias("size")).distinct().collect():
        if row["size"] not in forests:
            forests[row["size"]] = [grow(np.zeros((0, row["size"])), 0, 0.5, 0)]
    return forests


def _packed(kind: str):
    """Every row, its vector as bytes or, where it is unusable, null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed: list[bytes | None] = [None] * batch.num_rows
            for rows, matrix in usable(batch.column(2)):
                for row, vector in zip(rows.tolist(), matrix.astype(kind)):
                    packed[row] = vector.tobytes()
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["id", "label", "vector"])

    return run
