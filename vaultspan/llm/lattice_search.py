"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector to the cell of a shifted grid over a few Gaussian
projections. A query visits its own cell and perturbed ones, each coordinate one
step down or up, in order of estimated success: the sum of squared distances from
its projections to the borders that it crosses. What the cells of all tables hold
are the candidates; their exact distances rank them.

Rows meet in groups of cells that agree in the leading coordinates, so that a
query is sent once per group with the list of its cells there. Groups with many
rows or many queries are cut into blocks on either side. Grid spacing comes from
the spread of a bounded sample; every row is indexed. Should a query find fewer
than k rows, it is compared with all rows, block by block.

Defined results: vectors that are null, empty or zero, or have null or non-finite
components, and rows without an id, take no part; rows with the query's id count
as the query itself; repeated rows are one candidate; vectors of another dimension
are no candidates; ties go to the smaller id; an empty table gives an empty result;
other columns are never read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultspan.llm.scratch import Scratch
from vaultspan.llm.vectors import number_type, sampled, usable

TABLES = 8
PROJECTIONS = 6
SPACING = 1.5  # grid step, of the standard deviation of a projection
PROBES = 150
SAMPLE = 10_000
ROWS_PER_BLOCK = 4096
QUERIES_PER_BLOCK = 1024
_STEPS = np.array(list(itertools.product((-1, 0, 1), repeat=PROJECTIONS)))


class Grids:
    """The hash tables of one dimension."""

    def __init__(self, size: int, spacing: float):
        draw = np.random.default_rng(size)
        self._directions = draw.normal(size=(TABLES, PROJECTIONS, size)) / spacing
        self._shift = draw.uniform(size=(TABLES, PROJECTIONS))

    def projected(self, table: int, vectors: np.ndarray) -> np.ndarray:
        # element-wise sums: a row's cell must not depend on the rows beside it
        return np.stack([(vectors * d).sum(axis=1) for d in self._directions[table]], axis=1) + self._shift[table]


def _code(cells: np.ndarray, count: int) -> np.ndarray:
    """The first ``count`` coordinates as one number; distant cells may share it, which only adds candidates."""
    code = np.zeros(cells.shape[0], dtype=np.int64)
    for c in range(count):
        code = code * 1021 + np.clip(cells[:, c], -510, 510).astype(np.int64) + 510
    return code


def probes(projected: np.ndarray, count: int) -> np.ndarray:
    """Cells to visit for one query, the likeliest first."""
    cell = np.floor(projected)
    inside = projected - cell
    cost = np.stack([inside**2, np.zeros(PROJECTIONS), (1 - inside) ** 2])
    total = cost[_STEPS + 1, np.arange(PROJECTIONS)].sum(axis=1)
    return cell + _STEPS[np.argsort(total, kind="stable")[:count]]


_SIDE = "grp long, size int, tbl int, id long, vector binary, code binary"


def _indexed(grids, kind: str, leading: int, count: int):
    """Rows by group of cells: with their own cell (count 0) or with the list of cells to visit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            out = []
            for rows, matrix in usable(batch.column(1)):
                size = matrix.shape[1]
                packed = [v.tobytes() for v in matrix.astype(kind)]
                for table in range(TABLES):
                    spots = grids.value[size].projected(table, matrix)
                    if count == 0:
                        cells = np.floor(spots)
                        groups, codes = _code(cells, leading), _code(cells, PROJECTIONS)
                        out += [(g, size, table, ids[r], v, c.tobytes()) for g, r, v, c in zip(groups.tolist(), rows, packed, codes)]
                        continue
                    for r, v, spot in zip(rows, packed, spots):
                        visits = probes(spot, count)
                        groups, codes = _code(visits, leading), _code(visits, PROJECTIONS)
                        for g in np.unique(groups).tolist():
                            out.append((g, size, table, ids[r], v, codes[groups == g].tobytes()))
                if len(out) > 20_000:
                    yield _batch(out)
                    out = []
            if out:
                yield _batch(out)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    return pa.record_batch(
        [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["grp", "size", "tbl", "id", "vector", "code"]
    )


def _nearest(k: int, kind: str):
    """The k nearest candidates in one block of rows for every query of one block of queries."""

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if rows.num_rows and queries.num_rows:
            unpack = lambda t: np.stack([np.frombuffer(v, kind) for v in t.column("vector").to_pylist()]).astype(float)
            points, ids = unpack(rows), rows.column("id").to_numpy()
            cells = [np.frombuffer(c, np.int64) for c in rows.column("code").to_pylist()]
            own = np.array([c[0] if len(c) else 0 for c in cells])
            for query, qid, visited in zip(unpack(queries), queries.column("id").to_pylist(), queries.column("code").to_pylist()):
                hit = ids != qid
                if visited:
                    hit &= np.isin(own, np.frombuffer(visited, np.int64))
                at = np.flatnonzero(hit)
                if not len(at):
                    continue
                apart = np.sqrt(((points[at] - query) ** 2).sum(axis=1))
                best = np.lexsort((ids[at], apart))
                _, fresh = np.unique(ids[at][best], return_index=True)  # repeated rows are one candidate
                best = best[np.sort(fresh)][:k]
                out[0].extend([qid] * len(best))
                out[1].extend(ids[at][best].tolist())
                out[2].extend(apart[best].tolist())
        return pa.table(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())],
            names=["query_id", "vec_id", "score"],
        )

    return run


_KEY = ["grp", "size", "tbl"]


def _ranked(found: DataFrame, k: int) -> DataFrame:
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")).withColumn("rank", F.row_number().over(nearest)).where(
        F.col("rank") <= k
    )


def _met(rows: DataFrame, queries: DataFrame, k: int, kind: str) -> DataFrame:
    """Bring blocks of rows and blocks of queries of a group together."""
    # cut by counts, so neither side of a group is ever held whole
    blocks = (
        rows.groupBy(*_KEY).agg(F.ceil(F.count(F.lit(1)) / F.lit(ROWS_PER_BLOCK)).cast("int").alias("rows_in"))
        .join(queries.groupBy(*_KEY).agg(F.ceil(F.count(F.lit(1)) / F.lit(QUERIES_PER_BLOCK)).cast("int").alias("queries_in")), _KEY)
    )
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    left = rows.join(blocks, _KEY).withColumn("rb", own("rows_in")).withColumn("qb", spread("queries_in")).drop("rows_in", "queries_in")
    right = queries.join(blocks, _KEY).withColumn("qb", own("queries_in")).withColumn("rb", spread("rows_in")).drop("rows_in", "queries_in")
    key = [*_KEY, "rb", "qb"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_nearest(k, kind), "query_id long, vec_id long, score double")


def nearest_neighbours(
    rows: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding", probe_count: int = PROBES
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for every row that ``is_query`` accepts."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "lattice")
    kind = number_type(rows, vector_column)
    source = rows.where(F.col(id_column).isNotNull())
    picked = lambda df: df.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, matrix in usable(batch.column(1)):
                yield pa.record_batch([pa.array([v.tobytes() for v in matrix.astype(kind)], pa.binary())], names=["vector"])

    vectors = picked(source).mapInArrow(packed, "vector binary")
    spacing = {
        size: SPACING * float(np.sqrt(part.var(axis=0).sum())) or 1.0 for size, part in sampled(vectors, "vector", kind, SAMPLE).items()
    }
    itemsize = np.dtype(kind).itemsize
    counts = vectors.groupBy(F.octet_length("vector").alias("bytes")).count().collect()  # a row per dimension
    grids = spark.sparkContext.broadcast({r["bytes"] // itemsize: Grids(r["bytes"] // itemsize, spacing.get(r["bytes"] // itemsize, 1.0)) for r in counts})
    total = max([r["count"] for r in counts], default=0)
    # a grid step splits a projection into about 3.5 cells that matter
    leading = int(np.clip(np.ceil(np.log(max(total, 1) / 2000) / np.log(3.5)), 1, PROJECTIONS))
    points = picked(source).mapInArrow(_indexed(grids, kind, leading, 0), _SIDE)
    queries = picked(source.where(is_query)).mapInArrow(_indexed(grids, kind, leading, probe_count), _SIDE)
    found = scratch.store(_ranked(_met(points, queries, k, kind), k), "found")

    lacking = (
        queries.where("tbl = 0").select("size", "id").distinct()
        .join(found.groupBy(F.col("query_id").alias("id")).agg(F.count(F.lit(1)).alias("got")), "id", "left")
        .where(F.coalesce("got", F.lit(0)) < k).select("id")
    )
    lacking = scratch.store(lacking, "lacking")
    if not lacking.isEmpty():
        whole = lambda df: df.where("tbl = 0").withColumn("grp", F.lit(0).cast("long"))
        again = whole(queries.join(lacking, "id", "left_semi")).withColumn("code", F.lit(b"")).dropDuplicates(["id", "size"])
        more = _ranked(_met(whole(points), again, k, kind), k)
        found = found.join(lacking.select(F.col("id").alias("query_id")), "query_id", "left_anti").select(more.columns).union(more)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
