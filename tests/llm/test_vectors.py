"""The operators on vectors against brute force, and their defined edge cases."""

from __future__ import annotations

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from vaultspan.llm import components, lattice_search, tree_forest
from vaultspan.llm.scratch import Scratch

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, score string"


@pytest.fixture(scope="module")
def odd(spark):
    """Unusable vectors, another dimension, repeated rows, null ids and labels."""
    rows = [
        (100, [1.0, 0.0, 0.0], 1, "x"),
        (100, [1.0, 0.0, 0.0], 1, "x"),
        (101, [2.0, 0.0, 0.0], 1, "x"),
        (102, [1.0, 0.01, 0.0], 2, "x"),
        (103, [1.0, 0.01, 0.0], None, "x"),
        (104, None, 1, "x"),
        (105, [], 1, "x"),
        (106, [0.0, 0.0, 0.0], 1, "x"),
        (107, [1.0, None, 0.0], 1, "x"),
        (108, [float("nan"), 1.0, 0.0], 1, "x"),
        (109, [float("inf"), 1.0, 0.0], 1, None),
        (110, [1.0, 0.0], 1, "x"),
        (None, [1.0, 0.0, 0.0], 1, "x"),
        (200, [0.0, 1.0, 0.0], 1, "x"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def clusters(seed: int, groups: int, members: int, spread: float, size: int = 32):
    draw = np.random.default_rng(seed)
    rows, key = [], 0
    for g in range(groups):
        centre = draw.normal(size=size)
        for _ in range(members):
            vector = centre + draw.normal(size=size) * spread * float(draw.uniform(0, 1))
            rows.append((key := key + 1, [float(x) for x in vector.astype(np.float32)], g % 3, None))
    return rows


def brute_near(rows, threshold=0.98):
    ids = [r[0] for r in rows]
    vectors = np.array([r[1] for r in rows], dtype=float)
    unit = vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    label = np.array([r[2] for r in rows])
    linked = (unit @ unit.T >= threshold) & (label[:, None] == label[None])
    np.fill_diagonal(linked, False)
    component = np.array(ids)
    while True:
        lower = np.array([min([component[i], *component[linked[i]]]) for i in range(len(ids))])
        if (lower == component).all():
            break
        component = lower
    return {k: (int(linked[i].sum()), int(component[i]), k == component[i]) for i, k in enumerate(ids)}


def near(rows, **options):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in tree_forest.near_vectors(rows, **options).collect()}


@pytest.mark.parametrize("leaf, block", [(400, 1024), (20, 16)])
def test_forest_finds_what_all_pairs_give(spark, monkeypatch, leaf, block):
    """Also with deep trees and leaves that are compared block by block."""
    monkeypatch.setattr(tree_forest, "LEAF", leaf)
    monkeypatch.setattr(tree_forest, "BLOCK", block)
    rows = clusters(1, 40, 15, 0.25)
    assert near(spark.createDataFrame(rows, SCHEMA)) == brute_near(rows)


def test_forest_edge_cases(odd):
    found = collections.Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in tree_forest.near_vectors(odd).collect())
    expected = collections.Counter(
        [(100, 3, 100, True)] * 2 + [(101, 3, 100, False), (None, 3, 100, False)]
        + [(k, 0, k, True) for k in (102, 103, 104, 105, 106, 107, 108, 109, 110, 200)]
    )
    assert found == expected
    assert tree_forest.near_vectors(odd.where("false")).collect() == []


def test_tight_nodes_are_not_split_for_ever():
    sample = np.ones((100, 8)) + np.random.default_rng(2).normal(size=(100, 8)) * 1e-6
    tree = tree_forest.grow(sample, depth=12, threshold=0.98, seed=1)
    assert len(tree.low) == 1
    assert [leaf for leaf, _ in tree.leaves(sample)] == [0]


def search(rows, **options):
    found = collections.defaultdict(list)
    for r in lattice_search.nearest_neighbours(rows, F.col("vec_id") % 100 == 0, **options).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    return found


def test_search_recall_and_exact_scores(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    local = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in rows.collect()}
    ids, matrix = np.array(list(local)), np.stack(list(local.values()))
    found, hit = search(rows), 0
    assert set(found) == {k for k in local if k % 100 == 0}
    for query, nearest in found.items():
        apart = np.sqrt(((matrix - local[query]) ** 2).sum(axis=1))
        assert [r for r, _, _ in nearest] == list(range(1, 11))
        for _, key, score in nearest:
            assert score == apart[ids == key][0] and key != query
        order = [k for k in ids[np.lexsort((ids, apart))].tolist() if k != query][:10]
        hit += len(set(order) & {key for _, key, _ in nearest})
    assert hit / (10 * len(found)) >= 0.9


def test_search_in_blocks_and_by_leading_coordinates(spark, monkeypatch):
    rows = spark.createDataFrame(clusters(3, 50, 20, 0.1), SCHEMA)
    whole = search(rows, k=5)
    monkeypatch.setattr(lattice_search, "ROWS_PER_BLOCK", 7)
    monkeypatch.setattr(lattice_search, "QUERIES_PER_BLOCK", 2)
    assert search(rows, k=5) == whole


def test_search_edge_cases(odd):
    """Fewer rows than asked for: all of them, though far from the query; ties go to the smaller id."""
    found = search(odd)
    assert [(r, k) for r, k, _ in found[100]] == [(1, 102), (2, 103), (3, 101), (4, 200)]
    assert [(r, k) for r, k, _ in found[200]][:2] == [(1, 102), (2, 103)]
    assert sorted(k for _, k, _ in found[200]) == [100, 101, 102, 103]
    assert search(odd.where("false")) == {}
    assert search(odd.where("vec_id in (100, 104)")) == {}


def test_probes_come_in_order_of_estimated_success():
    spot = np.array([0.1, 0.5, 0.9, 0.4, 0.6, 0.5])
    cells = lattice_search.probes(spot, 30)
    assert cells[0].tolist() == [0] * 6
    steps = cells - np.floor(spot)
    cost = np.where(steps < 0, spot**2, np.where(steps > 0, (1 - spot) ** 2, 0)).sum(axis=1)
    assert (np.diff(cost) >= -1e-12).all() and len({tuple(c) for c in cells.tolist()}) == 30


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 5000), (7, 6)]
    links = spark.createDataFrame(chain + star, "u long, v long")
    found = dict(tuple(r) for r in components.components(Scratch(spark, "t"), links).collect())
    assert found == {**{i: 1 for i in range(1, 61)}, **{i: 1000 for i in range(1000, 1050)}}
    assert components.components(Scratch(spark, "t"), links.where("false")).collect() == []
