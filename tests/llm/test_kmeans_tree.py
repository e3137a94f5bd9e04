"""Neighbours of the tree against brute force: recall on whole tables, equality where all is visited."""

import math
from functools import reduce

import numpy as np
import pytest
from brute import SF
from pyspark.sql import functions as F

from riskloom.llm import kmeans_tree
from riskloom.llm.kmeans_tree import Layout, Shelf, build, nearest, op11_kmeans_tree

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k=20, every=20):
    """Exact neighbours of distinct rows, ties by id."""
    dims = {}
    good = set()
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good.add((i, tuple(np.float32(x).item() for x in v)))
            dims[len(v)] = dims.get(len(v), 0) + 1
    dim = max(dims, key=lambda d: (dims[d], d), default=0)
    good = [g for g in good if len(g[1]) == dim]
    out = []
    for i, v in good:
        if i % every:
            continue
        near = {(-sum(a * b for a, b in zip(v, w)), j) for j, w in good if j != i}
        out += [(i, r, j, -s) for r, (s, j) in enumerate(sorted(near)[:k], 1)]
    return sorted(out)


def rounded(rows):
    return sorted((q, r, v, round(s, 9)) for q, r, v, s in rows)


def odd_vectors(seed=0, n=700, dim=5):
    """Clusters, a third of all rows on one vector, unequal lengths, and rows that take no part."""
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(6, dim))
    rows = []
    for i in range(n):
        v = middles[i % 6] * rng.uniform(0.2, 4) + rng.normal(size=dim) * 0.3
        v = middles[0] * 2 if i % 3 == 0 else v
        rows.append((i - 40, [float(np.float32(x)) for x in v], i))
    return rows + [
        (None, rows[1][1], 1), (2000, None, 1), (2020, [0.0] * dim, 1), (2040, [], 1),
        (2060, [1.0, None, 1.0, 1.0, 1.0], 1), (2080, [1.0, float("nan"), 1.0, 1.0, 1.0], None),
        (2100, [float("inf")] * dim, 1), (2120, [1.0, 2.0], 1), rows[40], rows[40],
        (rows[40][0], rows[41][1], 2),
    ]


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.1"])
def test_recall_on_whole_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in rows])
    vectors = np.array([r["embedding"] for r in rows])
    got = op11_kmeans_tree(spark, sf).collect()
    assert sorted((r["query_id"], r["rank"]) for r in got) == sorted(
        (q, r) for q in ids[ids % 20 == 0].tolist() for r in range(1, 21)
    )
    found = 0
    for at in np.flatnonzero(ids % 20 == 0):
        scores = vectors @ vectors[at]
        scores[at] = -np.inf
        best = set(ids[np.argsort(-scores)[:20]].tolist())
        found += sum(r["vec_id"] in best for r in got if r["query_id"] == ids[at])
    assert found >= 0.9 * len(got)
    for r in got[:200]:
        a, b = (vectors[np.flatnonzero(ids == r[c])[0]].tolist() for c in ("query_id", "vec_id"))
        assert r["score"] == reduce(lambda s, xy: s + xy[0] * xy[1], zip(a, b), 0.0)


@pytest.mark.parametrize("rows_on_shelf, queries", [(1 << 20, 1 << 20), (60, 7)])
def test_all_visited_is_brute_force(spark, monkeypatch, rows_on_shelf, queries):
    monkeypatch.setattr(kmeans_tree, "SHELF_VALUES", rows_on_shelf * 5)
    monkeypatch.setattr(kmeans_tree, "SHELF_QUERIES", queries)
    monkeypatch.setattr(kmeans_tree, "CELLS", 500)
    rows = odd_vectors()
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS leaf", "3 AS shelf")
    got = nearest(frame, F.col("id") % 20 == 0, recall=1.0).collect()
    assert rounded(got) == rounded(plain(rows))


def test_fewer_than_k_and_searches_that_find_too_few(spark):
    rows = [(20 * i, [1.0, float(i)], 0) for i in range(1, 8)]
    got = nearest(spark.createDataFrame(rows, SCHEMA), F.col("id") % 20 == 0).collect()
    assert rounded(got) == rounded(plain(rows)) and len(got) == 42
    many = odd_vectors(1)
    index = build(spark.createDataFrame(many, SCHEMA), F.col("id") % 20 == 0, k=300)
    index.visits = 1
    asked = index.rows.filter("id % 20 = 0").dropDuplicates().selectExpr(
        "monotonically_increasing_id() AS query", "id AS query_id", "vector"
    )
    kmeans_tree_rows = index.search(kmeans_tree.write_out(asked)).groupBy("query").count().collect()
    assert {r["count"] for r in kmeans_tree_rows} == {300}


def test_integer_and_double_vectors(spark):
    rows = [(i, [i % 7, i % 11, 1], 0) for i in range(1, 61)]
    for kind in ("int", "double"):
        frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int") if (
            kind == "int"
        ) else spark.createDataFrame(
            [(i, [float(x) for x in v], n) for i, v, n in rows],
            "vec_id long, embedding array<double>, label int",
        )
        got = nearest(frame, F.col("id") % 20 == 0, recall=1.0).collect()
        assert rounded(got) == rounded(plain(rows))


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert nearest(empty, F.col("id") % 20 == 0).count() == 0
    unasked = spark.createDataFrame([(1, [1.0], 0)], SCHEMA)
    assert nearest(unasked, F.col("id") % 20 == 0).count() == 0


def test_layout_deals_large_leaves():
    layout = Layout.of(np.array([3, 4, 25, 2, 9, 0]), 10)
    assert layout.first.tolist() == [0, 0, 1, 4, 5, 5]
    assert layout.deals.tolist() == [1, 1, 3, 1, 1, 1]
    assert layout.low.tolist() == [0, 2, 2, 2, 3, 4]
    assert layout.high.tolist() == [2, 3, 3, 3, 4, 6]


def test_shelf_keeps_one_more_than_k_of_equal_vectors():
    shelf = Shelf(np.arange(50), np.ones((50, 3)), np.zeros(50, int), 4)
    row, ids, score = shelf.search(np.array([2]), np.ones((1, 3)), np.ones((1, 8)))
    assert len(shelf.ids) == 5 and ids.tolist() == [0, 1, 3, 4] and set(score) == {3.0}
