"""Bucketed neighbours against brute force, exact and approximate."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_scores import brute_knn, knn_case

from riskloom.operators import lsh
from riskloom.operators.lsh import lsh_neighbors, lsh_recall, lsh_target_mean
from riskloom.plans import run

SCHEMA = "id int, vec array<double>, y int, fold int"
ALLOWED = {
    "self": lambda q, r: q[0] != r[0],
    "fold": lambda q, r: q[3] != r[3],
    None: lambda q, r: True,
}


@pytest.mark.parametrize("kind", ["spread", "tied"])
@pytest.mark.parametrize("exclude", ["self", "fold", None])
def test_exact_means_against_brute_force(spark, monkeypatch, kind, exclude):
    monkeypatch.setattr(lsh, "BLOCK_QUERIES", 40)
    monkeypatch.setattr(lsh, "LEAST_QUERIES", 8)
    monkeypatch.setattr(lsh, "CELLS", 3_000)
    rows, ks = knn_case(kind), [3, 10]
    # Queries of another table may have ids of the first; only "self" leaves those out.
    queries = rows if exclude else [
        (i, [v + 0.01 for v in r[1]], 0, 0) for i, r in enumerate(rows[::4])
    ]
    refs, asked = (spark.createDataFrame(x, SCHEMA) for x in (rows, queries))
    got = lsh_target_mean(
        refs, asked.select("id", "vec", "fold"), ks, exclude, exact=True, bucket_points=10
    ).collect()
    want = brute_knn(rows, queries, ks, ALLOWED[exclude])
    assert len(got) == len(queries) and all(r["certain"] for r in got)
    for r in got:
        assert (r[1], r[2]) == pytest.approx(want[r["id"]]), r["id"]


def test_neighbours_are_ordered_certain_ones_right_and_recall_as_asked(spark):
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(8, 30)) * 3
    rows = [
        (i, (middles[i % 8] + rng.normal(size=30)).tolist(), 0, 0) for i in range(1_500)
    ]
    refs = spark.createDataFrame(rows, SCHEMA)
    got = lsh_neighbors(refs, refs, 20, recall=0.9, bucket_points=20).collect()
    vec = np.array([r[1] for r in rows])
    hits = 0
    for r in got:
        d2 = ((vec - vec[r["id"]]) ** 2).sum(axis=1)
        d2[r["id"]] = np.inf
        best = np.lexsort((np.arange(len(d2)), d2))[:20].tolist()
        hits += len(set(best) & set(r["ids"]))
        assert r["d2"] == sorted(r["d2"]) and np.allclose(d2[r["ids"]], r["d2"])
        assert not r["certain"] or r["ids"] == best
    assert len(got) == 1_500 and hits >= 0.87 * 20 * 1_500
    measured = lsh_recall(refs, refs.filter("id % 30 = 0"), 20, recall=0.9, bucket_points=20)
    row = measured.first()
    assert row["queries"] == 50 and row["recall"] >= 0.87 and row["distances_exact"]


def test_fewer_than_k_one_point_and_none(spark):
    rows = [(i, [float(i), 0.0], i % 2, 0) for i in range(4)]
    refs = spark.createDataFrame(rows, SCHEMA)
    got = {r["id"]: r for r in lsh_neighbors(refs, refs, 10).collect()}
    assert got[0]["ids"] == [1, 2, 3] and got[0]["n"] == 3 and got[0]["certain"]
    alone = refs.filter("id = 0")
    assert lsh_target_mean(alone, alone, [3]).first()["KNN_TARGET_MEAN_K3"] is None
    assert lsh_target_mean(refs.limit(0), refs, [3]).count() == 0
    assert lsh_target_mean(refs, refs.limit(0), [3]).count() == 0


def test_bounds_never_exceed_distances():
    rng = random.Random(2)
    points = np.array([[rng.gauss(0, 1) for _ in range(5)] for _ in range(300)])
    axes = np.linalg.qr(np.random.default_rng(1).normal(size=(5, 3)))[0]
    edges = [np.array([-0.5, 0.0, 0.5]), np.array([0.1]), np.array([])]
    known = np.unique(lsh.Buckets(axes, edges, np.zeros(0, int)).of(points))
    buckets = lsh.Buckets(axes, edges, known)
    at = np.searchsorted(known, buckets.of(points))
    d2 = ((points[:, None] - points[None]) ** 2).sum(axis=2)
    assert (buckets.bounds(points)[:, at] <= d2 + 1e-12).all()


def test_job_gives_the_same_features_by_cells_and_by_buckets(spark):
    rng = random.Random(4)
    rows = [
        (i, i % 3 == 0, rng.random(), rng.random(), 100.0 + i, 10.0 + i % 7) for i in range(240)
    ]
    names = "SK_ID_CURR long, TARGET boolean, EXT_SOURCE_2 double, EXT_SOURCE_3 double, " \
        "AMT_CREDIT double, AMT_ANNUITY double"
    rows = [(i, t, None if i % 9 == 0 else a, b, c, d) for i, t, a, b, c, d in rows]
    frame = spark.createDataFrame(rows, names).withColumn("TARGET", F.col("TARGET").cast("int"))
    train, test = frame.filter("SK_ID_CURR < 200"), frame.filter("SK_ID_CURR >= 200")
    found = [
        [sorted(map(tuple, t.collect()), key=str) for t in run.add_neighbours(
            train, test.drop("TARGET"), [5, 20], search=search
        )]
        for search in ("cells", "buckets", "approximate")
    ]
    assert found[0] == found[1]
    assert [len(t) for t in found[2]] == [200, 40]
