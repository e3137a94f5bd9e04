"""Properties of ranks, AUC, folds, encodings, neighbours and blends."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import blend as B
from riskloom.operators import encode as E
from riskloom.operators import folds
from riskloom.operators import neighbors as N
from riskloom.operators.joins import attach, lookup
from riskloom.operators.neighbors import knn_target_mean
from riskloom.operators.ordered import rank_normalize, roc_auc
from riskloom.session import settle


def brute_auc(rows):
    pairs = [(a, b) for y, a in rows if y == 1 for z, b in rows if z == 0]
    return sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs)


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(3)
    rows = [
        (i, int(rng.random() < 0.3), round(rng.random(), 2), round(rng.random(), 3),
         round(rng.random(), 1), i % 5)
        for i in range(600)
    ]
    df = spark.createDataFrame(
        rows, "id int, y int, a double, b double, c double, fold int"
    )
    return df.cache(), rows


def test_auc_with_ties(scored):
    df, rows = scored
    for name, at in {"a": 2, "b": 3, "c": 4}.items():
        want = brute_auc([(r[1], r[at]) for r in rows])
        assert roc_auc(df, "y", name).first()["auc"] == pytest.approx(want, abs=1e-12)


def test_auc_flips_with_the_sign_and_keeps_under_monotone_maps(scored):
    df, _ = scored
    base = roc_auc(df, "y", "a").first()["auc"]
    flipped = roc_auc(df.withColumn("m", -F.col("a")), "y", "m").first()["auc"]
    mapped = roc_auc(df.withColumn("m", F.exp(3 * F.col("a"))), "y", "m").first()["auc"]
    assert base + flipped == pytest.approx(1.0, abs=1e-12) and mapped == base


def test_auc_of_constant_scores_is_half(scored):
    df, _ = scored
    assert roc_auc(df.withColumn("s", F.lit(0.3)), "y", "s").first()["auc"] == 0.5


def test_ranks_average(scored):
    df, rows = scored
    out = rank_normalize(df, ["a", "c"])
    means = out.agg(F.avg("a_rank"), F.avg("c_rank")).first()
    assert means[0] == pytest.approx((len(rows) + 1) / (2 * len(rows)))
    assert means[1] == pytest.approx((len(rows) + 1) / (2 * len(rows)))


def test_folds_are_balanced_per_stratum(scored):
    df, _ = scored
    for cells in (1, 7, 1024):
        out = folds.stratified_folds(df.drop("fold"), "id", "y", 5, cells=cells)
        sizes = out.groupBy("y", "fold").count().collect()
        assert out.count() == 600
        for y in (0, 1):
            counts = [r["count"] for r in sizes if r["y"] == y]
            assert len(counts) == 5 and max(counts) - min(counts) <= 1


def test_cells_do_not_change_the_folds(scored):
    df, _ = scored
    few, many = (
        {r["id"]: r["fold"] for r in
         folds.stratified_folds(df.drop("fold"), "id", "y", 5, cells=c).collect()}
        for c in (2, 500)
    )
    assert few == many


def test_a_group_has_one_fold(spark):
    rows = [(i, i % 40, (i % 40) % 2) for i in range(1000)]
    out = folds.group_folds(spark.createDataFrame(rows, "id int, g int, y int"), "g", "y", 4)
    spread = out.groupBy("g").agg(F.count_distinct("fold").alias("n")).agg(F.max("n")).first()[0]
    assert spread == 1 and out.count() == 1000


def test_stratified_sample_sizes(scored):
    df, rows = scored
    out = folds.stratified_sample(df, "id", "y", 0.25)
    for y in (0, 1):
        size = sum(r[1] == y for r in rows)
        assert out.filter(F.col("y") == y).count() == int(size * 0.25 + 0.5)


def test_encoding_ignores_labels_of_the_own_fold(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["p", "q", None]), rng.randint(0, 1), i % 3) for i in range(300)]
    # Flipping a pair inside fold 0 of one category keeps the global mean and changes no map.
    df = spark.createDataFrame(rows, "id int, c string, y int, fold int")
    ones = [i for i, c, y, f in rows if c == "p" and f == 0 and y == 1][:1]
    zeros = [i for i, c, y, f in rows if c == "q" and f == 0 and y == 0][:1]
    swapped = df.withColumn(
        "y", F.when(F.col("id").isin(ones + zeros), 1 - F.col("y")).otherwise(F.col("y"))
    )
    first, second = (
        {r["id"]: r["c_TE"] for r in
         E.encode_out_of_fold(d, ["c"], "y", 3).filter("fold = 0").collect()}
        for d in (df, swapped)
    )
    assert first == pytest.approx(second)


def test_encodings_per_fold_leave_one_fold_out_each(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice(["p", "q", None]), rng.randint(0, 1), i % 3) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, c string, y int, fold int")
    mu = sum(r[2] for r in rows) / len(rows)
    for r in E.encode_per_fold(df, ["c"], "y", 3).collect():
        for f in range(3):
            others = [y for _, c, y, g in rows if c == r["c"] and g != f]
            want = (sum(others) + 10 * mu) / (len(others) + 10) if r["c"] else mu
            assert r["c_TE"][f] == pytest.approx(want)


def test_null_and_unseen_categories_get_the_mean(spark):
    train = spark.createDataFrame(
        [(1, "a", 1, 0), (2, "b", 0, 1), (3, None, 1, 1), (4, "b", 1, 1)],
        "id int, c string, y int, fold int",
    )
    out = {r["id"]: r["c_TE"] for r in E.encode_out_of_fold(train, ["c"], "y", 2).collect()}
    assert out[3] == 0.75 and out[1] == pytest.approx(0.75)  # "a" only occurs in its own fold
    test = spark.createDataFrame([(9, "zzz"), (8, None), (7, "b")], "id int, c string")
    full = {r["id"]: r["c_TE"] for r in E.encode_full(train, test, ["c"], "y").collect()}
    assert full[9] == full[8] == 0.75 and full[7] == pytest.approx((1 + 7.5) / 12)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_with_a_heavy_key(spark, how):
    rows = [(7 if i % 3 == 0 else i % 50, i) for i in range(3000)] + [(None, -i) for i in range(99)]
    left = spark.createDataFrame(rows, "k int, v int")
    dim = spark.createDataFrame([(k, f"d{k}") for k in range(0, 40)], "k int, d string")
    want = sorted(map(str, left.join(dim, "k", how).collect()))
    assert sorted(map(str, lookup(left, dim, ["k"], how, 0.05).collect())) == want
    assert sorted(map(str, attach(left, dim, ["k"], how, max_rows=3).collect())) == want
    assert sorted(map(str, attach(left, dim, ["k"], how, max_bytes=99).collect())) == want
    assert sorted(map(str, attach(left, dim, ["k"], how).collect())) == want


def test_lookup_reads_its_rows_once(spark, tmp_path):
    spark.range(1000).selectExpr("id % 7 AS k", "id AS v").write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    dim = spark.createDataFrame([(k, f"d{k}") for k in range(5)], "k long, d string")
    plan = lookup(rows, dim, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1


def brute_knn(refs, queries, ks, allowed):
    out = {}
    for q in queries:
        near = sorted(
            (sum((a - b) ** 2 for a, b in zip(q[1], r[1])), r[0], r[2])
            for r in refs if allowed(q, r)
        )
        out[q[0]] = tuple(np.mean([y for _, _, y in near[:k]]) if near else None for k in ks)
    return out


def knn_case(kind):
    rng = random.Random(11)
    rows = []
    for i in range(500):
        if i % 3 == 0:
            vec = [0.5, 0.5, 0.5]  # a third of all rows on one point
        elif kind == "tied":
            vec = [0.5, round(rng.random(), 1), round(rng.random(), 2)]
        else:
            vec = [rng.random(), rng.random() ** 3, rng.gauss(0, 4)]
        rows.append((i, vec, rng.randint(0, 1), i % 4))
    return rows


@pytest.mark.parametrize("kind", ["spread", "tied"])
@pytest.mark.parametrize("exclude", ["self", "fold", None])
@pytest.mark.parametrize("cell,chunk", [(8192, 128), (40, 128), (40, 2)])
def test_knn_against_brute_force(spark, kind, exclude, cell, chunk):
    rows, ks = knn_case(kind), [3, 10]
    schema = "id int, vec array<double>, y int, fold int"
    refs = spark.createDataFrame(rows, schema)
    queries = rows if exclude else [(1000 + i, [v + 0.01 for v in r[1]], 0, 0)
                                    for i, r in enumerate(rows[::4])]
    asked = spark.createDataFrame(queries, schema).select("id", "vec", "fold")
    got = {
        r["id"]: (r["KNN_TARGET_MEAN_K3"], r["KNN_TARGET_MEAN_K10"])
        for r in knn_target_mean(
            refs, asked, ks, exclude, cell_points=cell, cell_queries=60, chunk_cells=chunk
        ).collect()
    }
    allowed = {
        "self": lambda q, r: q[0] != r[0],
        "fold": lambda q, r: q[3] != r[3],
        None: lambda q, r: True,
    }[exclude]
    want = brute_knn(rows, queries, ks, allowed)
    assert set(got) == set(want)
    for key, value in want.items():
        assert got[key] == pytest.approx(value), key


def test_neighbour_tree_cuts_every_side_and_prunes(spark):
    rng = np.random.default_rng(6)
    vec = rng.random((20_000, 4))
    vec[::5, 3] = 0.5  # ties as a filled median makes them
    rows = [(int(i), [float(v) for v in x], int(i % 2), int(i % 5)) for i, x in enumerate(vec)]
    points = spark.createDataFrame(rows, "id int, vec array<double>, y int, fold int")
    points = settle(points.repartition(8).withColumn("y", F.col("y").cast("double")))
    tree = N._Cuts(points, 80)
    placed = settle(points.withColumn("cell", tree.cell_of()))
    tree.measure(placed, True)
    assert set(tree.dim[np.isfinite(tree.at)]) == {0, 1, 2, 3}
    sites = placed.withColumnRenamed("id", "site").withColumn("sub", F.lit(0))

    def reached(most):
        within = N._radius(sites, placed, most, True)
        rows = sites.join(within, "site", "left")
        return settle(rows.withColumn("r2", tree.certain(most, True)))

    # More than a cell holds outside the query's fold: a box above it gives the radius.
    assert reached(100).filter(F.col("r2") == float("inf")).count() == 0
    near = reached(20).withColumn("sub", F.col("site"))
    cells = placed.select("cell").distinct().count()
    assert tree.touched(near).distinct().count() / near.count() < 0.25 * cells


def test_neighbour_join_stores_no_row_per_query_and_chunk(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, [rng.random(), rng.random(), rng.random()], i % 2) for i in range(900)]
    refs = spark.createDataFrame(rows, "id int, vec array<double>, y int")
    stored = []

    def counted(df):
        kept = settle(df)
        stored.append(kept.count())
        return kept

    monkeypatch.setattr(N, "settle", counted)
    found = knn_target_mean(
        refs, refs.select("id", "vec"), [3, 10], "self", cell_points=16, chunk_cells=1
    )
    assert found.count() == len(rows) and max(stored) <= len(rows)


@pytest.mark.parametrize("exclude", ["self", "fold"])
def test_knn_of_many_coordinates_against_brute_force(spark, exclude):
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(4, 24))
    vec = 1000 + centres[rng.integers(0, 4, 400)] + 0.05 * rng.normal(size=(400, 24))
    vec[200:260] = vec[0]  # ties
    vec[260:300] = vec[:40] + 1e-9
    rows = [(int(i), [float(v) for v in x], int(i % 3 == 0), int(i % 4)) for i, x in enumerate(vec)]
    refs = spark.createDataFrame(rows, "id int, vec array<double>, y int, fold int")
    allowed = {"self": lambda q, r: q[0] != r[0], "fold": lambda q, r: q[3] != r[3]}[exclude]
    want = brute_knn(rows, rows, [3, 20], allowed)
    asked = refs.select("id", "vec", "fold")
    for r in knn_target_mean(refs, asked, [3, 20], exclude, cell_points=60, cell_queries=50).collect():
        assert (r["KNN_TARGET_MEAN_K3"], r["KNN_TARGET_MEAN_K20"]) == pytest.approx(want[r["id"]])


def test_simplex_blend_against_all_vectors(scored):
    df, rows = scored
    weights, auc = B.simplex_blend(df, "y", ["a", "b", "c"], step=0.25, bins=50)
    best, best_w = -1.0, None
    for a, b in itertools.product(range(5), range(5)):
        if a + b <= 4:
            w = (a / 4, b / 4, (4 - a - b) / 4)
            got = brute_auc([(r[1], w[0] * r[2] + w[1] * r[3] + w[2] * r[4]) for r in rows])
            if got > best + 1e-12:
                best, best_w = got, w
    assert auc == pytest.approx(best, abs=1e-12)
    assert tuple(weights.values()) == best_w and sum(weights.values()) == 1


def test_simplex_blend_of_nearly_equal_scores(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(400):
        a = round(rng.random(), 3)
        rows.append((int(rng.random() < a), a, a + rng.random() * 1e-6, a + rng.random() * 1e-6))
    df = spark.createDataFrame(rows, "y int, a double, b double, c double")
    weights, auc = B.simplex_blend(df, "y", ["a", "b", "c"], step=0.1, bins=16)
    found = {}
    for i, j in itertools.product(range(11), range(11)):
        if i + j <= 10:
            w = (i / 10, j / 10, (10 - i - j) / 10)
            blends = [(r[0], w[0] * r[1] + w[1] * r[2] + w[2] * r[3]) for r in rows]
            found[w] = brute_auc(blends)
    best = max(found.values())
    assert auc == pytest.approx(best, abs=1e-12)
    assert found[tuple(weights.values())] == pytest.approx(best, abs=1e-12)


def test_ridge_equals_the_closed_form(scored):
    df, rows = scored
    names = ["a", "b", "c"]
    fits = B.fit_ridge(df, "y", names, (1.0, 3.0))
    x = np.array([r[2:5] for r in rows])
    y = np.array([r[1] for r in rows], dtype=float)
    fold = np.array([r[5] for r in rows])
    for alpha in (1.0, 3.0):
        for f in [*range(5), None]:
            keep = fold != f if f is not None else np.ones(len(y), dtype=bool)
            xc, yc = x[keep] - x[keep].mean(0), y[keep] - y[keep].mean()
            w = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
            slope, intercept = fits[alpha][f]
            assert np.allclose(slope, w, atol=1e-9)
            assert intercept == pytest.approx(y[keep].mean() - x[keep].mean(0) @ w, abs=1e-9)


def test_blend_scales_back(spark):
    df = spark.createDataFrame([(1.0, 2.0, 4.0)], "a double, b double, c double")
    row = df.select(B.blend({"a": 0.5, "b": 0.25, "c": 0.25}, ["b"])).first()
    assert row[0] == pytest.approx((0.5 * 1 + 0.25 * 4) / 0.75)
