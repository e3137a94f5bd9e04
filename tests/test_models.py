"""Learner-based operators on a planted signal, and the whole run on derived tables."""

import random

import pytest
from pyspark.sql import functions as F

from riskloom.functions.expressions import hash_fraction
from riskloom.operators import folds
from riskloom.operators import models as M
from riskloom.operators.ordered import roc_auc
from riskloom.plans import credit, run
from riskloom.plans.evaluation import evaluate
from riskloom.plans.standins import credit_tables

SF = "/root/testdata/sf0.001"
FOREST = M.Learner("forest", M.random_forest, (1,), {"numTrees": 8, "maxDepth": 4})


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        x, noise = rng.random(), rng.random()
        rows.append((i, int(rng.random() < 0.1 + 0.8 * (x > 0.6)), x, noise, "abc"[i % 3]))
    df = spark.createDataFrame(rows, "id int, y int, x double, noise double, c string")
    return folds.stratified_folds(df, "id", "y", 3).cache()


def test_out_of_fold_scores_find_the_signal(planted):
    out = M.oof_scores(planted, planted.drop("y"), ["x", "noise"], "y", "id", [FOREST], 3)
    assert out.train.count() == 600 and out.test.count() == 600
    assert roc_auc(out.train, "y", "forest").first()["auc"] > 0.75
    gain = {r["feature"]: r["g"] for r in
            out.importances.groupBy("feature").agg(F.avg("importance").alias("g")).collect()}
    assert gain["x"] > 0.8 > gain["noise"]


def test_scores_are_reproducible(planted):
    first, second = (
        {r["id"]: r["forest"] for r in
         M.oof_scores(planted, None, ["x"], "y", "id", [FOREST], 3).train.collect()}
        for _ in range(2)
    )
    assert first == second


def test_early_stop_rows_come_from_the_training_folds(planted):
    boost = M.Learner("boosted", M.boosted_trees, (1, 2), {"maxIter": 4, "maxDepth": 2})
    out = M.oof_scores(planted, None, ["x"], "y", "id", [boost], 3, early_stop_share=0.2)
    assert roc_auc(out.train, "y", "boosted").first()["auc"] > 0.7
    assert out.importances.count() == 3  # one per fold, from the first seed only


def test_drift_is_found_and_gated(planted):
    shifted = planted.withColumn("x", F.col("x") + 2)
    auc, drifting, top = M.adversarial(planted, shifted, ["x", "noise"], "id", 3, FOREST)
    assert auc > 0.95 and drifting and top.first()["feature"] == "x"
    drift = M.column_drift(planted, shifted, ["x", "noise"])
    got = {r["name"]: r["auc"] for r in drift.collect()}
    assert got["x"] == 1.0 and got["noise"] == 0.5
    spark = planted.sparkSession
    gains = spark.createDataFrame([("x", 0.0), ("noise", 0.9)], "feature string, importance double")
    gate = {r["feature"]: r["dropped"] for r in M.drift_gate(drift, gains).collect()}
    assert gate == {"x": True, "noise": False}


def test_child_models_cover_train_and_test_parents(spark, planted):
    child = planted.select(F.col("id").alias("p"), "x", "c").withColumn(
        "p", (F.col("p") / 4).cast("int")
    )
    parents = child.groupBy("p").agg((F.avg("x") > 0.5).cast("int").alias("y"))
    test = F.col("p") % 5 == 0
    out = M.child_model_meta(
        child, parents.filter(~test), parents.filter(test), "p", "y", ["x", "c"], "META_C",
        FOREST, 3,
    )
    rows = out.collect()
    assert len(rows) == parents.count()
    for r in rows:
        assert r["META_C_MIN"] <= r["META_C_MEAN"] <= r["META_C_MAX"]
    joined = out.join(parents, "p")
    assert roc_auc(joined, "y", "META_C_MEAN").first()["auc"] > 0.6


def test_reconstruction_fills_known_and_missing(planted):
    df = planted.withColumn("z", F.when(F.col("id") % 4 > 0, 3 * F.col("x")))
    known, test = df.filter("id < 500"), df.filter("id >= 500")
    assert M.reconstruct(known, test, "z", ["x"], "id", 3) is None
    train_out, test_out = M.reconstruct(
        known, test, "z", ["x", "noise"], "id", 3, min_known=10, maxIter=5, maxDepth=4
    )
    assert train_out.count() == 500 and test_out.count() == 100
    error = train_out.join(planted, "id").agg(F.avg(F.abs(F.col("PRED_z") - 3 * F.col("x"))))
    assert error.first()[0] < 0.4


def test_search_prefers_the_better_parameters(planted):
    grid = M.param_grid(maxDepth=[1, 4], numTrees=[5])
    best, trials = M.param_search(planted, ["x", "noise"], "y", "id", M.random_forest, grid, 3)
    assert best in grid and trials.count() == 6


def test_evaluation_of_a_subset_scales_weights_back(planted):
    other = M.Learner("second", M.random_forest, (3,), {"numTrees": 4, "maxDepth": 3})
    train, test = planted.drop("fold").filter("id < 450"), planted.drop("fold", "y").filter("id >= 450")
    weights = {"forest": 0.5, "second": 0.25, "third": 0.25}
    full = evaluate(train, test, "id", "y", ["c"], [FOREST, other],
                    {"forest": 0.7, "second": 0.3}, k=3, check_drift=False)
    assert full.aucs.count() == 5 and full.scores.count() == 150
    assert full.selection_auc == max(r["auc"] for r in full.aucs.collect())
    assert sum(full.grid_weights.values()) == pytest.approx(1.0)
    part = evaluate(train, test, "id", "y", ["c"], [FOREST, other], weights, ["third"], k=3,
                    check_drift=False)
    assert part.aucs.count() == 4 and part.scores.filter(F.col("score").isNull()).count() == 0


def test_whole_run_from_files_to_scores(spark, tmp_path):
    data, out = str(tmp_path / "data"), str(tmp_path / "out")
    tables = credit_tables(spark, SF)
    test = hash_fraction(F.col(credit.APPLICANT), 5) % 4 == 0
    application = tables.pop("application")
    application.filter(test).drop(credit.TARGET).write.parquet(f"{data}/application_test.parquet")
    application.filter(~test).write.parquet(f"{data}/application_train.parquet")
    for name, df in tables.items():
        if name == "bureau":
            df.write.option("header", True).csv(f"{data}/{name}.csv")
        else:
            df.write.parquet(f"{data}/{name}.parquet")
    settings = run.Settings(
        folds=2, rounds=2, neighbours=(5, 10_000), child_models=("bureau",), tag="test",
        search={"forest": {"maxDepth": [2, 3]}}, search_share=0.5, fold_safe_neighbours=True,
        gate_drift=True, proposed=True, ridge_alphas=(1.0, 10.0),
    )
    result = run.run(spark, data, out, settings)
    scores = result.scores.collect()
    assert len(scores) == application.filter(test).count()
    assert all(0 <= r["score"] <= 1.5 for r in scores)
    assert {"stacked_ridge_1", "stacked_ridge_rank_10"} <= {
        r["name"] for r in result.aucs.collect()
    }
    files = [p for p in (tmp_path / "out").iterdir() if p.name.startswith("submission_")]
    assert len(files) == 1 and files[0].name.endswith("_test")
    written = spark.read.option("header", True).csv(str(files[0]))
    assert written.columns == [credit.APPLICANT, credit.TARGET]
    assert written.count() == len(scores)
