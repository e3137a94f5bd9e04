"""Queries that fit learners.

A tree of depth one on a two-valued feature scores a row by the label mean of the rows it was
fitted on that share its value, which SQL can state: these queries check folds, held-out scoring,
averages and what is built on them. Those with boosted trees and forests have no SQL form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.expressions import hash_fraction, residual
from riskloom.operators import blend as B
from riskloom.operators import folds
from riskloom.operators import models as M
from riskloom.operators.ordered import roc_auc
from riskloom.plans import credit
from riskloom.plans.checks_credit import KEY, _cleaned
from riskloom.plans.checks_scores import SCORES, _auc_sql, _fold_sql, _hash_sql, _labelled
from riskloom.plans.evaluation import evaluate
from riskloom.plans.registry import days_from, days_sql, query, rounded, table
from riskloom.plans.standins import credit_tables
from riskloom.session import settle

FOLDS = 3
SMALL_FOREST = M.Learner("forest", M.random_forest, params={"numTrees": 10, "maxDepth": 4})
SMALL_BOOST = M.Learner("boosted", M.boosted_trees, (42, 2024), {"maxIter": 5, "maxDepth": 3})


def _folded(spark, sf) -> DataFrame:
    return settle(folds.stratified_folds(_labelled(spark, sf), "doc_id", "y", FOLDS))


def _order_features(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        days_from("o_orderdate").alias("days"),
        "o_totalprice",
        (F.col("o_orderkey") % 40).alias("overdue"),
        F.col("o_orderstatus").alias("status"),
    )


TREE = M.Learner("tree", M.decision_tree, (42, 2024), {"maxDepth": 1})

_PRICED_SQL = f"""
  SELECT o_orderkey, CAST(o_totalprice > 150000 AS INTEGER) AS y,
         CAST(o_totalprice > 120000 AS DOUBLE) AS b,
         CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END AS x,
         {_hash_sql("o_orderkey", 5)} % 5 = 0 AS unseen
  FROM orders
"""


def _priced(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey",
        (F.col("o_totalprice") > 150000).cast("int").alias("y"),
        (F.col("o_totalprice") > 120000).cast("double").alias("b"),
        F.when(F.col("o_orderkey") % 3 > 0, F.col("o_totalprice")).alias("x"),
        (hash_fraction(F.col("o_orderkey"), 5) % 5 == 0).alias("unseen"),
    )


@query(
    "oof_tree",
    f"""
    WITH o AS ({_PRICED_SQL}), seen AS (
      SELECT *, {_fold_sql("o_orderkey", "y", 5)} AS fold FROM o WHERE NOT unseen
    ), fits AS (
      SELECT f.fold, b, avg(y) AS p FROM seen JOIN (SELECT DISTINCT fold FROM seen) f
      ON seen.fold <> f.fold GROUP BY 1, 2
    )
    SELECT o_orderkey, round(p, 9) AS tree FROM seen JOIN fits USING (fold, b)
    UNION ALL
    SELECT o_orderkey, round(avg(p), 9) FROM o JOIN fits USING (b) WHERE unseen GROUP BY 1
    """,
)
def oof_tree(spark, sf):
    rows = settle(_priced(spark, sf))
    seen = folds.stratified_folds(rows.filter("NOT unseen"), "o_orderkey", "y", 5)
    out = M.oof_scores(seen, rows.filter("unseen"), ["b"], "y", "o_orderkey", [TREE], 5)
    both = out.train.select("o_orderkey", "tree").unionByName(out.test)
    return both.select("o_orderkey", *rounded(9, "tree"))


def _tree_as_deep_as_its_seed(seed: int, **params):
    return M.decision_tree(seed, maxDepth=seed, **params)


@query(
    "seed_ensemble_tree",
    f"""
    WITH o AS ({_PRICED_SQL}), seen AS (
      SELECT *, {_fold_sql("o_orderkey", "y", 5)} AS fold FROM o WHERE NOT unseen
    ), fits AS (
      SELECT f.fold, s.y, s.b FROM seen s JOIN (SELECT DISTINCT fold FROM seen) f
      ON s.fold <> f.fold
    ), flat AS (
      SELECT fold, avg(y) AS p0 FROM fits GROUP BY 1
    ), deep AS (
      SELECT fold, b, avg(y) AS p1 FROM fits GROUP BY 1, 2
    )
    SELECT o_orderkey, round((p0 + p1) / 2, 9) AS tree
    FROM seen JOIN flat USING (fold) JOIN deep USING (fold, b)
    UNION ALL
    SELECT o_orderkey, round(avg((p0 + p1) / 2), 9)
    FROM o JOIN deep USING (b) JOIN flat USING (fold) WHERE unseen GROUP BY 1
    """,
)
def seed_ensemble_tree(spark, sf):
    """Two seeds that give different trees: one leaf for seed 0, two leaves for seed 1."""
    rows = settle(_priced(spark, sf))
    seen = folds.stratified_folds(rows.filter("NOT unseen"), "o_orderkey", "y", 5)
    learner = M.Learner("tree", _tree_as_deep_as_its_seed, (0, 1))
    out = M.oof_scores(seen, rows.filter("unseen"), ["b"], "y", "o_orderkey", [learner], 5)
    both = out.train.select("o_orderkey", "tree").unionByName(out.test)
    return both.select("o_orderkey", *rounded(9, "tree"))


_ORIGIN_SQL = f"""
  SELECT CASE WHEN d < -1200 THEN 0 ELSE 1 END AS origin, CAST(d < -1000 AS DOUBLE) AS b,
         CASE WHEN d < -1200 THEN '0:' ELSE '1:' END || o_orderkey AS place
  FROM (SELECT o_orderkey, {days_sql("o_orderdate")} AS d FROM orders)
"""
_ORIGIN_SCORED_SQL = f"""
  WITH o AS (SELECT *, {_fold_sql("place", "origin", 3)} AS fold FROM ({_ORIGIN_SQL}))
  SELECT o.place, o.origin, p FROM o JOIN (
    SELECT f.fold, b, avg(origin) AS p FROM o JOIN (SELECT DISTINCT fold FROM o) f
    ON o.fold <> f.fold GROUP BY 1, 2) USING (fold, b)
"""


@query(
    "adversarial_tree",
    f"""
    SELECT feature, CAST(importance AS DOUBLE) AS importance, round(auc, 9) AS auc,
           auc > 0.65 AS drifting
    FROM (VALUES ('b', 1), ('flat', 0)) v(feature, importance)
    CROSS JOIN (SELECT ({_auc_sql(_ORIGIN_SCORED_SQL, "origin", "p")}) AS auc)
    """,
)
def adversarial_tree(spark, sf):
    days = days_from("o_orderdate")
    rows = table(spark, sf, "orders").select(
        "o_orderkey", (days < -1000).cast("double").alias("b"), F.lit(1.0).alias("flat"),
        (days < -1200).alias("old"),
    )
    auc, drifting, top = M.adversarial(
        rows.filter("old"), rows.filter("NOT old"), ["b", "flat"], "o_orderkey", FOLDS, TREE
    )
    return top.withColumns({"auc": F.lit(round(auc, 9)), "drifting": F.lit(drifting)})



@query(
    "adversarial_top",
    f"""
    SELECT feature, CAST(feature = 'b' AS INTEGER)::DOUBLE AS importance, round(auc, 9) AS auc
    FROM (SELECT 'b' AS feature UNION ALL
          SELECT 'c' || lpad(i::VARCHAR, 2, '0') FROM range(1, 15) t(i)) v
    CROSS JOIN (SELECT ({_auc_sql(_ORIGIN_SCORED_SQL, "origin", "p")}) AS auc)
    """,
)
def adversarial_top(spark, sf):
    """Twenty columns, of which one tells the origin: it and the first fourteen others are kept."""
    days = days_from("o_orderdate")
    names = [f"c{i:02d}" for i in range(19, 0, -1)]
    rows = table(spark, sf, "orders").select(
        "o_orderkey", *[F.lit(float(i)).alias(c) for i, c in enumerate(names)],
        (days < -1000).cast("double").alias("b"), (days < -1200).alias("old"),
    )
    auc, _, top = M.adversarial(
        rows.filter("old"), rows.filter("NOT old"), [*names, "b"], "o_orderkey", FOLDS, TREE
    )
    return top.withColumn("auc", F.lit(round(auc, 9)))


_CHILD_SQL = f"""
  SELECT o_custkey, o_custkey % 2 AS y,
         CAST((o_custkey % 2 + CAST(o_orderkey % 5 = 0 AS INTEGER)) % 2 AS DOUBLE) AS b,
         {_hash_sql("o_custkey", 5)} % 5 = 0 AS unseen
  FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)
"""


@query(
    "child_model_tree",
    f"""
    WITH o AS ({_CHILD_SQL}), parents AS (
      SELECT o_custkey, {_fold_sql("o_custkey", "y", 3)} AS fold
      FROM (SELECT DISTINCT o_custkey, y FROM o WHERE NOT unseen)
    ), seen AS (
      SELECT * FROM o JOIN parents USING (o_custkey)
    ), fits AS (
      SELECT f.fold, b, avg(y) AS p FROM seen JOIN (SELECT DISTINCT fold FROM seen) f
      ON seen.fold <> f.fold GROUP BY 1, 2
    ), rows AS (
      SELECT o_custkey, p FROM seen JOIN fits USING (fold, b)
      UNION ALL
      SELECT o_custkey, q FROM o JOIN (SELECT b, avg(p) AS q FROM fits GROUP BY 1) USING (b)
      WHERE unseen
    )
    SELECT o_custkey, round(avg(p), 9) AS META_MEAN, round(max(p), 9) AS META_MAX,
           round(min(p), 9) AS META_MIN, round(stddev_samp(p), 7) AS META_STD
    FROM rows GROUP BY 1
    """,
)
def child_model_tree(spark, sf):
    flipped = (F.col("o_custkey") % 2 + (F.col("o_orderkey") % 5 == 0).cast("int")) % 2
    child = table(spark, sf, "orders").select("o_custkey", flipped.cast("double").alias("b"))
    parents = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), (F.col("c_custkey") % 2).cast("int").alias("y")
    )
    unseen = hash_fraction(F.col("o_custkey"), 5) % 5 == 0
    metas = M.child_model_meta(
        child, parents.filter(~unseen), parents.filter(unseen), "o_custkey", "y", ["b"], "META",
        TREE, FOLDS,
    )
    names = ["META_MEAN", "META_MAX", "META_MIN"]
    return metas.select("o_custkey", *rounded(9, *names), *rounded(7, "META_STD"))


@query(
    "reconstruct_tree",
    f"""
    WITH o AS ({_PRICED_SQL}), edges AS (
      SELECT quantile_cont(x, 0.5) AS middle FROM o WHERE NOT unseen
    ), known AS (
      SELECT *, {_fold_sql("o_orderkey", "bin", 3)} AS fold
      FROM (SELECT *, x > middle AS bin FROM o, edges WHERE NOT unseen AND x IS NOT NULL)
    ), fits AS (
      SELECT f.fold, b, avg(x) AS p FROM known JOIN (SELECT DISTINCT fold FROM known) f
      ON known.fold <> f.fold GROUP BY 1, 2
    )
    SELECT o_orderkey, round(p, 4) AS PRED_x FROM known JOIN fits USING (fold, b)
    UNION ALL
    SELECT o_orderkey, round(p, 4) FROM o JOIN (SELECT b, avg(x) AS p FROM known GROUP BY 1)
    USING (b) WHERE NOT unseen AND x IS NULL
    UNION ALL
    SELECT o_orderkey, round(avg(p), 4) FROM o JOIN fits USING (b) WHERE unseen GROUP BY 1
    """,
)
def reconstruct_tree(spark, sf):
    rows = settle(_priced(spark, sf))
    on_train, on_test = M.reconstruct(
        rows.filter("NOT unseen"), rows.filter("unseen"), "x", ["b"], "o_orderkey", FOLDS, bins=2,
        min_known=10, maxIter=1, maxDepth=1,
    )
    return on_train.unionByName(on_test).select("o_orderkey", *rounded(4, "PRED_x"))


@query(
    "param_search_tree",
    f"""
    WITH o AS (SELECT *, {_fold_sql("o_orderkey", "y", 3)} AS fold FROM ({_PRICED_SQL})),
    s AS (
      SELECT o.fold, o.y, p FROM o JOIN (
        SELECT f.fold, b, avg(y) AS p FROM o JOIN (SELECT DISTINCT fold FROM o) f
        ON o.fold <> f.fold GROUP BY 1, 2) USING (fold, b)
    ), pairs AS (
      SELECT a.fold, sum(CASE WHEN a.p > z.p THEN 1.0 WHEN a.p = z.p THEN 0.5 ELSE 0 END * a.n * z.n)
               / sum(a.n * z.n) AS auc
      FROM (SELECT fold, p, count(*) AS n FROM s WHERE y = 1 GROUP BY 1, 2) a
      JOIN (SELECT fold, p, count(*) AS n FROM s WHERE y = 0 GROUP BY 1, 2) z USING (fold)
      GROUP BY 1
    )
    SELECT 1 AS trial, fold, round(CAST(auc AS DOUBLE), 9) AS auc, 1 AS best_depth FROM pairs
    UNION ALL
    SELECT 0, fold, 0.5, 1 FROM pairs
    """,
)
def param_search_tree(spark, sf):
    folded = folds.stratified_folds(_priced(spark, sf), "o_orderkey", "y", FOLDS)
    best, trials = M.param_search(
        folded, ["b"], "y", "o_orderkey", M.decision_tree, M.param_grid(maxDepth=[0, 1]), FOLDS
    )
    return trials.select(
        "trial", "fold", *rounded(9, "auc"), F.lit(best["maxDepth"]).alias("best_depth")
    )


@query("oof_scores")
def oof_scores(spark, sf):
    learners = [SMALL_BOOST, SMALL_FOREST, M.Learner("logistic", M.logistic)]
    rows = _folded(spark, sf)
    return M.oof_scores(
        rows, None, SCORES, "y", "doc_id", learners, FOLDS, early_stop_share=0.2
    ).train


@query("adversarial_auc")
def adversarial_auc(spark, sf):
    rows = _order_features(spark, sf)
    old = F.col("days") < -1200
    auc, drifting, top = M.adversarial(
        rows.filter(old), rows.filter(~old), ["o_totalprice", "overdue", "days"], "o_orderkey",
        FOLDS, SMALL_FOREST,
    )
    return top.withColumns({"auc": F.lit(auc), "drifting": F.lit(drifting)})


@query("child_model_meta")
def child_model_meta(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), (F.col("c_acctbal") < 1500).cast("int").alias("y")
    )
    held_back = hash_fraction(F.col("o_custkey"), 5) % 5 == 0
    return M.child_model_meta(
        _order_features(spark, sf),
        customers.filter(~held_back),
        customers.filter(held_back),
        "o_custkey",
        "y",
        ["days", "o_totalprice", "overdue", "status"],
        "META_ORDERS",
        SMALL_FOREST,
        FOLDS,
    )


@query("reconstruct_column")
def reconstruct_column(spark, sf):
    application = settle(credit_tables(spark, sf)["application"])
    test = hash_fraction(F.col(KEY), 5) % 5 == 0
    features = ["EXT_SOURCE_2", "DAYS_BIRTH", "AMT_CREDIT", "AMT_INCOME_TOTAL", "OWN_CAR_AGE"]
    train_rows, test_rows = application.filter(~test), application.filter(test)
    predicted = M.reconstruct(
        train_rows, test_rows, "EXT_SOURCE_3", features, KEY, FOLDS, min_known=50,
        maxIter=5, maxDepth=3,
    )
    both = predicted[0].unionByName(predicted[1])
    out = application.select(KEY, "EXT_SOURCE_3").join(both, KEY, "left")
    return residual(out, "EXT_SOURCE_3", "PRED_EXT_SOURCE_3", "EXT_SOURCE_3_RESIDUAL")


@query("param_search")
def param_search(spark, sf):
    grid = M.param_grid(maxDepth=[2, 4], numTrees=[5, 10])
    best, trials = M.param_search(
        _folded(spark, sf), SCORES, "y", "doc_id", M.random_forest, grid, FOLDS
    )
    return trials.withColumn("best_depth", F.lit(best["maxDepth"]))


@query("stacker_sweep")
def stacker_sweep(spark, sf):
    rows = _folded(spark, sf)
    alphas = (0.1, 1.0, 3.0, 10.0)
    fits = B.fit_ridge(rows, "y", SCORES, alphas)
    tag = lambda kind, x: f"{kind}_{x}".replace(".", "_")
    stacked = {tag("ridge", a): B.ridge_out_of_fold(SCORES, fits[a]) for a in alphas}
    wide = rows.select("doc_id", "y", *[c.alias(n) for n, c in stacked.items()])
    for c in (0.5, 1.0, 2.0):
        fitted = M.logistic_stack(rows, "y", SCORES, "doc_id", c, FOLDS)
        wide = wide.join(
            fitted.select("doc_id", F.col("stacked").alias(tag("logistic", c))), "doc_id"
        )
    names = [c for c in wide.columns if c not in ("doc_id", "y")]
    best, table_of_aucs = B.best_strategy(settle(wide), "y", names)
    return table_of_aucs.withColumn("best", F.lit(best))


@query("credit_evaluation")
def credit_evaluation(spark, sf):
    tables = credit_tables(spark, sf)
    wide = credit.full_features(_cleaned(tables), credit.child_features(tables))
    wide = settle(wide)
    test = hash_fraction(F.col(KEY), 5) % 5 == 0
    result = evaluate(
        wide.filter(~test),
        wide.filter(test).drop(credit.TARGET),
        KEY,
        credit.TARGET,
        credit.TARGET_ENCODED,
        [SMALL_BOOST, SMALL_FOREST],
        {"boosted": 0.65, "forest": 0.35},
        k=FOLDS,
        check_drift=False,
    )
    return result.scores.withColumns(
        {"strategy": F.lit(result.strategy), "selection_auc": F.lit(result.selection_auc)}
    )


def held_out_auc(scored: DataFrame, label: str, score: str) -> float:
    """AUC of one score column as a number, for tests."""
    return roc_auc(scored, label, score).first()["auc"]
