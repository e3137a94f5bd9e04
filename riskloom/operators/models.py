"""Out-of-fold scoring and what is built on it, with ``pyspark.ml`` learners.

Rows stay in DataFrames throughout. A fold's model is fitted on the other folds; held-out rows are
scored once, by the model that has not seen them.
"""

from __future__ import annotations

import itertools
import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool
from operator import add

from pyspark.ml import Estimator
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.expressions import hash_fraction
from riskloom.operators import clean, folds
from riskloom.operators.aggregate import to_parent
from riskloom.operators.joins import attach, only_members
from riskloom.operators.ordered import auc_by_column, roc_auc
from riskloom.session import settle

log = logging.getLogger("riskloom")

# Marker for a missing number, seeds of the seed ensemble, drift threshold.
MISSING = -999.0
SEEDS = (42, 2024)
DRIFT_AUC = 0.65

FEATURES = "_features"


def boosted_trees(seed: int, **params) -> Estimator:
    """Gradient-boosted trees; ``early_stop`` names a 0/1 column of rows kept for validation."""
    early = params.pop("early_stop", None)
    settings = {"maxIter": 20, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.8} | params
    model = GBTClassifier(seed=seed, featuresCol=FEATURES, **settings)
    return model.setValidationIndicatorCol(early) if early else model


def random_forest(seed: int, **params) -> Estimator:
    settings = {"numTrees": 20, "maxDepth": 5} | params
    return RandomForestClassifier(seed=seed, featuresCol=FEATURES, **settings)


def decision_tree(seed: int, **params) -> Estimator:
    return DecisionTreeClassifier(seed=seed, featuresCol=FEATURES, **params)


def logistic(seed: int = 0, **params) -> Estimator:
    return LogisticRegression(featuresCol=FEATURES, **params)


@dataclass(frozen=True)
class Learner:
    """A named learner; several seeds make a seed ensemble whose scores are averaged."""

    name: str
    make: Callable[..., Estimator]
    seeds: Sequence[int] = (42,)
    params: Mapping[str, object] = field(default_factory=dict)


def assemble(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep`` plus the features as ``_numbers``; null, NaN and infinities become the marker.

    Array columns hold one value per fold and go to ``_by_fold``; ``vectors`` picks theirs.
    """
    arrays = {f.name for f in df.schema if f.dataType.typeName() == "array"}
    one = [F.coalesce(clean.finite(F.col(c)), F.lit(MISSING)) for c in features if c not in arrays]
    many = [F.col(c) for c in features if c in arrays]
    return df.select(
        *keep,
        (F.array(*one) if one else F.array().cast("array<double>")).alias("_numbers"),
        (F.array(*many) if many else F.array().cast("array<array<double>>")).alias("_by_fold"),
    )


def feature_order(df: DataFrame, features: Sequence[str]) -> list[str]:
    """The features in the order ``vectors`` puts them: plain ones, then one-per-fold ones."""
    arrays = {f.name for f in df.schema if f.dataType.typeName() == "array"}
    return [c for c in features if c not in arrays] + [c for c in features if c in arrays]


def vectors(df: DataFrame, fold: int = 0) -> DataFrame:
    """The assembled rows with the feature vector that the model of a fold sees."""
    mine = F.transform("_by_fold", lambda values: F.get(values, F.lit(fold)))
    return df.withColumn(FEATURES, array_to_vector(F.concat("_numbers", mine))).drop(
        "_numbers", "_by_fold"
    )


def positive_probability(model, df: DataFrame, out: str) -> DataFrame:
    """Add the probability of label 1 and drop the other outputs of the model.

    A training summary is cut off first: it holds the session and the training rows, and would be
    shipped with every scoring task.
    """
    if getattr(model, "hasSummary", False):
        model._java_obj.setSummary(df.sparkSession.sparkContext._jvm.scala.Option.empty())
    scored = model.transform(df)
    added = [c for c in scored.columns if c not in df.columns]
    return scored.withColumn(out, vector_to_array("probability")[1]).drop(*added)


def _importances(model, features: Sequence[str]) -> list[float]:
    if hasattr(model, "featureImportances"):
        return [float(v) for v in model.featureImportances.toArray()]
    return [abs(float(v)) for v in model.coefficients.toArray()]


@dataclass
class OutOfFold:
    """Held-out scores per training row, averaged scores per test row, importances per fold."""

    train: DataFrame
    test: DataFrame | None
    importances: DataFrame


def oof_scores(
    train: DataFrame,
    test: DataFrame | None,
    features: Sequence[str] | Mapping[str, Sequence[str]],
    label: str,
    key: str,
    learners: Sequence[Learner],
    k: int = 5,
    early_stop_share: float = 0.0,
    parallel: int = 4,
) -> OutOfFold:
    """Score every training row out of fold and every test row with the mean over folds.

    ``train`` carries ``fold``; ``features`` may differ per learner. With ``early_stop_share`` the
    boosted learners stop on rows taken from the training folds, never on the held-out fold. Fits
    of one learner run side by side.
    """
    per_learner = features if isinstance(features, Mapping) else {x.name: features for x in learners}
    spark = train.sparkSession
    train_out = train.select(key, label, "fold")
    test_out = None if test is None else test.select(key)
    importances = []
    for learner in learners:
        columns = feature_order(train, per_learner[learner.name])
        matrix = assemble(train.withColumn(label, F.col(label).cast("double")),
                          columns, [key, label, "fold"])
        if early_stop_share:
            inner = hash_fraction(F.col(key), 17) < F.lit(int(early_stop_share * 16**8))
            matrix = matrix.withColumn("_stop", inner)
        matrix = settle(matrix)
        unseen = None if test is None else settle(vectors(assemble(test, columns, [key])))
        params = dict(learner.params)
        if early_stop_share and learner.make is boosted_trees:
            params["early_stop"] = "_stop"

        def fitted(task: tuple[int, int]):
            fold, seed = task
            fit_rows = vectors(matrix, fold).filter(F.col("fold") != fold)
            return learner.make(seed=seed, labelCol=label, **params).fit(fit_rows)

        tasks = [(fold, seed) for fold in range(k) for seed in learner.seeds]
        models = dict(zip(tasks, side_by_side(fitted, tasks, parallel)))
        held_out, test_columns = [], []
        for fold in range(k):
            rest = vectors(matrix, fold).filter(F.col("fold") == fold).select(key, FEATURES)
            names = []
            for seed in learner.seeds:
                name = f"_p_{fold}_{seed}"
                rest = positive_probability(models[fold, seed], rest, name)
                if unseen is not None:
                    unseen = positive_probability(models[fold, seed], unseen, name)
                names.append(name)
            importances += [
                (learner.name, fold, c, v)
                for c, v in zip(columns, _importances(models[fold, learner.seeds[0]], columns))
            ]
            test_columns += names
            held_out.append(rest.select(key, _mean_of(names).alias(learner.name)))
        scored = reduce(DataFrame.unionByName, held_out)
        train_out = train_out.join(scored, key, "left")
        if unseen is not None:
            test_out = test_out.join(
                unseen.select(key, _mean_of(test_columns).alias(learner.name)), key, "left"
            )
    table = spark.createDataFrame(
        importances, "learner string, fold int, feature string, importance double"
    )
    return OutOfFold(settle(train_out), test_out and settle(test_out), table)


def side_by_side(fit: Callable, tasks: Sequence, parallel: int = 4) -> list:
    """The results of ``fit`` in the order of ``tasks``, a few at a time."""
    with ThreadPool(max(1, min(parallel, len(tasks)))) as pool:
        return pool.map(fit, tasks)


def _mean_of(names: Sequence[str]) -> Column:
    return reduce(add, [F.col(n) for n in names]) / len(names)


def adversarial(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    key: str,
    k: int = 5,
    learner: Learner | None = None,
    top: int = 15,
    threshold: float = DRIFT_AUC,
) -> tuple[float, bool, DataFrame]:
    """How well train and test rows can be told apart: AUC, drift flag, strongest columns."""
    learner = learner or Learner("p_test", boosted_trees)
    both = (
        train.select(key, *features)
        .withColumn("origin", F.lit(0))
        .unionByName(
            test.select(key, *features).withColumn("origin", F.lit(1)), allowMissingColumns=True
        )
        .withColumn("_row", F.concat_ws(":", "origin", key))
    )
    folded = folds.stratified_folds(both, "_row", "origin", k)
    scored = oof_scores(folded, None, features, "origin", "_row", [learner], k)
    auc = roc_auc(scored.train, "origin", learner.name).first()["auc"]
    strongest = (
        scored.importances.groupBy("feature")
        .agg((F.sum("importance") / k).alias("importance"))
        .orderBy(F.desc("importance"), "feature")
        .limit(top)
    )
    return auc, auc > threshold, strongest


def column_drift(train: DataFrame, test: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(name, auc, ...)``: how well one raw column alone tells test rows from train rows."""
    both = (
        train.select(*columns)
        .withColumn("origin", F.lit(0))
        .unionByName(
            test.select(*columns).withColumn("origin", F.lit(1)), allowMissingColumns=True
        )
    )
    return auc_by_column(both, "origin", columns)


def drift_gate(
    drift: DataFrame, importances: DataFrame, threshold: float = DRIFT_AUC, min_gain: float = 0.01
) -> DataFrame:
    """``(feature, drift, gain, dropped)``: drop what drifts and brings little gain."""
    gain = importances.groupBy("feature").agg(F.avg("importance").alias("gain"))
    rows = drift.select(
        F.col("name").alias("feature"), F.greatest("auc", 1 - F.col("auc")).alias("drift")
    )
    joined = rows.join(gain, "feature", "left").withColumn("gain", F.coalesce("gain", F.lit(0.0)))
    dropped = (F.col("drift") > threshold) & (F.col("gain") < min_gain)
    return joined.withColumn("dropped", dropped)


def child_model_meta(
    child: DataFrame,
    train_parents: DataFrame,
    test_parents: DataFrame,
    key: str,
    label: str,
    features: Sequence[str],
    prefix: str,
    learner: Learner | None = None,
    k: int = 5,
) -> DataFrame:
    """Row scores of a child table under the parent's label, as mean, max, min, std per parent.

    ``train_parents`` has ``key, label``; all child rows of a parent share a fold. Text features
    are coded by the order of the training values.
    """
    learner = learner or Learner("row_score", boosted_trees)
    text = [c for c, kind in child.select(*features).dtypes if kind == "string"]
    child = child.select(key, *features)
    train = attach(child, train_parents.select(key, label), [key], "inner")
    test = only_members(child, test_parents, key)
    for c in text:
        codes = clean.category_codes(train, c, f"{c}_code")
        train = clean.index_category(train, codes, c, f"{c}_code")
        test = clean.index_category(test, codes, c, f"{c}_code")
    columns = [f"{c}_code" if c in text else c for c in features]
    grouped = folds.group_folds(train, key, label, k)
    matrix = settle(
        vectors(
            assemble(grouped.withColumn(label, F.col(label).cast("double")), columns,
                     [key, label, "fold"])
        )
    )
    unseen = vectors(assemble(test, columns, [key]))
    models = side_by_side(
        lambda fold: learner.make(seed=learner.seeds[0], labelCol=label, **learner.params).fit(
            matrix.filter(F.col("fold") != fold)
        ),
        range(k),
    )
    parts, names = [], []
    for fold, model in enumerate(models):
        held_out = matrix.filter(F.col("fold") == fold)
        parts.append(positive_probability(model, held_out, "_p").select(key, "_p"))
        unseen = positive_probability(model, unseen, f"_p{fold}")
        names.append(f"_p{fold}")
    scored = reduce(DataFrame.unionByName, parts).unionByName(
        unseen.select(key, _mean_of(names).alias("_p"))
    )
    p = F.col("_p")
    stats = {"MEAN": F.avg(p), "MAX": F.max(p), "MIN": F.min(p), "STD": F.stddev_samp(p)}
    return to_parent(scored, key, {f"{prefix}_{n}": c for n, c in stats.items()})


def reconstruct(
    train: DataFrame,
    test: DataFrame,
    column: str,
    features: Sequence[str],
    key: str,
    k: int = 5,
    bins: int = 10,
    min_known: int = 1000,
    seed: int = 42,
    **params,
) -> tuple[DataFrame, DataFrame] | None:
    """``PRED_<column>`` for both tables: out of fold where known, by a full model where missing.

    Folds are stratified by quantile bin. Test rows get the mean over folds. With fewer than
    ``min_known`` known values there is no reconstruction.
    """
    known = train.filter(F.col(column).isNotNull())
    held = known.limit(min_known).count()
    if held < min_known:
        log.warning("%s is not reconstructed: %d known values of %d", column, held, min_known)
        return None
    out = f"PRED_{column}"
    settings = {"maxIter": 20, "maxDepth": 5, "stepSize": 0.1} | params
    learn = lambda: GBTRegressor(
        seed=seed, featuresCol=FEATURES, labelCol="_y", predictionCol="_p", **settings
    )
    edges = clean.fit_bins(known, [column], bins)[column]
    binned = known.withColumn("_bin", clean.bin_of(F.col(column), edges))
    folded = folds.stratified_folds(binned, key, "_bin", k, seed)
    target = F.col(column).cast("double")
    matrix = settle(
        vectors(assemble(folded.withColumn("_y", target), features, [key, "_y", "fold"]))
    )
    missing = vectors(assemble(train.filter(F.col(column).isNull()), features, [key]))
    unseen = vectors(assemble(test, features, [key]))
    # The last model is of all known rows.
    *models, full = side_by_side(
        lambda fold: learn().fit(matrix.filter(F.col("fold") != fold)), range(k + 1)
    )
    parts, names = [], []
    for fold, model in enumerate(models):
        held_out = matrix.filter(F.col("fold") == fold)
        parts.append(model.transform(held_out).select(key, F.col("_p").alias(out)))
        unseen = model.transform(unseen).withColumnRenamed("_p", f"_p{fold}")
        names.append(f"_p{fold}")
    parts.append(full.transform(missing).select(key, F.col("_p").alias(out)))
    return (
        reduce(DataFrame.unionByName, parts),
        unseen.select(key, _mean_of(names).alias(out)),
    )


def param_grid(**choices: Sequence) -> list[dict]:
    """All combinations of the listed values."""
    names = list(choices)
    return [dict(zip(names, values)) for values in itertools.product(*choices.values())]


def param_search(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    make: Callable[..., Estimator],
    grid: Sequence[Mapping[str, object]],
    k: int = 5,
    seed: int = 42,
    parallel: int = 4,
) -> tuple[dict, DataFrame]:
    """Best parameters by fold-mean AUC, and ``(trial, fold, auc, ...)`` for all trials.

    ``train`` carries ``fold`` and fold-safe features. Fits run side by side; all trials and folds
    are scored by one AUC job.
    """
    matrix = settle(assemble(train.withColumn(label, F.col(label).cast("double")), features,
                             [key, label, "fold"]))

    def one(task: tuple[int, int]) -> DataFrame:
        trial, fold = task
        seen = vectors(matrix, fold)
        model = make(seed=seed, labelCol=label, **grid[trial]).fit(
            seen.filter(F.col("fold") != fold)
        )
        held_out = seen.filter(F.col("fold") == fold)
        return positive_probability(model, held_out, "score").select(
            F.lit(trial).alias("trial"), "fold", label, "score"
        )

    tasks = [(t, f) for t in range(len(grid)) for f in range(k)]
    with ThreadPool(parallel) as pool:
        scored = reduce(DataFrame.unionByName, pool.map(one, tasks))
    table = settle(roc_auc(scored, label, "score", by=["trial", "fold"]))
    best = table.groupBy("trial").agg(F.avg("auc").alias("auc")).orderBy(F.desc("auc"), "trial")
    return dict(grid[best.first()["trial"]]), table


def logistic_stack(
    train: DataFrame, label: str, scores: Sequence[str], key: str, inverse_reg: float, k: int
) -> DataFrame:
    """``(key, label, stacked)``: cross-fitted logistic stacker over score columns."""
    n = train.count()
    learner = Learner(
        "stacked", logistic, params={"regParam": 1.0 / (inverse_reg * n), "standardization": False}
    )
    return oof_scores(train, None, scores, label, key, [learner], k).train
