"""Drift check, out-of-fold learners, blends, stackers and the choice among them."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import blend as B
from riskloom.operators import clean, encode, folds
from riskloom.operators import models as M
from riskloom.operators.ordered import rank_normalize
from riskloom.session import settle

log = logging.getLogger("riskloom")

# Blend weights, grid step and ridge strength.
WEIGHTS = {"boosted": 0.65, "forest": 0.15, "boosted_deep": 0.20}
GRID_STEP = 0.05
RIDGE_ALPHA = 1.0


def default_learners(rounds: int = 20) -> list[M.Learner]:
    """Two boosted learners on encoded categories and a forest on category codes."""
    return [
        M.Learner("boosted", M.boosted_trees, M.SEEDS, {"maxIter": rounds, "maxDepth": 5}),
        M.Learner("forest", M.random_forest, (42,), {"numTrees": rounds, "maxDepth": 8}),
        M.Learner("boosted_deep", M.boosted_trees, (42,), {"maxIter": rounds, "maxDepth": 7}),
    ]


@dataclass
class Evaluation:
    strategy: str
    selection_auc: float
    aucs: DataFrame
    scores: DataFrame
    out_of_fold: DataFrame
    zero_importance: DataFrame
    grid_weights: dict[str, float] = field(default_factory=dict)
    drift_auc: float | None = None
    drift_columns: DataFrame | None = None


def evaluate(
    train: DataFrame,
    test: DataFrame,
    key: str,
    label: str,
    encoded: Sequence[str] = (),
    learners: Sequence[M.Learner] | None = None,
    weights: Mapping[str, float] | None = None,
    without: Sequence[str] = (),
    k: int = 5,
    seed: int = 42,
    check_drift: bool = True,
    early_stop_share: float = 0.1,
    ridge_alphas: Sequence[float] = (),
) -> Evaluation:
    """Score ``train`` out of fold and ``test`` by the best of five strategies.

    ``encoded`` text columns are target-encoded for the boosted learners; the forest sees category
    codes of all text columns. ``without`` leaves learners out of every blend; the static weights
    are then scaled back to 1 and the grid is skipped. ``ridge_alphas`` adds stackers of other
    strengths to the strategies.
    """
    learners = [x for x in (learners or default_learners()) if x.name not in without]
    weights = dict(weights or WEIGHTS)
    names = [x.name for x in learners]

    text = [c for c, kind in train.dtypes if kind == "string" and c not in (key, label)]
    encoded = [c for c in encoded if c in text]
    numbers = [c for c, kind in train.dtypes if kind != "string" and c not in (key, label)]
    train = settle(folds.stratified_folds(train, key, label, k, seed))
    for c in text:
        codes = clean.category_codes(train, c, f"{c}_CODE")
        train = clean.index_category(train, codes, c, f"{c}_CODE")
        test = clean.index_category(test, codes, c, f"{c}_CODE")
    train_matrix = settle(encode.encode_per_fold(train, encoded, label, k))
    test_matrix = settle(encode.encode_full(train, test, encoded, label, keep=True))
    te = [f"{c}_TE" for c in encoded]
    codes = [f"{c}_CODE" for c in text]
    rest = [f"{c}_CODE" for c in text if c not in encoded]
    features = {
        x.name: numbers + (te + rest if x.make is M.boosted_trees else codes) for x in learners
    }

    drift_auc = drift_columns = None
    if check_drift:
        columns = numbers + codes
        drift_auc, drifting, drift_columns = M.adversarial(train, test, columns, key, k)
        log.log(logging.WARNING if drifting else logging.INFO, "drift AUC %.4f", drift_auc)

    oof = M.oof_scores(
        train_matrix, test_matrix, features, label, key, learners, k, early_stop_share
    )
    rows, unseen = rank_normalize(oof.train, names), rank_normalize(oof.test, names)
    ranks = [f"{n}_rank" for n in names]
    ridge = B.fit_ridge(rows, label, names, (RIDGE_ALPHA, *ridge_alphas))
    ridge_rank = B.fit_ridge(rows, label, ranks, (RIDGE_ALPHA, *ridge_alphas))
    kept = {n: w for n, w in weights.items() if n in names}
    scale_back = [n for n in weights if n not in names]
    static = B.blend(weights, scale_back) if scale_back else B.blend(kept)
    rank_weights = {f"{n}_rank": w for n, w in weights.items()}
    static_rank = B.blend(rank_weights, [f"{n}_rank" for n in scale_back])

    on_train = {
        "static": static,
        "static_rank": static_rank,
        "stacked_ridge": B.ridge_out_of_fold(names, ridge[RIDGE_ALPHA]),
        "stacked_ridge_rank": B.ridge_out_of_fold(ranks, ridge_rank[RIDGE_ALPHA]),
    }
    on_test = {
        "static": static,
        "static_rank": static_rank,
        "stacked_ridge": B.ridge_full(names, ridge[RIDGE_ALPHA]),
        "stacked_ridge_rank": B.ridge_full(ranks, ridge_rank[RIDGE_ALPHA]),
    }
    for alpha in ridge_alphas:  # the sweep: one more strategy per strength and scale
        tag = f"{alpha:g}".replace(".", "_")
        for name, on, fits in (("ridge", names, ridge), ("ridge_rank", ranks, ridge_rank)):
            on_train[f"stacked_{name}_{tag}"] = B.ridge_out_of_fold(on, fits[alpha])
            on_test[f"stacked_{name}_{tag}"] = B.ridge_full(on, fits[alpha])
    grid_weights: dict[str, float] = {}
    if not without and len(names) > 1:
        grid_weights, _ = B.simplex_blend(rows, label, names, GRID_STEP)
        on_train["grid_blend"] = on_test["grid_blend"] = B.blend(grid_weights)

    candidates = settle(
        rows.select(key, label, "fold", *names, *[c.alias(s) for s, c in on_train.items()])
    )
    strategy, aucs = B.best_strategy(candidates, label, list(on_train))
    aucs = settle(aucs)
    selection_auc = aucs.filter(F.col("name") == strategy).first()["auc"]
    primary = oof.importances.filter(F.col("learner") == names[0])
    return Evaluation(
        strategy,
        selection_auc,
        aucs,
        unseen.select(key, on_test[strategy].alias("score")),
        candidates,
        B.zero_in_all_folds(primary, k),
        grid_weights,
        drift_auc,
        drift_columns,
    )
