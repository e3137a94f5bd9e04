"""The whole job: files in, features, model evaluation, score file out.

    python -m riskloom.plans.run DATA_DIR OUT_DIR [--fast]
"""

from __future__ import annotations

import logging
import sys
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import session
from riskloom.functions import aggregates, expressions
from riskloom.functions.expressions import guarded_ratio, narrowed
from riskloom.operators import aggregate, clean, folds, joins, ordered
from riskloom.operators import models as M
from riskloom.operators.encode import encode_per_fold
from riskloom.operators.joins import with_group_key
from riskloom.operators.lsh import lsh_target_mean
from riskloom.operators.neighbors import knn_target_mean, vector
from riskloom.plans import credit
from riskloom.plans.evaluation import Evaluation, default_learners, evaluate
from riskloom.session import drop_written, settle
from riskloom.sources import tables as S

log = logging.getLogger("riskloom")

TABLES = [
    "application_train",
    "application_test",
    "bureau",
    "bureau_balance",
    "previous_application",
    "POS_CASH_balance",
    "installments_payments",
    "credit_card_balance",
]
# Child tables that get a row-level model, with the id that is not a feature.
CHILD_MODELS = {
    "bureau": credit.CREDIT,
    "previous_application": credit.LOAN,
    "installments_payments": credit.LOAN,
    "POS_CASH_balance": credit.LOAN,
    "credit_card_balance": credit.LOAN,
    "bureau_balance": credit.CREDIT,
}
NEIGHBOURS = (100, 300, 500)


def _by_buckets(exact: bool):
    return lambda *args, **kwargs: lsh_target_mean(*args, exact=exact, **kwargs).drop("certain")


#: Ways to find neighbours: exact in cells of limited size, whose tree grows with the points; exact
#: in a constant number of buckets; approximate in such buckets, at a recall that was measured.
SEARCHES = {
    "cells": knn_target_mean, "buckets": _by_buckets(True), "approximate": _by_buckets(False)
}


@dataclass(frozen=True)
class Settings:
    """What the two ways of running differ in; ``fast()`` is the short one."""

    folds: int = 5
    seed: int = 42
    rounds: int = 100
    sample: float = 1.0
    neighbours: Sequence[int] = NEIGHBOURS
    neighbour_search: str = "cells"
    child_models: Sequence[str] = ()
    reconstruct: bool = False
    min_known: int = 1000
    search: dict = field(default_factory=dict)
    search_share: float = 1.0
    fold_safe_neighbours: bool = False
    gate_drift: bool = False
    proposed: bool = False
    ridge_alphas: Sequence[float] = ()
    tag: str = "full"

    @classmethod
    def fast(cls) -> Settings:
        return cls(folds=3, rounds=30, sample=0.15, tag="debug")


def load(spark: SparkSession, data_dir: str) -> dict[str, DataFrame]:
    """All tables that exist as Parquet or CSV; a CSV is converted once.

    A file ``schemas.json`` beside them may declare the columns of a CSV, which is then read once.
    """
    found = {}
    schemas = S.declared_schemas(spark, f"{data_dir.rstrip('/')}/schemas.json")
    for name in TABLES:
        stem = f"{data_dir.rstrip('/')}/{name}"
        if S.exists(spark, f"{stem}.csv"):
            found[name] = S.csv_to_parquet(
                spark, f"{stem}.csv", f"{stem}.parquet", schemas.get(name)
            )
        else:
            table = S.optional_table(spark, f"{stem}.parquet")
            if table is not None:
                found[name] = table
    return found


def child_metas(
    tables: dict[str, DataFrame], names: Sequence[str], root: str, settings: Settings
) -> list[DataFrame]:
    """``META_<TABLE>_*`` columns for the named child tables, staged."""
    train = tables["application_train"].select(credit.APPLICANT, credit.TARGET)
    test = tables["application_test"].select(credit.APPLICANT)
    bridge = tables["bureau"].select(credit.CREDIT, credit.APPLICANT)
    metas = []
    for name in names:
        rows = tables[name]
        if name == "bureau_balance":
            rows = with_group_key(rows, bridge, credit.CREDIT, [credit.APPLICANT])
        features = [
            c for c in rows.columns
            if c not in (credit.APPLICANT, credit.TARGET, CHILD_MODELS[name])
        ]

        def build(rows=rows, name=name, features=features):
            learner = M.Learner("row_score", M.boosted_trees, params={"maxIter": settings.rounds})
            return M.child_model_meta(
                rows, train, test, credit.APPLICANT, credit.TARGET, features,
                f"META_{name}".upper(), learner, settings.folds,
            )

        inputs = [tables[name], bridge, train, test]
        metas.append(S.staged(build, root, f"meta_{name}", _fingerprint(settings), inputs))
    return metas


def reconstructions(
    tables: dict[str, DataFrame], settings: Settings
) -> tuple[list[DataFrame], list[DataFrame]]:
    """``PRED_EXT_SOURCE_*`` for both application tables."""
    train, test = tables["application_train"], tables["application_test"]
    features = [
        c for c in credit.RECONSTRUCTION_FEATURES if c in train.columns and c in test.columns
    ]
    pairs = [
        M.reconstruct(train, test, c, features, credit.APPLICANT, settings.folds,
                      min_known=settings.min_known, seed=settings.seed, maxIter=settings.rounds)
        for c in credit.EXT_SOURCES
        if c in train.columns
    ]
    pairs = [p for p in pairs if p is not None]
    return [settle(p[0]) for p in pairs], [settle(p[1]) for p in pairs]


def add_neighbours(
    train: DataFrame,
    test: DataFrame,
    ks: Sequence[int],
    k: int = 0,
    seed: int = 42,
    search: str = "cells",
) -> tuple[DataFrame, DataFrame]:
    """Target means of the nearest applicants, each training row left out of its own mean.

    ``search`` is one of ``SEARCHES``. With ``k`` folds, the ones the evaluation takes, a row sees no label of its own fold.
    """
    key, ratio = credit.APPLICANT, "KNN_CREDIT_ANNUITY_RATIO"
    columns = [c for c in credit.EXT_SOURCES if c in train.columns]
    if not columns:
        return train, test
    credit_per_annuity = guarded_ratio(F.col("AMT_CREDIT"), F.col("AMT_ANNUITY"), credit.EPS)
    known = train.withColumn(ratio, credit_per_annuity)
    medians = clean.fit_medians(known, [*columns, ratio])
    place = vector([*columns, ratio])

    def points(df: DataFrame, *extra) -> DataFrame:
        filled = clean.fill(
            df.withColumn(ratio, credit_per_annuity).withColumns(
                {c: F.col(c).cast("double") for c in columns}
            ),
            medians,
        )
        return filled.select(F.col(key).alias("id"), place.alias("vec"), *extra)

    extra = [F.col(credit.TARGET).alias("y")]
    asked = ["id", "vec"]
    if k:
        train = settle(folds.stratified_folds(train, key, credit.TARGET, k, seed))
        extra, asked = [*extra, "fold"], [*asked, "fold"]
    refs = settle(points(train, *extra))
    train = train.drop("fold") if k else train
    most = refs.count() - 1
    usable = sorted({min(k, most) for k in ks if min(k, most) > 1})
    mean = SEARCHES[search]
    own = mean(refs, refs.select(*asked), usable, exclude="fold" if k else "self")
    other = mean(refs.select("id", "vec", "y"), points(test), usable, exclude=None)
    return (
        train.join(own.withColumnRenamed("id", key), key, "left"),
        test.join(other.withColumnRenamed("id", key), key, "left"),
    )


def _fingerprint(settings: Settings) -> dict[str, object]:
    return {"seed": settings.seed, "sample": settings.sample, "rounds": settings.rounds,
            "folds": settings.folds, "code": S.code_digest(M, clean, folds, aggregate, joins, session, expressions)}


def build_features(
    tables: dict[str, DataFrame], stage_root: str, settings: Settings
) -> tuple[DataFrame, DataFrame]:
    """Train and test at applicant grain with every feature column."""
    train, test = tables["application_train"], tables["application_test"]
    if settings.sample < 1:
        train = folds.hash_sample(train, credit.APPLICANT, settings.sample, settings.seed)
    cap = clean.fit_cap(train, "OWN_CAR_AGE") if "OWN_CAR_AGE" in train.columns else None
    train, test = (credit.clean_application(t, cap) for t in (train, test))
    children = {}
    code = S.code_digest(
        credit, aggregate, clean, ordered, joins, session, aggregates, expressions
    )
    for name, (build, reads) in credit.CHILDREN.items():
        inputs = [tables[t] for t in reads]
        children[name] = S.staged(
            lambda build=build, inputs=inputs: narrowed(build(*inputs)),
            stage_root, name, {"seed": settings.seed, "code": code}, inputs,
        )
    metas = child_metas(tables, settings.child_models, stage_root, settings)
    if settings.proposed:
        metas += credit.proposed_features(tables)
    on_train, on_test = reconstructions(tables, settings) if settings.reconstruct else ([], [])
    return (
        credit.full_features(train, children, [*metas, *on_train]),
        credit.full_features(test, children, [*metas, *on_test]),
    )


def run(
    spark: SparkSession, data_dir: str, out_dir: str, settings: Settings | None = None
) -> Evaluation:
    """Run everything and write ``submission_<run>_<tag>`` with one score per test applicant."""
    settings = settings or Settings()
    run_id = uuid.uuid4().hex
    out_dir = out_dir.rstrip("/")
    tables = load(spark, data_dir)
    train, test = build_features(tables, f"{out_dir}/stages", settings)
    train, test = _counted(train, "train"), _counted(test, "test")
    if settings.gate_drift:
        train, test = gated(train, test, settings)
    if settings.neighbours:
        safe = settings.folds if settings.fold_safe_neighbours else 0
        train, test = add_neighbours(
            train, test, settings.neighbours, safe, settings.seed, settings.neighbour_search
        )
    learners = default_learners(settings.rounds)
    if settings.search:
        learners = tuned(train, settings, learners)
    result = evaluate(
        train, test, credit.APPLICANT, credit.TARGET, credit.TARGET_ENCODED, learners,
        k=settings.folds, seed=settings.seed, ridge_alphas=settings.ridge_alphas,
    )
    S.write_scores(
        result.scores, credit.APPLICANT, "score", f"{out_dir}/submission_{run_id}_{settings.tag}"
    )
    log.info("run %s: %s %.5f", run_id, result.strategy, result.selection_auc)
    return result


def _counted(df: DataFrame, stage: str) -> DataFrame:
    """The stage computed once, its rows, columns and nulls logged on the way."""
    rows, seen = S.watched(df, stage)
    rows = settle(rows)
    found = seen.get
    log.info(
        "%s: %d rows, %d columns, %d nulls", stage, found["rows"], found["columns"], found["nulls"]
    )
    return rows


def gated(
    train: DataFrame, test: DataFrame, settings: Settings
) -> tuple[DataFrame, DataFrame]:
    """Both tables without the numbers that tell them apart and bring a forest little gain."""
    numbers = [
        c for c, kind in train.dtypes
        if kind != "string" and c not in (credit.APPLICANT, credit.TARGET) and c in test.columns
    ]
    folded = folds.stratified_folds(
        train, credit.APPLICANT, credit.TARGET, settings.folds, settings.seed
    )
    scored = M.oof_scores(
        folded, None, numbers, credit.TARGET, credit.APPLICANT,
        [M.Learner("gain", M.random_forest)], settings.folds,
    )
    gate = M.drift_gate(M.column_drift(train, test, numbers), scored.importances)
    gone = [r["feature"] for r in gate.filter("dropped").collect()]
    log.info("drift gate drops %s", gone)
    return train.drop(*gone), test.drop(*gone)


def tuned(train: DataFrame, settings: Settings, learners: list[M.Learner]) -> list[M.Learner]:
    """Learners with the best parameters of their grid; a learner without a grid stays as it is."""
    numbers = [
        c for c, kind in train.dtypes
        if kind != "string" and c not in (credit.APPLICANT, credit.TARGET)
    ]
    rows = train
    if settings.search_share < 1:
        rows = folds.stratified_sample(
            train, credit.APPLICANT, credit.TARGET, settings.search_share, settings.seed
        )
    folded = folds.stratified_folds(
        rows, credit.APPLICANT, credit.TARGET, settings.folds, settings.seed
    )
    text = [c for c in credit.TARGET_ENCODED if c in train.columns]
    encoded = encode_per_fold(folded, text, credit.TARGET, settings.folds)
    features = numbers + [f"{c}_TE" for c in text]
    out = []
    for learner in learners:
        choices = settings.search.get(learner.name)
        if choices:
            grid = [{**learner.params, **p} for p in M.param_grid(**choices)]
            best, _ = M.param_search(
                encoded, features, credit.TARGET, credit.APPLICANT, learner.make, grid,
                settings.folds, settings.seed,
            )
            learner = replace(learner, params=best)
        out.append(learner)
    return out


if __name__ == "__main__":
    arguments = [a for a in sys.argv[1:] if not a.startswith("--")]
    session = SparkSession.builder.appName("riskloom").getOrCreate()
    run(session, arguments[0], arguments[1],
        Settings.fast() if "--fast" in sys.argv else Settings())
    drop_written(session)
