"""Blending and stacking of out-of-fold scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.ordered import auc_by_column, roc_auc
from riskloom.session import settle, shuffle_width

BLOCK = 4_000_000
EXACT_VECTORS = 16


def blend(weights: Mapping[str, float], without: Sequence[str] = ()) -> Column:
    """Weighted sum of score columns; with some left out, the rest is scaled back to weight 1."""
    kept = {c: float(w) for c, w in weights.items() if c not in without}
    scale = sum(kept.values()) if without else 1.0
    return reduce(add, [F.lit(w / scale) * F.col(c) for c, w in kept.items()])


def simplex_weights(wid: int, parts: int, units: int) -> tuple[float, ...]:
    """The weight vector behind an id: its leading entries are the digits of the id."""
    digits = []
    for _ in range(parts - 1):
        wid, digit = divmod(wid, units + 1)
        digits.append(digit)
    lead = digits[::-1]
    return tuple(d / units for d in [*lead, units - sum(lead)])


def _spread(
    df: DataFrame, label: str, scores: Sequence[str], units: int, alive: Sequence[int]
) -> DataFrame:
    """Rows times the ``alive`` grid vectors as ``(wid, y, blended)``.

    Each row becomes many, so the rows are first spread over all tasks.
    """
    rows = df.select(F.col(label).cast("int").alias("y"), *scores).repartition(shuffle_width(df))
    listed = F.split(F.lit(",".join(map(str, alive))), ",").cast("array<bigint>")
    rows = rows.withColumn("wid", F.explode(listed))
    leading, base = range(len(scores) - 1), units + 1
    left, terms = F.lit(units), []
    for j in leading:
        place = F.floor(F.col("wid") / F.lit(base ** (len(leading) - 1 - j)))
        unit = (place % base).cast("int")
        left = left - unit
        terms.append(unit / F.lit(float(units)) * F.col(scores[j]).cast("double"))
    terms.append(left / F.lit(float(units)) * F.col(scores[-1]).cast("double"))
    return rows.select("wid", "y", reduce(add, terms).alias("blended"))


def _vectors(parts: int, units: int) -> np.ndarray:
    """Ids of all grid vectors, in lexicographic order of the vector."""
    lead = [()]
    for _ in range(parts - 1):
        lead = [(*v, u) for v in lead for u in range(units + 1 - sum(v))]
    return np.array([reduce(lambda wid, u: wid * (units + 1) + u, v, 0) for v in lead])


def grid_bounds(
    df: DataFrame,
    label: str,
    scores: Sequence[str],
    units: int,
    bins: int = 256,
    alive: Sequence[int] = (),
) -> DataFrame:
    """``(wid, lower, upper)``: certain limits of each blend's AUC from binned blends.

    A task blends blocks of rows with all vectors (or the ``alive`` ones) and sends on counts, at
    most one row per vector and bin, whatever the table size. Pairs inside one bin count as all
    lost for the lower and all won for the upper limit.
    """
    ends = df.agg(
        F.min(F.least(*scores)).cast("double").alias("lo"),
        F.max(F.greatest(*scores)).cast("double").alias("hi"),
    ).first()
    if ends["lo"] is None:
        return df.sparkSession.createDataFrame([], "wid long, lower double, upper double")
    low, width = ends["lo"], max(ends["hi"] - ends["lo"], 1e-300)
    wids = np.array(alive) if len(alive) else _vectors(len(scores), units)
    weights = np.array([simplex_weights(int(w), len(scores), units) for w in wids])
    block = max(1, BLOCK // len(wids))

    def count(batches):
        counts = [np.zeros((len(wids), bins + 1), np.int64) for _ in range(2)]
        for batch in batches:
            y = batch.column(0).to_numpy()
            values = [batch.column(i + 1).to_numpy() for i in range(weights.shape[1])]
            for start in range(0, len(y), block):
                part = slice(start, start + block)
                # Added in the order of the exact blends, so both round alike.
                blended = weights[:, :1] * values[0][part]
                for j in range(1, len(values)):
                    blended = blended + weights[:, j : j + 1] * values[j][part]
                at = np.floor((blended - low) / width * bins).astype(np.int64)
                at = np.clip(at, 0, bins) + np.arange(len(wids))[:, None] * (bins + 1)
                for n, own in zip(counts, (y[part] == 1, y[part] != 1)):
                    n += np.bincount(at[:, own].ravel(), minlength=n.size).reshape(n.shape)
        vector, place = np.nonzero(counts[0] + counts[1])
        for start in range(0, len(vector), 100_000):
            v, b = vector[start : start + 100_000], place[start : start + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (wids[v], b, counts[0][v, b], counts[1][v, b])],
                names=["wid", "bin", "pos", "neg"],
            )

    rows = df.select(
        F.col(label).cast("int").alias("y"), *[F.col(s).cast("double").alias(s) for s in scores]
    )
    binned = (
        rows.mapInArrow(count, "wid long, bin long, pos long, neg long")
        .groupBy("wid", "bin")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    per_weight = Window.partitionBy("wid")
    below = per_weight.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    big = lambda c: F.col(c).cast("double")
    summed = (
        binned.withColumn("before", F.coalesce(F.sum("neg").over(below), F.lit(0)))
        .groupBy("wid")
        .agg(
            F.sum(big("pos") * big("before")).alias("won"),
            F.sum(big("pos") * big("neg")).alias("open"),
            F.sum("pos").alias("p"),
            F.sum("neg").alias("n"),
        )
    )
    pairs = big("p") * big("n")
    return summed.select(
        "wid",
        (F.col("won") / pairs).alias("lower"),
        ((F.col("won") + F.col("open")) / pairs).alias("upper"),
    )


def simplex_blend(
    df: DataFrame, label: str, scores: Sequence[str], step: float = 0.05, bins: int = 256
) -> tuple[dict[str, float], float]:
    """The grid's best weights and their exact AUC; the first vector wins a tie.

    Binned limits rule out every vector that cannot win. While more than a few remain, they are
    binned more finely; the last ones are scored exactly.
    """
    units = round(1 / step)
    known = settle(df.select(label, *scores).dropna())
    alive: list[int] = []
    for finer in (bins, 32 * bins):
        limits = grid_bounds(known, label, scores, units, finer, alive).collect()
        floor = max(r["lower"] for r in limits) - 1e-12
        alive = sorted(r["wid"] for r in limits if r["upper"] >= floor)
        if len(alive) <= EXACT_VECTORS:
            break
    exact = roc_auc(_spread(known, label, scores, units, alive), "y", "blended", by=["wid"])
    best = exact.orderBy(F.desc("auc"), "wid").first()
    return dict(zip(scores, simplex_weights(best["wid"], len(scores), units))), best["auc"]


def gram(df: DataFrame, label: str, scores: Sequence[str], fold: str = "fold") -> DataFrame:
    """Per fold: row count and all sums and product sums of scores and label."""
    names = [*scores, label]
    value = {n: F.col(n).cast("double") for n in names}
    sums = [F.count("*").alias("n")] + [F.sum(value[n]).alias(f"s_{n}") for n in names]
    sums += [
        F.sum(value[a] * value[b]).alias(f"p_{a}_{b}")
        for i, a in enumerate(names)
        for b in names[i:]
    ]
    return df.groupBy(fold).agg(*sums)


def _solve(sums: dict[str, float], label: str, scores: Sequence[str], alpha: float):
    n = sums["n"]
    mean = np.array([sums[f"s_{s}"] / n for s in scores])
    y_mean = sums[f"s_{label}"] / n
    xx = np.array(
        [
            [sums[f"p_{a}_{b}"] if f"p_{a}_{b}" in sums else sums[f"p_{b}_{a}"] for b in scores]
            for a in scores
        ]
    ) - n * np.outer(mean, mean)
    xy = np.array([sums[f"p_{s}_{label}"] for s in scores]) - n * mean * y_mean
    slope = np.linalg.solve(xx + alpha * np.eye(len(scores)), xy)
    return slope, float(y_mean - mean @ slope)


def fit_ridge(
    df: DataFrame,
    label: str,
    scores: Sequence[str],
    alphas: Sequence[float] = (1.0,),
    fold: str = "fold",
) -> dict[float, dict]:
    """Ridge weights for every alpha from one pass: per held-out fold, and ``None`` for all rows.

    Only the per-fold sums (a few numbers per fold) reach the driver. The intercept is unpenalised.
    """
    parts = {r[fold]: {k: float(v) for k, v in r.asDict().items() if k != fold} for r in
             gram(df, label, scores, fold).collect()}
    keys = next(iter(parts.values())).keys()
    whole = {k: sum(p[k] for p in parts.values()) for k in keys}
    fits = {}
    for alpha in alphas:
        fits[alpha] = {
            f: _solve({k: whole[k] - p[k] for k in keys}, label, scores, alpha)
            for f, p in parts.items()
        }
        fits[alpha][None] = _solve(whole, label, scores, alpha)
    return fits


def _linear(scores: Sequence[str], fit) -> Column:
    slope, intercept = fit
    return reduce(
        add, [F.lit(float(w)) * F.col(s) for s, w in zip(scores, slope)], F.lit(intercept)
    )


def ridge_out_of_fold(scores: Sequence[str], fits: dict, fold: str = "fold") -> Column:
    """Stacked score of a training row from the fit that has not seen its fold."""
    chain = None
    for f, fit in fits.items():
        if f is not None:
            step = F.when if chain is None else chain.when
            chain = step(F.col(fold) == f, _linear(scores, fit))
    return chain


def ridge_full(scores: Sequence[str], fits: dict) -> Column:
    """Stacked score of a row without a label."""
    return _linear(scores, fits[None])


def best_strategy(df: DataFrame, label: str, strategies: Sequence[str]) -> tuple[str, DataFrame]:
    """The strategy column with the highest AUC (the first one wins a tie) and the AUC table.

    The AUC is the one the choice was made by, so it is a selection score.
    """
    order = {s: i for i, s in enumerate(strategies)}
    table = auc_by_column(df, label, strategies)
    rows = sorted(table.collect(), key=lambda r: (-r["auc"], order[r["name"]]))
    return rows[0]["name"], table


def zero_in_all_folds(importances: DataFrame, n_folds: int) -> DataFrame:
    """Features whose importance is zero in every fold, from ``(feature, fold, importance)``."""
    return (
        importances.filter(F.col("importance") == 0)
        .groupBy("feature")
        .agg(F.count("*").alias("n_zero"))
        .filter(F.col("n_zero") == n_folds)
    )
