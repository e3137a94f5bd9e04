"""Smoothed target encoding, over the whole table or out of fold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.joins import attach
from riskloom.session import settle

ALPHA = 10.0


def target_mean(df: DataFrame, label: str) -> float:
    """The mean label of all rows (one number); every map smooths towards it."""
    return df.agg(F.avg(F.col(label).cast("double"))).first()[0]


def _cells(df: DataFrame, columns: Sequence[str], label: str, extra: Sequence[str]) -> DataFrame:
    """Label sums and counts for all columns at once; null categories are left out."""
    named = F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("cat")) for c in columns]
    )
    return (
        df.select(*extra, F.col(label).cast("double").alias("_y"), F.explode(named).alias("c"))
        .select(*extra, "_y", "c.name", "c.cat")
        .filter(F.col("cat").isNotNull())
        .groupBy("name", "cat", *extra)
        .agg(F.sum("_y").alias("s"), F.count("_y").alias("n"))
    )


def full_map(
    df: DataFrame, columns: Sequence[str], label: str, mu: float, alpha: float = ALPHA
) -> DataFrame:
    """``(name, cat, te)`` from all labels: the encoding for rows without a label."""
    smoothed = (F.col("s") + alpha * mu) / (F.col("n") + alpha)
    return _cells(df, columns, label, []).select("name", "cat", smoothed.alias("te"))


def fold_map(
    df: DataFrame,
    columns: Sequence[str],
    label: str,
    mu: float,
    k: int,
    alpha: float = ALPHA,
    fold: str = "fold",
) -> DataFrame:
    """``(name, cat, fold, te)``: the encoding of a category without the labels of a fold.

    Holds every category for every fold, so it serves both the held-out rows of a fold and the
    rows the fold's model is trained on.
    """
    cells = _cells(df, columns, label, [fold])
    totals = cells.groupBy("name", "cat").agg(
        F.sum("s").alias("S"),
        F.sum("n").alias("N"),
        F.collect_list(F.struct(F.col(fold).alias("f"), "s", "n")).alias("own"),
    )
    spread = totals.withColumn(fold, F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    mine = F.filter("own", lambda o: o["f"] == F.col(fold))
    own_s = F.coalesce(F.get(mine, F.lit(0))["s"], F.lit(0.0))
    own_n = F.coalesce(F.get(mine, F.lit(0))["n"], F.lit(0))
    te = (F.col("S") - own_s + alpha * mu) / (F.col("N") - own_n + alpha)
    return spread.select("name", "cat", F.col(fold).cast("int").alias(fold), te.alias("te"))


def encode(
    df: DataFrame,
    te_map: DataFrame,
    columns: Sequence[str],
    mu: float | Column,
    on_fold: str | None = None,
    keep: bool = False,
) -> DataFrame:
    """Replace each column by ``<column>_TE``; null and unseen categories get ``mu``."""
    out, te_map = df, settle(te_map)
    unknown = mu if isinstance(mu, Column) else F.lit(mu)
    for c in columns:
        part = te_map.filter(F.col("name") == c).select(
            F.col("cat").alias(f"_{c}"),
            *([F.col(on_fold)] if on_fold else []),
            F.col("te").alias(f"{c}_TE"),
        )
        on = [f"_{c}"] + ([on_fold] if on_fold else [])
        out = attach(out.withColumn(f"_{c}", F.col(c).cast("string")), part, on, settled=True)
        out = out.withColumn(f"{c}_TE", F.coalesce(f"{c}_TE", unknown)).drop(f"_{c}")
    return out if keep else out.drop(*columns)


def encode_out_of_fold(
    df: DataFrame,
    columns: Sequence[str],
    label: str,
    k: int = 5,
    alpha: float = ALPHA,
    keep: bool = False,
) -> DataFrame:
    """Encode training rows so that no row sees a label of its own fold."""
    mu = target_mean(df, label)
    return encode(df, fold_map(df, columns, label, mu, k, alpha), columns, mu, "fold", keep)


def encode_per_fold(
    df: DataFrame, columns: Sequence[str], label: str, k: int = 5, alpha: float = ALPHA
) -> DataFrame:
    """Add ``<column>_TE`` arrays: element ``f`` is the encoding without the labels of fold ``f``.

    The model of fold ``f`` takes that element for the rows it is fitted on and for the rows it
    scores, so no label of its held-out fold is in its features.
    """
    mu = target_mean(df, label)
    by_fold = F.array_sort(F.collect_list(F.struct("fold", "te")))
    maps = (
        fold_map(df, columns, label, mu, k, alpha)
        .groupBy("name", "cat")
        .agg(F.transform(by_fold, lambda s: s["te"]).alias("te"))
    )
    return encode(df, maps, columns, F.array(*[F.lit(mu)] * k), keep=True)


def encode_full(
    train: DataFrame,
    target: DataFrame,
    columns: Sequence[str],
    label: str,
    alpha: float = ALPHA,
    keep: bool = False,
) -> DataFrame:
    """Encode ``target`` with the maps of all training labels."""
    mu = target_mean(train, label)
    return encode(target, full_map(train, columns, label, mu, alpha), columns, mu, None, keep)
