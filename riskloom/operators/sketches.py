"""Quantiles and ranks from mergeable sketches, for tables where exact order costs a shuffle.

A sketch (KLL, after Karnin, Lang and Liberty) is one binary value per group, of a size that depends
on ``k`` and hardly on the rows. Partial sketches are merged on the map side, so a group that holds
most of a table still sends one small value per task, and sketches stored per day or per file can be
merged later without reading the rows again. Up to about ``k`` values a sketch is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 400


def rank_error(k: int = K) -> float:
    """The share of rows by which a rank may be off, in 99 of 100 sketches (a published fit)."""
    return 2.296 / k**0.9723


def quantile_sketches(
    df: DataFrame, value: str, by: Sequence[str] = (), k: int = K
) -> DataFrame:
    """``(by..., sketch, n)`` of the values that are neither null nor NaN, one row per group."""
    number = F.col(value).cast("double")
    kept = df.filter(number.isNotNull() & ~F.isnan(number))
    return kept.groupBy(*by).agg(
        F.kll_sketch_agg_double(number, k).alias("sketch"), F.count("*").alias("n")
    )


def merged(sketches: DataFrame, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """Sketches of finer groups as sketches of ``by``."""
    return sketches.groupBy(*by).agg(
        F.kll_merge_agg_double("sketch", k).alias("sketch"), F.sum("n").alias("n")
    )


def quantiles(sketches: DataFrame, probs: Sequence[float], out: str = "quantiles") -> DataFrame:
    """``sketches`` with the array ``out``: a value of the group near each of ``probs``."""
    asked = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for p in probs]
    return sketches.filter("n > 0").withColumn(out, F.array(*asked)).drop("sketch")


def sketched_quantile(
    df: DataFrame, value: str, q: float, out: str, by: Sequence[str] = (), k: int = K
) -> DataFrame:
    """``(by..., out)``: the approximate form of ``nearest_quantile``; a group without values is
    absent."""
    found = quantiles(quantile_sketches(df, value, by, k), [q], out)
    return found.select(*by, F.get(out, F.lit(0)).alias(out))


def _whole(df: DataFrame, value: str, k: int) -> bytes | None:
    row = quantile_sketches(df, value, (), k).select("sketch", "n").first()
    return bytes(row["sketch"]) if row is not None and row["n"] else None


def sketched_bins(
    df: DataFrame, column: str, bins: int = 10, k: int = K
) -> list[float]:
    """Inner edges of ``bins`` bins of about equal counts, duplicates merged; none for no values."""
    sketch = _whole(df, column, k)
    if sketch is None:
        return []
    probs = [i / bins for i in range(1, bins)]
    one = df.sparkSession.range(1).select(F.lit(sketch).alias("sketch"), F.lit(1).alias("n"))
    return sorted(set(quantiles(one, probs).first()["quantiles"]))


def rank_columns(
    df: DataFrame, scores: Sequence[str], suffix: str = "_rank", k: int = K
) -> DataFrame:
    """Add the approximate percentile rank of each score; a null or NaN score has a null rank.

    One pass makes a sketch per score, from which ``4 * k`` evenly spaced quantiles are read; the
    second looks rows up among them: no shuffle of rows and no join. A rank is the middle of the
    ranks of its ties, off by at most ``rank_error`` and half a step.
    """
    probs = [(i + 0.5) / (4 * k) for i in range(4 * k)]
    ranks = {}
    for s in scores:
        sketch = _whole(df, s, k)
        if sketch is None:
            ranks[s + suffix] = F.lit(None).cast("double")
            continue
        one = df.sparkSession.range(1).select(F.lit(sketch).alias("sketch"), F.lit(1).alias("n"))
        ranks[s + suffix] = _place(np.array(quantiles(one, probs).first()["quantiles"]))(
            F.col(s).cast("double")
        )
    return df.withColumns(ranks)


def _place(ladder: np.ndarray):
    @F.pandas_udf("double")
    def place(values: pd.Series) -> pd.Series:
        x = values.to_numpy(dtype=float, na_value=np.nan)
        sides = [np.searchsorted(ladder, x, side=side) for side in ("left", "right")]
        return pd.Series(np.where(np.isnan(x), np.nan, sum(sides) / (2 * len(ladder)))).where(
            ~np.isnan(x), None
        )

    return place
