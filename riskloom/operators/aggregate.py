"""Child tables brought to the grain of their parent."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import aggregates as A
from riskloom.operators.ordered import nearest_quantile


def to_parent(df: DataFrame, key: str | Sequence[str], specs: Mapping[str, Column]) -> DataFrame:
    """One row per key, one column per spec, in a single pass with map-side partial sums."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(*[spec.alias(name) for name, spec in specs.items()])


def left_onto(parent: DataFrame, *children: DataFrame, on: str) -> DataFrame:
    """Left-join aggregates that hold one row per key; parents without children get nulls."""
    for child in children:
        parent = parent.join(child, on, "left")
    return parent


def version_counts(df: DataFrame, keys: str | Sequence[str], version: str) -> DataFrame:
    """``(keys..., n_versions)``: distinct versions per loan, null being a version of its own."""
    return to_parent(df, keys, {"n_versions": A.distinct_with_null(F.col(version))})


def restructured_share(versions: DataFrame, parent: str, more_than: int = 2) -> DataFrame:
    """``(parent, n_restructured, restructured_frac)`` over loans with their version counts."""
    many = A.flag(F.col("n_versions") > more_than)
    return to_parent(
        versions, parent, {"n_restructured": A.total(many), "restructured_frac": A.mean(many)}
    )


def restructured(
    df: DataFrame, loan: str, parent: str, version: str, more_than: int = 2
) -> DataFrame:
    """Both steps for rows that carry the loan and its parent."""
    return restructured_share(version_counts(df, [loan, parent], version), parent, more_than)


def quantile_by_parent(
    df: DataFrame, key: str, value: str, q: float, out: str, where: Column | None = None
) -> DataFrame:
    """Nearest-rank quantile per key over the rows that satisfy ``where``."""
    return nearest_quantile(df if where is None else df.filter(where), value, q, out, [key])


def status_pivot(
    df: DataFrame, key: str, status: str, names: Mapping[str, str], where: Column | None = None
) -> DataFrame:
    """Counts per listed status as columns, 0 where a key has none of a status.

    The statuses are known, so the pivot is one aggregation with map-side partial counts.
    """
    rows = df if where is None else df.filter(where)
    return to_parent(
        rows, key, {out: A.tally(F.col(status) == name) for name, out in names.items()}
    )


def mean_of_means(df: DataFrame, inner: str, outer: str, value: Column, out: str) -> DataFrame:
    """Mean per inner key, then the mean of those means per outer key."""
    per_inner = to_parent(df, [outer, inner], {"m": A.mean(value)})
    return to_parent(per_inner, outer, {out: A.mean(F.col("m"))})


def weighted_mean(value: Column, weight: Column, where: Column | None = None) -> Column:
    """``sum(w * x) / sum(w)`` over rows with a known value, for use in ``to_parent``."""
    known = F.when(value.isNotNull(), weight)
    kept = lambda c: c if where is None else F.when(where, c)
    return F.try_divide(F.sum(kept(value * weight)), F.sum(kept(known)))
