"""Cleaning: caps, fills, category codes, bins and column pruning.

Parameters are fitted on one table and applied to any other, as small DataFrames or scalars.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.joins import attach
from riskloom.operators.ordered import linear_quantiles, nearest_quantile, running_totals


def fit_cap(df: DataFrame, column: str, q: float = 0.99) -> float | None:
    """The upper cap: nearest-rank quantile of the whole column (one number)."""
    row = nearest_quantile(df.select(column), column, q, "cap").first()
    return None if row is None else row["cap"]


def apply_cap(df: DataFrame, column: str, cap: float | None) -> DataFrame:
    """Clip from above; nulls stay null."""
    if cap is None:
        return df
    kind = df.schema[column].dataType
    clipped = F.when(F.col(column) > F.lit(cap), F.lit(cap).cast(kind)).otherwise(F.col(column))
    return df.withColumn(column, clipped)


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact medians (interpolated), one number per column."""
    edges = linear_quantiles(df, columns, [0.5])
    return {c: (edges[c][0] if edges[c] else None) for c in columns}


def finite(column: Column) -> Column:
    """NaN and infinities as null."""
    value = column.cast("double")
    endless = F.lit(float("inf"))
    return F.when(~F.isnan(value) & (F.abs(value) != endless), value)


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace null, NaN and infinities in numeric columns, and null in the others."""
    numeric = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    changed = {}
    for c, v in values.items():
        if v is not None and c in df.columns:
            source = finite(F.col(c)) if c in numeric else F.col(c)
            changed[c] = F.coalesce(source, F.lit(v))
    return df.withColumns(changed) if changed else df


def category_codes(df: DataFrame, column: str, out: str) -> DataFrame:
    """``(column, out)``: distinct values in sorted order, numbered from 0; null has no code."""
    values = (
        df.filter(F.col(column).isNotNull()).select(column).distinct().withColumn("n", F.lit(1))
    )
    ranked = running_totals(values, [column], ["n"])
    return ranked.select(column, F.col("n_before").cast("int").alias(out))


def index_category(df: DataFrame, codes: DataFrame, column: str, out: str) -> DataFrame:
    """Attach fitted codes; null and unseen values get -1."""
    return attach(df, codes, [column]).withColumn(out, F.coalesce(out, F.lit(-1)))


def prune(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the listed columns; absent names are ignored."""
    return df.drop(*[n for n in names if n in df.columns])


def fit_bins(df: DataFrame, columns: Sequence[str], bins: int = 10) -> dict[str, list[float]]:
    """Distinct interpolated quantile edges per column, at most ``bins + 1`` numbers each."""
    probs = [i / bins for i in range(bins + 1)]
    edges = linear_quantiles(df, columns, probs)
    return {c: sorted(set(edges[c])) for c in columns}


def bin_of(column: Column, edges: Sequence[float]) -> Column:
    """Right-closed bin number, the lowest edge included in bin 0; null outside and for null."""
    inner = edges[1:-1]
    position = F.lit(0)
    for edge in inner:
        position = position + (column > F.lit(edge)).cast("int")
    inside = (column >= F.lit(edges[0])) & (column <= F.lit(edges[-1]))
    return F.when(inside, position)
