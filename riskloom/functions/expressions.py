"""Row-wise column builders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def guarded_ratio(x: Column, y: Column, eps: float) -> Column:
    """``x / (y + eps)``, null where the shifted denominator is exactly zero."""
    return F.try_divide(x.cast("double"), y.cast("double") + F.lit(float(eps)))


def decayed(value: Column, days: Column, rate: float = 0.01) -> Column:
    """``value`` aged by ``exp(-rate * |days|)``."""
    return value * F.exp(F.abs(days) * F.lit(-float(rate)))


def without(column: Column, sentinel) -> Column:
    """The column with a sentinel value turned into null."""
    return F.nullif(column, F.lit(sentinel))


def is_sentinel(column: Column, sentinel) -> Column:
    return (column == F.lit(sentinel)).cast("int")


def ordinal(status: Column, fixed: Mapping[str, int], default: int = 0) -> Column:
    """Fixed codes first, then the status read as an integer, then the default."""
    parsed = F.coalesce(status.try_cast("int"), F.lit(default))
    chain = None
    for name, code in fixed.items():
        chain = (F.when if chain is None else chain.when)(status == name, F.lit(code))
    return parsed if chain is None else chain.otherwise(parsed)


def row_product(columns: Sequence[str]) -> Column:
    return reduce(mul, [F.col(c) for c in columns])


def row_mean(columns: Sequence[str]) -> Column:
    """Mean of the non-null values of a row; null when there is none."""
    total = reduce(add, [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns])
    return F.try_divide(total, known_count(columns))


def row_min(columns: Sequence[str]) -> Column:
    return F.least(*[F.col(c) for c in columns])


def null_count(columns: Sequence[str]) -> Column:
    return reduce(add, [F.col(c).isNull().cast("int") for c in columns], F.lit(0))


def known_count(columns: Sequence[str]) -> Column:
    return reduce(add, [F.col(c).isNotNull().cast("int") for c in columns], F.lit(0))


def residual(df: DataFrame, actual: str, predicted: str, out: str) -> DataFrame:
    """Add ``actual - predicted`` when both columns exist."""
    if actual not in df.columns or predicted not in df.columns:
        return df
    return df.withColumn(out, F.col(actual) - F.col(predicted))


def transform_prefix(df: DataFrame, prefix: str, change) -> DataFrame:
    """Apply ``change`` to every column whose name starts with ``prefix``."""
    return df.withColumns({c: change(F.col(c)) for c in df.columns if c.startswith(prefix)})


def narrowed(df: DataFrame, whole: Sequence[str] = ()) -> DataFrame:
    """Double to float, as a last step before a table is written.

    Of the longs only those declared in ``whole`` become int: keys and counts may be larger.
    """
    to = {T.DoubleType(): "float"} | ({T.LongType(): "int"} if whole else {})
    return df.select(
        *[
            F.col(f.name).cast(to[f.dataType]).alias(f.name)
            if f.dataType in to and (f.dataType == T.DoubleType() or f.name in whole)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def hash_fraction(key: Column, seed: int, digits: int = 8) -> Column:
    """A reproducible uniform integer in ``[0, 16 ** digits)`` from a key and a seed."""
    text = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))
    return F.conv(F.substring(text, 1, digits), 16, 10).cast("long")
