"""Aggregate builders with one rule set: sums of nothing are 0, empty windows are null.

Every builder takes an optional ``where``: the aggregate then covers only the rows that satisfy
it, and is null for a group without such a row. All windows of a child table are therefore
computed by the same ``groupBy``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(predicate: Column) -> Column:
    """A predicate as 0/1; unknown stays null."""
    return predicate.cast("int")


def _kept(value: Column, where: Column | None) -> Column:
    return value if where is None else F.when(where, value)


def _if_any(value: Column, where: Column | None) -> Column:
    return value if where is None else F.when(F.count_if(where) > 0, value)


def total(value: Column, where: Column | None = None) -> Column:
    return _if_any(F.coalesce(F.sum(_kept(value, where)), F.lit(0)), where)


def mean(value: Column, where: Column | None = None) -> Column:
    return F.avg(_kept(value, where))


def low(value: Column, where: Column | None = None) -> Column:
    return F.min(_kept(value, where))


def high(value: Column, where: Column | None = None) -> Column:
    return F.max(_kept(value, where))


def spread(value: Column, where: Column | None = None) -> Column:
    """Sample standard deviation; null for a single row."""
    return F.stddev_samp(_kept(value, where))


def rows(where: Column | None = None) -> Column:
    """Number of rows, nulls included."""
    return F.count("*") if where is None else _if_any(F.count_if(where), where)


def known(value: Column) -> Column:
    """Number of non-null values."""
    return F.count(value)


def tally(predicate: Column, where: Column | None = None) -> Column:
    """Number of rows for which the predicate is true."""
    return total(flag(predicate), where)


def share(predicate: Column, where: Column | None = None) -> Column:
    """Share of true among the rows for which the predicate is known."""
    return mean(flag(predicate), where)


def earliest(value: Column, order: Column) -> Column:
    """Value at the smallest order key; give a key without ties."""
    return F.min_by(value, order)


def latest(value: Column, order: Column) -> Column:
    """Value at the largest order key; give a key without ties."""
    return F.max_by(value, order)


def distinct_with_null(value: Column) -> Column:
    """Number of distinct values, null being one of them."""
    return F.count_distinct(value) + F.max(flag(value.isNull()))
