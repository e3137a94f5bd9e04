"""Registered queries and the SQL that states the same result."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The dates that relative days count from.
ORDERS_AS_OF = "2001-12-01"
EVENTS_AS_OF = "2024-02-01"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def days_from(column: str, as_of: str = ORDERS_AS_OF) -> Column:
    """Days relative to a date, negative for the past."""
    return F.datediff(F.col(column), F.lit(as_of).cast("date"))


def days_sql(column: str, as_of: str = ORDERS_AS_OF) -> str:
    return f"CAST(datediff('day', DATE '{as_of}', CAST({column} AS DATE)) AS INTEGER)"


def rounded(digits: int, *names: str, **named: Column) -> list[Column]:
    """Doubles rounded for a stable comparison."""
    return [F.round(F.col(n).cast("double"), digits).alias(n) for n in names] + [
        F.round(c.cast("double"), digits).alias(n) for n, c in named.items()
    ]


def money(column: str) -> Column:
    """An amount in cents precision, so that sums and means are exact."""
    return F.col(column).cast("decimal(18,2)")


def money_mean_sql(column: str, where: str = "TRUE") -> str:
    return (
        f"CAST(sum(CAST({column} AS DECIMAL(18,2))) FILTER ({where}) AS DOUBLE) "
        f"/ count({column}) FILTER ({where})"
    )


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for one run below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
