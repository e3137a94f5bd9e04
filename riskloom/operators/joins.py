"""Joins of rows to a table that holds one row per key, safe for keys that repeat very often."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import settle, shuffle_width

HASH, SALT = "_key_hash", "_key_salt"
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32_000_000


def attach(
    rows: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    settled: bool = False,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``rows`` to ``dim`` (unique on ``on``).

    ``dim`` is broadcast when it is counted and measured to be small, and joined by ``lookup``
    beyond that. At most ``max_rows`` rows are stored to find out; a ``settled`` one is read.
    """
    head = dim.limit(max_rows + 1)
    head = head if settled else settle(head)
    if _small(head, max_rows, max_bytes):
        return rows.join(F.broadcast(dim if settled else head), list(on), how)
    return lookup(rows, dim, on, how)


def _small(head: DataFrame, max_rows: int, max_bytes: int) -> bool:
    size = F.sum(F.length(F.to_json(F.struct("*"))))
    found = head.agg(F.count("*").alias("n"), F.coalesce(size, F.lit(0)).alias("bytes")).first()
    return found["n"] <= max_rows and found["bytes"] <= max_bytes


def lookup(
    rows: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left", share: float = 0.002
) -> DataFrame:
    """Shuffle join in which keys above ``share`` of the rows are spread over several tasks.

    The sketch behind ``freqItems`` keeps at most about ``1 / share`` keys, so what is known of
    frequent keys is bounded. Their rows get a salt, their row of ``dim`` is copied to every salt;
    all other keys join as they are, and ``rows`` is read once. The sketch reads a tenth of the
    rows: it only decides which keys are spread. ``how`` is one of ``left``, ``inner``,
    ``left_semi``, ``left_anti``; ``dim`` has one row per key, or for the two last any number.
    """
    on = list(on)
    key = F.xxhash64(*on)
    frequent = rows.select(key.alias(HASH)).sample(0.1, seed=7).freqItems([HASH], share)
    heavy = frequent.first()[0]
    salts = shuffle_width(rows)
    salt = F.when(key.isin(heavy), F.monotonically_increasing_id() % salts).otherwise(F.lit(0))
    copies = F.when(key.isin(heavy), F.lit(salts)).otherwise(F.lit(1))
    offered = dim.select("*", F.sequence(F.lit(0), copies - 1).alias(SALT)).withColumn(
        SALT, F.explode(SALT)
    )
    if how in ("left_semi", "left_anti"):
        offered = offered.select(*on, SALT).distinct()
    asked = rows.withColumn(SALT, salt.cast("int"))
    return asked.join(offered, [*on, SALT], how).drop(SALT)


def with_group_key(
    rows: DataFrame, bridge: DataFrame, on: str, carry: Sequence[str]
) -> DataFrame:
    """Child rows with the keys of their grandparent; rows without a parent drop out.

    ``bridge`` is a stored table, so it is counted and read in place.
    """
    return attach(rows, bridge.select(on, *carry), [on], "inner", settled=True)


def only_members(rows: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``members``, a stored table in which keys may repeat."""
    return attach(rows, members.select(key), [key], "left_semi", settled=True)
