"""Fold assignment and stratified samples, reproducible from a key and a seed.

The order inside a stratum is the order of a hash of the key, so it needs no sorting of the whole
stratum: the leading bits of the hash cut every stratum into cells of near-equal size, rows are
numbered inside a cell, and the cells' counts give each cell its start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.expressions import hash_fraction
from riskloom.operators.joins import attach

DIGITS = 12
CELLS = 4096
CELL_ROWS = 10_000


def hash_folds(df: DataFrame, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold`` from the key alone: no shuffle, balanced in expectation."""
    return df.withColumn("fold", (hash_fraction(F.col(key), seed) % k).cast("int"))


def _places(
    df: DataFrame, key: str, strata: str, seed: int, cells: int | None
) -> DataFrame:
    """Add the 0-based place of a row in its stratum and the size of the stratum.

    ``cells`` only decides how many tasks share the work; by default it follows the row count.
    """
    cells = cells or max(CELLS, df.count() // CELL_ROWS)
    hashed = df.withColumn("_h", hash_fraction(F.col(key), seed, DIGITS)).withColumn(
        "_cell", F.floor(F.col("_h") * cells / 16**DIGITS).cast("int")
    )
    counts = hashed.groupBy(strata, "_cell").agg(F.count("*").alias("_n"))
    per_stratum = Window.partitionBy(strata)
    before = per_stratum.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(strata).alias("_stratum"),
        F.col("_cell").alias("_c"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        F.sum("_n").over(per_stratum).alias("_size"),
    )
    in_cell = Window.partitionBy(strata, "_cell").orderBy("_h", F.col(key))
    numbered = hashed.withColumn("_at", F.row_number().over(in_cell) - 1)
    joined = numbered.join(
        starts,
        numbered[strata].eqNullSafe(starts["_stratum"]) & (numbered["_cell"] == starts["_c"]),
    )
    return joined.withColumn("_place", F.col("_start") + F.col("_at")).drop(
        "_h", "_cell", "_at", "_start", "_stratum", "_c"
    )


def stratified_folds(
    df: DataFrame, key: str, strata: str, k: int = 5, seed: int = 42, cells: int | None = None
) -> DataFrame:
    """Add ``fold``: per stratum, fold sizes differ by at most one. ``key`` is unique."""
    placed = _places(df, key, strata, seed, cells)
    return placed.withColumn("fold", (F.col("_place") % k).cast("int")).drop("_place", "_size")


def group_folds(
    df: DataFrame, group: str, strata: str, k: int = 5, seed: int = 42, cells: int | None = None
) -> DataFrame:
    """Add ``fold`` at group grain: all rows of a group share it.

    Groups are stratified by their largest stratum value; the fold is then attached to the rows.
    """
    groups = df.groupBy(group).agg(F.max(strata).alias("_top"))
    folds = stratified_folds(groups, group, "_top", k, seed, cells).select(group, "fold")
    return attach(df, folds, [group])


def stratified_sample(
    df: DataFrame, key: str, strata: str, frac: float, seed: int = 42, cells: int | None = None
) -> DataFrame:
    """The first ``round(frac * size)`` rows of every stratum in hash order."""
    placed = _places(df, key, strata, seed, cells)
    return placed.filter(F.col("_place") < F.round(F.col("_size") * F.lit(float(frac)))).drop(
        "_place", "_size"
    )


def hash_sample(df: DataFrame, key: str, frac: float, seed: int = 42) -> DataFrame:
    """Rows whose key hash falls below ``frac``: reproducible and free of shuffles."""
    return df.filter(hash_fraction(F.col(key), seed) < F.lit(int(frac * 16**8)))
