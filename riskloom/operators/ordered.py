"""Order-dependent operators that never sort a whole group inside one task.

Everything here rests on one layout: rows are range-partitioned by ``(group, order)``, so a group
that holds a large share of the table is cut over many partitions. Each partition works on its own
rows; what the partitions owe each other (at most one open group per partition border) is a table
of at most ``2 * partitions`` rows and is broadcast. The number of partitions is left to adaptive
execution, so small tables stay in few.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.joins import attach
from riskloom.session import settle, write_out

SLICE = "_slice"


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def running_totals(
    df: DataFrame, order: Sequence[str], measures: Sequence[str], group: Sequence[str] = ()
) -> DataFrame:
    """Add ``<m>_before`` (sum over earlier rows of the group) and ``<m>_total`` for each measure.

    ``order`` must be unique inside a group; aggregate by it first. Nulls sort first.
    """
    group = list(group)
    laid = write_out(
        df.repartitionByRange(*group, *order).withColumn(SLICE, F.spark_partition_id())
    )
    in_slice = Window.partitionBy(SLICE, *group)
    earlier = in_slice.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = laid.withColumns(
        {f"{m}_before": F.coalesce(F.sum(m).over(earlier), F.lit(0)) for m in measures}
        | {f"{m}_total": F.sum(m).over(in_slice) for m in measures}
    )

    borders = _open_groups(laid, group).groupBy(SLICE, *group).agg(
        *[F.sum(m).alias(f"{m}_part") for m in measures]
    )
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    earlier_slices = whole.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    owed = borders.select(
        F.col(SLICE).alias("_s"),
        *[F.col(g).alias(f"_g_{g}") for g in group],
        *[F.sum(f"{m}_part").over(earlier_slices).alias(f"{m}_owed") for m in measures],
        *[F.sum(f"{m}_part").over(whole).alias(f"{m}_all") for m in measures],
    )
    match = local[SLICE] == owed["_s"]
    for g in group:
        match = match & local[g].eqNullSafe(owed[f"_g_{g}"])
    joined = local.join(F.broadcast(owed), match, "left")
    return joined.select(
        *[local[c] for c in df.columns],
        *[
            (F.col(f"{m}_before") + F.coalesce(f"{m}_owed", F.lit(0))).alias(f"{m}_before")
            for m in measures
        ],
        *[F.coalesce(f"{m}_all", f"{m}_total").alias(f"{m}_total") for m in measures],
    )


def _open_groups(laid: DataFrame, group: list[str]) -> DataFrame:
    """Rows of the groups that reach over a slice border: only a slice's first or last group can."""
    if not group:
        return laid
    ends = laid.groupBy(SLICE).agg(
        F.min(F.struct(*group)).alias("low"), F.max(F.struct(*group)).alias("high")
    )
    open_groups = (
        ends.select(F.explode(F.array_distinct(F.array("low", "high"))).alias("g"))
        .groupBy("g")
        .count()
        .filter("count > 1")
        .select(*[F.col(f"g.{g}").alias(g) for g in group])
    )
    return laid.join(F.broadcast(open_groups), _same(laid, open_groups, group), "left_semi")


def value_counts(df: DataFrame, value: str, group: Sequence[str] = ()) -> DataFrame:
    """Non-null values with their counts ``n``; combines on the map side, so ties cost nothing."""
    return (
        df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("n"))
    )


def nearest_quantile(
    df: DataFrame, value: str, q: float, out: str, group: Sequence[str] = ()
) -> DataFrame:
    """The value at rank ``round(q * (n - 1))`` of the non-null values, one row per group."""
    ranked = running_totals(value_counts(df, value, group), [value], ["n"], group)
    target = F.round(F.lit(q) * (F.col("n_total") - 1)).cast("long")
    return ranked.filter(
        (F.col("n_before") <= target) & (target < F.col("n_before") + F.col("n"))
    ).select(*group, F.col(value).alias(out))


def linear_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float]
) -> dict[str, list[float]]:
    """Exact interpolated quantiles of whole columns, a few numbers each; none for all-null.

    All columns share one layout; only the values at the wanted places leave it.
    """
    ranked = running_totals(
        value_counts(_long(df, columns), "value", ["name"]), ["value"], ["n"], ["name"]
    )
    places = [F.lit(float(p)) * (F.col("n_total") - 1) for p in probs]
    wanted = F.array_distinct(F.array(*[f(p) for p in places for f in (F.floor, F.ceil)]))
    here = F.filter(
        wanted, lambda at: (F.col("n_before") <= at) & (at < F.col("n_before") + F.col("n"))
    )
    picked = ranked.select("name", "value", "n_total", F.explode(here).alias("at")).collect()
    value = {(r["name"], r["at"]): r["value"] for r in picked}
    size = {r["name"]: r["n_total"] for r in picked}
    out: dict[str, list[float]] = {c: [] for c in columns}
    for c, n in size.items():
        for p in probs:
            place = float(p) * (n - 1)
            low, high = value[c, math.floor(place)], value[c, math.ceil(place)]
            out[c].append(low + (high - low) * (place - math.floor(place)))
    return out


def rank_maps(df: DataFrame, scores: Sequence[str]) -> DataFrame:
    """``(name, value, pct_rank)`` per distinct score: average rank of ties over the row count."""
    ranked = running_totals(
        value_counts(_long(df, scores), "value", ["name"]), ["value"], ["n"], ["name"]
    )
    middle = F.col("n_before") + (F.col("n") + 1) / F.lit(2.0)
    return ranked.select("name", "value", (middle / F.col("n_total")).alias("pct_rank"))


def _long(df: DataFrame, scores: Sequence[str], *keep: Column) -> DataFrame:
    """Several score columns as ``(keep..., name, value)`` rows."""
    named = [
        F.struct(F.lit(s).alias("name"), F.col(s).cast("double").alias("value")) for s in scores
    ]
    return df.select(*keep, F.explode(F.array(*named)).alias("_s")).select(
        *[c for c in df.select(*keep).columns], "_s.name", "_s.value"
    )


def rank_normalize(df: DataFrame, scores: Sequence[str], suffix: str = "_rank") -> DataFrame:
    """Add the percentile rank of each score column; a null score keeps a null rank."""
    maps = settle(rank_maps(df, scores))
    out = df
    for s in scores:
        ranks = maps.filter(F.col("name") == s).select(
            F.col("value").alias("_value"), F.col("pct_rank").alias(s + suffix)
        )
        out = attach(
            out.withColumn("_value", F.col(s).cast("double")), ranks, ["_value"], settled=True
        ).drop("_value")
    return out.select(*df.columns, *[s + suffix for s in scores])


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., auc, positives, negatives)``; ties count half, null scores or labels are left out.

    Counts per distinct score, then one running total; the pair count is an exact decimal.
    """
    y = F.col(label).cast("int")
    counts = (
        df.filter(F.col(score).isNotNull() & y.isNotNull())
        .groupBy(*by, F.col(score).alias("_score"))
        .agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    )
    return auc_of_counts(counts, by)


def auc_of_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """AUC from ``(by..., _score, pos, neg)`` rows with one row per distinct score."""
    ranked = running_totals(counts, ["_score"], ["pos", "neg"], by)
    big = "decimal(18,0)"
    won = F.col("pos").cast(big) * (2 * F.col("neg_before") + F.col("neg")).cast(big)
    summed = ranked.groupBy(*by).agg(
        F.sum(won.cast("decimal(38,0)")).cast("double").alias("won"),
        F.max("pos_total").alias("positives"),
        F.max("neg_total").alias("negatives"),
    )
    pairs = 2.0 * F.col("positives").cast("double") * F.col("negatives").cast("double")
    return summed.select(
        *by, F.try_divide(F.col("won"), pairs).alias("auc"), "positives", "negatives"
    )


def auc_by_column(df: DataFrame, label: str, scores: Sequence[str]) -> DataFrame:
    """``(name, auc, positives, negatives)`` for several score columns in one pass."""
    long = _long(df, scores, F.col(label).alias("_label"))
    return roc_auc(long, "_label", "value", by=["name"])


def ewm_last(
    df: DataFrame, key: str, order: Sequence[str], value: str, half_life: float, out: str
) -> DataFrame:
    """Last value of the adjusted exponentially weighted mean, rows taken in ``order``.

    A row that is ``i`` places from the end weighs ``2 ** (-i / half_life)``; a null value holds
    its place but adds nothing. Every range slice reduces its part of a key to one row, and the
    parts of a key are then aged by the number of rows that follow them.
    """
    decay = lambda steps: F.pow(F.lit(2.0), -steps / F.lit(float(half_life)))
    columns = list(dict.fromkeys([key, *order, value]))
    sliced = (
        df.select(*columns)
        .repartitionByRange(key, *order)
        .withColumn(SLICE, F.spark_partition_id())
    )
    backwards = Window.partitionBy(key, SLICE).orderBy(*[F.col(c).desc() for c in order])
    weight = decay(F.col("_i"))
    parts = (
        sliced.withColumn("_i", (F.row_number().over(backwards) - 1).cast("double"))
        .groupBy(key, SLICE)
        .agg(
            F.sum(F.col(value) * weight).alias("_num"),
            F.sum(F.when(F.col(value).isNotNull(), weight)).alias("_den"),
            F.count("*").alias("_rows"),
        )
    )
    later = (
        Window.partitionBy(key)
        .orderBy(F.col(SLICE).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    aged = decay(F.coalesce(F.sum("_rows").over(later), F.lit(0)).cast("double"))
    return (
        parts.withColumn("_age", aged)
        .groupBy(key)
        .agg(
            F.try_divide(
                F.sum(F.col("_num") * F.col("_age")), F.sum(F.col("_den") * F.col("_age"))
            ).alias(out)
        )
    )
