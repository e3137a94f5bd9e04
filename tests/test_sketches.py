"""Sketched quantiles, bins and ranks against exact ones, within the stated rank error."""

import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import sketches as S
from riskloom.operators.ordered import rank_normalize

ERROR = 2 * S.rank_error()


def values(n=20_000):
    rng = random.Random(6)
    # A third of all rows share one value; some are null or NaN.
    return [
        (i, "a" if i % 3 else "b", 7.0 if i % 3 == 0 else None if i % 50 == 1 else
         float("nan") if i % 50 == 2 else rng.gauss(0, 40)) for i in range(n)
    ]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(values(), "id long, g string, v double").repartition(8)


def inside(known, value, p):
    below = sum(x < value for x in known) / len(known)
    until = sum(x <= value for x in known) / len(known)
    return below - ERROR <= p <= until + ERROR


def test_quantiles_of_merged_sketches(rows):
    fine = S.quantile_sketches(rows.withColumn("day", F.col("id") % 11), "v", ["g", "day"])
    probs = [0.01, 0.3, 0.5, 0.95]
    got = {r["g"]: r for r in S.quantiles(S.merged(fine, ["g"]), probs).collect()}
    for g in "ab":
        known = [v for _, h, v in values() if h == g and v is not None and v == v]
        assert got[g]["n"] == len(known)
        assert all(inside(known, v, p) for v, p in zip(got[g]["quantiles"], probs))


def test_quantile_bins_and_ranks(rows):
    known = [v for *_, v in values() if v is not None and v == v]
    whole = S.sketched_quantile(rows, "v", 0.99, "cap").first()["cap"]
    assert inside(known, whole, 0.99)
    edges = S.sketched_bins(rows, "v", 10)
    assert edges == sorted(set(edges)) and 5 <= len(edges) <= 9
    assert all(any(inside(known, e, i / 10) for i in range(1, 10)) for e in edges)
    clean = rows.withColumn("exact", F.when(~F.isnan("v"), F.col("v")))
    both = rank_normalize(S.rank_columns(clean, ["v"]), ["exact"]).collect()
    for r in both:
        assert (r["v_rank"] is None) == (r["exact"] is None)
        assert r["exact"] is None or abs(r["v_rank"] - r["exact_rank"]) <= ERROR


def test_few_values_are_exact_and_none_give_nothing(spark):
    few = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    assert S.sketched_quantile(few, "v", 0.5, "m").first()["m"] == 50.0
    empty = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    assert S.sketched_quantile(empty, "v", 0.5, "m").collect() == []
    assert S.sketched_bins(empty, "v") == []
    assert [r["v_rank"] for r in S.rank_columns(empty, ["v"]).collect()] == [None, None]
    assert S.sketched_quantile(empty.limit(0), "v", 0.5, "m", []).collect() == []
