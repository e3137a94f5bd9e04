"""Hand cases for nulls, windows, order and quantiles."""

import math

import pytest
from pyspark.sql import functions as F

from riskloom.functions import aggregates as A
from riskloom.functions import expressions as X
from riskloom.operators import aggregate as G
from riskloom.operators.ordered import ewm_last, nearest_quantile, running_totals


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_sum_of_nulls_is_zero_and_mean_is_null(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "id int, x double")
    row = one(G.to_parent(df, "id", {"s": A.total(F.col("x")), "m": A.mean(F.col("x"))}))
    assert row["s"] == 0 and row["m"] is None


def test_empty_window_is_null(spark):
    df = spark.createDataFrame([(1, -10), (1, -400), (2, -900)], "id int, day int")
    seen = F.col("day") >= -365
    specs = {"n": A.rows(seen), "s": A.total(F.col("day"), seen), "t": A.tally(seen, seen)}
    got = {r["id"]: r for r in G.to_parent(df, "id", specs).collect()}
    assert got[1]["n"] == 1 and got[1]["s"] == -10
    assert got[2]["n"] is None and got[2]["s"] is None and got[2]["t"] is None


def test_ordered_tie_takes_smaller_then_larger(spark):
    df = spark.createDataFrame([(1, 5, 20, 7), (1, 5, 10, 3)], "id int, month int, loan int, v int")
    place = F.struct("month", "loan")
    row = one(
        G.to_parent(
            df, "id", {"a": A.earliest(F.col("v"), place), "b": A.latest(F.col("v"), place)}
        )
    )
    assert (row["a"], row["b"]) == (3, 7)


def test_unknown_comparison_leaves_the_share(spark):
    df = spark.createDataFrame([(1, True), (1, None)], "id int, late boolean")
    assert one(G.to_parent(df, "id", {"f": A.share(F.col("late"))}))["f"] == 1.0


@pytest.mark.parametrize("q,expected", [(0.99, 59), (0.95, 57), (0.5, 31), (0.0, 1), (1.0, 60)])
def test_nearest_rank_quantile(spark, q, expected):
    df = spark.range(1, 61).withColumnRenamed("id", "v")
    assert one(nearest_quantile(df, "v", q, "x"))["x"] == expected


def test_grouped_quantile_against_sorting(spark):
    rows = [(g, (i * 37 + g * 11) % 23) for g in range(5) for i in range(4 + 50 * (g == 2))]
    df = spark.createDataFrame(rows, "g int, v int")
    got = {r["g"]: r["x"] for r in nearest_quantile(df, "v", 0.95, "x", ["g"]).collect()}
    for g in range(5):
        values = sorted(v for k, v in rows if k == g)
        assert got[g] == values[math.floor(0.95 * (len(values) - 1) + 0.5)]


def test_running_totals_with_one_group_over_all_slices(spark):
    rows = [("hot", i, i % 3) for i in range(4000)] + [(f"g{j}", i, 1) for j in range(50)
                                                      for i in range(j % 4)]
    rows += [(None, i, 2) for i in range(30)]
    df = spark.createDataFrame(rows, "g string, o int, n int")
    out = running_totals(df, ["o"], ["n"], ["g"]).collect()
    assert len(out) == len(rows)
    expected, totals = {}, {}
    for g, o, n in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        expected[g, o] = totals.get(g, 0)
        totals[g] = totals.get(g, 0) + n
    for r in out:
        assert r["n_before"] == expected[r["g"], r["o"]]
        assert r["n_total"] == totals[r["g"]]


def test_ewm_hand_case(spark):
    df = spark.createDataFrame([(1, m, x) for m, x in enumerate([0, 0, 8])], "id int, m int, x int")
    got = one(ewm_last(df, "id", ["m"], "x", 3.0, "e"))["e"]
    assert got == pytest.approx(8 / (1 + 2 ** (-1 / 3) + 2 ** (-2 / 3)))


def test_ewm_of_a_key_that_spans_slices(spark):
    n = 3000
    rows = [(1, i, float((i * 7919) % 13)) for i in range(n)] + [(2, 0, 4.0), (3, 1, None)]
    df = spark.createDataFrame(rows, "id int, m int, x double")
    got = {r["id"]: r["e"] for r in ewm_last(df, "id", ["m"], "x", 40.0, "e").collect()}
    weights = [2 ** (-(n - 1 - i) / 40.0) for i in range(n)]
    want = sum(w * rows[i][2] for i, w in enumerate(weights)) / sum(weights)
    assert got[1] == pytest.approx(want)
    assert got[2] == 4.0 and got[3] is None


def test_restructured_counts_null_as_a_version(spark):
    rows = [(1, 10, 1), (1, 10, 1), (1, 10, 2), (1, 11, 1), (1, 11, 2), (1, 11, None)]
    df = spark.createDataFrame(rows, "id int, loan int, v int")
    row = one(G.restructured(df, "loan", "id", "v"))
    assert row["n_restructured"] == 1 and row["restructured_frac"] == 0.5


def test_rowwise_with_null(spark):
    df = spark.createDataFrame([(None, 0.2, 0.4)], "a double, b double, c double")
    names = ["a", "b", "c"]
    row = one(
        df.select(
            X.row_product(names).alias("p"), X.row_mean(names).alias("m"),
            X.row_min(names).alias("l"), X.null_count(names).alias("n"),
        )
    )
    assert row["p"] is None and row["m"] == pytest.approx(0.3)
    assert row["l"] == 0.2 and row["n"] == 1


def test_guarded_ratio_at_zero(spark):
    df = spark.createDataFrame([(5.0, 0.0)], "x double, y double")
    row = one(
        df.select(
            X.guarded_ratio(F.col("x"), F.col("y"), 1e-8).alias("a"),
            X.guarded_ratio(F.col("x"), F.col("y"), 0).alias("b"),
        )
    )
    assert row["a"] == pytest.approx(5e8) and row["b"] is None


def test_status_severity(spark):
    df = spark.createDataFrame([(s,) for s in ["C", "X", "0", "3", None, "late"]], "s string")
    got = [r[0] for r in df.select(X.ordinal(F.col("s"), {"C": -1, "X": 0})).collect()]
    assert got == [-1, 0, 0, 3, 0, 0]


def test_status_pivot_fills_zero(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "c")], "id int, s string")
    got = {r["id"]: (r["na"], r["nb"]) for r in
           G.status_pivot(df, "id", "s", {"a": "na", "b": "nb"}).collect()}
    assert got == {1: (2, 0), 2: (0, 0)}
