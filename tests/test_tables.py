"""Cleaning, sources, sinks and stages."""

import math

import pytest
from pyspark.sql import functions as F

from riskloom.functions import expressions as X
from riskloom.operators import clean as C
from riskloom.operators import folds
from riskloom.session import drop_written, write_out
from riskloom.sources import tables as S


def test_cap_is_nearest_rank_and_keeps_nulls(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 61)] + [(0, None)], "id int, v double")
    cap = C.fit_cap(df, "v")
    assert cap == 59.0
    out = {r["id"]: r["v"] for r in C.apply_cap(df, "v", cap).collect()}
    assert out[60] == 59.0 and out[58] == 58.0 and out[0] is None


def test_medians_of_even_odd_and_empty_columns(spark):
    df = spark.createDataFrame(
        [(1.0, 5, None), (4.0, 7, None), (2.0, None, None), (3.0, 6, None)],
        "a double, b int, c double",
    )
    assert C.fit_medians(df, ["a", "b", "c"]) == {"a": 2.5, "b": 6.0, "c": None}


def test_fill_covers_nan_and_infinity(spark):
    rows = [(float("nan"), "x"), (float("inf"), None), (None, "y"), (1.5, "z")]
    df = spark.createDataFrame(rows, "v double, t string")
    out = C.fill(df, {"v": -999.0, "t": "MISSING", "absent": 1}).collect()
    assert [r["v"] for r in out] == [-999.0, -999.0, -999.0, 1.5]
    assert [r["t"] for r in out] == ["x", "MISSING", "y", "z"]


def test_bins_merge_equal_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [1] * 50 + list(range(2, 52))], "v double")
    edges = C.fit_bins(df, ["v"], 10)["v"]
    assert len(edges) == len(set(edges)) < 11
    got = df.select(C.bin_of(F.col("v"), edges).alias("b")).groupBy("b").count().collect()
    assert sum(r["count"] for r in got) == 100 and all(r["b"] is not None for r in got)


def test_codes_of_null_and_unseen_values(spark):
    train = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "c string")
    codes = C.category_codes(train, "c", "code")
    test = spark.createDataFrame([(1, "b"), (2, "z"), (3, None), (4, "a")], "id int, c string")
    out = {r["id"]: r["code"] for r in C.index_category(test, codes, "c", "code").collect()}
    assert out == {1: 1, 2: -1, 3: -1, 4: 0}


def test_prune_ignores_absent_columns(spark):
    assert C.prune(spark.range(1).withColumn("x", F.lit(1)), ["x", "nope"]).columns == ["id"]


def test_narrowing(spark):
    df = spark.createDataFrame([(1, 2.5, "a")], "k long, v double, t string")
    assert X.narrowed(df).dtypes == [("k", "bigint"), ("v", "float"), ("t", "string")]
    assert X.narrowed(df, ["k"]).dtypes == [("k", "int"), ("v", "float"), ("t", "string")]


def test_sentinel_flag_uses_the_original_value(spark):
    df = spark.createDataFrame([(365243,), (-5,), (None,)], "d int")
    out = df.select(
        X.is_sentinel(F.col("d"), 365243).alias("f"), X.without(F.col("d"), 365243).alias("v")
    ).collect()
    assert [(r["f"], r["v"]) for r in out] == [(1, None), (0, -5), (None, None)]


def test_csv_is_converted_once(spark, tmp_path):
    source = tmp_path / "t.csv"
    source.write_bytes(b"id,name\n1,caf\xe9\n2,ok\n")
    target = str(tmp_path / "t.parquet")
    first = S.csv_to_parquet(spark, str(source), target).orderBy("id").collect()
    assert [r["id"] for r in first] == [1, 2] and first[0]["name"] == "caf�"
    source.write_bytes(b"id,name\n9,new\n")
    assert S.csv_to_parquet(spark, str(source), target).count() == 2


def test_stage_is_reused_and_keyed_by_parameters_and_input(spark, tmp_path):
    calls, source, root = [], str(tmp_path / "in.parquet"), str(tmp_path / "stages")
    spark.range(5).write.parquet(source)

    def stage(seed):
        df = spark.read.parquet(source)

        def build():
            calls.append(seed)
            return df.filter("id > 0")

        return S.staged(build, root, "x", {"seed": seed}, [df])

    assert [stage(1).count(), stage(1).count()] == [4, 4] and calls == [1]
    assert stage(2).count() == 4 and calls == [1, 2]
    spark.range(9).write.mode("overwrite").parquet(source)
    assert stage(1).count() == 8 and calls == [1, 2, 1]


def test_written_tables_can_be_dropped(spark):
    kept = write_out(spark.range(3))
    assert kept.count() == 3
    path = kept.inputFiles()[0].rsplit("/", 1)[0]
    assert S.exists(spark, path)
    drop_written(spark)
    assert not S.exists(spark, path)


def test_optional_table_and_report(spark, tmp_path):
    path = str(tmp_path / "a.parquet")
    spark.range(9).write.parquet(path)
    assert S.optional_table(spark, str(tmp_path / "none")) is None
    out = S.report(spark, {"a": path, "b": str(tmp_path / "b")})
    assert out["b"] is None and out["a"]["types"] == [("id", "bigint")]
    assert len(out["a"]["sample"]) == 5


def test_profile_counts_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "b"), (3, "a")], "k int, t string")
    rows = {r["column"]: r for r in S.profile(df).collect()}
    assert rows["t"]["nulls"] == 1 and rows["t"]["low"] == "a" and rows["k"]["rows"] == 3


def test_hash_sample_is_reproducible_and_close(spark):
    df = spark.range(20000)
    first = folds.hash_sample(df, "id", 0.15).count()
    assert first == folds.hash_sample(df.repartition(5), "id", 0.15).count()
    assert math.isclose(first / 20000, 0.15, abs_tol=0.01)


def test_watched_counts_without_another_job(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "a int, b int")
    seen_df, seen = S.watched(df, "stage")
    seen_df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 2 and seen.get["nulls"] == 1 and seen.get["columns"] == 2


def test_scores_are_written_as_floats(spark, tmp_path):
    path = str(tmp_path / "scores")
    S.write_scores(spark.createDataFrame([(1, 0.1)], "id int, p double"), "id", "p", path)
    back = spark.read.option("header", True).csv(path).first()
    assert back["id"] == "1" and back["TARGET"] == pytest.approx("0.1") and len(back) == 2


def test_stage_keys_follow_the_code(tmp_path):
    import importlib.util

    digests = []
    for body in ("x = 1\n", "x = 2\n"):
        path = tmp_path / f"m{len(digests)}.py"
        path.write_text(body)
        spec = importlib.util.spec_from_file_location(path.stem, path)
        module = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(module)
        digests.append(S.code_digest(module))
    assert digests[0] != digests[1]
    assert S.stage_key("s", {"code": digests[0]}) != S.stage_key("s", {"code": digests[1]})
