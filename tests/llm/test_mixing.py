import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from brute import SCHEMA, SF, odd_rows, words  # noqa: E402
from compare import differences, oracle  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from riskloom.llm import curriculum  # noqa: E402


def test_mix_of_awkward_rows_is_that_of_sql(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA).withColumn("size", F.lit(1))
    made = curriculum.curriculum(df).select(
        "doc_id", "size", "source_size", "target", "taken", F.round("position", 9).alias("position")
    )
    rows = made.collect()
    con = duckdb.connect()
    con.register("documents", df.drop("size").toArrow())
    wanted = con.execute(curriculum.OP7_SQL).fetchall()
    key = lambda r: tuple(str(x) for x in r[:5])
    assert sorted(map(key, rows)) == sorted(map(key, wanted))
    by_source = {}
    for r in curriculum.curriculum(df).collect():
        by_source.setdefault(r.source, [r.target, 0])[1] += r.taken
        assert r.taken <= 2 * r.size
    assert all(abs(t - n) <= 0.5 for t, n in by_source.values())
    assert curriculum.curriculum(df.limit(0)).count() == 0
    assert curriculum.mixed(df.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, "", "en", "a", 0), (2, None, "en", "b", 0)], SCHEMA)
    assert [r.taken for r in curriculum.curriculum(blank).collect()] == [0, 0]


@pytest.mark.parametrize(
    "schedule", [((0, 2.0), (1, 2.0)), ((0, 0.0), (0.5, 4.0), (1, 1.0)), ((0, 3.0), (0.25, 0.0), (1, 2))]
)
def test_positions_invert_the_schedule(spark, schedule):
    schedule = [(float(t), float(w)) for t, w in schedule]
    total = curriculum.integral(schedule)
    df = spark.range(0, 101).select((F.col("id") / 100).alias("share"))
    for r in df.select("share", curriculum.progress(F.col("share"), schedule).alias("t")).collect():
        done = 0.0
        for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
            t = min(max(r.t, t0), t1)
            done += (t - t0) * (w0 + w0 + (w1 - w0) * (t - t0) / (t1 - t0)) / 2
        assert abs(done - r.share * total) < 1e-9


def test_mixed_rows_follow_positions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = curriculum.mixed(docs.withColumn("words", F.lit("x"))).collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    total = sum(len(words(r.text)) for r in docs.collect())
    assert abs(sum(r.words for r in rows) - 1.5 * total) < 20


def test_query_is_native(spark):
    df = curriculum.op7_curriculum(spark, SF)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert differences(df, df.collect(), oracle(SF), curriculum.OP7_SQL) is None
