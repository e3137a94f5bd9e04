"""Declared CSV schemas and the catalogue of finished stages."""

import json
import os

import pytest
from pyspark.sql import functions as F

from riskloom.operators import models as M
from riskloom.sources import catalogue
from riskloom.sources import tables as S


def test_broken_lines_and_bytes_are_kept_beside_the_rows(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes(b"a,b,c\n1,x,2.5\noops,y,1\n3,caf\xe9,4\n5,z\n6,w,7,8\n")
    (tmp_path / "schemas.json").write_text(json.dumps({"t": "a int, b string, c double"}))
    schema = S.declared_schemas(spark, f"{tmp_path}/schemas.json")["t"]
    rows = S.csv_to_parquet(spark, str(path), f"{tmp_path}/t.parquet", schema, keep_faults=True)
    got = {r["b"]: r for r in rows.collect()}
    assert (got["x"]["a"], got["x"]["c"], got["x"]["_broken"]) == (1, 2.5, None)
    assert got["y"]["a"] is None and got["y"]["_broken"] == "oops,y,1"
    assert got["caf�"]["_replaced"] and got["caf�"]["_broken"] is None
    assert got["z"]["_broken"] == "5,z" and got["w"]["_broken"] == "6,w,7,8"
    assert [b for b, r in got.items() if r["_replaced"]] == ["caf�"]
    assert S.declared_schemas(spark, f"{tmp_path}/none.json") == {}


def test_catalogue_finds_complete_stages_only(spark, tmp_path):
    root = str(tmp_path)
    assert catalogue.finished(spark, root) == {}
    df = spark.range(5).withColumn("v", F.col("id") * 2)
    calls = []

    def build():
        calls.append(1)
        return df

    for _ in range(2):
        catalogue.publish(build, root, "meta_v", ["id"], {"seed": 1}, [df])
    assert len(calls) == 1
    changed = catalogue.publish(
        lambda: df.withColumn("w", F.lit(1)), root, "meta_v", ["id"], {"seed": 2}, [df]
    )
    assert changed.columns == ["id", "v", "w"]
    stage = catalogue.finished(spark, root)["meta_v"]
    assert stage.schema.names == ["id", "v", "w"] and stage.keys == ("id",)
    base = spark.range(7).withColumn("w", F.lit(9))
    joined, absent = catalogue.join_present(base, root, ["meta_v", "meta_x"], ["id"])
    assert absent == ["meta_x"] and joined.columns == ["id", "w", "v"]
    assert {(r["id"], r["w"], r["v"]) for r in joined.collect()} == {
        (i, 9, 2 * i if i < 5 else None) for i in range(7)
    }
    _, absent = catalogue.join_present(base, root, ["meta_v"], ["w"])
    assert absent == ["meta_v"]
    os.remove(f"{stage.path}/_SUCCESS")
    assert catalogue.finished(spark, root) == {}


def test_too_few_known_values_are_logged(spark, caplog):
    df = spark.createDataFrame([(i, float(i), 1.0) for i in range(20)], "id long, x double, f double")
    with caplog.at_level("WARNING", logger="riskloom"):
        assert M.reconstruct(df, df, "x", ["f"], "id", min_known=21) is None
    assert "20 known values of 21" in caplog.text


def test_side_by_side_keeps_the_order_and_raises():
    assert M.side_by_side(lambda x: x * 2, range(9), 3) == [2 * x for x in range(9)]
    assert M.side_by_side(lambda x: x, []) == []
    with pytest.raises(ZeroDivisionError):
        M.side_by_side(lambda x: 1 // x, [1, 0])
