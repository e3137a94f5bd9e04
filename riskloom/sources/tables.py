"""Sources and sinks: CSV to Parquet, staged results, optional tables, profiles, score files."""

from __future__ import annotations

import hashlib
import inspect
import json
import logging
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger("riskloom")


def exists(spark: SparkSession, path: str) -> bool:
    """True when the path exists on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


BROKEN, REPLACED = "_broken", "_replaced"


def declared_schemas(spark: SparkSession, path: str) -> dict[str, T.StructType]:
    """Schemas by table from a JSON file of DDL strings; none where there is no such file."""
    if not exists(spark, path):
        return {}
    declared = json.loads(spark.read.text(path, wholetext=True).first()["value"])
    return {name: T.StructType.fromDDL(ddl) for name, ddl in declared.items()}


def read_declared(
    spark: SparkSession,
    csv_path: str | Sequence[str],
    schema: T.StructType,
    header: bool = True,
) -> DataFrame:
    """A CSV in one pass, by its declared schema, with what went wrong in two more columns.

    ``_broken`` is the whole line where it has too few or too many fields or a field that is not of
    its type (such fields are null, the others stay), else null. ``_replaced`` tells whether bytes
    of a text field could not be decoded; each such place holds the replacement character.
    """
    read = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    rows = (
        spark.read.schema(read)
        .options(
            header=header, encoding="UTF-8", mode="PERMISSIVE", columnNameOfCorruptRecord=BROKEN
        )
        .csv(csv_path)
    )
    text = [f.name for f in schema.fields if f.dataType == T.StringType()]
    spoilt = [F.coalesce(F.col(c).contains("\ufffd"), F.lit(False)) for c in text]
    return rows.withColumn(REPLACED, reduce(or_, spoilt, F.lit(False)))


def csv_to_parquet(
    spark: SparkSession, csv_path: str, parquet_path: str, schema=None, keep_faults: bool = False
) -> DataFrame:
    """Convert once: a finished Parquet table is read back, anything else is written from the CSV.

    Undecodable bytes become the replacement character. A declared schema saves the pass that
    infers one; with ``keep_faults`` it also keeps the columns of ``read_declared``.
    """
    if keep_faults and schema is not None:
        if not exists(spark, f"{parquet_path}/_SUCCESS"):
            read_declared(spark, csv_path, schema).write.mode("overwrite").parquet(parquet_path)
    elif not exists(spark, f"{parquet_path}/_SUCCESS"):
        reader = spark.read.option("header", True).option("encoding", "UTF-8")
        rows = reader.schema(schema).csv(csv_path) if schema else reader.option(
            "inferSchema", True
        ).csv(csv_path)
        rows.write.mode("overwrite").parquet(parquet_path)
    return spark.read.parquet(parquet_path)


def code_digest(*modules) -> str:
    """A digest of the modules' source: a stage that names it is built anew after a change."""
    text = "".join(inspect.getsource(m) for m in modules)
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def stage_key(
    name: str, params: Mapping[str, object], inputs: Sequence[DataFrame] = ()
) -> str:
    """Folder name of a stage: its name and a digest of parameters, plans and input files.

    Rewritten files have new names, so a stage over changed input is a new stage.
    """
    seen = [[df.semanticHash(), sorted(df.inputFiles())] for df in inputs]
    text = json.dumps({"params": dict(params), "inputs": seen}, sort_keys=True, default=str)
    return f"{name}-{hashlib.sha256(text.encode()).hexdigest()[:16]}"


def staged(
    build: Callable[[], DataFrame],
    root: str,
    name: str,
    params: Mapping[str, object],
    inputs: Sequence[DataFrame] = (),
) -> DataFrame:
    """Read the stage when it is complete, else build and write it, then read it back.

    ``inputs`` are the tables the stage is built from; ``build`` is not called for a finished one.
    """
    path = f"{root.rstrip('/')}/{stage_key(name, params, inputs)}"
    spark = SparkSession.getActiveSession()
    if not exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def optional_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table, or ``None`` when there is none."""
    return spark.read.parquet(path) if exists(spark, path) else None


def write_scores(df: DataFrame, key: str, score: str, path: str, label: str = "TARGET") -> None:
    """CSV files of ``(key, label)`` with the score narrowed to float."""
    df.select(key, F.col(score).cast("float").alias(label)).write.mode("overwrite").option(
        "header", True
    ).csv(path)


def profile(df: DataFrame) -> DataFrame:
    """One row per column: position, type, row count, null count, smallest and largest value.

    A single aggregation without shuffle of the rows themselves.
    """
    shown = {
        f.name: F.col(f"`{f.name}`")
        for f in df.schema
        if f.dataType.typeName() not in ("array", "map", "struct", "binary")
    }
    one = df.agg(
        F.count("*").alias("rows"),
        *[F.count(F.col(f"`{f.name}`")).alias(f"n_{i}") for i, f in enumerate(df.schema)],
        *[F.min(shown[f.name]).alias(f"lo_{i}") for i, f in enumerate(df.schema) if f.name in shown],
        *[F.max(shown[f.name]).alias(f"hi_{i}") for i, f in enumerate(df.schema) if f.name in shown],
    )
    missing = F.lit(None).cast("string")
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col("rows"),
            (F.col("rows") - F.col(f"n_{i}")).alias("nulls"),
            (F.col(f"lo_{i}").cast("string") if f.name in shown else missing).alias("low"),
            (F.col(f"hi_{i}").cast("string") if f.name in shown else missing).alias("high"),
        )
        for i, f in enumerate(df.schema)
    ]
    return one.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def head(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)


def report(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, dict | None]:
    """Types and five sample rows per table; a missing table is reported as ``None``."""
    out: dict[str, dict | None] = {}
    for name, path in paths.items():
        table = optional_table(spark, path)
        out[name] = table and {
            "types": table.dtypes,
            "sample": [r.asDict() for r in table.limit(5).collect()],
        }
    return out


def watched(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """The frame with a counter of rows and nulls that fills in while another job reads it."""
    seen = Observation(stage)
    nulls = [F.sum(F.col(f"`{c}`").isNull().cast("long")) for c in df.columns]
    total = nulls[0]
    for n in nulls[1:]:
        total = total + n
    watched_df = df.observe(
        seen,
        F.count("*").alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.coalesce(total, F.lit(0)).alias("nulls"),
    )
    return watched_df, seen
