"""A catalogue of finished stages: what a folder holds is found there, not listed by the caller.

``publish`` writes a stage and then its entry, a small file that appears by renaming: a reader sees
a whole entry or none, and a stage whose job died has none. ``join_present`` joins the tables of
all entries of some names, with the schema that the entry states.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskloom.operators.joins import attach
from riskloom.sources.tables import exists, stage_key, staged

log = logging.getLogger("riskloom")
FOLDER = "_catalogue"


@dataclass(frozen=True)
class Stage:
    """A finished stage: its name, the key columns, where its rows are and their schema."""

    name: str
    keys: tuple[str, ...]
    path: str
    schema: T.StructType

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.path)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def publish(
    build: Callable[[], DataFrame],
    root: str,
    name: str,
    keys: Sequence[str],
    params: Mapping[str, object],
    inputs: Sequence[DataFrame] = (),
) -> DataFrame:
    """``staged``, with an entry in the catalogue of ``root`` once the rows are there."""
    table = staged(build, root, name, params, inputs)
    spark, root = table.sparkSession, root.rstrip("/")
    folder = stage_key(name, params, inputs)
    entry = {"name": name, "keys": list(keys), "folder": folder, "schema": table.schema.json()}
    _commit(spark, f"{root}/{FOLDER}/{name}.json", json.dumps(entry))
    return table


def _commit(spark: SparkSession, path: str, text: str) -> None:
    """Write beside the place and move there; an entry of the same name is replaced."""
    files, target = _file_system(spark, path)
    _, aside = _file_system(spark, f"{path}.{uuid.uuid4().hex}")
    out = files.create(aside)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if files.exists(target):
        files.delete(target, False)
    if not files.rename(aside, target):
        raise OSError(f"could not move the entry to {path}")


def finished(spark: SparkSession, root: str) -> dict[str, Stage]:
    """The stages of ``root`` by name, of those whose rows are complete."""
    root = root.rstrip("/")
    files, folder = _file_system(spark, f"{root}/{FOLDER}")
    found = {}
    if not files.exists(folder):
        return found
    for status in files.listStatus(folder):
        path = status.getPath().toString()
        if not path.endswith(".json"):
            continue
        text = spark.read.text(path, wholetext=True).first()
        entry = json.loads(text["value"])
        place = f"{root}/{entry['folder']}"
        if exists(spark, f"{place}/_SUCCESS"):
            schema = T.StructType.fromJson(json.loads(entry["schema"]))
            found[entry["name"]] = Stage(entry["name"], tuple(entry["keys"]), place, schema)
    return found


def join_present(
    df: DataFrame, root: str, wanted: Sequence[str], on: Sequence[str]
) -> tuple[DataFrame, list[str]]:
    """``df`` left-joined to the wanted stages that exist, and the names of those that do not.

    A stage has one row per ``on``, which must be its keys. Of columns that ``df`` has already, those
    of ``df`` stay.
    """
    stages, absent = finished(df.sparkSession, root), []
    for name in wanted:
        stage = stages.get(name)
        if stage is None or set(stage.keys) != set(on):
            log.info("stage %s: not there, its columns are left out", name)
            absent.append(name)
            continue
        rows = stage.read(df.sparkSession)
        new = [c for c in rows.columns if c in on or c not in df.columns]
        df = attach(df, rows.select(*new), list(on), settled=True)
    return df, absent
