"""Session helpers: a local session for tests, and lineage cuts that survive lost executors."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Folders to delete at the end, by application.
_written: dict[str, list[str]] = {}


def local_session(cores: str | int = 8, app: str = "riskloom") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Without either, a temporary folder in local mode only.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    known = getattr(shared_folder, "local", None)
    if known is None:
        known = shared_folder.local = tempfile.mkdtemp(prefix="riskloom-")
    return known


def _to_delete(spark: SparkSession) -> list[str]:
    return _written.setdefault(spark.sparkContext.applicationId, [])


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint.

    Used where two branches of a plan must see the very same rows in the very same layout, or
    where a small aggregate is read several times.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
        _to_delete(spark).append(context.getCheckpointDir())
    return df.checkpoint(eager=True)


def write_out(df: DataFrame) -> DataFrame:
    """Like ``settle`` for large results: a columnar table in the shared folder, read back.

    Later reads take only the columns they need, and the planner sees the real size.
    """
    path = f"{shared_folder(df.sparkSession)}/riskloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _to_delete(df.sparkSession).append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession) -> None:
    """Delete the tables and checkpoints made for this application.

    For the end of a job: results that still read them are lost.
    """
    context = spark.sparkContext
    own = _to_delete(spark)
    while own:
        path = context._jvm.org.apache.hadoop.fs.Path(own.pop())
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
