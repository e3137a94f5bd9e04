"""Helpers shared by the operators: row-wise Arrow stages, words, bounded driver reads."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANKS = b" \t\n\x0b\x0c\r"
ROWS = 256


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that a stage holds few texts at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The values of a string column as bytes."""
    return column.cast(pa.large_binary()).to_pylist()


def annotated(
    df: DataFrame,
    inputs: list[str],
    name: str,
    result: T.DataType,
    rows: Callable[[list[pa.Array]], pa.Array],
    rows_at_once: int = ROWS,
) -> DataFrame:
    """``df`` with a column ``name`` that ``rows`` makes from ``inputs``, batch by batch.

    All columns pass through; a column that has this name already is replaced.
    """
    base = df.drop(name)
    schema = T.StructType([*base.schema.fields, T.StructField(name, result)])

    def stage(batches):
        for batch in slices(batches, rows_at_once):
            made = rows([batch.column(batch.schema.get_field_index(c)) for c in inputs])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in range(batch.num_columns)], made],
                names=[*batch.schema.names, name],
            )

    return base.mapInArrow(stage, schema)


def remainder(column: str, base: int) -> Column:
    """``crc32(id as text) mod base``; a null id counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(base))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Each name, with underscores before it until no column of ``df`` has it, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def signed(values: np.ndarray) -> pa.Array:
    """Unsigned 64-bit values as the signed longs that Spark stores."""
    return pa.array(np.ascontiguousarray(values).view(np.int64), pa.int64())
