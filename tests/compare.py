"""Compare a Spark result with a DuckDB result, order of rows and columns aside."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~null"
    if isinstance(v, float):
        return repr(v + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(df, rows, con, sql: str) -> str | None:
    """A description of the first difference, or None when results and types agree."""
    rel = con.sql(sql)
    want_types = dict(zip(rel.columns, map(str, rel.types)))
    want_cols, want = rows_of(list(rel.columns), rel.fetchall())
    got_cols, got = rows_of(df.columns, [tuple(r) for r in rows])
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    for name, kind in df.dtypes:
        if SAME_TYPE.get(kind, kind) != want_types[name]:
            return f"type of {name}: {kind} != {want_types[name]}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        pairs = [
            (c, x, y) for g, w in bad[:3] for c, x, y in zip(got_cols, g, w) if x != y
        ]
        return f"{len(bad)} of {len(want)} rows differ, e.g. {pairs[:8]}"
    return None
