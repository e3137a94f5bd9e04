"""Line dedup that can be extended and reversed: exact reference counts behind cuckoo filters.

The index of a corpus has three tables, all sharded by the key's hash:

* ``postings``: which document holds which line key, once per document;
* ``counts``: per key the number of documents (``refs``) and the smallest doc_id (``owner``);
* ``filters``: one cuckoo filter per shard of the keys that at least two documents hold.

Inserting or deleting documents changes the postings, recounts only the keys they touch, and adds
to or removes from the filters the keys that crossed two documents; the rest is kept as it is. To
decide on lines, documents send their keys to the shards, the filter drops nearly all keys that
occur once, and what passes is checked against the exact counts. A shard with more lines than
others (a very frequent line) is searched by several tasks, each with a copy of its filter.

Keys stand for lines by a 128-bit hash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import BLANKS, annotated, free_names, slices, utf8
from riskloom.llm.cuckoo import CuckooFilter
from riskloom.session import write_out

MIN_CHARS = 10
SHARD_ROWS = 200_000
KEY = ["shard", "k1", "k2"]
LINE = [*KEY, "doc_id", "text_hash"]
NO_ID = (1 << 63) - 1
RESULT = (
    T.StructType()
    .add("n_lines", T.LongType())
    .add("n_dropped", T.LongType())
    .add("kept", T.StringType())
)


def _keyed_lines(text: bytes | None, least: int) -> list[tuple[bytes, bytes | None]]:
    """Lines of a text, each with the hash of its key, or None where the key is too short."""
    text = text or b""
    out = []
    for line, low in zip(text.split(b"\n"), text.lower().split(b"\n")):
        key = low.strip(BLANKS)
        long = len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)
        out.append((line, xxhash.xxh3_128_digest(key) if long else None))
    return out


def line_keys(documents: DataFrame, text: str, doc_id: str, least: int = MIN_CHARS) -> DataFrame:
    """``k1, k2, doc_id, text_hash`` once per document row and key; a null id is the largest."""

    def stage(batches):
        for batch in slices(batches):
            hashes, sizes = [], []
            for value in utf8(batch.column(2)):
                keys = {h for _, h in _keyed_lines(value, least) if h is not None}
                hashes += keys
                sizes.append(len(keys))
            pairs = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            ids = [np.repeat(batch.column(i).to_numpy(), sizes) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (pairs[:, 0], pairs[:, 1], *ids)],
                names=["k1", "k2", "doc_id", "text_hash"],
            )

    chosen = documents.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        F.col(text).alias("text"),
    )
    return chosen.mapInArrow(stage, "k1 long, k2 long, doc_id long, text_hash long")


@dataclass
class LineIndex:
    """Postings, counts and filters of the documents inserted so far; the tables are stored."""

    shards: int
    postings: DataFrame
    counts: DataFrame
    filters: DataFrame
    least: int = MIN_CHARS

    @classmethod
    def empty(cls, spark, lines: int = 0, least: int = MIN_CHARS) -> LineIndex:
        """An index laid out for about ``lines`` postings; it may hold any number."""
        wide = 4 * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
        shards = max(wide, math.ceil(lines / SHARD_ROWS))
        # Empty tables of the JVM: rows from the driver's Python would cost a second set of workers.
        none = spark.range(0)
        key = none.select(*[F.col("id").alias(c) for c in KEY])
        return cls(
            shards,
            key.withColumn("doc_id", F.col("k1")),
            key.withColumn("refs", F.col("k1")).withColumn("owner", F.col("k1")),
            none.selectExpr("id AS shard", "CAST(string(id) AS BINARY) AS cells"),
            least,
        )

    def insert(self, documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> LineIndex:
        """The index with these documents too. Rows of one doc_id count as one document.

        There are more shards once the postings outgrow ``SHARD_ROWS`` for each of them.
        """
        return self.insert_keys(line_keys(documents, text, doc_id, self.least))

    def insert_keys(self, lines: DataFrame) -> LineIndex:
        """Like ``insert``, for documents whose lines are at hand (``line_keys``)."""
        new = lines.select("k1", "k2", "doc_id").distinct()
        if not self.postings.isEmpty():
            new = new.join(self.postings, ["k1", "k2", "doc_id"], "left_anti")
        new = write_out(new)
        base = self._fitted(self.postings.count() + new.count())
        new = base._sharded(new)
        return base._recounted(base.postings.unionByName(new), new)

    def _sharded(self, rows: DataFrame) -> DataFrame:
        shard = F.pmod("k1", F.lit(self.shards)).alias("shard")
        return rows.select(shard, *[c for c in rows.columns if c != "shard"])

    def _fitted(self, lines: int) -> LineIndex:
        """The same index in enough shards for so many postings, twice as many at least."""
        if lines <= self.shards * SHARD_ROWS:
            return self
        made = replace(self, shards=max(2 * self.shards, math.ceil(lines / SHARD_ROWS)))
        made.postings, made.counts = made._sharded(self.postings), made._sharded(self.counts)
        if not self.counts.isEmpty():
            held = made.counts.filter("refs >= 2").select("shard", "k1")
            made.filters = write_out(_changed(self.filters, held, held, True))
        return made

    def delete(self, ids: DataFrame, doc_id: str = "doc_id") -> LineIndex:
        """The index without the documents of these ids; unknown ids change nothing."""
        gone_ids = ids.select(
            F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc_id")
        ).distinct()
        gone = write_out(self.postings.join(gone_ids, "doc_id", "left_semi").select(*KEY, "doc_id"))
        left = write_out(self.postings.join(gone_ids, "doc_id", "left_anti").select(*KEY, "doc_id"))
        return self._recounted(left, gone)

    def _recounted(self, postings: DataFrame, touched: DataFrame) -> LineIndex:
        first = self.counts.isEmpty()
        mine = postings
        if not first:
            keys = touched.select(*KEY).distinct()
            mine = postings.join(keys, KEY, "left_semi")
        fresh = mine.groupBy(*KEY).agg(
            F.count("*").alias("refs"), F.min("doc_id").alias("owner")
        )
        if first:
            counts = write_out(fresh)
            crossed = counts.filter("refs >= 2").select("shard", "k1", F.lit(True).alias("added"))
        else:
            fresh = write_out(fresh)
            counts = write_out(
                self.counts.join(keys, KEY, "left_anti").unionByName(fresh)
            )
            now = fresh.filter("refs >= 2").select(*KEY, F.lit(True).alias("now"))
            was = (
                self.counts.join(keys, KEY, "left_semi")
                .filter("refs >= 2")
                .select(*KEY, F.lit(True).alias("was"))
            )
            crossed = (
                now.join(was, KEY, "full")
                .filter("now IS NULL OR was IS NULL")
                .select("shard", "k1", F.col("now").isNotNull().alias("added"))
            )
        held = counts.filter("refs >= 2").select("shard", "k1")
        filters = write_out(_changed(self.filters, crossed, held, first))
        return replace(self, postings=postings, counts=counts, filters=filters)

    def repeated(self, lines: DataFrame) -> DataFrame:
        """Of the lines (``line_keys``), those that another document with a smaller id holds too."""
        lines = self._sharded(lines)
        mean = self.postings.count() / self.shards
        salts = F.ceil(F.col("count") / (2 * mean + 1)).cast("int")
        # Shards of more than twice the mean: fewer than half of the shards, so fit to broadcast.
        sizes = (
            self.postings.groupBy("shard").count()
            .select("shard", salts.alias("salts"))
            .filter("salts > 1")
        )
        spread = lines.join(F.broadcast(sizes), "shard", "left").select(
            *LINE,
            F.pmod(F.xxhash64("doc_id", "text_hash"), F.coalesce("salts", F.lit(1))).alias("salt"),
        )
        copies = self.filters.join(F.broadcast(sizes), "shard", "left").select(
            "shard",
            F.explode(
                F.sequence(F.lit(0).cast("long"), F.coalesce("salts", F.lit(1)).cast("long") - 1)
            ).alias("salt"),
            "cells",
        )
        passed = (
            spread.groupBy("shard", "salt")
            .cogroup(copies.groupBy("shard", "salt"))
            .applyInArrow(_passing, ", ".join(f"{c} long" for c in LINE))
        )
        exact = self.counts.filter("refs >= 2").select(*KEY, "owner")
        return passed.join(exact, KEY).filter("doc_id > owner").select(*LINE[1:])


def _changed(filters: DataFrame, crossed: DataFrame, held: DataFrame, first: bool) -> DataFrame:
    """Filters after the keys in ``crossed`` came to or fell from two documents.

    A filter that has no room is made anew from the exact counts of its shard.
    """
    schema = "shard long, cells binary"
    if first:

        def build(keys: pa.Table) -> pa.Table:
            cells = CuckooFilter.of(_hashes(keys)).dumps()
            return pa.table({"shard": keys.column("shard")[:1], "cells": pa.array([cells])})

        return held.groupBy("shard").applyInArrow(build, schema)

    def change(old: pa.Table, keys: pa.Table) -> pa.Table:
        if not keys.num_rows:
            return old.select(["shard", "cells"])
        mine = CuckooFilter.loads(old.column("cells")[0].as_py()) if old.num_rows else None
        kinds, hashes = keys.column("kind").to_numpy(), _hashes(keys)
        room = mine is not None
        if room:
            for h in hashes[kinds == 0]:
                mine.remove(int(h))
            room = all(mine.add(int(h)) for h in hashes[kinds == 1])
        if not room:
            now = np.concatenate([hashes[kinds == 1], hashes[kinds == 2]])
            mine = CuckooFilter.of(np.unique(now))
        return pa.table({"shard": keys.column("shard")[:1], "cells": pa.array([mine.dumps()])})

    touched = crossed.select("shard").distinct()
    rows = crossed.select("shard", "k1", F.col("added").cast("int").alias("kind")).unionByName(
        held.join(touched, "shard", "left_semi").select("shard", "k1", F.lit(2).alias("kind"))
    )
    return (
        filters.groupBy("shard")
        .cogroup(rows.groupBy("shard"))
        .applyInArrow(change, schema)
    )


def _hashes(table: pa.Table) -> np.ndarray:
    return table.column("k1").to_numpy().view(np.uint64)


def _passing(lines: pa.Table, filters: pa.Table) -> pa.Table:
    lines = lines.select(LINE)
    if not lines.num_rows or not filters.num_rows:
        return lines.slice(0, 0)
    cells = CuckooFilter.loads(filters.column("cells")[0].as_py())
    return lines.filter(pa.array(cells.holds(_hashes(lines))))


def deduplicated(
    documents: DataFrame,
    index: LineIndex | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    into: str = "lines",
) -> DataFrame:
    """``documents`` with a struct ``into``: ``n_lines``, ``n_dropped`` and the text ``kept``.

    A line goes if its key has at least ``MIN_CHARS`` code points and a document with a smaller id
    holds it too. Without ``index``, one of these documents is made. Null and empty texts are one
    empty line. Rows that share a doc_id count as one document, so neither loses lines to the
    other; a null id counts as the largest id. Ids must be numbers. Other columns pass through,
    whatever their names; one named ``into`` is replaced. An empty table stays empty.
    """
    documents = documents.drop(into)
    gone, doc, hash_ = free_names(documents, "_drops", "_doc", "_text_hash")
    spark = documents.sparkSession
    least = index.least if index else MIN_CHARS
    lines = line_keys(documents, text, doc_id, least)
    if index is None:  # both ways need the keys, and the texts pass Python once for them
        lines = write_out(lines)
        index = LineIndex.empty(spark).insert_keys(lines)
    # Rows of one id share no list, or one of a frequent id would hold the lines of all its texts.
    drops = (
        index.repeated(lines)
        .groupBy(F.col("doc_id").alias(doc), F.col("text_hash").alias(hash_))
        .agg(F.collect_set(F.struct("k1", "k2")).alias(gone))
    )
    key = {
        doc: F.coalesce(documents[doc_id].cast("long"), F.lit(NO_ID)),
        hash_: F.xxhash64(documents[text]),
    }
    joined = documents.withColumns(key).join(drops, list(key), "left").drop(*key)

    def rows(columns: list[pa.Array]) -> pa.Array:
        n_lines, n_dropped, kept = [], [], []
        for value, drops in zip(utf8(columns[0]), columns[1].to_pylist()):
            if not drops:
                n_lines.append((value or b"").count(b"\n") + 1)
                n_dropped.append(0)
                kept.append((value or b"").decode())
                continue
            gone = {np.array([d["k1"], d["k2"]]).tobytes() for d in drops}
            lines = _keyed_lines(value, least)
            left = [line for line, h in lines if h not in gone]
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(left))
            kept.append(b"\n".join(left).decode())
        return pa.StructArray.from_arrays(
            [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept)],
            names=["n_lines", "n_dropped", "kept"],
        )

    return annotated(joined, [text, gone], into, RESULT, rows).drop(gone)


def with_unique_lines(documents: DataFrame) -> DataFrame:
    """Documents with their repeated lines dropped and ``n_chars`` set anew."""
    lines = free_names(documents, "_lines")[0]
    made = deduplicated(documents, into=lines)
    return made.withColumns(
        {
            "text": F.col(f"{lines}.kept"),
            "n_chars": F.length(f"{lines}.kept").cast("long"),
        }
    ).select(*documents.columns)


def op10_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Per document: lines, lines dropped, and the hash of the text that stays."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return deduplicated(documents).select(
        "doc_id",
        "lines.n_lines",
        "lines.n_dropped",
        F.sha2(F.col("lines.kept").cast("binary"), 256).alias("kept_sha256"),
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP10_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), split AS (
  SELECT r, doc_id, i, lines[i] AS line,
    translate(regexp_replace(lines[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
      '{_UPPER}', '{_LOWER}') AS k
  FROM (SELECT r, doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM docs)
), owners AS (
  SELECT k, min(doc_id) AS owner, count(DISTINCT doc_id) AS refs FROM split
  WHERE length(k) >= {MIN_CHARS} GROUP BY k
), marked AS (
  SELECT r, split.doc_id, i, line, coalesce(refs >= 2 AND split.doc_id <> owner, FALSE) AS gone
  FROM split LEFT JOIN owners USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""
