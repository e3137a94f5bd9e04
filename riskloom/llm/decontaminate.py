"""Benchmark decontamination: prefix-filtered containment join of item windows and documents.

A window is ``WINDOW`` consecutive words of an item, or the whole item if it is shorter. A document
contains a window only if it contains the window's rarest word, so with exact containment a prefix
of one word is enough: windows are filed under their rarest word (rarity is counted over all
documents), each document word that heads such a file is a candidate, length and position bounds
drop candidates whose window would reach over either end, and the remaining ones are compared word
by word.

A benchmark of at most ``BLOCK_BYTES`` is indexed on the driver and broadcast, and documents are not
shuffled. A larger one is cut, counted and filed by Spark; documents are held against a filter of
fixed size that knows each head word and its place in its window, and the stretches that pass are
joined to the windows, exactly and with frequent windows salted.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import annotated, free_names, slices, utf8
from riskloom.operators.joins import attach, lookup
from riskloom.session import write_out

WINDOW = 10
BLOCK_BYTES = 8_000_000
# Bits of the filter of a larger benchmark (4 MB), and words a task counts before it sends.
FILTER_BITS = 1 << 25
HELD_WORDS = 200_000
RESULT = (
    T.StructType()
    .add("n_words", T.LongType())
    .add("spans", T.ArrayType(T.IntegerType()))
    .add("items", T.ArrayType(T.StringType()))
)

# ASCII letters and digits stay (letters in lower case), bytes beyond ASCII stay, all else parts.
_WORD_BYTES = bytes(
    c if c >= 128 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 32
    for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text: runs of ASCII letters (lower-cased), digits and non-ASCII."""
    return text.translate(_WORD_BYTES).split() if text else []


def windows_of(words: list[bytes], size: int = WINDOW) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    size = min(size, len(words))
    return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]


def _index(items: list[tuple[str, bytes | None]], counts: dict[bytes, int], size: int) -> dict:
    """Rarest word -> (its offset, window length) -> joined window -> item ids."""
    index: dict = defaultdict(lambda: defaultdict(lambda: defaultdict(set)))
    for item, text in items:
        for window in windows_of(words_of(text), size):
            offset = min(range(len(window)), key=lambda i: (counts.get(window[i], 0), window[i]))
            index[window[offset]][offset, len(window)][b" ".join(window)].add(item)
    return {
        w: [(o, n, {k: sorted(v) for k, v in at.items()}) for (o, n), at in sorted(by.items())]
        for w, by in index.items()
    }


def _found(words: list[bytes], index: dict) -> tuple[list[tuple[int, int]], set[str]]:
    spans, items = [], set()
    for at in [i for i, w in enumerate(words) if w in index]:
        for offset, size, windows in index[words[at]]:
            start = at - offset
            if start < 0 or start + size > len(words):
                continue
            held = windows.get(b" ".join(words[start : start + size]))
            if held is not None:
                spans.append((start, start + size))
                items.update(held)
    return spans, items


def merged(spans: list[tuple[int, int]]) -> list[int]:
    """Overlapping or touching spans as one flat list of starts and ends."""
    out: list[int] = []
    for start, end in sorted(spans):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def _counted(documents: DataFrame, text: str, vocabulary) -> dict[bytes, int]:
    """How often each word of the block's vocabulary occurs in all documents."""

    def stage(batches):
        held, total = vocabulary.value, Counter()
        for batch in slices(batches):
            for value in utf8(batch.column(0)):
                total.update(w for w in words_of(value) if w in held)
        yield pa.RecordBatch.from_pydict(
            {
                "word": pa.array(list(total), pa.binary()),
                "n": pa.array(list(total.values()), pa.int64()),
            }
        )

    sums = (
        documents.select(text)
        .mapInArrow(stage, "word binary, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )
    return {bytes(r["word"]): r["n"] for r in sums.collect()}


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    into: str = "contamination",
) -> DataFrame:
    """``documents`` with a struct ``into``: ``n_words``, ``spans`` of hit words, ``items`` found.

    ``spans`` holds starts and ends of disjoint word ranges in turn; ``items`` the distinct ids, as
    strings, of items of which a window occurs. Null and empty texts have no words. Items without
    words have no window; a null item id is the empty string; repeated items count once per id.
    Repeated documents stay. Other columns pass through, one named ``into`` is replaced. An empty
    benchmark hits nothing; an empty table of documents stays empty. ``block_bytes`` of items are
    broadcast at most; it changes no result.
    """
    spark = documents.sparkSession
    held = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
        F.col(item_text).cast("string").alias("text"),
    ).filter(F.length("text") > 0)
    size = held.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > block_bytes:
        return _joined(documents, held, text, window, into)
    items = [(r["item"], r["text"].encode()) for r in held.distinct().collect()]
    vocabulary = spark.sparkContext.broadcast({w for _, t in items for w in words_of(t)})
    counts = _counted(documents, text, vocabulary) if items else {}
    index = spark.sparkContext.broadcast(_index(items, counts, window))
    return annotated(documents, [text], into, RESULT, _matcher(index))


def _pack(rows: list[tuple[int, list[int], list[str]]]) -> pa.Array:
    n_words, spans, items = zip(*rows) if rows else ((), (), ())
    return pa.StructArray.from_arrays(
        [
            pa.array(n_words, pa.int64()),
            pa.array(spans, pa.list_(pa.int32())),
            pa.array(items, pa.list_(pa.string())),
        ],
        names=["n_words", "spans", "items"],
    )


def _matcher(index):
    def rows(columns: list[pa.Array]) -> pa.Array:
        held, out = index.value, []
        for value in utf8(columns[0]):
            words = words_of(value)
            spans, items = _found(words, held)
            out.append((len(words), merged(spans), sorted(items)))
        return _pack(out)

    return rows


def _stated(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    arrays = [pa.array(c, t) for c, t in zip(columns, kinds.values())]
    return pa.RecordBatch.from_arrays(arrays, names=list(kinds))


def _item_windows(held: DataFrame, size: int) -> DataFrame:
    """``item, window`` for every window of every item, words parted by a space."""
    kinds = {"item": pa.string(), "window": pa.string()}

    def cut(batches):
        for batch in slices(batches, 16):
            items = batch.column(0).to_pylist()
            rows = [
                (item, b" ".join(window).decode())
                for item, text in zip(items, utf8(batch.column(1)))
                for window in windows_of(words_of(text), size)
            ]
            yield _stated(rows, kinds)

    return held.select("item", "text").mapInArrow(cut, "item string, window string").distinct()


def _word_counts(documents: DataFrame, text: str) -> DataFrame:
    """``word, n`` over all documents; tasks add up before they send."""
    kinds = {"word": pa.string(), "n": pa.int64()}

    def count(batches):
        total = Counter()
        for batch in slices(batches, 16):
            for value in utf8(batch.column(0)):
                total.update(words_of(value))
                if len(total) > HELD_WORDS:
                    yield _stated([(w.decode(), n) for w, n in total.items()], kinds)
                    total.clear()
        yield _stated([(w.decode(), n) for w, n in total.items()], kinds)

    sent = documents.select(F.col(text).cast("string")).mapInArrow(count, "word string, n long")
    return sent.groupBy("word").agg(F.sum("n").alias("n"))


def _heads(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """``word, at, size`` per window: its rarest word, the place of it, and how many words it has."""
    words = windows.select("window", F.posexplode(F.split("window", " ")).alias("at", "word"))
    words = words.withColumn("size", F.size(F.split("window", " ")))
    rare = words.select("word").distinct().join(counts, "word", "left")
    rare = rare.select("word", F.coalesce("n", F.lit(0)).alias("n"))
    head = F.min(F.struct("n", "word", "at", "size")).alias("head")
    return lookup(words, rare, ["word"], "inner").groupBy("window").agg(head).select("head.*")


def _bits(heads: DataFrame) -> np.ndarray:
    """A bit for each head word, and one for each head word with its place and window length.

    The array has ``FILTER_BITS`` whatever the size of the benchmark; more windows than it can tell
    apart cost candidates, not results.
    """
    place = F.concat_ws(" ", "at", "size")
    hashes = F.array(F.xxhash64("word"), F.xxhash64("word", place))
    found = (
        heads.select(F.explode(hashes).alias("hash"))
        .select(F.pmod("hash", F.lit(FILTER_BITS)).alias("bit"))
        .select(
            F.floor(F.col("bit") / 64).cast("int").alias("at"),
            F.expr("shiftleft(1L, cast(bit % 64 as int))").alias("mask"),
        )
        .groupBy("at")
        .agg(F.bit_or("mask").alias("mask"))
        .toArrow()
    )
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[found["at"].to_numpy()] = found["mask"].to_numpy()
    return bits


def _candidates(words: list[bytes], bits: np.ndarray, places: list[tuple[int, int]]) -> list[dict]:
    """Starts and words of stretches that may be windows: a head word stands where it should."""

    def known(value: int) -> bool:
        bit = value % FILTER_BITS
        return bool(bits[bit >> 6] >> (bit & 63) & 1)

    filed: dict[bytes, list[tuple[int, int]]] = {}
    out = []
    for at, word in enumerate(words):
        if word not in filed:
            # As Spark hashes two columns: the hash of the first is the seed of the second.
            seed = xxhash.xxh64_intdigest(word, seed=42)
            filed[word] = [
                (offset, size)
                for offset, size in (places if known(seed) else ())
                if known(xxhash.xxh64_intdigest(f"{offset} {size}", seed=seed))
            ]
        for offset, size in filed[word]:
            start = at - offset
            if start >= 0 and start + size <= len(words):
                stretch = b" ".join(words[start : start + size]).decode()
                out.append({"start": start, "end": start + size, "window": stretch})
    return out


def _joined(
    documents: DataFrame, held: DataFrame, text: str, window: int, into: str
) -> DataFrame:
    """``contamination`` by joins: no part of the benchmark passes the driver or is broadcast.

    Documents are read twice and written once, whatever the size of the benchmark.
    """
    taken = documents.withColumn(into, F.lit(0))
    row, seen, spans, items = free_names(taken, "_row", "_seen", "_spans", "_items")
    pairs = write_out(_item_windows(held, window))
    heads = write_out(
        _heads(pairs.select("window").distinct(), _word_counts(documents, text))
        .select("word", "at", "size")
        .distinct()
    )
    # At most one place for each word of each window length.
    places = [tuple(r) for r in heads.select("at", "size").distinct().collect()]
    bits = documents.sparkSession.sparkContext.broadcast(_bits(heads))
    kind = T.StructType().add("n_words", T.LongType())
    stretch = T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType())
    kind = kind.add("found", T.ArrayType(stretch.add("window", T.StringType())))
    arrow = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("window", pa.string())])

    def candidates(columns: list[pa.Array]) -> pa.Array:
        words = [words_of(value) for value in utf8(columns[0])]
        found = [_candidates(w, bits.value, places) for w in words]
        return pa.StructArray.from_arrays(
            [pa.array(map(len, words), pa.int64()), pa.array(found, pa.list_(arrow))],
            names=["n_words", "found"],
        )

    base = documents.drop(into).withColumn(row, F.monotonically_increasing_id())
    base = write_out(annotated(base, [text], seen, kind, candidates))
    asked = base.select(row, F.inline(F.col(seen)["found"]))
    files = pairs.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias(items))
    hits = (
        lookup(asked, files, ["window"], "inner")
        .groupBy(row)
        .agg(
            F.collect_set(F.struct("start", "end")).alias(spans),
            F.array_distinct(F.flatten(F.collect_set(items))).alias(items),
        )
    )
    joined = attach(base, write_out(hits), [row], settled=True)

    def rows(columns: list[pa.Array]) -> pa.Array:
        sizes = columns[0].field("n_words").to_pylist()
        found = zip(sizes, columns[1].to_pylist(), columns[2].to_pylist())
        return _pack(
            [
                (n, merged([(s["start"], s["end"]) for s in at or ()]), sorted(held or ()))
                for n, at, held in found
            ]
        )

    slim = joined.withColumn(seen, F.struct(F.col(seen)["n_words"].alias("n_words")))
    return annotated(slim, [seen, spans, items], into, RESULT, rows).drop(row, seen, spans, items)


def without_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents in which no window of any item occurs, with their own columns."""
    found = contamination(documents, benchmark, into="_contamination")
    return found.filter(F.size("_contamination.items") == 0).select(*documents.columns)


def op8_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Per document: words, hit words, items found and whether any was."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contamination(documents, benchmark)
    spans = F.col("contamination.spans")
    hit = F.aggregate(
        F.sequence(F.lit(1), F.size(spans)),
        F.lit(0).cast("long"),
        lambda total, i: total
        + F.when(i % 2 == 0, spans[i - 1]).otherwise(-spans[i - 1]).cast("long"),
    )
    hit = F.when(F.size(spans) > 0, hit).otherwise(F.lit(0).cast("long"))
    return found.select(
        "doc_id",
        F.col("contamination.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("contamination.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("contamination.items"), ","), 256).alias("items_sha256"),
        (F.size("contamination.items") > 0).alias("contaminated"),
    )


_WORDS_SQL = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP8_SQL = rf"""
WITH items AS (
  SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS_SQL} AS w FROM benchmark
), sized AS (
  SELECT item, w, least(len(w), {WINDOW}) AS size FROM items WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item, size, array_to_string(w[i : i + size - 1], ' ') AS words
  FROM (SELECT item, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM sized)
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS_SQL} AS w FROM documents
), sizes AS (
  SELECT DISTINCT size FROM windows
), grams AS (
  SELECT r, i, size, array_to_string(w[i : i + size - 1], ' ') AS words
  FROM (
    SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes
    WHERE len(w) >= size
  )
), found AS (
  SELECT r, i, size, item FROM grams JOIN windows USING (size, words)
), hits AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT r, unnest(range(i, i + size)) AS p FROM found) GROUP BY r
), held AS (
  SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids
  FROM found GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN held USING (r)
"""
