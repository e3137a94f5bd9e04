"""How far sources of a language differ in their words: an audit in exact integer arithmetic.

Words are counted without a dictionary. A task joins the texts of a shard in one Arrow buffer, takes
a pointer to each word's start, and sorts the pointers by multikey quicksort with eight bytes as one
character: large slices are split into less, equal and greater than a pivot, small slices of one
depth are sorted together, and what is equal goes on with its next eight bytes. The sort keeps text
order among equal words, so an equal run yields the word's occurrences and documents per group.
Spark adds up the shards, keeps the frequent words of each language, and compares groups:

* ``pair``: every other source of the language with the symmetric divergence, summed over all words;
* ``term``: the words that a source uses most above its language.

The sum over all words of a pair is what a word absent from both adds, times the number of words,
plus what the words present in either add beyond that. Blocks of words are compared in numpy, for
at most ``SOURCES`` times ``SOURCES`` sources at once, so a task holds no whole language.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.joins import attach
from riskloom.session import write_out

MIN_DOCS = 10
TOP_TERMS = 10
SHARD_BYTES = 16_000_000
SMALL = 4_096
SOURCES = 256
BLOCK_ROWS = 200_000
CHUNK_CELLS = 1_000_000
SCALE = 1_000_000_000
GROUP = ["lang", "source"]

_FOLD = np.zeros(256, np.uint8)  # A-Z to a-z, other letters and bytes of longer characters as is
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[128:] = np.arange(128, 256)


def word_pointers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of every word in folded ``data``, whose texts begin at ``offsets``."""
    inside = data != 0
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | border[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | border[1:-1]
    first = np.flatnonzero(starts)
    return first, np.flatnonzero(ends) - first + 1


def equal_runs(
    data: np.ndarray, starts: np.ndarray, lengths: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers by equal word, in text order inside a run, and the sizes of the runs.

    ``data`` must have eight more bytes after its last word.
    """
    windows = np.ndarray((max(len(data) - 7, 0),), ">u8", data, 0, (1,))
    done: list[tuple[np.ndarray, np.ndarray]] = []

    def keys(words: np.ndarray, depth: int) -> np.ndarray:
        left = lengths[words] - 8 * depth
        at = np.where(left > 0, starts[words] + 8 * depth, starts[words])
        cut = (8 * np.clip(8 - left, 0, 7)).astype(np.uint64)
        found = windows[at].astype(np.uint64) >> cut << cut
        return np.where(left > 0, found, np.uint64(0))

    # The slices of a depth, end to end, and their sizes.
    words, sizes, depth = np.arange(len(starts)), np.array([len(starts)]), 0
    while len(words):
        key = keys(words, depth)
        deeper: list[tuple[np.ndarray, np.ndarray]] = []
        # A slice that is large goes on the stack; numbers part the small ones when sorted at once.
        large = sizes > SMALL
        part = np.repeat(large, sizes)
        small = [(words[~part], key[~part], sizes[~large])]
        ends = np.cumsum(sizes)
        stack = [
            (words[end - size : end], key[end - size : end])
            for end, size in zip(ends[large].tolist(), sizes[large].tolist())
        ]
        while stack:
            here, key = stack.pop()
            sample = np.sort(key[:: max(1, len(key) // 255)])
            pivot = sample[len(sample) // 2]
            equal = here[key == pivot]
            (deeper if int(pivot) & 255 else done).append((equal, np.array([len(equal)])))
            for side in (key < pivot, key > pivot):
                found = (here[side], key[side])
                if len(found[0]) > SMALL:
                    stack.append(found)
                elif len(found[0]):
                    small.append((*found, np.array([len(found[0])])))
        words, key, sizes = [np.concatenate(x) for x in zip(*small)]
        if len(words):
            number = np.repeat(np.arange(len(sizes)), sizes)
            by = np.lexsort((key, number))
            words, key, number = words[by], key[by], number[by]
            changed = (key[1:] != key[:-1]) | (number[1:] != number[:-1])
            begins = np.flatnonzero(np.append(True, changed))
            sizes = np.diff(np.append(begins, len(words)))
            # Words that go on after equal bytes, unless there is one word only.
            more = ((key[begins] & np.uint64(255)) != 0) & (sizes > 1)
            whole = np.repeat(more, sizes)
            done.append((words[~whole], sizes[~more]))
            deeper.append((words[whole], sizes[more]))
        words, sizes = [np.concatenate(x) for x in zip(*deeper)] if deeper else (words[:0], sizes[:0])
        depth += 1
    return np.concatenate([w for w, _ in done]), np.concatenate([n for _, n in done])


def _texts_of(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The words themselves as one string array."""
    ends = np.cumsum(lengths)
    index = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)
    offsets = np.append(0, ends).astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[index])]
    ).cast(pa.string())


def shard_counts(
    texts: pa.Array, groups: np.ndarray
) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Per group number and word of a shard: group, word, occurrences, documents."""
    texts = texts.cast(pa.large_string())
    until = texts.offset + len(texts) + 1
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : until]
    held = texts.buffers()[2]
    raw = np.frombuffer(held, np.uint8) if held else np.zeros(0, np.uint8)
    data = np.zeros(int(offsets[-1] - offsets[0]) + 8, np.uint8)
    np.take(_FOLD, raw[offsets[0] : offsets[-1]], out=data[:-8])
    offsets = offsets - offsets[0]
    starts, lengths = word_pointers(data[:-8], offsets)
    if not len(starts):
        return np.zeros(0, int), pa.array([], pa.string()), np.zeros(0, int), np.zeros(0, int)
    words, sizes = equal_runs(data, starts, lengths)
    run = np.repeat(np.arange(len(sizes)), sizes)
    doc = np.searchsorted(offsets, starts[words], side="right") - 1
    first = np.ones(len(words), np.int64)
    first[1:] = (run[1:] != run[:-1]) | (doc[1:] != doc[:-1])
    wide = int(groups.max()) + 1
    cell = run * wide + groups[doc]
    by = np.argsort(cell, kind="stable")
    cell = cell[by]
    begins = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    heads = words[np.cumsum(sizes) - sizes]
    names = _texts_of(data, starts[heads], lengths[heads])
    return (
        cell[begins] % wide,
        names.take(pa.array(cell[begins] // wide)),
        np.diff(np.append(begins, len(cell))),
        np.add.reduceat(first[by], begins),
    )


def _counting(batches):
    """Shards of about ``SHARD_BYTES``; a longer text is a shard of its own."""
    waiting: list[pa.RecordBatch] = []

    def flush():
        table = pa.Table.from_batches(waiting).combine_chunks()
        waiting.clear()
        langs = table.column("lang").chunk(0).dictionary_encode()
        sources = table.column("source").chunk(0).dictionary_encode()
        many = max(len(sources.dictionary), 1)
        both = langs.indices.to_numpy().astype(np.int64) * many + sources.indices.to_numpy()
        groups, terms, n, docs = shard_counts(table.column("text").chunk(0), both)
        return pa.RecordBatch.from_arrays(
            [
                langs.dictionary.take(pa.array(groups // many)),
                sources.dictionary.take(pa.array(groups % many)),
                terms,
                pa.array(n, pa.int64()),
                pa.array(docs, pa.int64()),
            ],
            names=[*GROUP, "term", "n", "docs"],
        )

    held = 0
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
        start = 0
        for end, size in enumerate(sizes.tolist()):
            if held and held + size > SHARD_BYTES:
                if end > start:
                    waiting.append(batch.slice(start, end - start))
                yield flush()
                start, held = end, 0
            held += size
        if start < batch.num_rows:
            waiting.append(batch.slice(start))
    if waiting:
        yield flush()


def word_counts(documents: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences of each word and documents that hold it."""
    read = documents.select(
        *[
            F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
            for c, n in ((lang, "lang"), (source, "source"), (text, "text"))
        ]
    )
    shards = read.mapInArrow(
        _counting, "lang string, source string, term string, n long, docs long"
    )
    return shards.groupBy(*GROUP, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: str, total: str, kept: str) -> Column:
    """``1 + floor(SCALE * (count + 2) / (total + 2 * kept))``, in decimals; null without words."""
    exact = f"1 + ({SCALE}BD * ({count} + 2)) div ({total} + 2 * {kept})"
    return F.when(F.col(kept) > 0, F.expr(exact))


def _divergence(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _compared(table: pa.Table) -> pa.Table:
    """What the words of one block add to each pair of sources beyond words absent from both.

    Rows without a term give a source's share of an absent word. ``side`` is 0 for sources of the
    first block of sources, 1 for those of the second; in a block paired with itself all have 0.
    """
    lang = table.column("lang")[0]
    bucket_pair = table.column("first")[0].as_py() == table.column("second")[0].as_py()
    term = table.column("term").combine_chunks()
    absent = term.is_null().to_numpy(zero_copy_only=False)
    side = table.column("side").to_numpy()
    index = table.column("idx").to_numpy()
    p = table.column("p").to_numpy()
    marks = [np.flatnonzero(absent & (side == s)) for s in (0, 1)]
    marks = [m[np.argsort(index[m])] for m in marks]
    if bucket_pair:
        marks[1] = marks[0][:0]
    split = len(marks[0])
    columns = np.concatenate(marks)
    base = p[columns]
    source = index[columns]
    # Column of each row: by source within its side.
    column = np.where(
        side == 0,
        np.searchsorted(source[:split], index),
        split + np.searchsorted(source[split:], index),
    )
    rows = np.flatnonzero(~absent)
    word = term.dictionary_encode().indices.fill_null(0).to_numpy(zero_copy_only=False)
    n = len(columns)
    extra = np.zeros((n, n), np.int64)
    rows = rows[np.argsort(word[rows], kind="stable")]
    word = word[rows].astype(np.int64)
    step = max(1, CHUNK_CELLS // max(n, 1))
    f = lambda x, y: (x - y) * (x - y) // (x + y)
    neither = f(base[:, None], base[None, :])
    low = int(word[0]) if len(word) else 0
    high = int(word[-1]) + 1 if len(word) else 0
    for start in range(low, high, step):
        here = slice(*np.searchsorted(word, [start, start + step]))
        at, col = word[here] - start, column[rows[here]]
        share = np.tile(base, (min(step, high - start), 1))
        present = np.zeros(share.shape, bool)
        share[at, col] = p[rows[here]]
        present[at, col] = True
        for a in range(n):
            held = np.flatnonzero(present[:, a])
            if not len(held):
                continue
            more = f(share[held], share[held, a][:, None]) - neither[a]
            extra[a] += more.sum(axis=0)
            # Words that the other source lacks are not met from its side.
            extra[:, a] += (more * ~present[held]).sum(axis=0)
    if bucket_pair:
        a, b = np.triu_indices(n, 1)
    else:
        a, b = [x.ravel() for x in np.meshgrid(np.arange(split), np.arange(split, n), indexing="ij")]
    return pa.table(
        {
            "lang": pa.array([lang.as_py()] * len(a), pa.string()),
            "a": pa.array(source[a], pa.int32()),
            "b": pa.array(source[b], pa.int32()),
            "extra": pa.array(extra[a, b], pa.int64()),
        }
    )


def audited(
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = MIN_DOCS,
    top: int = TOP_TERMS,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for the parts ``pair`` and ``term``.

    Null text, language and source count as the empty string. Words are runs of letters A-Z, folded
    to lower case, and of characters beyond ASCII. Each row is a document, so repeated rows count
    each. A language keeps the words that at least ``min_docs`` of its documents hold; one without
    such words has pairs of value 0 and no terms, and one with a single source has no pairs. Equal
    values are ranked by item in UTF-8 order. Other columns are not read; an empty table gives no
    rows.
    """
    groups = documents.select(
        *[
            F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
            for c, n in ((lang, "lang"), (source, "source"))
        ]
    ).distinct()
    counts = write_out(word_counts(documents, text, lang, source))
    # A word's window holds at most one row per source of its language.
    same = Window.partitionBy("lang", "term")
    kept = write_out(
        counts.withColumns(
            {
                "held_by": F.sum("docs").over(same),
                "n_lang": F.sum("n").over(same),
                "one": (F.row_number().over(same.orderBy("source")) == 1).cast("long"),
            }
        )
        .filter(F.col("held_by") >= min_docs)
        .select(*GROUP, "term", "n", "n_lang", "one")
    )
    sizes = kept.groupBy(*GROUP).agg(
        F.sum("n").alias("total"), F.sum("one").alias("ones"), F.count("*").alias("entries")
    )
    in_lang = Window.partitionBy("lang")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    facts = write_out(
        groups.join(sizes, GROUP, "left")
        .select(*GROUP, *[zero(c).alias(c) for c in ("total", "ones", "entries")])
        .select(
            *GROUP,
            "total",
            F.sum("total").over(in_lang).alias("total_lang"),
            F.sum("ones").over(in_lang).alias("words"),
            F.sum("entries").over(in_lang).alias("entries"),
            (F.row_number().over(in_lang.orderBy("source")) - 1).cast("int").alias("idx"),
        )
        .withColumn("count", F.lit(0))
        .withColumn("p0", _share("count", "total", "words"))
        .withColumn("buckets", F.expr(f"int(ceil(entries / {BLOCK_ROWS}))"))
        .withColumn("blocks", F.expr(f"int(max(idx) OVER (PARTITION BY lang) div {SOURCES} + 1)"))
        .drop("count")
    )
    shares = attach(kept, facts, GROUP, "inner", settled=True).withColumn(
        "p", _share("n", "total", "words")
    )
    terms = (
        shares.withColumn("q", _share("n_lang", "total_lang", "words"))
        .filter("p > q")
        .select(*GROUP, F.col("term").alias("item"), _divergence("p", "q").alias("value"))
    )
    best = Window.partitionBy(*GROUP).orderBy(F.col("value").desc(), F.col("item"))
    terms = terms.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)

    others = facts.select(
        "lang", F.col("source").alias("item"), F.col("idx").alias("idx2"), F.col("p0").alias("q0")
    )
    pairs = (
        facts.join(others, "lang")
        .filter(F.col("source") != F.col("item"))
        .withColumns({"a": F.least("idx", "idx2"), "b": F.greatest("idx", "idx2")})
        .withColumn("base", F.when(F.col("words") > 0, F.col("words") * _divergence("p0", "q0")))
        .join(_extras(shares, facts), ["lang", "a", "b"], "left")
        .select(*GROUP, "item", (zero("base") + zero("extra")).alias("value"))
        .withColumn("rank", F.row_number().over(best))
    )
    named = lambda df, part: df.select(
        *GROUP, F.lit(part).alias("part"), "item", "value", "rank"
    )
    return named(pairs, "pair").unionByName(named(terms, "term"))


def _extras(shares: DataFrame, facts: DataFrame) -> DataFrame:
    """``(lang, a, b, extra)`` of pairs of source numbers ``a < b``, summed over all blocks."""
    block = F.expr(f"idx div {SOURCES}")
    both = F.explode(F.expr("transform(sequence(0L, blocks - 1L), o -> struct("
                            "least(o, block) AS first, greatest(o, block) AS second))"))

    def sent(df: DataFrame, bucket: Column, term: Column, p: str) -> DataFrame:
        return (
            df.withColumn("block", block)
            .select("lang", "idx", "block", F.col(p).alias("p"), bucket.alias("bucket"),
                    term.alias("term"), both.alias("at"))
            .select("lang", "bucket", "at.first", "at.second", "idx", "p", "term",
                    (F.expr("block > at.first")).cast("int").alias("side"))
        )

    spread = F.expr("pmod(xxhash64(term), buckets)")
    entries = sent(shares, spread, F.col("term"), "p")
    marks = sent(
        facts.filter("words > 0"),
        F.explode(F.expr("sequence(0L, buckets - 1L)")),
        F.lit(None).cast("string"),
        "p0",
    )
    return (
        entries.unionByName(marks)
        .groupBy("lang", "bucket", "first", "second")
        .applyInArrow(_compared, "lang string, a int, b int, extra long")
        .groupBy("lang", "a", "b")
        .agg(F.sum("extra").alias("extra"))
    )


def op12_source_audit(spark, sf_dir: str) -> DataFrame:
    """Sources of ``documents`` against each other and their words against their language."""
    return audited(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP12_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS text,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents
), words AS (
  SELECT r, lang, source,
    unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs
), kept AS (
  SELECT lang, term, count(*) AS n_lang FROM words GROUP BY ALL HAVING count(DISTINCT r) >= {MIN_DOCS}
), langs AS (
  SELECT lang, count(*) AS v, sum(n_lang)::BIGINT AS total_lang FROM kept GROUP BY ALL
), counted AS (
  SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
  SELECT lang, source, coalesce(sum(n), 0)::BIGINT AS total
  FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN counted USING (lang, source) GROUP BY ALL
), dense AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
    1 + ({SCALE} * (coalesce(n, 0) + 2)) // (total + 2 * v) AS p,
    1 + ({SCALE} * (n_lang + 2)) // (total_lang + 2 * v) AS q
  FROM groups JOIN kept USING (lang) JOIN langs USING (lang)
    LEFT JOIN counted USING (lang, source, term)
), sums AS (
  SELECT a.lang, a.source, b.source AS item,
    sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p))::BIGINT AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
), terms AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value
  FROM dense WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, 'pair' AS part,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank
  FROM pairs
  UNION ALL BY NAME
  SELECT *, 'term' AS part,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank
  FROM terms QUALIFY rank <= {TOP_TERMS}
)
SELECT lang, source, part, item, value, rank FROM ranked
"""
