"""Document fingerprints from closed syncmers of words, by DataFrame functions alone.

A window of ``K`` words is kept if the least hash among its runs of ``S`` words stands at either
edge of the window. Whether a window is kept depends on its own words only, so equal passages keep
equal windows wherever they stand, and any ``K - S`` consecutive windows keep at least one. The word
sequence is padded by ``K - 1`` empty words at both ends, so that every text with a word keeps some.

The fingerprint is the kept windows' 32-bit hashes in text order, 8 hex digits each; texts without a
word have the empty one. Likeness is the Jaccard index of two fingerprints' sets of hashes.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import width

K = 5
S = 2
_BLANKS = " \t\n\x0b\f\r"
_FIRST = -(1 << 63)
_LAST = (1 << 63) - 1
# Characters of a text that decide the order of rows of one id, before the hash of the whole.
PREFIX = 64
# Ranges per shuffle partition, and rows drawn per range to place its border.
RANGES = 2
DRAWN = 20


def _words(text: str) -> Column:
    return F.split(F.btrim(F.col(text), F.lit(_BLANKS)), r"[\x20\x09-\x0D]+")


def with_anchors(df: DataFrame, text: str, into: str, k: int = K, s: int = S) -> DataFrame:
    """``df`` with the array of kept window hashes of the non-null string column ``text``.

    Each step is a column of its own, so that it is computed once and not inside a lambda.
    """
    pad = F.array_repeat(F.lit(""), k - 1)
    runs = F.transform(
        F.sequence(F.lit(1), F.size("_w") - (s - 1)),
        lambda i: F.xxhash64(*[F.element_at("_w", i + j) for j in range(s)]),
    )
    inner = k - s + 1

    def least_at_edge(i):
        held = [F.element_at("_h", i + j) for j in range(inner)]
        return F.least(*held) == F.least(held[0], held[-1])

    windows = F.filter(F.sequence(F.lit(1), F.size("_h") - (inner - 1)), least_at_edge)
    # Every s-th run and the last one cover all words of the window.
    cover = sorted({*range(0, inner, s), inner - 1})
    hashed = F.transform(
        "_at",
        lambda i: F.shiftrightunsigned(
            F.xxhash64(*[F.element_at("_h", i + j) for j in cover]), 32
        ),
    )
    empty = F.length(F.btrim(F.col(text), F.lit(_BLANKS))) == 0
    return (
        df.withColumn("_w", F.concat(pad, _words(text), pad))
        .withColumn("_h", runs)
        .withColumn("_at", windows)
        .withColumn(into, F.when(empty, F.array().cast("array<long>")).otherwise(hashed))
        .drop("_w", "_h", "_at")
    )


def as_text(anchors: str) -> Column:
    digits = F.transform(anchors, lambda x: F.lpad(F.hex(x), 8, "0"))
    return F.lower(F.array_join(digits, ""))


def likeness(a: str, b: str) -> Column:
    """Shared over all distinct hashes; 1 for two empty fingerprints."""
    shared, both = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(both == 0, F.lit(1.0)).otherwise(shared / both)


def _tuples(cuts: list, schema: T.StructType) -> Column:
    """Cuts ``(tie, row)`` as an array of constant structs."""
    made = []
    for tie, row in cuts:
        values = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(tie, schema.fields)]
        made.append(F.struct(F.struct(*values).alias("_tie"), F.lit(row).cast("long").alias("_row")))
    kind = T.StructType([T.StructField("_tie", schema), T.StructField("_row", T.LongType())])
    return F.array(*made).cast(T.ArrayType(kind))


def _cuts(rows: DataFrame) -> tuple[list, set]:
    """Largest ``(tie, row)`` of each range in rising order, and the ties that fill several ranges.

    Cuts are rows of a sample whose size follows the number of ranges. A tie that does not fill a
    range of its own is not parted: its cut has the largest row number.
    """
    ranges = max(2, RANGES * width(rows))
    found = rows.agg(F.count("*").alias("n"), F.max(F.struct("_tie", "_row")).alias("top")).first()
    if not found["n"]:
        return [], set()
    drawn = rows.select("_tie", "_row").sample(min(1.0, ranges * DRAWN / found["n"]), seed=7)
    # Sorted by Spark, whose order of text and of nulls is the one that counts.
    drawn = [(tuple(r["_tie"]), r["_row"]) for r in drawn.sort("_tie", "_row").collect()]
    step = max(1, len(drawn) // ranges)
    chosen = drawn[step - 1 :: step]
    times = Counter(tie for tie, _ in chosen)
    frequent = {tie for tie, n in times.items() if n > 1}
    top = (tuple(found["top"]["_tie"]), found["top"]["_row"])
    cuts = []
    for tie, row in [*chosen, top]:
        cut = (tie, row if tie in frequent else _LAST)
        if not cuts or cuts[-1] != cut:
            cuts.append(cut)
    return cuts, frequent


def with_next(documents: DataFrame, order: str, carried: list[str]) -> DataFrame:
    """Rows with ``next_<c>``: the values of the row that follows by descending ``order``.

    The last row is followed by the first. Rows that agree in ``order``, a non-null long, follow each
    other by descending first ``PREFIX`` characters of the ``carried`` strings, then by their hash.
    Rows are cut into ranges of that whole order, and equal rows by their number in the input, so
    no range grows with the rows of one id; the first row of a range also goes to the range before
    it, so one shuffle is enough and no task gets the whole order. Rows that fill several ranges with
    equal values must be numbered alike each time the input is read, as a table's are; if they are
    not, the query fails.
    """
    starts = [F.substring(c, 1, PREFIX).alias(f"start_{i}") for i, c in enumerate(carried)]
    tie = F.struct(F.col(order).alias("order"), *starts, F.xxhash64(*carried).alias("hash"))
    rows = documents.withColumn("_tie", tie).withColumn("_row", F.monotonically_increasing_id())
    cuts, frequent = _cuts(rows)
    if not cuts:
        return documents.withColumns({f"next_{c}": F.col(c) for c in carried})
    schema = rows.schema["_tie"].dataType
    # A range is looked up in two steps: a block of cuts, then the cut.
    size = math.isqrt(len(cuts) - 1) + 1
    blocks = [cuts[i : i + size] for i in range(0, len(cuts), size)]
    place = F.struct("_tie", "_row")
    tops = _tuples([b[-1] for b in blocks[:-1]], schema)
    held = F.element_at(F.array(*[_tuples(b, schema) for b in blocks]), F.col("_block") + 1)
    last = len(cuts) - 1
    before = F.when(F.col("_range") == last, F.lit(0)).otherwise(F.col("_range") + 1)
    # The first rows of a range: the named one, or all rows of a tie that is not parted.
    whole = F.struct(F.col("_tie"), F.lit(_LAST).alias("_row"))
    cut = F.element_at(F.col("_held"), F.col("_range") - F.col("_block") * size + 1)
    first = (cut == place) | (cut == whole)
    own = F.struct(F.col("_range").alias("home"), F.lit(False).alias("guest"))
    guest = F.struct(before.alias("home"), F.lit(True).alias("guest"))
    spread = (
        rows.withColumn("_block", F.size(F.filter(tops, lambda c: c < place)))
        .withColumn("_held", held)
        .withColumn(
            "_range",
            F.col("_block") * size + F.size(F.filter("_held", lambda c: c < place)),
        )
        .withColumn("_home", F.explode(F.when(first, F.array(own, guest)).otherwise(F.array(own))))
        .withColumn("_guest", F.col("_home.guest"))
        .withColumn("_home", F.col("_home.home"))
        .drop("_block", "_held", "_range")
    )
    along = Window.partitionBy("_home").orderBy("_guest", F.desc("_tie"), F.desc("_row"))
    missing = F.raise_error(F.lit("the input was not numbered alike when it was read again"))
    return (
        spread.withColumns({f"next_{c}": F.lead(c).over(along) for c in carried})
        .withColumn("_follows", F.lead(F.lit(True)).over(along))
        .filter(~F.col("_guest"))
        .withColumns(
            {
                f"next_{c}": F.when(F.col("_follows"), F.col(f"next_{c}")).otherwise(missing)
                for c in carried
            }
        )
        .drop("_tie", "_row", "_home", "_guest", "_follows")
    )


def fingerprinted(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, s: int = S
) -> DataFrame:
    """Per document row: its fingerprint, that of its edited text, and how alike they are.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    The edited text has its last ``n_chars // 3`` code points replaced by the first as many of the
    next document, by descending id, the first one after the last. A null text is empty; null ids
    come last; documents of one id follow each other as ``with_next`` says. Other columns are ignored, an empty table stays
    empty.
    """
    base = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(_FIRST)).alias("_order"),
    )
    paired = with_next(base, "_order", ["text"])
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - cut),
        F.substring(F.col("next_text"), F.lit(1), cut),
    )
    rows = paired.select("doc_id", "text", "next_text", edited.alias("edited"))
    for column, into in (("text", "_own"), ("edited", "_edit"), ("next_text", "_next")):
        rows = with_anchors(rows, column, into, k, s)
    return rows.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text("_own").alias("fingerprint"),
        as_text("_edit").alias("edited_fingerprint"),
        likeness("_own", "_edit").alias("near_edited"),
        likeness("_own", "_next").alias("near_next"),
    )


def op1_syncmers(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprinted(spark.read.parquet(f"{sf_dir}/documents.parquet"))
