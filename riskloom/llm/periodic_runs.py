"""Periodic runs of words, found as maximal pairs in the LCP-interval tree of each text.

A run is a stretch of words with smallest period ``q`` that no neighbouring word extends and that is
at least ``MIN_EXPONENT`` periods and ``MIN_WORDS`` words long. Two equal stretches ``i < j`` of
``l`` words that neither side extends (a maximal pair) are a stretch of ``l + d`` words with period
``d = j - i``, maximal as it stands. So the pairs with ``d <= l / (MIN_EXPONENT - 1)`` are the runs,
once per multiple of their period; the least period of equal stretches stays.

Suffixes are sorted by doubling, a slice of many texts at once, and only where a repeat within a
text is long enough. A stack then walks the LCP intervals bottom up. The positions below an interval
are one list in text order, each labelled with the class of its left word. An interval joins its
children's lists, the smaller into the larger; pairs across children end differently, pairs of two
classes begin differently. Equal stretches that are close to each other lie in one run and are whole
periods apart, and all but the run's first have the same left word. So of the positions close to
``p``, only the farthest on either side can be its partner, and two look-ups find it.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import annotated, utf8

MIN_WORDS = 6
MIN_EXPONENT = 4
SLICE_WORDS = 400_000
BLOCK = 2_000
EDIT_EVERY = 10
_BLANKS = " \t\n\x0b\f\r"
RUN = T.StructType()
for _field in ("start", "length", "period"):
    RUN = RUN.add(_field, T.LongType())
RESULT = (
    T.StructType()
    .add("n_words", T.LongType())
    .add("runs", T.ArrayType(RUN))
    .add("kept", T.StringType())
)
_ARROW_RUN = pa.struct([(f.name, pa.int64()) for f in RUN.fields])


class Positions:
    """Positions in text order, in blocks, so that adding one moves few others."""

    __slots__ = ("blocks", "size")

    def __init__(self, position: int):
        self.blocks = [[position]]
        self.size = 1

    def __iter__(self):
        for block in self.blocks:
            yield from block

    def _place(self, position: int) -> int:
        if len(self.blocks) == 1:
            return 0
        return max(0, bisect_right(self.blocks, position, key=lambda b: b[0]) - 1)

    def add(self, position: int) -> None:
        at = self._place(position)
        block = self.blocks[at]
        insort(block, position)
        self.size += 1
        if len(block) > BLOCK:
            half = len(block) // 2
            self.blocks[at : at + 1] = [block[:half], block[half:]]

    def first_from(self, least: int) -> int | None:
        at = self._place(least)
        block = self.blocks[at]
        i = bisect_left(block, least)
        if i < len(block):
            return block[i]
        return self.blocks[at + 1][0] if at + 1 < len(self.blocks) else None

    def last_until(self, most: int) -> int | None:
        block = self.blocks[self._place(most)]
        i = bisect_right(block, most)
        return block[i - 1] if i else None


def least_overlap(min_words: int, min_exponent: int) -> int:
    """The fewest equal words that a maximal pair of some run can have."""
    return min(
        max(min_words - d, (min_exponent - 1) * d) for d in range(1, max(2, min_words + 1))
    )


def sorted_suffixes(symbols: np.ndarray, texts: np.ndarray, least: int):
    """Suffixes in order, and where one shares its first words with another of its text.

    ``symbols`` has a 0 before the first text and after each; ``texts`` numbers the texts. Words are
    compared up to the first power of two at most ``least`` for all suffixes, and on for those that
    are still equal. Returns the order and the mask of slots equal to a neighbour at that depth.
    """
    n = len(symbols)
    base = np.int64(symbols.max()) + 1
    key = (texts * base + symbols) * base + np.append(symbols[1:], 0)
    order = np.argsort(key, kind="stable")
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    active = np.zeros(n, bool)
    deep = None
    depth, ordered = 2, key[order]
    while True:
        begins = np.empty(len(slots), bool)
        begins[:1] = True
        np.not_equal(ordered[1:], ordered[:-1], out=begins[1:])
        ends = np.append(begins[1:], True)
        rank[order[slots]] = slots[np.maximum.accumulate(np.where(begins, np.arange(len(slots)), 0))]
        active[slots] = ~(begins & ends)
        if 2 * depth > least and deep is None:
            deep = active.copy()
        slots = np.flatnonzero(active)
        if not len(slots):
            break
        # Equal suffixes hold no end of text within this depth, so the next words are in the text.
        here = order[slots]
        key = rank[here] * n + rank[here + depth]
        by = np.argsort(key, kind="stable")
        order[slots] = here[by]
        ordered = key[by]
        depth *= 2
    return order, deep if deep is not None else active


def _common_prefixes(symbols: list[int], order: np.ndarray, deep: np.ndarray) -> dict[int, int]:
    """Words shared with the suffix before, for the ``deep`` suffixes in text order."""
    slots = np.flatnonzero(deep)
    here = order[slots]
    before = np.where((slots > 0) & deep[slots - 1], order[slots - 1], -1)
    by = np.argsort(here)
    shared: dict[int, int] = {}
    last, h = -2, 0
    for p, q in zip(here[by].tolist(), before[by].tolist()):
        h = max(h - 1, 0) if p == last + 1 else 0
        last = p
        if q < 0:
            h = 0
            continue
        while symbols[p + h] == symbols[q + h] and symbols[p + h]:
            h += 1
        shared[p] = h
    return shared


def maximal_pairs(symbols: np.ndarray, texts: np.ndarray, min_words: int, min_exponent: int):
    """``{(start, end): period}`` of all runs, by position in ``symbols``."""
    least = least_overlap(min_words, min_exponent)
    order, deep = sorted_suffixes(symbols, texts, least)
    found: dict[tuple[int, int], int] = {}
    if not deep.any():
        return found
    left = symbols.tolist()
    shared = _common_prefixes(left, order, deep)

    def pair(i: int, j: int, words: int) -> None:
        d = j - i
        if left[i - 1] != left[j - 1] and words + d >= min_words:
            at = (i, j + words)
            found[at] = min(d, found.get(at, d))

    def joined(a: Positions, b: Positions, words: int) -> Positions:
        if a.size < b.size:
            a, b = b, a
        reach = words // (min_exponent - 1)
        added = list(b)
        for p in added:
            first = a.first_from(p - reach)
            if first is not None and first < p:
                pair(first, p, words)
            last = a.last_until(p + reach)
            if last is not None and last > p:
                pair(p, last, words)
        for p in added:
            a.add(p)
        return a

    open_intervals: list[list] = []
    child = None
    for p in order[deep].tolist():
        words = shared.get(p, 0)
        if child is not None:
            while open_intervals and open_intervals[-1][0] > words:
                l, positions = open_intervals.pop()
                child = joined(positions, child, l)
            if words < least:
                open_intervals.clear()
            elif open_intervals and open_intervals[-1][0] == words:
                open_intervals[-1][1] = joined(open_intervals[-1][1], child, words)
            else:
                open_intervals.append([words, child])
        child = Positions(p)
    while open_intervals:
        l, positions = open_intervals.pop()
        child = joined(positions, child, l)
    return found


def runs_of(
    texts: list[list[bytes]], min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT
) -> list[list[tuple[int, int, int]]]:
    """``(start, length, period)`` of every run per list of words, by start and period."""
    codes: dict[bytes, int] = {}
    symbols, numbers, starts = [0], [0], []
    for number, words in enumerate(texts):
        starts.append(len(symbols))
        symbols += [codes.setdefault(w, len(codes) + 1) for w in words]
        symbols.append(0)
        numbers.append(len(words) + 1)
    numbers[0] = 1
    owner = np.repeat(np.arange(-1, len(texts)), numbers) + 1
    found = maximal_pairs(np.array(symbols, np.int64), owner, min_words, min_exponent)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (start, end), period in found.items():
        text = int(owner[start]) - 1
        out[text].append((start - starts[text], end - start, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period, joined by a space."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


def with_runs(
    documents: DataFrame,
    text: str = "text",
    into: str = "periodic",
    min_words: int = MIN_WORDS,
    min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """``documents`` with a struct ``into``: ``n_words``, all ``runs`` and the text ``kept``.

    Words are parted by ASCII blanks and numbered from 0. Null, empty and blank texts have no words,
    no runs and an empty ``kept``. Every row is taken by itself, so repeated rows give equal results
    and an empty table stays empty. Runs are ordered by start, then period, which no two share.
    Other columns pass through; one named ``into`` is replaced. ``min_exponent`` is at least 3 and
    ``min_words`` at least 3, below which nearness of equal stretches does not imply a run.
    """
    if min_exponent < 3 or min_words < 3:
        raise ValueError("min_exponent and min_words must be at least 3")

    def rows(columns: list[pa.Array]) -> pa.Array:
        counts, runs, kept = [], [], []
        waiting: list[list[bytes]] = []

        def flush() -> None:
            for words, found in zip(waiting, runs_of(waiting, min_words, min_exponent)):
                counts.append(len(words))
                runs.append([dict(zip(RUN.names, r)) for r in found])
                kept.append(collapsed(words, found).decode())
            waiting.clear()

        held = 0
        for value in utf8(columns[0]):
            words = (value or b"").split()
            if waiting and held + len(words) > SLICE_WORDS:
                flush()
                held = 0
            waiting.append(words)
            held += len(words)
        flush()
        return pa.StructArray.from_arrays(
            [
                pa.array(counts, pa.int64()),
                pa.array(runs, pa.list_(_ARROW_RUN)),
                pa.array(kept, pa.string()),
            ],
            names=RESULT.names,
        )

    return annotated(documents, [text], into, RESULT, rows)


def highest_exponent(runs: Column) -> Column:
    """Of runs ordered by start and period, the first with the greatest ``length / period``."""
    return F.aggregate(
        runs,
        F.element_at(F.slice(runs, 1, 1), 1),
        lambda best, r: F.when(
            r["length"] * best["period"] > best["length"] * r["period"], r
        ).otherwise(best),
    )


def _edited(documents: DataFrame) -> DataFrame:
    """One in ten texts repeats a stretch of its words from some word to its end."""
    number = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    blank = F.length(F.btrim(F.col("text"), F.lit(_BLANKS))) == 0
    chosen = F.col("text").isNotNull() & ~blank & (number % EDIT_EVERY == 0)
    words = F.split(F.btrim(F.col("text"), F.lit(_BLANKS)), r"[\x20\x09-\x0D]+")
    staged = (
        documents.select("doc_id", "text", F.when(chosen, words).alias("w"), number.alias("h"))
        .withColumn("g", F.expr(f"h div {EDIT_EVERY}"))
        .withColumn("n", F.coalesce(F.size("w"), F.lit(0)))
        .withColumn("a", F.expr("if(n > 0, int(g % n), 0)"))
        .withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    )
    tail = F.flatten(F.array_repeat(F.expr("slice(w, a + 1, p)"), F.expr("int((n - a) div p) + 1")))
    whole = F.concat(F.expr("slice(w, 1, a)"), F.slice(tail, F.lit(1), F.col("n") - F.col("a")))
    return staged.select(
        "doc_id",
        F.when(F.col("w").isNotNull(), F.array_join(whole, " "))
        .otherwise(F.col("text"))
        .alias("text"),
    )


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """All documents: number of runs, the one of highest exponent, digests of runs and kept text."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    runs = F.col("periodic.runs")
    line = lambda r: F.concat_ws(",", *[r[f].cast("string") for f in RUN.names])
    listed = F.array_join(F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))), "")
    found = with_runs(_edited(documents)).withColumn(
        "best", F.when(F.size(runs) > 0, highest_exponent(runs))
    )
    return found.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("periodic.kept").cast("binary"), 256).alias("collapsed_sha256"),
    )
