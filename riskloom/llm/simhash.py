"""SimHash near-dedup: fingerprints linked by the generalised pigeonhole principle.

Bits that go together are grouped into the same partition, so that a partition repeats less often
by chance than its width suggests for scattered bits. With partition thresholds that sum to
``radius - partitions + 1`` (a partition of threshold -1 is left out), two fingerprints within the
radius agree in at least one partition up to its threshold. The thresholds, and the number of
partitions, are those of the least estimated cost: probe keys plus candidates, by dynamic
programming over partitions. Estimates come from exact bit counts and a bounded sample; they steer
the cost only, never the result.

Each distinct fingerprint is filed under every key that a partition's value can turn into within
its threshold. Fingerprints of one key are candidates. Short files are compared pair by pair; in
long ones (many near copies of one text) pairs are not listed: two fingerprints are within two bits
of each other exactly if they share a value at most one bit from both, so members are joined through
those values. Files too long for one task take the same way as a shuffle by value. Links become
components by star contraction.
"""

from __future__ import annotations

import itertools
import math
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import free_names, signed, slices, utf8
from riskloom.session import write_out

SHINGLE = 3
RADIUS = 2
BITS = 64
SAMPLE = 2048
SHORT_FILE = 32
LONG_FILE = 32_768
_digest = partial(xxhash.xxh64_digest, seed=42)
_POWERS = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
_AROUND = np.concatenate([np.zeros(1, np.uint64), _POWERS])


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """Bits set in over half of the shingle hashes, as an unsigned integer."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    size = min(size, len(words))
    shingles = map(b" ".join, zip(*[words[i:] for i in range(size)]))
    total = len(words) - size + 1
    ones = np.zeros(BITS, np.int64)
    while block := list(itertools.islice(shingles, 1 << 16)):
        hashes = np.frombuffer(b"".join(map(_digest, block)), np.uint8).reshape(-1, 8)
        ones += np.add.reduce(np.unpackbits(hashes, axis=1), axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big")


def fingerprints(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_hash, fp`` per document row; null and empty texts have fingerprint zero."""

    def stage(batches):
        for batch in slices(batches):
            made = np.array([fingerprint(t) for t in utf8(batch.column(2))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), signed(made)],
                names=["doc_id", "text_hash", "fp"],
            )

    chosen = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        F.col(text).alias("text"),
    )
    return chosen.mapInArrow(stage, "doc_id long, text_hash long, fp long")


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


def _bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Rows and, for each pair of bits, the rows in which both are set (64 x 64 sums)."""

    def stage(batches):
        both, n = np.zeros((BITS, BITS)), 0
        for batch in slices(batches, 65_536):
            values = _unsigned(batch.column(0))
            bits = ((values[:, None] & _POWERS) != 0).astype(np.float32)
            both += bits.T @ bits
            n += len(values)
        cells = np.append(both.astype(np.int64).ravel(), n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(cells))), pa.array(cells)], names=["cell", "n"]
        )

    sums = fps.select("fp").mapInArrow(stage, "cell long, n long").groupBy("cell").agg(
        F.sum("n").alias("n")
    )
    cells = np.zeros(BITS * BITS + 1)
    for row in sums.collect():
        cells[row["cell"]] = row["n"]
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def _groups(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal width, correlated bits together."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    like = np.abs((both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(like, 0)
    free, groups = set(range(BITS)), []
    for part in range(parts):
        size = (len(free) + parts - part - 1) // (parts - part)
        group = [max(free, key=lambda b: (like[b, list(free)].sum(), -b))]
        free.remove(group[0])
        while len(group) < size:
            best = max(free, key=lambda b: (like[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def _within(n: int, both: np.ndarray, sample: np.ndarray, bits: list[int], radius: int):
    """Estimated share of pairs that differ in at most 0..radius of these bits."""
    share = np.diag(both)[bits] / max(n, 1)
    chance = np.zeros(radius + 1)
    chance[0] = 1.0
    for differ in 2 * share * (1 - share):
        chance = chance * (1 - differ) + np.append(0, chance[:-1]) * differ
    seen = np.zeros(radius + 1)
    mask = np.uint64(_mask(bits))
    pairs = len(sample) * (len(sample) - 1) / 2
    for i in range(len(sample) - 1):
        apart = np.bitwise_count((sample[i + 1 :] ^ sample[i]) & mask)
        seen += [np.count_nonzero(apart == d) for d in range(radius + 1)]
    return np.maximum(np.cumsum(chance), np.cumsum(seen) / max(pairs, 1))


def _variants(width: int, threshold: int) -> int:
    return sum(math.comb(width, d) for d in range(threshold + 1)) if threshold >= 0 else 0


def thresholds(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """The thresholds (-1 and up) of least cost that sum to ``total``; costs[i][t + 1]."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for done, (cost, chosen) in best.items():
            for t, more in enumerate(row, start=-1):
                found = (cost + more, [*chosen, t])
                if done + t not in step or found < step[done + t]:
                    step[done + t] = found
        best = step
    return best[total]


def plan_partitions(fps: DataFrame, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Bit mask and threshold of each partition that is probed."""
    n, both = _bit_counts(fps)
    rows = fps.select("fp").orderBy(F.xxhash64("fp")).limit(SAMPLE).collect()
    sample = np.array([r["fp"] for r in rows], np.int64).view(np.uint64)
    plans = []
    for parts in range(1, radius + 2):
        groups = _groups(n, both, parts)
        costs = []
        for bits in groups:
            shares = _within(n, both, sample, bits, radius)
            costs.append(
                [0.0]
                + [n * _variants(len(bits), t) + n * n / 2 * shares[t] for t in range(radius + 1)]
            )
        cost, chosen = thresholds(costs, radius - parts + 1)
        plans.append((cost, [(_mask(g), t) for g, t in zip(groups, chosen) if t >= 0]))
    return min(plans)[1]


def _keys(values: np.ndarray, mask: int, threshold: int):
    """Every value that the masked bits can turn into within the threshold, with its owner."""
    bits = [np.uint64(1 << b) for b in range(BITS) if mask >> b & 1]
    base = values & np.uint64(mask)
    yield base
    for size in range(1, threshold + 1):
        for flips in itertools.combinations(bits, size):
            yield base ^ np.uint64(sum(int(f) for f in flips))


def _probes(fps: DataFrame, plan: list[tuple[int, int]]) -> DataFrame:
    def stage(batches):
        for batch in slices(batches, 4096):
            values = _unsigned(batch.column(0))
            for part, (mask, threshold) in enumerate(plan):
                for keys in _keys(values, mask, threshold):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys), part)), signed(keys), signed(values)],
                        names=["part", "key", "fp"],
                    )

    return fps.select("fp").mapInArrow(stage, "part long, key long, fp long")


def joined_through(values: np.ndarray) -> np.ndarray:
    """For distinct values, a label per value: equal where links of at most two bits connect."""
    around = (values[:, None] ^ _AROUND).ravel()
    order = np.argsort(around, kind="stable")
    owner = np.repeat(np.arange(len(values)), len(_AROUND))[order]
    starts = np.flatnonzero(np.append(True, around[order][1:] != around[order][:-1]))
    lengths = np.diff(np.append(starts, len(owner)))
    label = np.arange(len(values))
    while True:
        least = np.minimum.reduceat(label[owner], starts)
        new = label.copy()
        np.minimum.at(new, owner, np.repeat(least, lengths))
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _links(keys: np.ndarray, values: np.ndarray, radius: int):
    """Links inside files; rows are sorted by key, and a file's fingerprints are distinct."""
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    lengths = np.diff(np.append(starts, len(keys)))
    left, right = [], []
    short = np.repeat(lengths <= SHORT_FILE, lengths)
    for step in range(1, min(SHORT_FILE, int(lengths.max(initial=1)))):
        i = np.flatnonzero(short[:-step] & (keys[step:] == keys[:-step]))
        if not len(i):
            break
        i = i[np.bitwise_count(values[i] ^ values[i + step]) <= radius]
        left.append(values[i])
        right.append(values[i + step])
    for start, length in zip(starts[lengths > SHORT_FILE], lengths[lengths > SHORT_FILE]):
        file = np.unique(values[start : start + length])
        label = joined_through(file)
        own = np.arange(len(file)) != label
        left.append(file[label[own]])
        right.append(file[own])
    return (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (left, right))


def _compared(probes: DataFrame, radius: int) -> DataFrame:
    def stage(batches):
        rest = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))

        def links(part, key, fp):
            file = np.flatnonzero(
                np.append(True, (part[1:] != part[:-1]) | (key[1:] != key[:-1]))
            )
            number = np.repeat(np.arange(len(file)), np.diff(np.append(file, len(key))))
            a, b = _links(number, fp, radius)
            return pa.RecordBatch.from_arrays([signed(a), signed(b)], names=["a", "b"])

        for batch in batches:
            new = (batch.column(0).to_numpy(), _unsigned(batch.column(1)))
            new = (*new, _unsigned(batch.column(2)))
            part, key, fp = (np.concatenate(x) for x in zip(rest, new))
            open_ = (part == part[-1]) & (key == key[-1]) if len(part) else np.zeros(0, bool)
            rest = (part[open_], key[open_], fp[open_])
            if len(part) and not open_.all():
                yield links(part[~open_], key[~open_], fp[~open_])
        if len(rest[0]):
            yield links(*rest)

    filed = probes.repartition("part", "key").sortWithinPartitions("part", "key", "fp")
    return filed.mapInArrow(stage, "a long, b long")


def _through_values(fps: DataFrame) -> DataFrame:
    """Links within two bits as a shuffle by the values one bit away, for very long files."""

    def stage(batches):
        for batch in slices(batches, 4096):
            values = _unsigned(batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [
                    signed((values[:, None] ^ _AROUND).ravel()),
                    signed(np.repeat(values, len(_AROUND))),
                ],
                names=["key", "fp"],
            )

    around = fps.mapInArrow(stage, "key long, fp long")
    least = around.groupBy("key").agg(F.min("fp").alias("a"), F.max("fp").alias("most"))
    least = least.filter("a < most").select("key", "a")
    return around.join(least, "key").filter("fp != a").select("a", F.col("fp").alias("b"))


def links(
    fps: DataFrame, radius: int = RADIUS, long_file: int = LONG_FILE, plan=None
) -> DataFrame:
    """``a, b``: links between distinct fingerprints whose components are those of all links.

    ``fps`` holds distinct ``fp``. Every link returned is real, and any two fingerprints within
    the radius end up in one component; inside long files not every link is listed.
    """
    if radius != RADIUS:
        raise ValueError("long files are joined through values, which holds for a radius of two")
    plan = plan or plan_partitions(fps, radius)
    probes = write_out(_probes(fps, plan))
    long = write_out(
        probes.groupBy("part", "key").count().filter(F.col("count") > long_file)
    ).select("part", "key")
    if long.isEmpty():
        return _compared(probes, radius)
    usual = probes.join(long, ["part", "key"], "left_anti").select("part", "key", "fp")
    rest = probes.join(long, ["part", "key"], "left_semi").select("fp").distinct()
    return _compared(usual, radius).unionByName(_through_values(rest))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b); root is the least node it connects to.

    Alternates between giving the larger neighbours of a node, and the smaller ones, to the least
    (star contraction), until nothing changes. Nodes with very many neighbours are joined, not
    gathered.
    """
    pairs = write_out(_ordered(edges))
    state = _state(pairs)
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = _ordered(
            both.join(least, "a").filter("b > a").select(F.col("b"), F.col("m").alias("a"))
        )
        large = write_out(large)
        # Every pair is (smaller a, larger b): the larger one's least neighbour takes the others.
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b")
        pairs = write_out(
            _ordered(
                small.select(F.col("m").alias("a"), F.col("a").alias("b")).unionByName(
                    small.select(F.col("m").alias("a"), "b")
                )
            )
        )
        before, state = state, _state(pairs)
        if state == before:
            break
    members = pairs.select(F.col("b").alias("node"), F.col("a").alias("root"))
    roots = pairs.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return members.unionByName(roots)


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct pairs with the smaller node first; loops go."""
    return (
        edges.filter("a != b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def _state(pairs: DataFrame) -> tuple:
    marks = [F.bit_xor(F.xxhash64(*x)) for x in (("a", "b"), ("b", "a"))]
    return tuple(pairs.agg(F.count("*"), *marks).first())


def _grouped(prints: DataFrame, radius: int, long_file: int) -> DataFrame:
    """``fp, root``: the component of each fingerprint in ``prints``."""
    distinct = write_out(prints.select("fp").distinct())
    nodes = components(links(distinct, radius, long_file))
    found = distinct.join(nodes, distinct["fp"] == nodes["node"], "left")
    return write_out(found.select("fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    radius: int = RADIUS,
    long_file: int = LONG_FILE,
) -> DataFrame:
    """``doc_id, fp, component_id`` per document row.

    ``component_id`` is the least doc_id that links of at most ``radius`` bits reach, the document
    itself included. Null and empty texts have fingerprint zero and link like any other. A null
    doc_id is never the least unless all ids of its component are null. Repeated rows stay; an
    empty table stays empty; other columns are ignored.
    """
    prints = write_out(fingerprints(documents, doc_id, text))
    roots = _grouped(prints, radius, long_file)
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).join(roots, "fp")
    heads = least.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = write_out(roots.join(heads, "root").select("fp", "component_id"))
    return prints.join(labels, "fp").select("doc_id", "fp", "component_id")


def without_near_duplicates(documents: DataFrame) -> DataFrame:
    """One row of each component: that of the least doc_id (null last), of equal ids any one.

    Components are those of ``near_duplicates``. Repeated rows are near copies; all texts without
    a word are one component. An empty table stays empty; other columns pass through, whatever
    their names.
    """
    prints = write_out(fingerprints(documents))
    first = F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "text_hash")
    each = prints.groupBy("fp").agg(F.min(first).alias("first"))
    roots = _grouped(prints, RADIUS, LONG_FILE)
    heads = each.join(roots, "fp").groupBy("root").agg(F.min("first").alias("first"))
    return first_rows(documents, heads)


def first_rows(documents: DataFrame, heads: DataFrame) -> DataFrame:
    """One row of ``documents`` for each ``first`` (_none, doc_id, text_hash) of ``heads``."""
    key = free_names(documents, "_none", "_id", "_hash")
    number = free_names(documents, *key, "_n")[-1]
    heads = heads.select("first.*")
    keep = heads.select(
        F.col("_none").alias(key[0]),
        F.coalesce("doc_id", F.lit(0)).cast("long").alias(key[1]),
        F.col("text_hash").alias(key[2]),
    )
    id_ = F.coalesce(documents["doc_id"], F.lit(0)).cast("long")
    made = [documents["doc_id"].isNull(), id_, F.xxhash64(documents["text"])]
    kept = documents.withColumns(dict(zip(key, made))).join(keep, key, "left_semi")
    one = Window.partitionBy(*key).orderBy(key[2])
    return (
        kept.withColumn(number, F.row_number().over(one))
        .filter(F.col(number) == 1)
        .select(*documents.columns)
    )


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    """Per document: its fingerprint and the least doc_id of its component."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(documents).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
