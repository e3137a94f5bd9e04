"""k nearest neighbours through random projections: approximate with measured recall, or exact.

1. Points are projected on a few random orthonormal axes, each cut into slabs of about equal
   counts; slab numbers make a point's bucket. There are at most ``2 ** MAX_BITS`` buckets, so
   edges and bucket numbers are of constant size however many points there are.
2. A point's distance to a bucket is at least that of its projections to the bucket's slabs. A
   query probes buckets in the order of this bound. How many is found by comparing a bounded set
   of queries with all points: as few as hold the wanted share of their true neighbours.
3. Queries of neighbouring buckets form blocks of limited size. A block's queries come first, then
   the points of all buckets that one of them probes stream by; only the ``k`` best so far of the
   block are held, with exact distances. A bucket may therefore be of any size.
4. A query whose ``k``-th distance is below the bound of every bucket not seen is certain. For
   exact results the others are asked again, with the buckets that their ``k``-th distance reaches.

Points with equal coordinates are thinned to the ``k`` (or ``k + 1``) smallest ids first, so a place
that holds a third of all rows costs nothing. Equal distances are settled by id.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.neighbors import thinned
from riskloom.session import settle, shuffle_width, write_out

MAX_BITS = 12
MAX_AXES = 12
BUCKET_POINTS = 512
SAMPLE_POINTS = 20_000
CALIBRATION = 128
BLOCK_QUERIES = 8_192
LEAST_QUERIES = 256
CELLS = 2_000_000
ROUNDING = 1e-9


@dataclass
class Buckets:
    """Random axes, the edges of their slabs, and the numbers of the buckets that hold points."""

    axes: np.ndarray
    edges: list[np.ndarray]
    known: np.ndarray

    def of(self, x: np.ndarray) -> np.ndarray:
        """The bucket number of each row: slab numbers in mixed base."""
        number = np.zeros(len(x), np.int64)
        for place, edges in zip((x @ self.axes).T, self.edges):
            number = number * (len(edges) + 1) + np.searchsorted(edges, place, side="left")
        return number

    def _slabs(self) -> list[np.ndarray]:
        left, slabs = self.known.copy(), []
        for edges in reversed(self.edges):
            slabs.append(left % (len(edges) + 1))
            left //= len(edges) + 1
        return slabs[::-1]

    def bounds(self, x: np.ndarray) -> np.ndarray:
        """A squared distance that no point of a known bucket falls below, per row and bucket."""
        out = np.zeros((len(x), len(self.known)))
        for place, edges, slab in zip((x @ self.axes).T, self.edges, self._slabs()):
            below = np.append(-np.inf, edges)
            above = np.append(edges, np.inf)
            gap = np.maximum(below - place[:, None], place[:, None] - above)
            out += (np.maximum(gap, 0.0) ** 2)[:, slab]
        return out * (1 - ROUNDING)


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(rows, -1)


def _some(rows: DataFrame, total: int, most: int) -> pa.Table:
    """About ``most`` rows spread over the table, at most ``most``."""
    if total > most:
        rows = rows.sample(min(1.0, 1.2 * most / total), seed=7).limit(most)
    return rows.toArrow().combine_chunks()


def fit(
    points: DataFrame,
    total: int,
    bucket_points: int = BUCKET_POINTS,
    principal: bool = False,
    seed: int = 7,
) -> Buckets:
    """Axes, random or principal, and slabs by quantiles of a bounded sample; ``known`` is empty.

    Axes are halved one after the other, each time the one with the widest slabs.
    """
    table = _some(points.select("vec"), total, SAMPLE_POINTS)
    sample = _matrix(table.column("vec").chunk(0), table.num_rows)
    dim = sample.shape[1]
    bits = min(MAX_BITS, max(0, math.ceil(math.log2(max(total, 1) / bucket_points))))
    axes = min(dim, MAX_AXES)
    if principal and len(sample) > 1:
        turned = np.linalg.eigh(np.atleast_2d(np.cov(sample.T)))[1][:, ::-1][:, :axes]
    else:
        turned, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, axes)))
    places = sample @ turned
    slabs, spread = np.ones(axes, int), np.ptp(np.quantile(places, [0.1, 0.9], axis=0), axis=0)
    for _ in range(bits):
        slabs[np.argmax(spread / slabs)] *= 2
    edges = [
        np.unique(np.quantile(places[:, j], np.arange(1, n) / n)) for j, n in enumerate(slabs)
    ]
    return Buckets(turned, edges, np.zeros(0, np.int64))


def _with_bucket(df: DataFrame, buckets: Buckets) -> DataFrame:
    def stage(batches):
        for batch in batches:
            number = buckets.of(_matrix(batch.column("vec"), batch.num_rows))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(number)], names=[*batch.schema.names, "bucket"]
            )

    return df.mapInArrow(stage, df.select("*", F.lit(0).cast("long").alias("bucket")).schema)


def _first_columns(d2: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, int]:
    """Per row the places of its ``k`` least cells, equal ones by id, and how many these are."""
    place = np.argsort(d2, axis=1)
    ordered = np.take_along_axis(d2, place, axis=1)
    tied = ((ordered[:, 1:] == ordered[:, :-1]) & np.isfinite(ordered[:, 1:])).any(axis=1)
    for i in np.flatnonzero(tied):
        place[i] = np.lexsort((ids[i], d2[i]))
    return place[:, :k], min(k, d2.shape[1])


@dataclass
class _Asked:
    """Queries of one block with the best points met so far."""

    query: np.ndarray
    ids: np.ndarray
    vec: np.ndarray
    fold: np.ndarray
    k: int
    exclude: str | None

    def __post_init__(self):
        n = len(self.ids)
        self.length = np.einsum("ij,ij->i", self.vec, self.vec)
        self.d2 = np.full((n, self.k), np.inf)
        self.near = np.zeros((n, self.k), np.int64)
        self.y = np.zeros((n, self.k))
        self.limit = np.full(n, np.inf)
        self.waiting: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def meet(self, ids: np.ndarray, vec: np.ndarray, y: np.ndarray, fold: np.ndarray) -> None:
        length = np.einsum("ij,ij->i", vec, vec)
        step = max(1, CELLS // max(len(ids), 1))
        for start in range(0, len(self.ids), step):
            who = slice(start, start + step)
            # A fast product finds whom to measure exactly; its error is far below the slack.
            rough = self.length[who, None] + length - 2.0 * (self.vec[who] @ vec.T)
            if self.exclude == "self":
                for i in np.flatnonzero(np.isin(self.ids[who], ids)):
                    rough[i, ids == self.ids[start + i]] = np.inf
            elif self.exclude == "fold":
                rough[self.fold[who, None] == fold[None, :]] = np.inf
            slack = ROUNDING * (self.length[who] + length.max())
            if len(ids) > self.k:
                kth = np.partition(rough, self.k - 1, axis=1)[:, self.k - 1]
                self.limit[who] = np.minimum(self.limit[who], kth + slack)
            row, col = np.nonzero((rough <= (self.limit[who] + slack)[:, None]) & np.isfinite(rough))
            if not len(row):
                continue
            row += start
            exact = np.zeros(len(row))
            for j in range(vec.shape[1]):
                exact += (self.vec[row, j] - vec[col, j]) ** 2
            self.waiting.append((row, exact, ids[col], y[col]))
            self.held += len(row)
            if self.held > CELLS:
                self.settle()

    def settle(self) -> None:
        """Sort what was met since the last time into the best of each query."""
        if not self.held:
            return
        row, d2, near, label = [np.concatenate(x) for x in zip(*self.waiting)]
        self.waiting, self.held = [], 0
        met = np.zeros(len(self.ids), bool)
        met[row] = True
        old_row, old_col = old = np.nonzero(np.isfinite(self.d2) & met[:, None])
        row = np.concatenate([old_row, row])
        d2 = np.concatenate([self.d2[old], d2])
        near = np.concatenate([self.near[old], near])
        label = np.concatenate([self.y[old], label])
        by = np.argsort(row, kind="stable")
        rows, begins, sizes = np.unique(row[by], return_index=True, return_counts=True)
        # Rows of like size side by side in a matrix, padded with infinite distances.
        order = np.argsort(sizes)
        while len(order):
            most = max(1, CELLS // int(sizes[order[-1]]))
            some, order = order[-most:], order[:-most]
            wide = int(sizes[some[-1]])
            at = begins[some, None] + np.arange(wide)
            valid = np.arange(wide) < sizes[some, None]
            at = by[np.minimum(at, len(by) - 1)]
            place, keep = _first_columns(np.where(valid, d2[at], np.inf), near[at], self.k)
            at = np.take_along_axis(at, place, axis=1)
            into = (rows[some], slice(0, keep))
            self.d2[into] = np.where(np.take_along_axis(valid, place, axis=1), d2[at], np.inf)
            self.near[into], self.y[into] = near[at], label[at]
        self.limit = np.minimum(self.limit, self.d2[:, -1])

    def answers(self, buckets: Buckets, seen: set[int], ranks: Sequence[int] | None):
        """Record batches of some queries each, with the means at ``ranks`` or whole lists."""
        self.settle()
        unseen = np.array([b not in seen for b in buckets.known.tolist()], bool)
        step = max(1, CELLS // max(len(buckets.known), self.k))
        for start in range(0, len(self.ids), step):
            who = slice(start, start + step)
            n = np.isfinite(self.d2[who]).sum(axis=1)
            bound = buckets.bounds(self.vec[who])[:, unseen].min(axis=1, initial=np.inf)
            reach = self.d2[who, -1]
            columns = {
                "query": pa.array(self.query[who]),
                "id": pa.array(self.ids[who]),
                "n": pa.array(n.astype(np.int32)),
                "reach": pa.array(reach),
                "certain": pa.array((bound > reach) | ~unseen.any()),
            }
            if ranks is None:
                offsets = pa.array(np.append(0, np.cumsum(n)).astype(np.int32))
                held = np.isfinite(self.d2[who])
                for name, values in (("ids", self.near), ("d2", self.d2)):
                    columns[name] = pa.ListArray.from_arrays(offsets, pa.array(values[who][held]))
            else:
                running = np.cumsum(self.y[who], axis=1)
                for k in ranks:
                    used = np.minimum(n, k)
                    total = running[np.arange(len(n)), np.maximum(used - 1, 0)]
                    mean = total / np.maximum(used, 1)
                    columns[f"K{k}"] = pa.array(mean, mask=used == 0)
            yield pa.RecordBatch.from_pydict(columns)


def _meeting(buckets: Buckets, k: int, exclude: str | None, ranks: Sequence[int] | None):
    """A block's queries, then its points; other blocks of the partition follow."""

    def queries_of(parts: list[pa.RecordBatch]) -> _Asked:
        table = pa.Table.from_batches(parts).combine_chunks()
        column = lambda c: table.column(c).chunk(0)
        return _Asked(
            column("query").to_numpy(),
            column("id").to_numpy(),
            _matrix(column("vec"), table.num_rows),
            column("fold").to_numpy(zero_copy_only=False),
            k,
            exclude,
        )

    def stage(batches):
        here, parts, asked, seen = None, [], None, set()

        def close():
            found = asked or (queries_of(parts) if parts else None)
            if found is not None:
                yield from found.answers(buckets, seen, ranks)

        for batch in batches:
            block, kind = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            changes = (block[1:] != block[:-1]) | (kind[1:] != kind[:-1])
            cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                piece = batch.slice(begin, end - begin)
                if block[begin] != here:
                    yield from close()
                    here, parts, asked, seen = block[begin], [], None, set()
                if kind[begin] == 0:
                    parts.append(piece)
                    continue
                if asked is None and parts:
                    asked = queries_of(parts)
                if asked is not None:
                    seen.update(piece.column("bucket").to_numpy().tolist())
                    asked.meet(
                        piece.column("id").to_numpy(),
                        _matrix(piece.column("vec"), piece.num_rows),
                        piece.column("y").to_numpy(zero_copy_only=False),
                        piece.column("fold").to_numpy(zero_copy_only=False),
                    )
        yield from close()

    return stage


@dataclass
class Index:
    """Points by bucket in a stored table ``id, vec, y, fold, bucket``."""

    buckets: Buckets
    points: DataFrame
    k: int
    exclude: str | None

    def search(
        self, queries: DataFrame, probes: int, ranks: Sequence[int] | None, exact: bool
    ) -> DataFrame:
        """One row per query of the stored ``query, id, vec, fold``, ``query`` being unique."""
        homes = write_out(_with_bucket(queries, self.buckets))
        first = self._searched(homes, ranks, lambda bounds, _: _nearest_buckets(bounds, probes))
        if not exact:
            return first
        first = write_out(first)
        again = homes.join(
            first.filter(~F.col("certain")).select("query", "reach"), "query"
        )
        second = self._searched(
            write_out(again), ranks, lambda bounds, reach: bounds <= reach[:, None]
        )
        return first.filter("certain").unionByName(second)

    def _searched(
        self, homes: DataFrame, ranks: Sequence[int] | None, chosen: Callable
    ) -> DataFrame:
        buckets, k = self.buckets, self.k
        blocks = write_out(self._blocks(homes))
        reach = F.col("reach") if "reach" in homes.columns else F.lit(float("inf"))

        def probed(batches):
            step = max(1, CELLS // max(len(buckets.known), 1))
            for batch in batches:
                for start in range(0, batch.num_rows, step):
                    some = batch.slice(start, step)
                    bounds = buckets.bounds(_matrix(some.column("vec"), some.num_rows))
                    row, col = np.nonzero(chosen(bounds, some.column("reach").to_numpy()))
                    block = some.column("block").to_numpy()[row]
                    pairs, same = np.unique(
                        np.column_stack([block, buckets.known[col]]), axis=0, return_inverse=True
                    )
                    near = np.full(len(pairs), np.inf)
                    np.minimum.at(near, same, bounds[row, col])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(near)],
                        names=["block", "bucket", "near"],
                    )

        asked = blocks.select("block", "vec", reach.alias("reach"))
        touched = asked.sortWithinPartitions("block").mapInArrow(
            probed, "block long, bucket long, near double"
        )
        touched = settle(touched.groupBy("block", "bucket").agg(F.min("near").alias("near")))
        queries = blocks.select(
            "block", F.lit(0).alias("kind"), "query", "id", "vec", F.lit(None).cast("double").alias("y"),
            "fold", F.lit(None).cast("long").alias("bucket"), F.lit(0.0).alias("near"),
        )
        points = self.points.join(touched, "bucket").select(
            "block", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("query"), "id", "vec",
            "y", "fold", "bucket", "near",
        )
        kinds = "ids array<long>, d2 array<double>"
        if ranks is not None:
            kinds = ", ".join(f"K{r} double" for r in ranks)
        return (
            queries.unionByName(points)
            .repartition(2 * shuffle_width(homes), "block")
            # Near buckets first: the sooner the k-th distance is small, the less is measured.
            .sortWithinPartitions("block", "kind", "near")
            .mapInArrow(
                _meeting(buckets, k, self.exclude, ranks),
                f"query long, id long, n int, reach double, certain boolean, {kinds}",
            )
        )

    def _blocks(self, homes: DataFrame) -> DataFrame:
        """Add ``block``: homes in order of their number, together or cut to limited size."""
        counts = homes.groupBy("bucket").count().orderBy("bucket").collect()
        total = sum(r["count"] for r in counts)
        most = math.ceil(total / (8 * shuffle_width(homes)))
        most = min(BLOCK_QUERIES, max(LEAST_QUERIES, most))
        rows, block, held = [], -1, most
        for r in counts:
            parts = math.ceil(r["count"] / most)
            if parts > 1 or held + r["count"] > most:
                rows.append((r["bucket"], block + 1, parts))
                block, held = block + parts, r["count"] if parts == 1 else most
            else:
                rows.append((r["bucket"], block, 1))
                held += r["count"]
        # One row per bucket that holds queries; their number is no more than that of all buckets.
        spark = homes.sparkSession
        placed = spark.createDataFrame(rows, "bucket long, first long, parts long")
        part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), "parts")
        return (
            homes.join(F.broadcast(placed), "bucket")
            .withColumn("block", F.col("first") + part)
            .drop("first", "parts", "bucket")
        )


def _nearest_buckets(bounds: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` buckets of least bound per row, and those of the same bound as the last."""
    if probes >= bounds.shape[1]:
        return np.ones(bounds.shape, bool)
    return bounds <= np.partition(bounds, probes - 1, axis=1)[:, probes - 1 : probes]


def _folded(df: DataFrame, by_fold: bool, *extra: str) -> DataFrame:
    fold = F.col("fold").cast("long") if by_fold else F.lit(0).cast("long")
    return df.select(F.col("id").cast("long").alias("id"), "vec", fold.alias("fold"), *extra)


def _built(
    refs: DataFrame, k: int, exclude: str | None, bucket_points: int, principal: bool
) -> Index | None:
    by_fold = exclude == "fold"
    if "y" not in refs.columns:
        refs = refs.withColumn("y", F.lit(0.0))
    kept = thinned(refs, ["vec", "fold"] if by_fold else ["vec"], k + (exclude == "self"))
    points = settle(_folded(kept, by_fold, "y"))
    total = points.count()
    if not total:
        return None
    buckets = fit(points, total, bucket_points, principal)
    points = write_out(_with_bucket(points, buckets))
    known = points.select("bucket").distinct().toArrow().column("bucket").to_numpy()
    return Index(Buckets(buckets.axes, buckets.edges, np.sort(known)), points, k, exclude)


def exact_neighbors(
    points: DataFrame, asked: pa.Table, k: int, exclude: str | None
) -> DataFrame:
    """``(query, place, id, d2, bucket)`` of a bounded set of queries held against all points.

    ``asked`` has ``id, vec, fold``; ``query`` is its row number. Every task keeps the ``k`` best of
    its points per query.
    """
    column = lambda c: asked.column(c).combine_chunks()
    vec = _matrix(column("vec"), asked.num_rows)
    ids, folds = column("id").to_numpy(), column("fold").to_numpy()

    def stage(batches):
        held = _Asked(ids, ids, vec, folds, k, exclude)
        place = {}
        for batch in batches:
            here = batch.column("id").to_numpy()
            place.update(zip(here.tolist(), batch.column("bucket").to_pylist()))
            held.meet(
                here,
                _matrix(batch.column("vec"), batch.num_rows),
                batch.column("y").to_numpy(),
                batch.column("fold").to_numpy(),
            )
            held.settle()
            best = set(held.near[np.isfinite(held.d2)].tolist())
            place = {i: b for i, b in place.items() if i in best}
        row, col = np.nonzero(np.isfinite(held.d2))
        near = held.near[row, col]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(row),
                pa.array(near),
                pa.array(held.d2[row, col]),
                pa.array([place[i] for i in near.tolist()], pa.int64()),
            ],
            names=["query", "id", "d2", "bucket"],
        )

    best = Window.partitionBy("query").orderBy("d2", "id")
    return (
        points.select("id", "vec", "y", "fold", "bucket")
        .mapInArrow(stage, "query long, id long, d2 double, bucket long")
        .withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= k)
    )


def probes_for(index: Index, queries: DataFrame, recall: float) -> int:
    """The fewest probes whose buckets hold ``recall`` of some queries' true neighbours."""
    asked = _some(queries.select("id", "vec", "fold"), queries.count(), CALIBRATION)
    if not asked.num_rows:
        return 1
    true = exact_neighbors(index.points, asked, index.k, index.exclude)
    rows = true.select("query", "bucket").toArrow()
    if not rows.num_rows:
        return 1
    bounds = index.buckets.bounds(_matrix(asked.column("vec").combine_chunks(), asked.num_rows))
    # A bucket is probed with all that have its bound or less.
    query = rows.column("query").to_numpy()
    at = np.searchsorted(index.buckets.known, rows.column("bucket").to_numpy())
    ordered = np.sort(bounds, axis=1)
    needed = np.array(
        [np.searchsorted(ordered[q], bounds[q, b], side="left") + 1 for q, b in zip(query, at)]
    )
    return int(np.sort(needed)[math.ceil(recall * len(needed)) - 1])


def lsh_neighbors(
    refs: DataFrame,
    queries: DataFrame,
    k: int,
    exclude: str | None = "self",
    recall: float = 0.95,
    exact: bool = False,
    bucket_points: int = BUCKET_POINTS,
) -> DataFrame:
    """``(id, n, reach, certain, ids, d2)`` per query: neighbours by distance, then id.

    ``refs`` has unique ids that are whole numbers and arrays ``vec`` of one length without nulls,
    ``queries`` such ids and arrays. ``exclude="self"`` leaves out the reference with the query's
    own id, ``exclude="fold"`` all references of its ``fold``, a column of both. ``d2`` are exact squared distances, ``reach`` the largest
    (infinite where fewer than ``k`` were found), ``certain`` tells that no point can be missing.
    Of points with equal coordinates the ``k + 1`` smallest ids take part. With ``exact`` all
    queries are certain. Without references there are no rows.
    """
    return _asked(refs, queries, k, exclude, recall, exact, bucket_points, None).drop("query")


def lsh_target_mean(
    refs: DataFrame,
    queries: DataFrame,
    ks: Sequence[int],
    exclude: str | None = "self",
    recall: float = 0.95,
    exact: bool = False,
    bucket_points: int = BUCKET_POINTS,
) -> DataFrame:
    """``(id, KNN_TARGET_MEAN_K<k>..., certain)`` as in ``lsh_neighbors``; ``refs`` also has ``y``.

    With fewer than ``k`` neighbours the mean covers those there are.
    """
    ks = sorted(set(ks))
    found = _asked(refs, queries, max(ks), exclude, recall, exact, bucket_points, ks)
    return found.select(
        "id", *[F.col(f"K{k}").alias(f"KNN_TARGET_MEAN_K{k}") for k in ks], "certain"
    )


def lsh_recall(
    refs: DataFrame,
    queries: DataFrame,
    k: int,
    exclude: str | None = "self",
    recall: float = 0.95,
    bucket_points: int = BUCKET_POINTS,
) -> DataFrame:
    """One row: how an approximate search of few ``queries`` compares with brute force.

    ``queries`` are held against all points in every task, so they should be hundreds at most.
    ``recall`` is the share of the true neighbours that were found, ``distances_exact`` whether all
    found have their true distance where they are true neighbours.
    """
    index = _built(refs, k, exclude, bucket_points, principal=False)
    number = F.monotonically_increasing_id().alias("query")
    queries = write_out(_folded(queries, exclude == "fold").select(number, "*"))
    found = index.search(queries, probes_for(index, queries, recall), None, exact=False)
    pairs = found.select(
        F.col("id").alias("of"), F.explode(F.arrays_zip("ids", "d2")).alias("x")
    ).select("of", F.col("x.ids").alias("id"), F.col("x.d2").alias("measured"))
    asked = queries.select("id", "vec", "fold").toArrow().combine_chunks()
    number = queries.sparkSession.createDataFrame(
        pa.table({"query": pa.array(range(asked.num_rows)), "of": asked.column("id")})
    )
    true = exact_neighbors(index.points, asked, k, exclude).join(number, "query")
    return pairs.join(true.select("of", "id", "d2"), ["of", "id"], "full").agg(
        F.countDistinct("of").alias("queries"),
        F.count("measured").alias("found"),
        F.try_divide(
            F.count(F.when(F.col("measured").isNotNull(), F.col("d2"))), F.count("d2")
        ).alias("recall"),
        F.coalesce(F.bool_and(F.col("measured") == F.col("d2")), F.lit(True)).alias(
            "distances_exact"
        ),
    )


def _asked(refs, queries, k, exclude, recall, exact, bucket_points, ranks) -> DataFrame:
    # The bound prunes best along the axes that differ most; random ones suit an estimate.
    index = _built(refs, k, exclude, bucket_points, principal=exact)
    if index is None:
        kinds = "ids array<long>, d2 array<double>"
        if ranks is not None:
            kinds = ", ".join(f"K{r} double" for r in ranks)
        return refs.sparkSession.createDataFrame(
            [], f"query long, id long, n int, reach double, certain boolean, {kinds}"
        )
    number = F.monotonically_increasing_id().alias("query")
    queries = write_out(_folded(queries, exclude == "fold").select(number, "*"))
    return index.search(queries, probes_for(index, queries, recall), ranks, exact)
