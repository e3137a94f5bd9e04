"""Approximate nearest neighbours by inner product in a hierarchical k-means tree.

Vectors get one more component that gives all the same length, so that the largest inner product is
the smallest distance. A tree of k-means splits is fitted on a bounded sample; every vector then
descends to the leaf of its nearest centres. A query walks the tree best bin first: a priority queue
holds the branches met so far by distance of their centre, the nearest is opened next, and the walk
ends after a number of leaves.

That number is calibrated: for a bounded set of queries the true neighbours are found by comparing
them with every vector, and visits are widened until the leaves visited hold the wanted share of
them. Leaves lie on shelves of a bounded number of vectors; a leaf of more is dealt to several. A
query is sent once to each shelf that holds leaves of its walk, shelves meet their queries batch by
batch, and a query's best of each shelf are merged. Queries that found too few visit all leaves.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import width
from riskloom.session import settle, write_out

NEIGHBOURS = 20
SAMPLE_VALUES = 3_200_000  # components of the sample, 50,000 vectors of 64
BRANCHES = 16
LEAF_ROWS = 64
LEAF_SAMPLE = 16
ITERATIONS = 8
CALIBRATION = 256
RECALL = 0.95
SHELF_VALUES = 4_194_304
SHELF_LEAST = 4_096
SHELF_QUERIES = 65_536
CELLS = 2_000_000
ROUNDING = 1e-12


@dataclass
class Tree:
    """Centres of all nodes; the children of a node are consecutive. ``leaf`` is -1 inside."""

    centres: np.ndarray
    first: np.ndarray
    count: np.ndarray
    leaf: np.ndarray
    longest: float

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector, by the nearest centre at every node."""
        points = lifted(vectors, self.longest)
        at = np.zeros(len(points), np.int64)
        while True:
            inner = np.flatnonzero(self.leaf[at] < 0)
            if not len(inner):
                return self.leaf[at]
            by = inner[np.argsort(at[inner], kind="stable")]
            for rows in np.split(by, np.flatnonzero(np.diff(at[by])) + 1):
                node = at[rows[0]]
                below = slice(self.first[node], self.first[node] + self.count[node])
                at[rows] = self.first[node] + _distances(points[rows], self.centres[below]).argmin(1)

    def walk(self, query: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first: the nearest branch met so far is opened next."""
        length = math.sqrt(float(query @ query))
        point = np.append(query / length, 0.0)
        waiting = [(0.0, 0)]
        while waiting:
            _, node = heapq.heappop(waiting)
            if self.leaf[node] >= 0:
                yield int(self.leaf[node])
                continue
            first = int(self.first[node])
            below = self.centres[first : first + int(self.count[node])]
            apart = below - point
            for i, d in enumerate(np.einsum("ij,ij->i", apart, apart).tolist()):
                heapq.heappush(waiting, (d, first + i))


def lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors divided by the longest length, with the component that makes theirs 1."""
    scaled = vectors / longest
    rest = 1.0 - np.einsum("ij,ij->i", scaled, scaled)
    return np.column_stack([scaled, np.sqrt(np.maximum(rest, 0.0))])


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances but for the points' own lengths."""
    return np.einsum("ij,ij->i", centres, centres) - 2.0 * (points @ centres.T)


def _split(points: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Cluster number of each point after k-means; fewer than ``parts`` where points are equal."""
    centres = points[rng.choice(len(points), min(parts, len(points)), replace=False)]
    for _ in range(ITERATIONS):
        near = _distances(points, centres).argmin(1)
        used, near = np.unique(near, return_inverse=True)
        sums = np.zeros((len(used), points.shape[1]))
        np.add.at(sums, near, points)
        centres = sums / np.bincount(near)[:, None]
    return near


def fit(sample: np.ndarray, longest: float, rows: int) -> Tree:
    """A tree for ``rows`` vectors, of which ``sample`` is a part; at least one vector."""
    rng = np.random.default_rng(11)
    points = lifted(sample, longest)
    most = max(LEAF_SAMPLE, LEAF_ROWS * len(points) / max(rows, 1))
    centres, first, count, leaf = [points.mean(0)], [0], [0], [-1]
    waiting, leaves = [(0, np.arange(len(points)))], 0
    for node, members in waiting:
        wanted = 1 if len(members) <= most else min(BRANCHES, math.ceil(2 * len(members) / most))
        near = _split(points[members], wanted, rng)
        parts = int(near.max()) + 1
        if parts == 1:
            leaf[node], leaves = leaves, leaves + 1
            continue
        first[node], count[node] = len(centres), parts
        for part in range(parts):
            mine = members[near == part]
            waiting.append((len(centres), mine))
            centres.append(points[mine].mean(0))
            first.append(0)
            count.append(0)
            leaf.append(-1)
    return Tree(np.array(centres), np.array(first), np.array(count), np.array(leaf), longest)


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner product of each pair of rows, added up in order of the components.

    Other than a matrix product this gives equal pairs equal results, wherever they stand.
    """
    out = np.zeros(len(left))
    for d in range(left.shape[1]):
        out += left[:, d] * right[:, d]
    return out


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def _best(scores: np.ndarray, slack: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's ``k`` highest cells and of those within ``slack`` of them."""
    if scores.shape[1] > k:
        least = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
    else:
        least = np.full(len(scores), -np.inf)
    hit = (scores >= (least - slack)[:, None]) & (scores > -np.inf)
    return np.nonzero(hit)


def _ranked(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best per query: score descending, then id."""
    by = np.lexsort((ids, -score, query))
    asked = query[by]
    begins = np.flatnonzero(np.append(True, asked[1:] != asked[:-1])) if len(by) else by
    place = np.arange(len(by)) - np.repeat(begins, np.diff(np.append(begins, len(by))))
    return by[place < k]


class Shelf:
    """Vectors of some leaves; of equal vectors only as many as one query can use."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaves: np.ndarray, k: int):
        rows = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.shape[1] * 8)))
        _, same = np.unique(rows.ravel(), return_inverse=True)
        by = np.lexsort((ids, same))
        repeated = np.zeros(len(by), bool)
        repeated[1:] = (same[by][1:] == same[by][:-1]) & (ids[by][1:] == ids[by][:-1])
        by = by[~repeated]
        # One more than k, as one may be the query's own row.
        by = by[_ranked(same[by], ids[by], np.zeros(len(by)), k + 1)]
        by = by[np.argsort(leaves[by], kind="stable")]
        self.ids, self.vectors, self.k = ids[by], vectors[by], k
        self.leaves, self.begins = np.unique(leaves[by], return_index=True)
        self.ends = np.append(self.begins[1:], len(by))
        self.longest = math.sqrt(float(np.einsum("ij,ij->i", self.vectors, self.vectors).max()))

    def search(self, own: np.ndarray, queries: np.ndarray, visits: np.ndarray):
        """Query number, id and score; ``visits`` tells which leaves each query opens."""
        scores = np.full((len(queries), len(self.ids)), -np.inf)
        for leaf, begin, end in zip(self.leaves, self.begins, self.ends):
            asking = np.flatnonzero(visits[:, leaf])
            if len(asking):
                scores[asking, begin:end] = queries[asking] @ self.vectors[begin:end].T
        for q in np.flatnonzero(np.isin(own, self.ids)):
            scores[q, self.ids == own[q]] = -np.inf
        lengths = np.sqrt(np.einsum("ij,ij->i", queries, queries))
        row, col = _best(scores, ROUNDING * self.longest * lengths, self.k)
        exact = np.concatenate(
            [
                inner_products(queries[row[i : i + 8192]], self.vectors[col[i : i + 8192]])
                for i in range(0, len(row), 8192)
            ]
            or [np.zeros(0)]
        )
        best = _ranked(row, self.ids[col], exact, self.k)
        return row[best], self.ids[col[best]], exact[best]


@dataclass
class Layout:
    """Where leaves lie: the first shelf of each, on how many it is dealt, and shelves' leaves."""

    first: np.ndarray
    deals: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, sizes: np.ndarray, most: int) -> Layout:
        first, deals, low, high = [], [], [], []
        held = most + 1
        for leaf, size in enumerate(sizes.tolist()):
            parts = max(1, math.ceil(size / most))
            if parts > 1 or held + size > most:
                first.append(len(low))
                low += [leaf] * parts
                high += [leaf + 1] * parts
                held = size if parts == 1 else most + 1
            else:
                first.append(len(low) - 1)
                high[-1] = leaf + 1
                held += size
            deals.append(parts)
        return cls(*[np.array(x) for x in (first, deals, low, high)])

    def table(self, spark) -> DataFrame:
        """``(leaf, first, deals)``."""
        columns = [np.arange(len(self.first)), self.first, self.deals]
        arrays = [pa.array(c, pa.int32()) for c in columns]
        return spark.createDataFrame(pa.table(arrays, names=["leaf", "first", "deals"]))


@dataclass
class Index:
    """All vectors by leaf in a stored table ``id, vector, leaf``, and how a search walks them."""

    tree: Tree
    layout: Layout
    rows: DataFrame
    dim: int
    visits: int
    k: int

    def search(self, queries: DataFrame) -> DataFrame:
        """``(query, query_id, vec_id, score)`` for the stored ``query, query_id, vector`` rows."""
        found = self._searched(queries, self.visits)
        if self.visits >= self.tree.leaves:
            return found
        found = write_out(found)
        enough = found.groupBy("query").count().filter(F.col("count") >= self.k)
        short = settle(queries.join(enough, "query", "left_anti"))
        if short.isEmpty():
            return found
        whole = self._searched(short, self.tree.leaves)
        return found.join(enough, "query", "left_semi").unionByName(whole)

    def _searched(self, queries: DataFrame, visits: int) -> DataFrame:
        asked = write_out(self._walked(queries, visits))
        # A shelf that very many queries visit is copied, for each part of its queries.
        parts = asked.groupBy("shelf").agg(
            F.ceil(F.count("*") / SHELF_QUERIES).cast("int").alias("parts")
        )
        parts = settle(parts)
        many = F.coalesce("parts", F.lit(1))
        spread = asked.join(parts, "shelf").withColumn(
            "part", F.pmod(F.xxhash64("id"), many).cast("int")
        )
        # One row per leaf, of which there are fewer than vectors in the bounded sample.
        lie = self.layout.table(queries.sparkSession)
        dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), "deals").cast("int")
        shelved = (
            self.rows.join(F.broadcast(lie), "leaf")
            .withColumn("shelf", F.col("first") + dealt)
            .join(parts, "shelf")
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        )
        none = F.lit(None)
        both = shelved.select(
            "shelf", "part", F.lit(0).alias("kind"), "id", none.cast("long").alias("query_id"),
            "vector", "leaf", none.cast("binary").alias("mask"),
        ).unionByName(
            spread.select(
                "shelf", "part", F.lit(1).alias("kind"), "id", "query_id", "vector",
                none.cast("int").alias("leaf"), "mask",
            )
        )
        groups = parts.agg(F.coalesce(F.sum("parts"), F.lit(1))).first()[0]
        merged = (
            both.repartition(int(groups), "shelf", "part")
            .sortWithinPartitions("shelf", "part", "kind")
            .mapInArrow(
                _meeting(self.layout, self.dim, self.tree.leaves, self.k),
                "query long, query_id long, vec_id long, score double",
            )
            # A row that is repeated may lie on several shelves.
            .dropDuplicates(["query", "vec_id", "score"])
        )
        best = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
        return (
            merged.withColumn("place", F.row_number().over(best))
            .filter(F.col("place") <= self.k)
            .drop("place")
        )

    def _walked(self, queries: DataFrame, visits: int) -> DataFrame:
        """One row per query and shelf with a bit for each leaf of the shelf to open."""
        tree, layout, dim = self.tree, self.layout, self.dim

        def stage(batches):
            for batch in batches:
                vectors = _matrix(batch.column("vector"), dim)
                row, shelves, masks = [], [], []
                for i, vector in enumerate(vectors):
                    leaves = np.fromiter(_first(tree.walk(vector), visits), np.int64)
                    opened = np.zeros(tree.leaves, np.uint8)
                    opened[leaves] = 1
                    starts, one = np.unique(layout.first[leaves], return_index=True)
                    for start, parts in zip(starts.tolist(), layout.deals[leaves[one]].tolist()):
                        mask = np.packbits(opened[layout.low[start] : layout.high[start]])
                        for shelf in range(start, start + parts):
                            row.append(i)
                            shelves.append(shelf)
                            masks.append(mask.tobytes())
                taken = batch.take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shelves, pa.int32()),
                        taken.column("query"),
                        taken.column("query_id"),
                        taken.column("vector"),
                        pa.array(masks, pa.binary()),
                    ],
                    names=["shelf", "id", "query_id", "vector", "mask"],
                )

        kind = queries.schema["vector"].dataType.simpleString()
        return (
            queries.select("query", "query_id", "vector")
            .repartition(width(queries))
            .mapInArrow(
                stage, f"shelf int, id long, query_id long, vector {kind}, mask binary"
            )
        )


def _first(walk: Iterator[int], visits: int) -> Iterator[int]:
    for _, leaf in zip(range(visits), walk):
        yield leaf


def _meeting(layout: Layout, dim: int, leaves: int, k: int):
    """Rows of a shelf, then its queries in batches; only the shelf is held."""

    def stage(batches):
        here, rows, shelf = None, [], None
        for batch in batches:
            keys = [batch.column(c).to_numpy() for c in ("shelf", "part", "kind")]
            changes = np.zeros(batch.num_rows, bool)
            for key in keys:
                changes[1:] |= key[1:] != key[:-1]
            cuts = [0, *np.flatnonzero(changes).tolist(), batch.num_rows]
            for begin, end in zip(cuts, cuts[1:]):
                if begin == end:
                    continue
                piece = batch.slice(begin, end - begin)
                at = (int(keys[0][begin]), int(keys[1][begin]))
                if at != here:
                    here, rows, shelf = at, [], None
                if keys[2][begin] == 0:
                    ids = piece.column("id").to_numpy()
                    vectors = _matrix(piece.column("vector"), dim)
                    rows.append((ids, vectors, piece.column("leaf").to_numpy()))
                    continue
                if shelf is None and rows:
                    ids, vectors, leaf = [np.concatenate(x) for x in zip(*rows)]
                    shelf, rows = Shelf(ids, vectors, leaf - layout.low[here[0]], k), []
                if shelf is not None:
                    yield from _answers(shelf, piece, dim)

    return stage


def _answers(shelf: Shelf, queries: pa.RecordBatch, dim: int):
    step = max(1, CELLS // len(shelf.ids))
    for start in range(0, queries.num_rows, step):
        some = queries.slice(start, step)
        masks = np.frombuffer(b"".join(some.column("mask").to_pylist()), np.uint8)
        visits = np.unpackbits(masks.reshape(some.num_rows, -1), axis=1)
        own = some.column("query_id").to_numpy()
        row, ids, score = shelf.search(own, _matrix(some.column("vector"), dim), visits)
        yield pa.RecordBatch.from_arrays(
            [
                some.column("id").take(pa.array(row)),
                some.column("query_id").take(pa.array(row)),
                pa.array(ids),
                pa.array(score),
            ],
            names=["query", "query_id", "vec_id", "score"],
        )


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``id, vector`` of the rows that take part, whatever the number of their components."""
    kind = vectors.schema[vector].dataType.elementType.simpleString()
    kind = kind if kind == "float" else "double"
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return (
        vectors.select(
            F.col(vec_id).cast("long").alias("id"),
            F.col(vector).cast(f"array<{kind}>").alias("vector"),
        )
        .filter(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite)
        .filter(F.exists("vector", lambda x: x != 0))
    )


def build(
    vectors: DataFrame,
    queries: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = NEIGHBOURS,
    recall: float = RECALL,
) -> Index | None:
    """An index of all usable rows, calibrated on some that the condition ``queries`` on ``id`` names.

    None if no row is usable.
    """
    rows = usable(vectors, vec_id, vector)
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    dims = (
        rows.groupBy(F.size("vector").alias("dim"))
        .agg(F.count("*").alias("rows"), F.max(squares).alias("most"))
        .orderBy(F.col("rows").desc(), F.col("dim").desc())
        .limit(1)
        .collect()
    )
    if not dims:
        return None
    dim, n, longest = dims[0]["dim"], dims[0]["rows"], math.sqrt(dims[0]["most"])
    rows = rows.filter(F.size("vector") == dim)
    tree = fit(_some(rows, n, max(1, SAMPLE_VALUES // dim), dim)[1], longest, n)

    def place(batches):
        for batch in batches:
            leaf = tree.assign(_matrix(batch.column("vector"), dim))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaf, pa.int32())], names=["id", "vector", "leaf"]
            )

    kind = rows.schema["vector"].dataType.simpleString()
    placed = write_out(rows.mapInArrow(place, f"id long, vector {kind}, leaf int"))
    sizes = np.zeros(tree.leaves, np.int64)
    for r in placed.groupBy("leaf").count().collect():
        sizes[r["leaf"]] = r["count"]
    # Every shelf that a query visits answers with k rows, so shelves are not made small.
    most = min(max(SHELF_LEAST, math.ceil(n / (2 * width(placed)))), max(1, SHELF_VALUES // dim))
    asked = placed.filter(queries)
    visits = _calibrated(tree, placed, asked, dim, k, recall)
    return Index(tree, Layout.of(sizes, most), placed, dim, visits, k)


def _some(rows: DataFrame, n: int, most: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of about ``most`` of ``n`` rows, at most ``most``."""
    if n > most:
        rows = rows.filter(F.rand(5) < 1.1 * most / n).limit(most)
    table = rows.select("id", "vector").toArrow().combine_chunks()
    if not table.num_rows:
        return np.zeros(0, np.int64), np.zeros((0, dim))
    return table.column("id").to_numpy(), _matrix(table.column("vector").chunk(0), dim)


def _calibrated(
    tree: Tree, placed: DataFrame, asked: DataFrame, dim: int, k: int, recall: float
) -> int:
    """The fewest visits whose leaves hold ``recall`` of some queries' true neighbours."""
    own, queries = _some(asked, asked.count(), CALIBRATION, dim)
    if not len(own):
        return 1

    def truth(batches):
        kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)]
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                some = batch.slice(start, 4096)
                ids, leaf = some.column("id").to_numpy(), some.column("leaf").to_numpy()
                scores = queries @ _matrix(some.column("vector"), dim).T
                scores[own[:, None] == ids[None, :]] = -np.inf
                row, col = _best(scores, np.zeros(len(queries)), k)
                found = [row, ids[col], scores[row, col], leaf[col].astype(np.int64)]
                kept = [np.concatenate(x) for x in zip(kept, found)]
                best = _ranked(kept[0], kept[1], kept[2], k)
                kept = [x[best] for x in kept]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in kept], names=["query", "id", "score", "leaf"]
        )

    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    true = (
        placed.mapInArrow(truth, "query long, id long, score double, leaf long")
        .withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= k)
        .groupBy("query")
        .agg(F.collect_list("leaf").alias("leaves"))
        .collect()
    )
    needed: list[int] = []
    for r in true:
        left = list(r["leaves"])
        for visit, leaf in enumerate(tree.walk(queries[r["query"]]), 1):
            if leaf in left:
                needed += [visit] * left.count(leaf)
                left = [x for x in left if x != leaf]
            if not left:
                break
    needed.sort()
    return needed[math.ceil(recall * len(needed)) - 1] if needed else 1


def nearest(
    vectors: DataFrame,
    queries: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = NEIGHBOURS,
    recall: float = RECALL,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows of largest inner product per query row.

    ``queries`` is a condition on the column ``id``. Candidates are all rows of another id; all are
    given if they are fewer than ``k``. Scores are exact, in double precision, so of the candidates
    seen the order is right: score descending, then id. Rows take no part whose id or vector is
    null, whose vector is empty, zero, or holds nulls or values that are not finite, or has another
    number of components than most (of equally many, the larger). Repeated rows count once, as a
    query and as a candidate; rows that share an id but not the vector count each. Other columns
    are not read. An empty table, or one without queries, gives no rows.
    """
    spark = vectors.sparkSession
    index = build(vectors, queries, vec_id, vector, k, recall)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = index.rows.filter(queries).dropDuplicates(["id", "vector"])
    numbered = write_out(
        asked.select(
            F.monotonically_increasing_id().alias("query"), F.col("id").alias("query_id"), "vector"
        )
    )
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return (
        index.search(numbered)
        .withColumn("rank", F.row_number().over(best))
        .select("query_id", "rank", "vec_id", "score")
    )


def op11_kmeans_tree(spark, sf_dir: str) -> DataFrame:
    """Every twentieth embedding against all others."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, F.col("id") % 20 == 0)
