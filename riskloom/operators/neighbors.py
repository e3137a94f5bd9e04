"""Exact k-nearest-neighbour target means as a two-round, space-partitioned join.

1. Reference points with the same coordinates are thinned to the ``k`` (or ``k + 1``) smallest
   ids: no query can use more of them, so a third of all rows on one point costs nothing.
2. A tree of medians, built from a bounded sample, cuts space into cells of limited size, each time
   across the widest side. The sample only places the cuts; the answer does not depend on it.
3. Round one searches each query's home, its cell or a few around it, and yields a radius that is
   certain to hold all neighbours; where the home holds too few, the farthest corner of the
   smallest enclosing box with enough points does. Round two holds a group of queries of
   neighbouring cells in a task and lets the points of all cells that some query's radius touches
   stream by, nearest cells first. Each query keeps its nearest points, and only sums leave the
   task: nothing is stored that grows with queries times neighbours or with chunks of points.

The number of groups is constant until a group has ``GROUP_QUERIES`` queries, so points that every
query touches (many coordinates) are copied ``GROUPS`` times up to a million queries.

Queries at the same coordinates are searched once. Ties are settled by id.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.joins import attach
from riskloom.session import settle, shuffle_width

SALT_ROWS = 100_000
SAMPLE_POINTS = 20_000
CELL_POINTS = 2_048
CELL_QUERIES = 8_192
SPARE_LEVELS = 3
BLOCK = 4_000_000
CHUNK_CELLS = 128
MIN_SHARE = 0.1
# What the driver holds of the tree, whatever the size of the table.
MAX_LEVELS = 13
TREE_BYTES = 64_000_000
# Points of a query's home, as a multiple of the neighbours sought.
HOME_SHARE = 4
# Queries are searched in about so many groups, none larger than what a task may hold.
GROUPS = 32
LEAST_QUERIES = 1_024
GROUP_QUERIES = 32_768
QUERY_ROWS = 256
FEW_COORDINATES = 8


def vector(columns: Sequence[str]) -> Column:
    """Numeric columns as one coordinate array."""
    return F.array(*[F.col(c).cast("double") for c in columns])


def knn_target_mean(
    refs: DataFrame,
    queries: DataFrame,
    ks: Sequence[int],
    exclude: str | None = None,
    cell_points: int | None = None,
    cell_queries: int = CELL_QUERIES,
    chunk_cells: int = CHUNK_CELLS,
) -> DataFrame:
    """``(id, KNN_TARGET_MEAN_K<k>...)`` for every query.

    ``refs`` has ``id, vec, y`` and ``queries`` has ``id, vec`` (no nulls in ``vec``), plus ``fold``
    in both when ``exclude="fold"``. ``exclude="self"`` leaves out the reference with the query's
    own id, ``exclude="fold"`` all references of the query's fold. With fewer than ``k``
    references the mean covers those there are. ``cell_points`` defaults to ``CELL_POINTS``, or more
    for large ``k``; cells are larger where the tree would not stay small. Cells stream by in turns
    of ``chunk_cells``, nearest first. None of these changes a result.
    """
    ks = sorted(set(ks))
    by_fold = exclude == "fold"
    most = max(ks) + (1 if exclude == "self" else 0)
    place = ["vec", "fold"] if by_fold else ["vec"]

    points = settle(thinned(refs, place, most))
    tree = _Cuts(points, cell_points or max(CELL_POINTS, 4 * most))
    points = settle(points.withColumn("cell", tree.cell_of()))
    tree.measure(points, by_fold)

    sites = queries.groupBy(*place).agg(F.min("id").alias("site"))
    sites = settle(sites.withColumn("cell", tree.cell_of()))
    sites = sites.toDF(*sites.columns)  # new column identities: queries may derive from refs
    sites, groups = _groups(sites, cell_queries)
    if tree.depth:
        home = F.shiftright("cell", tree.levels_up(HOME_SHARE * most))
        around = _blocks(sites.select("site", *place, home.alias("cell")), cell_queries)
        within = _radius(settle(around), points.withColumn("cell", home), most, by_fold)
        found = sites.join(within, "site", "left")
        sites = settle(found.withColumn("r2", tree.certain(most, by_fold)))
        # A query with a null coordinate has no radius, and its cell goes without an answer.
        lost = sites.filter(F.isnull("r2") | F.isnan("r2")).select("cell").distinct()
        found = sites.join(F.broadcast(lost), "cell", "left_anti")
        touched = tree.touched(found).join(
            found.select("cell", "sub", "group").distinct(), ["cell", "sub"]
        )
        touched = touched.groupBy("group", "from_cell").agg(F.min("gap").alias("gap"))
    else:
        sites = settle(sites.withColumn("r2", F.lit(float("inf"))))
        touched = sites.select("group", F.lit(1).alias("from_cell"), F.lit(0.0).alias("gap"))
        touched, found = touched.distinct(), sites
    facts = _nearest(found, points, touched, groups, ks, most, by_fold, chunk_cells)
    return _means(queries, sites.select("site", *place).join(facts, "site", "left"), place, ks,
                  exclude == "self")


def thinned(refs: DataFrame, place: list[str], most: int) -> DataFrame:
    """At most ``most`` smallest ids per place, in two steps so that no place is one big task."""
    salts = refs.count() // SALT_ROWS + 1
    salted = refs.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
    first = Window.partitionBy(*place, "_salt").orderBy("id")
    then = Window.partitionBy(*place).orderBy("id")
    return (
        salted.withColumn("_n", F.row_number().over(first))
        .filter(F.col("_n") <= most)
        .withColumn("_n", F.row_number().over(then))
        .filter(F.col("_n") <= most)
        .select("id", F.col("y").cast("double").alias("y"), *place)
    )


def _matrix(rows: pa.Table, column: str) -> np.ndarray:
    """An array column as a matrix, one row per value."""
    flat = rows.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    if not rows.num_rows:
        return np.zeros((0, 0))
    return flat.reshape(rows.num_rows, -1).astype(float)


class _Cuts:
    """A binary tree of median cuts, the bounding boxes of its nodes and their point counts."""

    def __init__(self, points: DataFrame, cell_points: int):
        total = points.count()
        levels = int(np.ceil(np.log2(max(total, 1) / cell_points)))
        if levels > 0:  # the driver holds the boxes, so large tables have larger cells
            width = max(1, len(points.select("vec").first()["vec"]))
            fitting = int(np.log2(TREE_BYTES / (16 * width))) - SPARE_LEVELS - 1
            levels = max(1, min(levels, MAX_LEVELS, fitting))
        # Spare levels are for cells that tied coordinates keep from being halved.
        self.depth = levels + SPARE_LEVELS if levels > 0 else 0
        nodes = 2 ** (self.depth + 1)
        self.dim = np.zeros(nodes, dtype=int)
        self.at = np.full(nodes, np.inf)
        if self.depth:
            want = max(SAMPLE_POINTS, 16 * 2**levels)
            rows = points.select("vec").sample(min(1.0, 1.2 * want / total), seed=7).limit(want)
            sample = _matrix(rows.toArrow(), "vec")
            self._cut(1, sample, max(2.0, len(sample) / 2**levels))

    def _cut(self, node: int, sample: np.ndarray, enough: float) -> None:
        """Cut across the widest side, or the next one where ties leave little on one half.

        A node with few sample points, or all of them on one place, stays whole.
        """
        if node >= 2**self.depth or len(sample) <= enough:
            return
        middle = np.sort(sample, axis=0)[(len(sample) - 1) // 2]
        below = np.where(sample < middle, sample, -np.inf).max(axis=0)
        best = (0, 0, np.inf)
        for j in np.argsort(-np.ptp(sample, axis=0), kind="stable"):
            for cut in (middle[j], below[j]):
                left = int((sample[:, j] <= cut).sum())
                if min(left, len(sample) - left) > best[0]:
                    best = (min(left, len(sample) - left), int(j), float(cut))
            if best[0] >= MIN_SHARE * len(sample):
                break
        if best[0] == 0:
            return
        self.dim[node], self.at[node] = best[1], best[2]
        low = sample[:, best[1]] <= best[2]
        self._cut(2 * node, sample[low], enough)
        self._cut(2 * node + 1, sample[~low], enough)

    def cell_of(self) -> Column:
        depth, dim, at = self.depth, self.dim, self.at
        if not depth:
            return F.lit(1)

        @F.pandas_udf("int")
        def cell(vec: pd.Series) -> pd.Series:
            x = np.stack(vec.to_numpy()).astype(float)
            node = np.ones(len(x), dtype=int)
            for _ in range(depth):
                node = 2 * node + (x[np.arange(len(x)), dim[node]] > at[node])
            return pd.Series(node.astype("int32"))

        return cell("vec")

    def measure(self, points: DataFrame, by_fold: bool) -> None:
        """Boxes and counts from the points themselves: one row per cell (and fold)."""
        if not self.depth:
            return
        width = len(points.select("vec").first()["vec"])
        fold = F.col("fold").cast("int") if by_fold else F.lit(0)
        cells = points.groupBy("cell", fold.alias("fold")).agg(
            F.array(*[F.min(F.col("vec")[i]) for i in range(width)]).alias("lo"),
            F.array(*[F.max(F.col("vec")[i]) for i in range(width)]).alias("hi"),
            F.count("*").alias("n"),
        )
        rows = cells.toArrow()
        cell, own = rows["cell"].to_numpy(), rows["fold"].to_numpy()
        self.folds = np.unique(own)
        nodes = 2 ** (self.depth + 1)
        self.lo = np.full((nodes, width), np.inf)
        self.hi = np.full((nodes, width), -np.inf)
        self.count = np.zeros((nodes, len(self.folds)), dtype=np.int64)
        np.minimum.at(self.lo, cell, _matrix(rows, "lo"))
        np.maximum.at(self.hi, cell, _matrix(rows, "hi"))
        np.add.at(self.count, (cell, np.searchsorted(self.folds, own)), rows["n"].to_numpy())
        for level in range(self.depth - 1, -1, -1):
            node = np.arange(2**level, 2 ** (level + 1))
            self.lo[node] = np.minimum(self.lo[2 * node], self.lo[2 * node + 1])
            self.hi[node] = np.maximum(self.hi[2 * node], self.hi[2 * node + 1])
            self.count[node] = self.count[2 * node] + self.count[2 * node + 1]

    def levels_up(self, enough: int) -> int:
        """How far up nodes hold ``enough`` points on average."""
        occupied = self.count[2**self.depth :].sum(axis=1)
        level, size = 0, float(occupied.sum())
        while level < self.depth:
            here = np.add.reduceat(occupied, np.arange(0, len(occupied), 2**level))
            if size / max(1, np.count_nonzero(here)) >= enough:
                break
            level += 1
        return level

    def certain(self, most: int, by_fold: bool) -> Column:
        """A squared radius that holds ``most`` usable points, infinite if there are fewer.

        That of the home cell, or the distance to the farthest corner of the smallest box above
        it with enough points outside the query's fold.
        """
        tree, depth = self, self.depth

        @F.pandas_udf("double")
        def radius(cell: pd.Series, vec: pd.Series, fold: pd.Series, r2: pd.Series) -> pd.Series:
            found = r2.fillna(np.inf).to_numpy().copy()
            open_ = np.flatnonzero(np.isinf(found))
            if not len(open_):
                return pd.Series(found)
            x = np.stack(vec.to_numpy()[open_]).astype(float)
            node = cell.to_numpy()[open_].astype(int)
            mine = fold.to_numpy()[open_]
            at = np.minimum(np.searchsorted(tree.folds, mine), len(tree.folds) - 1)
            held = by_fold & (tree.folds[at] == mine)
            left = np.arange(len(open_))
            for _ in range(depth + 1):
                usable = tree.count[node].sum(axis=1) - held * tree.count[node, at]
                hit = np.flatnonzero(usable[left] >= most)
                who = left[hit]
                far = np.maximum(
                    np.abs(x[who] - tree.lo[node[who]]), np.abs(x[who] - tree.hi[node[who]])
                )
                found[open_[who]] = (far**2).sum(axis=1) * (1 + 1e-9)
                left = np.delete(left, hit)
                node[left] //= 2
            return pd.Series(found)

        fold = F.col("fold").cast("int") if by_fold else F.lit(0)
        return radius("cell", "vec", fold, "r2")

    def touched(self, sites: DataFrame) -> DataFrame:
        """``(cell, sub, from_cell, gap)``: cells whose box is within the radius of a block's box.

        A block is the queries of one ``cell`` and ``sub``; ``gap`` is the squared distance.
        """
        boxes = sites.sparkSession.sparkContext.broadcast((self.lo, self.hi))
        depth, width = self.depth, self.lo.shape[1]

        def cells(batches):
            lo, hi = boxes.value
            for batch in batches:
                table = pa.Table.from_batches([batch])
                low, high = _matrix(table, "lo"), _matrix(table, "hi")
                limit = table["r2"].to_numpy() * (1 + 1e-9)
                block = np.stack([table["cell"].to_numpy(), table["sub"].to_numpy()], axis=1)
                for i in range(len(block)):
                    node = np.ones(1, dtype=int)
                    for _ in range(depth):
                        node = np.concatenate([2 * node, 2 * node + 1])
                        gap = np.maximum(np.maximum(lo[node] - high[i], low[i] - hi[node]), 0.0)
                        gap = (gap**2).sum(axis=1)
                        keep = np.isfinite(lo[node][:, 0]) & (gap <= limit[i])
                        node, gap = node[keep], gap[keep]
                    if len(node):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(node), block[i, 0], np.int32)),
                                pa.array(np.full(len(node), block[i, 1], np.int32)),
                                pa.array(node.astype(np.int32)),
                                pa.array(gap),
                            ],
                            names=["cell", "sub", "from_cell", "gap"],
                        )

        asked = sites.groupBy("cell", "sub").agg(
            F.array(*[F.min(F.col("vec")[i]) for i in range(width)]).alias("lo"),
            F.array(*[F.max(F.col("vec")[i]) for i in range(width)]).alias("hi"),
            F.max("r2").alias("r2"),
        )
        return asked.repartition(shuffle_width(sites), "cell", "sub").mapInArrow(
            cells, "cell int, sub int, from_cell int, gap double"
        )


def _blocks(sites: DataFrame, cell_queries: int) -> DataFrame:
    """Add ``sub``: a cell with many queries is split into parts of limited size."""
    parts = (
        sites.groupBy("cell")
        .count()
        .select("cell", F.ceil(F.col("count") / cell_queries).alias("parts"))
    )
    sub = F.pmod(F.xxhash64("site"), F.col("parts")).cast("int")
    return sites.join(parts, "cell").withColumn("sub", sub).drop("parts")


def _both_sides(asked: DataFrame, offered: DataFrame, *keys: str):
    """Co-grouped sides over a fixed number of tasks.

    The work grows with the product of both sides, not with the bytes that adaptive execution
    would merge small partitions by.
    """
    width = shuffle_width(asked)
    offered = offered.toDF(*offered.columns)  # new column identities: both sides share ancestors
    return (
        asked.repartition(width, *keys)
        .groupBy(*keys)
        .cogroup(offered.repartition(width, *keys).groupBy(*keys))
    )


def _distances(by_fold: bool):
    """A function of two Arrow tables that yields blocks of squared distances."""
    block_cells = BLOCK

    def numbers(table: pa.Table, name: str) -> np.ndarray:
        return table[name].combine_chunks().to_numpy(zero_copy_only=False)

    def blocks(asked: pa.Table, offered: pa.Table, limits: np.ndarray):
        """``(queries, points, d2)``: points in id order, those far from all queries left out."""
        points = np.argsort(numbers(offered, "id"), kind="stable")
        r, q = _matrix(offered, "vec")[points], _matrix(asked, "vec")
        fold = (numbers(asked, "fold"), numbers(offered, "fold")[points]) if by_fold else None
        near_first = np.argsort(q[:, int(np.argmax(np.ptp(q, axis=0)))], kind="stable")
        step = max(1, min(256, block_cells // len(r)))
        for start in range(0, len(q), step):
            who = near_first[start : start + step]
            reach = np.sqrt(limits[who].max()) * (1 + 1e-9)
            inside = (r >= q[who].min(axis=0) - reach) & (r <= q[who].max(axis=0) + reach)
            at = np.flatnonzero(inside.all(axis=1))
            d2 = np.zeros((len(who), len(at)))
            for j in range(q.shape[1]):
                d2 += (q[who, j][:, None] - r[at, j][None, :]) ** 2
            if by_fold:
                d2[fold[0][who][:, None] == fold[1][at][None, :]] = np.inf
            yield who, points[at], d2

    return numbers, blocks


def _radius(sites: DataFrame, points: DataFrame, most: int, by_fold: bool) -> DataFrame:
    """``(site, r2)``: the squared distance that holds ``most`` points of the query's own cell."""
    subs = sites.groupBy("cell").agg(F.max("sub").alias("subs"))
    offered = points.join(subs, "cell").withColumn(
        "sub", F.explode(F.sequence(F.lit(0), F.col("subs")))
    )
    numbers, blocks = _distances(by_fold)

    def radius(asked: pa.Table, offered: pa.Table) -> pa.Table:
        found = np.full(asked.num_rows, np.inf)
        if asked.num_rows and offered.num_rows >= most:
            for who, _, d2 in blocks(asked, offered, found):
                if d2.shape[1] >= most:  # points with a null coordinate are no neighbours
                    found[who] = np.partition(d2, most - 1, axis=1)[:, most - 1]
        return pa.table({"site": asked["site"].cast(pa.int64()), "r2": pa.array(found)})

    return _both_sides(sites, offered, "cell", "sub").applyInArrow(radius, "site long, r2 double")


def _ranks(ks: Sequence[int], most: int) -> list[int]:
    """Every ``k``, and every ``k + 1`` where a query may have to leave itself out."""
    return sorted({*ks, *(k + 1 for k in ks if most > max(ks))})


def _groups(sites: DataFrame, cell_queries: int) -> tuple[DataFrame, int]:
    """Add ``sub`` and ``group``, and say how many groups there are.

    Neighbouring cells make a group of up to a share ``1 / GROUPS`` of all queries, which is at least
    ``LEAST_QUERIES`` (or ``cell_queries``, if less) and at most ``GROUP_QUERIES``. A cell of more
    queries is split.
    """
    sizes = sites.groupBy("cell").count().toArrow()  # one row per cell of the bounded tree
    cell, size = sizes["cell"].to_numpy(), sizes["count"].to_numpy()
    least = min(cell_queries, LEAST_QUERIES)
    limit = max(least, min(GROUP_QUERIES, int(size.sum()) // GROUPS))
    first, parts = {}, {}
    group, held = 0, 0
    for i in np.argsort(cell):
        if held and held + size[i] > limit:
            group, held = group + 1, 0
        first[int(cell[i])], parts[int(cell[i])] = group, -(-int(size[i]) // limit)
        held += int(size[i])
        if size[i] > limit:
            group, held = group + parts[int(cell[i])], 0
    places = np.array(sorted(first), dtype=np.int64)
    begins = np.array([first[c] for c in places.tolist()], dtype=np.int64)
    counts = np.array([parts[c] for c in places.tolist()], dtype=np.int64)

    @F.pandas_udf("struct<begin int, parts int>")
    def place(cell: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(places, cell.to_numpy())
        return pd.DataFrame(
            {"begin": begins[at].astype("int32"), "parts": counts[at].astype("int32")}
        )

    sub = F.pmod(F.xxhash64("site"), F.col("_at.parts")).cast("int")
    rows = sites.withColumn("_at", place("cell")).withColumn("sub", sub)
    rows = rows.withColumn("group", F.col("_at.begin") + F.col("sub")).drop("_at")
    return rows, group + 1


class _Held:
    """The queries of a group and their nearest points among those that have passed by."""

    def __init__(self, most: int, by_fold: bool):
        self.most, self.by_fold = most, by_fold
        self.tables: list[pa.Table] = []
        self.ready = False

    def settle(self) -> None:
        """Lay the queries out by cell, so that a block of them is close together."""
        asked = pa.concat_tables(self.tables)
        whole = np.isfinite(_matrix(asked, "vec")).all(axis=1)  # the others have no neighbours
        asked = asked.filter(pa.array(whole))
        asked = asked.take(pa.array(np.argsort(asked["cell"].to_numpy(), kind="stable")))
        self.x = _matrix(asked, "vec")
        self.site = asked["site"]
        self.fold = _numbers(asked, "fold") if self.by_fold else None
        self.limit = _numbers(asked, "r2").astype(float)
        shape = (len(self.x), self.most)
        self.d2 = np.full(shape, np.inf)
        self.id = np.zeros(shape, dtype=np.int64)
        self.y = np.zeros(shape)
        self.tables, self.ready = [], True

    def pass_by(self, offered: pa.Table) -> None:
        r, ids = _matrix(offered, "vec"), _numbers(offered, "id")
        ys = _numbers(offered, "y").astype(float)
        fold = _numbers(offered, "fold") if self.by_fold else None
        for start in range(0, len(self.x), QUERY_ROWS):
            who = slice(start, min(start + QUERY_ROWS, len(self.x)))
            q, limit = self.x[who], self.limit[who]
            reach = np.sqrt(limit.max()) * (1 + 1e-9)
            near = (r >= q.min(axis=0) - reach) & (r <= q.max(axis=0) + reach)
            at = np.flatnonzero(near.all(axis=1))
            if not len(at):
                continue
            same = None
            if self.by_fold:
                same = self.fold[who][:, None] == fold[at][None, :]
            i, j, d2 = _within(q, r[at], limit, same, self.most)
            if len(i):
                self._merge(start, i, d2, ids[at[j]], ys[at[j]])

    def _merge(self, start: int, i, d2, ids, ys) -> None:
        """Keep the ``most`` nearest of the old and new points of each query, ties by id."""
        who, back = np.unique(i, return_inverse=True)
        rows = who + start
        owner = np.concatenate([np.repeat(np.arange(len(who)), self.most), back])
        every = [
            np.concatenate([old[rows].ravel(), new])
            for old, new in ((self.d2, d2), (self.id, ids), (self.y, ys))
        ]
        order = np.lexsort((every[1], every[0], owner))
        first = np.searchsorted(owner[order], np.arange(len(who)))
        kept = order[first[:, None] + np.arange(self.most)[None, :]]
        self.d2[rows], self.id[rows], self.y[rows] = (x[kept] for x in every)
        self.limit[rows] = np.minimum(self.limit[rows], self.d2[rows, -1])

    def facts(self, ranks: Sequence[int]):
        """Record batches of ``(site, n, sums, zero_ids, zero_ys)`` for queries with neighbours."""
        for start in range(0, len(self.x), QUERY_ROWS):
            who = slice(start, min(start + QUERY_ROWS, len(self.x)))
            n = np.isfinite(self.d2[who]).sum(axis=1)
            zero = (self.d2[who] == 0.0).sum(axis=1)
            running = np.cumsum(self.y[who], axis=1)
            at = np.minimum(np.array(ranks)[None, :], np.maximum(n, 1)[:, None]) - 1
            sums = np.take_along_axis(running, at, axis=1)
            own = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [
                    self.site.slice(start, len(n)).combine_chunks().take(pa.array(own)),
                    pa.array(n[own].astype(np.int32)),
                    pa.array(list(sums[own]), pa.list_(pa.float64())),
                    pa.array([self.id[start + i, : zero[i]] for i in own], pa.list_(pa.int64())),
                    pa.array([self.y[start + i, : zero[i]] for i in own], pa.list_(pa.float64())),
                ],
                names=["site", "n", "sums", "zero_ids", "zero_ys"],
            )


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table[name].combine_chunks().to_numpy(zero_copy_only=False)


def _exact(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs, summed in the order of the coordinates."""
    d2 = np.zeros((len(q), len(r)))
    for j in range(q.shape[1]):
        d2 += (q[:, j][:, None] - r[:, j][None, :]) ** 2
    return d2


def _rough(q: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Squared distances by one product of matrices in single precision, and what they may be off.

    None where single precision could not hold them.
    """
    middle = q.mean(axis=0)
    q, r = q - middle, r - middle
    q_size, r_size = (q**2).sum(axis=1), (r**2).sum(axis=1)
    size = q_size.max() + r_size.max()
    if not 1e-20 < size < 1e30:
        return None
    one = np.ones
    left = np.column_stack([-2 * q, q_size, one(len(q))]).astype(np.float32)
    right = np.column_stack([r, one(len(r)), r_size]).astype(np.float32)
    off = 4 * (q.shape[1] + 8) * float(np.finfo(np.float32).eps) * (q_size + r_size.max())
    return left @ right.T, off


def _up(values: np.ndarray, kind: np.dtype) -> np.ndarray:
    """The values in another precision, none of them less than before."""
    return values if values.dtype == kind else np.nextafter(values.astype(kind), kind.type(np.inf))


def _within(q: np.ndarray, r: np.ndarray, limit: np.ndarray, same: np.ndarray | None, most: int):
    """``(query, point, d2)`` of the pairs within the queries' limits, and of no fold they share.

    A query with far more of them gives its ``most`` nearest and what ties with these. With many
    coordinates a matrix product first leaves out pairs that are certain to be too far apart.
    """
    rough = _rough(q, r) if q.shape[1] > FEW_COORDINATES else None
    d2, off = rough if rough else (_exact(q, r), np.zeros(len(q)))
    if same is not None:
        d2[same] = np.inf
    bound = limit + off
    near = d2 <= _up(bound, d2.dtype)[:, None]
    if np.count_nonzero(near) > 4 * most * len(q) and len(r) > most:
        kth = np.partition(d2, most - 1, axis=1)[:, most - 1]
        bound = np.where(kth + 2 * off < bound, kth + 2 * off, bound)
        near = d2 <= _up(bound, d2.dtype)[:, None]
    i, j = np.divmod(np.flatnonzero(near.ravel()), len(r))
    if not rough:
        d2 = d2[i, j]
    else:
        d2 = np.zeros(len(i))
        for c in range(q.shape[1]):
            d2 += (q[i, c] - r[j, c]) ** 2
    kept = (d2 <= limit[i]) & np.isfinite(d2)
    return i[kept], j[kept], d2[kept]


def _nearest(
    sites: DataFrame,
    points: DataFrame,
    touched: DataFrame,
    groups: int,
    ks: Sequence[int],
    most: int,
    by_fold: bool,
    chunk_cells: int,
) -> DataFrame:
    """``(site, n, sums, zero_ids, zero_ys)`` per query site that has neighbours.

    A group of queries is held in one task while the points of all cells it touches stream by, so
    a task holds no more than its queries and their ``most`` nearest. ``sums`` holds the label sum
    of the nearest points at every rank of ``_ranks``, ``n`` how many points there are at most,
    ``zero_*`` the points at distance 0 in id order.
    """
    ranks = _ranks(ks, most)
    near_first = Window.partitionBy("group").orderBy("gap", "from_cell")
    streams = touched.select(
        "from_cell",
        "group",
        F.floor((F.row_number().over(near_first) - 1) / chunk_cells).cast("int").alias("turn"),
    )
    fold = F.col("fold").cast("int") if by_fold else F.lit(0)
    offered = points.withColumnRenamed("cell", "from_cell").join(streams, "from_cell").select(
        "group", "turn", F.lit(None).cast("long").alias("site"), "vec", fold.alias("fold"),
        F.lit(None).cast("double").alias("r2"), F.col("from_cell").alias("cell"),
        F.col("id").cast("long").alias("id"), F.col("y").cast("double").alias("y"),
    )
    asked = sites.select(
        "group", F.lit(-1).alias("turn"), F.col("site").cast("long").alias("site"), "vec",
        fold.alias("fold"), F.col("r2").cast("double").alias("r2"), F.col("cell").alias("cell"),
        F.lit(None).cast("long").alias("id"), F.lit(None).cast("double").alias("y"),
    )

    def search(batches):
        group, held = None, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            owner, turn = table["group"].to_numpy(), table["turn"].to_numpy()
            new = (np.diff(owner) != 0) | ((turn[1:] < 0) != (turn[:-1] < 0))
            edges = [0, *(np.flatnonzero(new) + 1).tolist(), len(owner)]
            for start, end in zip(edges, edges[1:]):
                if end == start:
                    continue
                part = table.slice(start, end - start)
                if owner[start] != group:
                    if held is not None and held.ready:
                        yield from held.facts(ranks)
                    group, held = owner[start], _Held(most, by_fold)
                if turn[start] < 0:
                    held.tables.append(part)
                else:
                    if not held.ready:
                        held.settle()
                    held.pass_by(part)
        if held is not None and held.ready:
            yield from held.facts(ranks)

    return settle(
        asked.unionByName(offered)
        .repartitionById(groups, "group")
        .sortWithinPartitions("group", "turn")
        .mapInArrow(
            search,
            "site long, n int, sums array<double>, zero_ids array<long>, zero_ys array<double>",
        )
    )


def _means(
    queries: DataFrame, answers: DataFrame, place: list[str], ks: Sequence[int], self_out: bool
) -> DataFrame:
    """The facts of a site turned into means for each of its queries."""
    rows = attach(queries.select("id", *place), answers.drop("site"), place)
    ranks = _ranks(ks, max(ks) + 1 if self_out else max(ks))
    n = F.col("n")

    def upto(rank: int) -> Column:
        return F.get("sums", F.lit(ranks.index(rank)))

    # Its own place among the points at distance 0 tells whether a query is its own neighbour.
    mine = F.coalesce(F.array_position("zero_ids", F.col("id")), F.lit(0)) if self_out else F.lit(0)
    rows = rows.withColumn("_mine", mine.cast("int"))
    own = F.get("zero_ys", F.col("_mine") - 1)
    means = {}
    for k in ks:
        mean = F.try_divide(upto(k), F.least(n, F.lit(k)))
        if self_out:
            others = F.try_divide(upto(k + 1) - own, F.least(n, F.lit(k + 1)) - 1)
            mean = F.when((F.col("_mine") > 0) & (F.col("_mine") <= k), others).otherwise(mean)
        means[f"KNN_TARGET_MEAN_K{k}"] = mean
    return rows.select("id", *[m.alias(name) for name, m in means.items()])
