"""Interpolated modified Kneser-Ney n-gram models, counted in Spark, searched in mapped arrays.

Counting. Each task turns its texts into symbols, sums its n-grams on numpy arrays and sends them,
packed, to the shard of their context (a frequent context is spread over all shards by n-gram). A
shard sums what arrives, writes its n-grams as sorted hash arrays below the shared folder, and
sends each distinct n-gram once to the shard of its suffix: those sums are the continuation counts
of the next lower order. So every order is one shuffle of packed arrays, and no step holds more
than a shard.

Scoring. A worker maps the arrays into memory; what it does not touch is never read, and workers of
one machine share the pages. A shard of an order is one file, and a worker keeps a bounded number of
files open; where the store cannot be mapped it keeps a bounded number of bytes. Every shard has a
file, also an empty one, so a missing file is an error. The distinct n-grams of a few texts are
looked up at a time.

Words stand for themselves by a 48-bit hash, contexts and n-grams by a 64-bit hash. An unseen n-gram
of a seen context passes the context's discounted mass down; below the unigrams lies a uniform
distribution over the training vocabulary and one unknown symbol, so probabilities sum to one.
"""

from __future__ import annotations

import json
import math
import mmap
import re
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import slices, utf8, width
from riskloom.session import shared_folder, write_out

START, END = 1 << 48, (1 << 48) + 1
FLUSH = 2_000_000
BLOCK = 1_000_000
SHARD_SYMBOLS = 1_000_000
HOT_SHARE = 0.001
HOT_SAMPLE = 2_000
LIMIT = 255  # counts from here on are kept apart
OPEN_SHARDS = 256
READ_BYTES = 256_000_000  # of shards that cannot be mapped
U = np.uint64


def word_symbols(text: bytes | None) -> np.ndarray:
    """48-bit hashes of the words of a text, ASCII letters in lower case."""
    words = text.lower().split() if text else []
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), U, len(words))
    return hashes & U((1 << 48) - 1)


def char_symbols(text: bytes | None) -> np.ndarray:
    """The code points of a text."""
    return np.frombuffer((text or b"").decode().encode("utf-32-le"), np.uint32).astype(U)


SYMBOLS = {"words": word_symbols, "chars": char_symbols}


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> U(33))) * U(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return values ^ (values >> U(33))


def _gram(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return _mix(context * U(0x9E3779B97F4A7C15) + symbol)


def _line(texts: list[np.ndarray], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array, padded; the places of the symbols to predict; their number."""
    pad, end = np.full(order - 1, START, U), np.array([END], U)
    line = np.concatenate([x for t in texts for x in (pad, t, end)])
    lengths = np.array([len(t) + 1 for t in texts])
    starts = np.cumsum(lengths + order - 1) - lengths
    at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    return line, at, lengths


def _columns(line: np.ndarray, at: np.ndarray, order: int) -> list[np.ndarray]:
    """[context of order n, ..., context of order 2, symbol] at these places."""
    columns, context = [line[at]], np.zeros(len(at), U)
    for back in range(1, order):
        context = _gram(context + U(back), line[at - back])
        columns.insert(0, context)
    return columns


def _summed(columns: list[np.ndarray], counts: list[np.ndarray]):
    """Distinct n-grams with their hash (sorted) and summed counts."""
    context = columns[0] if len(columns) > 1 else np.zeros(len(columns[0]), U)
    grams = _gram(context, columns[-1])
    order = np.argsort(grams)
    grams = grams[order]
    starts = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])[: len(grams)])
    first = order[starts]
    sums = [np.add.reduceat(c[order], starts) if len(order) else c for c in counts]
    return grams[starts], [c[first] for c in columns], sums


def _pack(columns: list[np.ndarray]) -> bytes:
    """Arrays of one length; like bytes stand together, the first column as differences."""
    first = np.diff(columns[0], prepend=U(0))
    planes = [c.view(np.uint8).reshape(-1, 8).T.tobytes() for c in [first, *columns[1:]]]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpack(blobs: list[bytes], n: int) -> list[np.ndarray]:
    parts = []
    for blob in blobs:
        flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
        planes = flat.reshape(n, 8, -1).transpose(0, 2, 1)
        cells = np.ascontiguousarray(planes).view(U).reshape(n, -1)
        parts.append([np.cumsum(cells[0], dtype=U), *cells[1:]])
    return [np.concatenate(c) for c in zip(*parts)]


def _among(values: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Whether each value is one of the sorted ``held``."""
    if not len(held):
        return np.zeros(len(values), bool)
    return held[np.minimum(np.searchsorted(held, values), len(held) - 1)] == values


def _representatives(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of values that stand for all, and for each value which of them.

    Sorted by the leading bits with the place in the trailing ones; a value may be stood for more
    than once where others share its leading bits.
    """
    bits = U(max(1, int(len(values) - 1).bit_length()))
    low = (U(1) << bits) - U(1)
    order = np.sort((values & ~low) | np.arange(len(values), dtype=U))
    order = (order & low).astype(np.int64)
    ranked = values[order]
    new = np.append(True, ranked[1:] != ranked[:-1])[: len(ranked)]
    back = np.empty(len(values), np.int64)
    back[order] = np.cumsum(new) - 1
    return order[new], back


def _shard_of(context: np.ndarray, grams: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    key = np.where(_among(context, hot), grams, _mix(context)) if len(hot) else _mix(context)
    return (key % U(shards)).astype(np.int64)


def _sent(columns, grams, sums, hot, shards) -> Iterator[tuple[int, bytes]]:
    """Packed n-grams per shard."""
    context = columns[0] if len(columns) > 1 else np.zeros(len(grams), U)
    spread = hot if len(columns) > 1 else np.zeros(1, U)
    shard = _shard_of(context, grams, spread, shards)
    order = np.lexsort((columns[-1], columns[0], shard))
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in range(shards):
        own = order[bounds[s] : bounds[s + 1]]
        if len(own):
            yield s, _pack([c[own] for c in [*columns, *sums]])


_OUT = "kind string, shard long, key long, v1 long, v2 long, v3 long, v4 long, data binary"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), *[pa.int64()] * 6, pa.binary()]
    names = [f.split()[0] for f in _OUT.split(", ")]
    cells = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, kinds)], names=names)


def _qualified(spark, path: str) -> str:
    """The path with the scheme that Spark's writers would use for it."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(path)
    uri = path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return uri.replace("file:/", "file:///", 1) if re.match("file:/(?!/)", uri) else uri


class _Folder:
    """Shards below a folder that driver and executors share, a file each, with named arrays.

    A file is its arrays one after the other, then an index of them, then the index's length.
    """

    def __init__(self, uri: str):
        self.fs, self.path = pyarrow.fs.FileSystem.from_uri(uri)
        self.local = isinstance(self.fs, pyarrow.fs.LocalFileSystem)

    def save(self, name: str, arrays: dict[str, np.ndarray]) -> None:
        """Written beside its place and moved there, so that a task may run again."""
        self.fs.create_dir(self.path, recursive=True)
        aside = f"{self.path}/{name}.{uuid.uuid4().hex}"
        index, at = {}, 0
        with self.fs.open_output_stream(aside) as out:
            for key, values in arrays.items():
                index[key] = (at, values.dtype.str, values.shape)
                at += out.write(np.ascontiguousarray(values).tobytes())
                at += out.write(b"\0" * (-at % 8))
            tail = json.dumps(index).encode()
            out.write(tail + len(tail).to_bytes(8, "little"))
        self.fs.move(aside, f"{self.path}/{name}")

    def load(self, name: str) -> tuple[dict[str, np.ndarray], int]:
        """The arrays of a shard, mapped where the store allows it, and the bytes they occupy.

        A shard that is not there is an error: empty shards have files too.
        """
        path = f"{self.path}/{name}"
        if self.local:
            with open(path, "rb") as source:
                held = mmap.mmap(source.fileno(), 0, access=mmap.ACCESS_READ)
        else:
            with self.fs.open_input_file(path) as source:
                held = source.read()
        size = len(held) - 8
        tail = int.from_bytes(held[size:], "little")
        arrays = {
            key: np.frombuffer(held, kind, math.prod(shape), at).reshape(shape)
            for key, (at, kind, shape) in json.loads(held[size - tail : size]).items()
        }
        return arrays, 0 if self.local else len(held)


def _arrays(order: int, columns, grams, adjusted, counts, hot):
    """The arrays of a shard of one order, and sums of its contexts that are kept with the model."""
    large = adjusted >= LIMIT
    arrays = {
        "gram": grams,
        "n": np.minimum(adjusted, LIMIT).astype(np.uint8),
        "large": np.stack([grams[large], adjusted[large]], 1),
    }
    if order == 1:
        return arrays | {"count": counts.astype(U)}, []
    by = np.argsort(columns[0])
    context, n = columns[0][by], adjusted[by]
    starts = np.flatnonzero(np.append(True, context[1:] != context[:-1])[: len(context)])
    sums = [
        np.add.reduceat(x.astype(np.int64), starts) if len(starts) else x.astype(np.int64)
        for x in (n, n == 1, n == 2, n >= 3)
    ]
    context = context[starts]
    own = ~_among(context, hot)
    arrays["context"] = context[own]
    arrays["sums"] = np.stack([x[own] for x in sums], 1).astype(np.uint32)
    kept = [
        (int(context[i].view(np.int64)), *[int(x[i]) for x in sums]) for i in np.flatnonzero(~own)
    ]
    return arrays, kept


def _written(folder: _Folder, order: int, shard: int, columns, grams, adjusted, counts, hot):
    """Write a shard of one order; rows of its statistics and of its hot contexts."""
    arrays, kept = _arrays(order, columns, grams, adjusted, counts, hot)
    folder.save(f"{order}-{shard}", arrays)
    rows = [
        ("stat", shard, order * 10 + i, int((adjusted == i).sum()), 0, 0, 0, None)
        for i in range(1, 5)
    ]
    rows += [
        ("stat", shard, order * 10 + 5, len(grams), int(adjusted.sum()), int(counts.sum()), 0, None)
    ]
    return rows + [("hot", order, *sums, None) for sums in kept]


def _empty_shards(stage: DataFrame, folder: str, order: int, shards: int) -> None:
    """Files for the shards that got no n-gram, so that a missing file is always an error."""
    filled = stage.filter("kind = 'stat'").select("shard").distinct()
    empty = stage.sparkSession.range(shards).join(filled, F.col("id") == F.col("shard"), "left_anti")

    def write(batches):
        none = np.zeros(0, U)
        arrays, _ = _arrays(order, [none] * order, none, none, none, none)
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                _Folder(folder).save(f"{order}-{shard}", arrays)
            yield batch

    empty.mapInArrow(write, "id long").count()


@dataclass
class Model:
    """Where the arrays are, and the few numbers that all shards share."""

    folder: str
    symbols: str
    order: int
    shards: int
    tokens: int
    types: int
    discounts: dict[int, tuple[float, float, float]]
    totals: dict[int, int]
    low_mass: float
    hot: np.ndarray
    hot_sums: dict[int, dict[int, tuple[int, int, int, int]]]


def train(
    texts: DataFrame,
    text: str = "text",
    symbols: str = "words",
    order: int = 2,
    flush: int = FLUSH,
    shard_symbols: int = SHARD_SYMBOLS,
) -> Model:
    """A model of all rows of ``texts``; null and empty texts are one end symbol.

    ``symbols`` is ``words`` or ``chars``. Start symbols are context only; each text ends with an
    end symbol, which is counted. Other columns are ignored. Repeated rows count as often as they
    occur. A model of no rows gives every symbol the same probability.
    """
    spark = texts.sparkSession
    rows = texts.select(F.col(text).cast("string").alias("text"))
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    per_symbol = 6 if symbols == "words" else 1  # bytes, roughly
    shards = max(2 * width(texts), math.ceil(size / per_symbol / shard_symbols))
    folder = _qualified(spark, f"{shared_folder(spark)}/ngrams-{uuid.uuid4().hex}")
    hot = _hot_contexts(rows, n, symbols, order)
    to_symbols = SYMBOLS[symbols]

    def count(batches):
        held, n = [], 0

        def sent():
            line, at, _ = _line(held, order)
            for start in range(0, len(at), 2 * flush):  # one text may be longer than that
                columns = _columns(line, at[start : start + 2 * flush], order)
                grams, columns, sums = _summed(columns, [np.ones(len(columns[-1]), U)])
                for shard, blob in _sent(columns, grams, [sums[0], sums[0]], hot, shards):
                    yield _rows([("next", shard, 0, 0, 0, 0, 0, blob)])

        for batch in slices(batches):
            for value in utf8(batch.column(0)):
                held.append(to_symbols(value))
                n += len(held[-1]) + 1
                if n >= flush:
                    yield from sent()
                    held, n = [], 0
        if held:
            yield from sent()

    stage = rows.mapInArrow(count, _OUT)
    found: dict[tuple[str, int], dict[int, tuple]] = {}
    for k in range(order, 0, -1):
        stage = write_out(
            stage.select("shard", "data")
            .groupBy("shard")
            .applyInArrow(_reducer(folder, k, hot, shards), _OUT)
        )
        _empty_shards(stage, folder, k, shards)
        sums = stage.filter("kind IN ('stat', 'hot')").withColumn(
            "shard", F.when(F.col("kind") == "hot", F.col("shard")).otherwise(F.lit(0))
        )
        sums = sums.groupBy("kind", "shard", "key").agg(
            *[F.sum(v).alias(v) for v in ("v1", "v2", "v3", "v4")]
        )
        for r in sums.collect():  # five statistics, and the hot contexts, of one order
            found.setdefault((r["kind"], k), {})[r["key"]] = tuple(r)[3:]
        stage = stage.filter("kind = 'next'")
    return _model(folder, symbols, order, shards, hot, found)


def _model(folder, symbols, order, shards, hot, found) -> Model:
    discounts, totals = {}, {}
    for k in range(1, order + 1):
        stat = found.get(("stat", k), {})
        n1, n2, n3, n4 = (stat.get(k * 10 + i, (0,))[0] for i in range(1, 5))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5

        def discount(i, here, above):
            return min(max(i - (i + 1) * y * above / here, 0.0), float(i)) if here else i * 0.5

        discounts[k] = (discount(1, n1, n2), discount(2, n2, n3), discount(3, n3, n4))
        totals[k] = stat.get(k * 10 + 5, (0, 0, 0))[1]
    stat = found.get(("stat", 1), {})
    types, _, tokens = stat.get(15, (0, 0, 0, 0))[:3]
    ones, twos = (stat.get(10 + i, (0,))[0] for i in (1, 2))
    mass = sum(d * n for d, n in zip(discounts[1], (ones, twos, types - ones - twos)))
    low = mass / totals[1] if totals[1] else 1.0
    hot_sums = {k: found.get(("hot", k), {}) for k in range(2, order + 1)}
    return Model(
        folder, symbols, order, shards, tokens, types, discounts, totals, low, hot, hot_sums
    )


def _hot_contexts(rows: DataFrame, n: int, symbols: str, order: int) -> np.ndarray:
    """Contexts that hold over a thousandth of the positions of a sample of texts.

    Only decides which contexts are spread over shards; sums are the same either way.
    """
    if order < 2 or not n:
        return np.zeros(0, U)
    to_symbols = SYMBOLS[symbols]

    def count(batches):
        for batch in slices(batches):
            line, at, _ = _line([to_symbols(t) for t in utf8(batch.column(0))], order)
            columns = _columns(line, at, order)
            for k, column in enumerate(columns[:-1]):
                values, sums = np.unique(column, return_counts=True)
                often = sums > HOT_SHARE / 10 * len(column)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.append(values[often], U(0)).view(np.int64)),
                        pa.array(np.append(sums[often], len(column) if k == 0 else 0)),
                    ],
                    names=["context", "n"],
                )

    sample = rows.sample(min(1.0, HOT_SAMPLE / n), seed=11) if n > HOT_SAMPLE else rows
    sums = sample.mapInArrow(count, "context long, n long").groupBy("context").agg(
        F.sum("n").alias("n")
    )
    total = sums.filter("context = 0").first()  # the empty context stands for all positions
    if total is None:
        return np.zeros(0, U)
    often = sums.filter((F.col("n") > HOT_SHARE * total["n"]) & (F.col("context") != 0))
    return np.sort(np.array([r["context"] for r in often.collect()], np.int64).view(U))


def _reducer(folder: str, k: int, hot: np.ndarray, shards: int):
    def reduce(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        blobs = table.column("data").to_pylist()
        cells = _unpack(blobs, k + 2)
        grams, columns, (adjusted, counts) = _summed(cells[:k], cells[k:])
        rows = _written(_Folder(folder), k, shard, columns, grams, adjusted, counts, hot)
        if k > 1:
            ones = np.ones(len(grams), U)
            low, below, sums = _summed(columns[1:], [ones, counts])
            rows += [
                ("next", s, 0, 0, 0, 0, 0, blob)
                for s, blob in _sent(below, low, sums, hot, shards)
            ]
        return pa.Table.from_batches([_rows(rows)])

    return reduce


class Scorer:
    """A model's arrays, mapped when they are needed; only the last used shards stay open."""

    def __init__(self, model: Model):
        self.model, self.folder, self.open = model, _Folder(model.folder), OrderedDict()
        self.bytes = 0
        self.hot_index = {}
        for k, sums in model.hot_sums.items():
            keys = np.array(sorted(key % (1 << 64) for key in sums), U)
            values = [sums[int(x.view(np.int64))] for x in keys]
            self.hot_index[k] = (keys, np.array(values, np.int64).reshape(-1, 4))

    def _array(self, k: int, shard: int, what: str) -> np.ndarray:
        name = f"{k}-{shard}"
        if name not in self.open:
            self.open[name] = self.folder.load(name)
            self.bytes += self.open[name][1]
            while len(self.open) > 1 and (len(self.open) > OPEN_SHARDS or self.bytes > READ_BYTES):
                self.bytes -= self.open.popitem(last=False)[1][1]
        self.open.move_to_end(name)
        return self.open[name][0][what]

    def _find(self, k: int, what: str, shard: np.ndarray, keys: np.ndarray):
        """Per key its place in its shard's sorted array, -1 where it is missing."""
        place = np.full(len(keys), -1)
        order = np.argsort(keys)
        small = np.uint16 if self.model.shards <= 1 << 16 else np.uint32
        order = order[np.argsort(shard[order].astype(small), kind="stable")]
        ends = np.flatnonzero(np.append(shard[order][1:] != shard[order][:-1], True))
        start = 0
        for end in ends + 1 if len(order) else []:
            own = order[start:end]
            held = self._array(k, shard[own[0]], what)
            if len(held):
                at = np.minimum(np.searchsorted(held, keys[own]), len(held) - 1)
                place[own] = np.where(held[at] == keys[own], at, -1)
            yield shard[own[0]], own[place[own] >= 0], place[own][place[own] >= 0]
            start = end

    def _counts(self, k: int, shard: np.ndarray, grams: np.ndarray):
        adjusted, counts = np.zeros(len(grams)), np.zeros(len(grams))
        for s, own, at in self._find(k, "gram", shard, grams):
            n = self._array(k, s, "n")[at].astype(np.float64)
            over = np.flatnonzero(n == LIMIT)
            if len(over):
                large = self._array(k, s, "large")
                n[over] = large[np.searchsorted(large[:, 0], grams[own][over]), 1]
            adjusted[own] = n
            if k == 1:
                counts[own] = self._array(k, s, "count")[at]
        return adjusted, counts

    def _contexts(self, k: int, shard: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        sums = np.zeros((len(contexts), 4))
        for s, own, at in self._find(k, "context", shard, contexts):
            sums[own] = self._array(k, s, "sums")[at]
        keys, values = self.hot_index[k]
        if len(keys):
            at = np.minimum(np.searchsorted(keys, contexts), len(keys) - 1)
            found = keys[at] == contexts
            sums[found] = values[at[found]]
        return sums

    def probabilities(self, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Probability and training count of the last symbol of each n-gram."""
        m, symbol = self.model, columns[-1]
        none = np.zeros(len(symbol), U)
        grams = _gram(none, symbol)
        shard = _shard_of(none, grams, none[:1], m.shards)
        adjusted, counts = self._counts(1, shard, grams)
        p = np.full(len(symbol), m.low_mass / (m.types + 1))
        if m.totals[1]:
            p += _discounted(adjusted, m.discounts[1]) / m.totals[1]
        for k in range(2, m.order + 1):
            context = columns[m.order - k]
            grams = _gram(context, symbol)
            shard = _shard_of(context, grams, m.hot, m.shards)
            adjusted, _ = self._counts(k, shard, grams)
            sums = self._contexts(k, shard, context)
            seen = sums[:, 0] > 0
            total = np.where(seen, sums[:, 0], 1)
            kept = sums[:, 1:] @ np.array(m.discounts[k]) / total
            p = np.where(seen, _discounted(adjusted, m.discounts[k]) / total + kept * p, p)
        return p, counts

    def score(self, texts: list[bytes | None]) -> dict[str, np.ndarray]:
        """Per text: tokens, known tokens, log10 probability, and that of smoothed unigrams."""
        m = self.model
        line, at, lengths = _line([SYMBOLS[m.symbols](t) for t in texts], m.order)
        text = np.repeat(np.arange(len(texts)), lengths)
        sums = np.zeros((3, len(texts)))
        for start in range(0, len(at), BLOCK):
            part = slice(start, start + BLOCK)
            columns = _columns(line, at[part], m.order)
            none = np.zeros(len(columns[0]), U)
            grams = _gram(columns[0] if m.order > 1 else none, columns[-1])
            first, back = _representatives(grams)
            p, counts = self.probabilities([c[first] for c in columns])
            base = (counts + 0.1) / (m.tokens + 0.1 * (m.types + 1))
            for i, x in enumerate((counts > 0, np.log10(p), np.log10(base))):
                sums[i] += np.bincount(text[part], x[back], len(texts))
        known = sums[0].astype(np.int64)
        return {"n_tokens": lengths, "n_known": known, "score": sums[1], "base_score": sums[2]}


def _discounted(counts: np.ndarray, discounts: tuple[float, float, float]) -> np.ndarray:
    steps = np.array([0.0, *discounts])
    return np.maximum(counts - steps[np.minimum(counts, 3).astype(np.int64)], 0.0)


_scorers: dict[str, Scorer] = {}


def scorer(model: Model) -> Scorer:
    """The scorer of a model in this worker."""
    if model.folder not in _scorers:
        _scorers.clear()
        _scorers[model.folder] = Scorer(model)
    return _scorers[model.folder]
