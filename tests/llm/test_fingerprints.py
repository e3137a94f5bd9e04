import hashlib
import os
import random
import re
import struct
import sys

import xxhash

sys.path.insert(0, os.path.dirname(__file__))
from brute import SCHEMA, SF, odd_rows, words  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from riskloom.llm import syncmers  # noqa: E402

K, S = syncmers.K, syncmers.S


def chained(values):
    """Spark's xxhash64 of several columns: each hash seeds the next."""
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else struct.pack("<q", v)
        seed = xxhash.xxh64_intdigest(data, seed=seed)
    return seed - (1 << 64) if seed >> 63 else seed


def anchors(text):
    found = words(text)
    if not found:
        return []
    line = [""] * (K - 1) + found + [""] * (K - 1)
    runs = [chained(line[i : i + S]) for i in range(len(line) - S + 1)]
    inner, out = K - S + 1, []
    cover = sorted({*range(0, inner, S), inner - 1})
    for i in range(len(runs) - inner + 1):
        window = runs[i : i + inner]
        if min(window) in (window[0], window[-1]):
            out.append((chained([window[c] for c in cover]) % (1 << 64)) >> 32)
    return out


def likeness(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def by_hand(rows):
    """Rows of (doc_id, text); a null id comes last."""
    low = -(1 << 63)
    rows = [(d, t or "") for d, t in rows]
    rows.sort(key=lambda r: (low if r[0] is None else r[0], r[1].encode()), reverse=True)
    out = []
    for i, (doc, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        own, changed = anchors(text), anchors(edited)
        out.append(
            (
                str(doc),
                len(text),
                hashlib.sha256(edited.encode()).hexdigest(),
                "".join(f"{x:08x}" for x in own),
                "".join(f"{x:08x}" for x in changed),
                likeness(own, changed),
                likeness(own, anchors(after)),
            )
        )
    return sorted(out)


def got(df):
    return sorted((str(r[0]), *tuple(r)[1:]) for r in df.collect())


def test_fingerprints_of_awkward_rows(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA).withColumn("fingerprint", F.lit(1))
    assert got(syncmers.fingerprinted(df)) == by_hand([(r[0], r[1]) for r in odd_rows()])
    assert syncmers.fingerprinted(df.limit(0)).count() == 0
    one = df.filter("doc_id = 9")
    assert [r.near_next for r in syncmers.fingerprinted(one).collect()] == [1.0]


def test_fingerprints_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = by_hand([(r.doc_id, r.text) for r in docs.collect()])
    found = got(syncmers.op1_syncmers(spark, SF))
    assert found == want
    mean = [sum(r[c] for r in found) / len(found) for c in (5, 6)]
    assert mean[0] > 0.35 > 0.1 > mean[1]


def test_next_rows_over_many_ranges_and_large_ids(spark):
    rng = random.Random(2)
    ids = [rng.randint(-(1 << 62), 1 << 62) for _ in range(500)]
    ids += ids[:20] + [ids[7]] * 30
    df = spark.createDataFrame([(i, f"t{n}") for n, i in enumerate(ids)], "o long, t string")
    rows = sorted(((i, f"t{n}") for n, i in enumerate(ids)), reverse=True)
    want = {r[1]: rows[(n + 1) % len(rows)][1] for n, r in enumerate(rows)}
    found = syncmers.with_next(df.repartition(7), "o", ["t"]).collect()
    assert {r.t: r.next_t for r in found} == want and len(found) == len(ids)


def test_an_id_and_a_text_of_half_the_rows_are_spread(spark):
    rows = [(None, "same text of many") for _ in range(4000)]
    rows += [(n % 50, f"text {n} of it") for n in range(2000)]
    rows += [(3, "x" * 100 + str(n)) for n in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(11)
    base = df.withColumn("_order", F.coalesce("doc_id", F.lit(-(1 << 63)))).select("_order", "text")
    paired = syncmers.with_next(base, "_order", ["text"])
    # As many rows as went in, and every row is the next one of exactly one other.
    found = [(r["_order"], r.text, r.next_text) for r in paired.collect()]
    own = sorted(t for _, t in rows)
    assert sorted(t for _, t, _ in found) == own and sorted(t for *_, t in found) == own
    alike = [n for o, t, n in found if t == "same text of many"]
    assert sum(n == "same text of many" for n in alike) == 3999
    low = sorted((o, t, n) for o, t, n in found if o == 4)
    assert [n for _, _, n in low[1:]] == [t for _, t, _ in low[:-1]]
    sizes = paired.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 6 and max(r["count"] for r in sizes) < 2500


def test_any_windows_in_a_row_keep_one(spark):
    text = " ".join(random.Random(1).choices("abcdefgh", k=4000))
    df = spark.createDataFrame([(text,)], "text string")
    kept = syncmers.with_anchors(df, "text", "a").select(F.size("a")).first()[0]
    assert kept >= (4000 + K - 1) // (K - S)
    assert not re.search("python|arrow", str(df._jdf.queryExecution()).lower())
