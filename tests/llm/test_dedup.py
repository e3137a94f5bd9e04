import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from brute import BLANK, SCHEMA, SF, least_reachable, lower, odd_rows, simhash  # noqa: E402

from riskloom.llm import line_dedup, simhash as near  # noqa: E402
from riskloom.llm.cuckoo import CuckooFilter  # noqa: E402


def kept_lines(rows):
    """doc row -> kept text, by the rule itself; a null id is the largest."""
    big = 1 << 63
    owners = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = lower(line.strip(BLANK))
            if len(key) >= 10:
                owners.setdefault(key, set()).add(big if doc is None else doc)
    out = []
    for doc, text in rows:
        mine = big if doc is None else doc
        left = []
        for line in (text or "").split("\n"):
            key = lower(line.strip(BLANK))
            if mine == min(owners.get(key, {mine})):
                left.append(line)
        out.append((doc, "\n".join(left)))
    return sorted(out, key=str)


def test_line_dedup_of_awkward_rows(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA).withColumn("lines", near.F.lit(7))
    got = line_dedup.deduplicated(df).select("doc_id", "lines.kept").collect()
    want = kept_lines([(r[0], r[1]) for r in odd_rows()])
    assert sorted(((r[0], r[1]) for r in got), key=str) == want
    assert line_dedup.with_unique_lines(df).columns == df.columns


def test_line_index_inserts_and_deletes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    first, second = docs.filter("doc_id % 3 = 0"), docs.filter("doc_id % 3 != 0")
    whole = line_dedup.LineIndex.empty(spark).insert(second).insert(first)
    got = line_dedup.deduplicated(docs, whole).select("doc_id", "lines.kept").collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, got), key=str) == kept_lines(rows)

    back = whole.delete(second.select("doc_id"))
    assert sorted(map(tuple, back.counts.select("k1", "k2", "refs", "owner").collect())) == sorted(
        map(
            tuple,
            line_dedup.LineIndex.empty(spark)
            .insert(first)
            .counts.select("k1", "k2", "refs", "owner")
            .collect(),
        )
    )
    left = [(r.doc_id, r.text) for r in first.collect()]
    got = line_dedup.deduplicated(first, back).select("doc_id", "lines.kept").collect()
    assert sorted(map(tuple, got), key=str) == kept_lines(left)


def test_texts_pass_python_once_for_their_keys(spark, monkeypatch):
    """Keys are stored for both uses, and an index without rows starts no Python of its own."""
    none = line_dedup.LineIndex.empty(spark)
    for table in (none.postings, none.counts, none.filters):
        assert table.count() == 0
        assert "ExistingRDD" not in table._jdf.queryExecution().executedPlan().toString()
    made, keys = [], line_dedup.line_keys
    monkeypatch.setattr(line_dedup, "line_keys", lambda *a: made.append(a) or keys(*a))
    rows = [(1, "a line of text\nown words here"), (2, "A line of text \nshort"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.lines for r in line_dedup.deduplicated(docs).collect()}
    assert {i: (r.n_lines, r.n_dropped, r.kept) for i, r in got.items()} == {
        1: (2, 0, rows[0][1]), 2: (2, 1, "short"), 3: (1, 0, "")
    }
    assert len(made) == 1


def test_shards_follow_the_lines(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    first, second = docs.filter("doc_id % 3 = 0"), docs.filter("doc_id % 3 != 0")
    small = line_dedup.LineIndex.empty(spark).insert(first)
    monkeypatch.setattr(line_dedup, "SHARD_ROWS", 3)
    few = line_dedup.LineIndex.empty(spark).insert(first)
    lines = few.postings.count()
    assert few.shards >= lines / 3 > small.shards
    for index in (few, small):
        whole = index.insert(second)
        assert whole.shards >= whole.postings.count() / 3
        got = line_dedup.deduplicated(docs, whole).select("doc_id", "lines.kept").collect()
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        assert sorted(map(tuple, got), key=str) == kept_lines(rows)


def test_rows_of_one_id_have_lists_of_their_own(spark):
    rows = [(1, "a line that all the texts share", 1, 2, 3)]
    for n in range(300):
        text = f"a line that all the texts share\na line of number {n // 2}\nof {n} alone, says it"
        rows.append((None if n % 3 else 7, text, 1, 2, 3))
    df = spark.createDataFrame(rows, "doc_id long, text string, _drops int, _doc int, _lines int")
    made = line_dedup.deduplicated(df)
    got = made.select("doc_id", "lines.kept").collect()
    assert sorted(map(tuple, got), key=str) == kept_lines([r[:2] for r in rows])
    assert {tuple(r) for r in made.select("_drops", "_doc", "_lines").collect()} == {(1, 2, 3)}
    assert line_dedup.with_unique_lines(df.withColumn("n_chars", near.F.lit(0))).count() == 301


def test_near_duplicates_keep_clashing_columns(spark):
    df = spark.createDataFrame(
        [(n, f"the same words in text {n // 2}", n, -n, "x", n) for n in range(6)],
        "doc_id long, text string, _id long, _hash long, _none string, _N long",
    )
    left = near.without_near_duplicates(df)
    assert left.columns == df.columns
    rows = [tuple(r) for r in left.collect()]
    assert rows and all(r[2] == r[5] == r[0] == -r[3] and r[4] == "x" for r in rows)


def test_cuckoo_filter_forgets():
    rng = np.random.default_rng(5)
    hashes = np.unique(rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(16))
    cells = CuckooFilter.loads(CuckooFilter.of(hashes).dumps())
    assert cells.holds(hashes).all()
    for h in hashes[::2]:
        assert cells.remove(int(h))
    assert cells.holds(hashes[1::2]).all()
    assert cells.holds(hashes[::2]).mean() < 0.01


def test_simhash_components_of_awkward_rows(spark):
    rows = [r for r in odd_rows() if r[0] is not None]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("fp", near.F.lit("x"))
    got = {r.doc_id: (r.fp, r.component_id) for r in near.near_duplicates(df).collect()}
    prints = {r[0]: simhash(r[1]) for r in rows}
    want = least_reachable(prints)
    assert {k: (v[0] % (1 << 64), v[1]) for k, v in got.items()} == {
        k: (prints[k], want[k]) for k in prints
    }
    left = near.without_near_duplicates(spark.createDataFrame(odd_rows(), SCHEMA))
    assert left.count() == len(set(want.values()))
    assert near.near_duplicates(df.limit(0)).count() == 0


def test_simhash_components_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r.component_id for r in near.near_duplicates(docs).collect()}
    prints = {r.doc_id: simhash(r.text) for r in docs.collect()}
    assert got == least_reachable(prints)


@pytest.mark.parametrize("long_file", [40, near.LONG_FILE])
@pytest.mark.parametrize(
    "thresholds", [None, (0, 0, 0), (1, 0), (0, 1), (2,)], ids=lambda t: str(t)
)
def test_links_of_crowded_fingerprints(spark, long_file, thresholds):
    """Dense clouds (long files) and stray values, under every allocation of thresholds."""
    rng = random.Random(3)
    values = {rng.getrandbits(64) for _ in range(60)}
    for base in list(values)[:3]:
        for _ in range(120):
            value = base
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                value ^= 1 << bit
            values.add(value)
    prints = {v - (1 << 64) if v >> 63 else v: v for v in values}
    df = spark.createDataFrame([(k,) for k in prints], "fp long")
    plan = None
    if thresholds:
        size = 64 // len(thresholds)
        masks = [((1 << size) - 1) << (size * i) for i in range(len(thresholds))]
        masks[-1] |= ((1 << 64) - 1) ^ sum(masks)
        plan = list(zip(masks, thresholds))
    edges = near.links(df, long_file=long_file, plan=plan)
    roots = {r.node: r.root for r in near.components(edges).collect()}
    want = least_reachable(prints)
    assert {k: roots.get(k, k) for k in prints} == want


def test_thresholds_are_the_cheapest():
    costs = [[0, 5, 9, 30], [0, 2, 50, 60], [0, 7, 8, 9]]
    best = min(
        (costs[0][a + 1] + costs[1][b + 1] + costs[2][c + 1], [a, b, c])
        for a in range(-1, 3)
        for b in range(-1, 3)
        for c in range(-1, 3)
        if a + b + c == 0
    )
    assert near.thresholds(costs, 0) == best
