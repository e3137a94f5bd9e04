"""Periodic runs against a search over all periods, and the query against plain Python."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from brute import SCHEMA, SF, odd_rows, words

from riskloom.llm import periodic_runs
from riskloom.llm.periodic_runs import Positions, op13_periodic_runs, runs_of, with_runs


def plain_runs(text, least=6, exponent=4):
    """Every period by itself: stretches of equal words that far apart, least period first."""
    found = {}
    codes = {}
    n, text = len(text), np.array([codes.setdefault(w, len(codes)) for w in text])
    for q in range(1, n // exponent + 1):
        same = np.concatenate([[False], text[:-q] == text[q:], [False]])
        starts, ends = np.flatnonzero(np.diff(same.astype(int))).reshape(-1, 2).T
        for i, j in zip(starts.tolist(), ends.tolist()):
            if j - i + q >= max(least, exponent * q):
                found.setdefault((i, j + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def edited(doc_id, text):
    got, h = words(text), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(got), h // 10
    if h % 10 or not n:
        return got
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [got[i] if i < a else got[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    got = edited(doc_id, text)
    runs = sorted(plain_runs(got), key=lambda r: (r[0], r[2]))
    gone = {i for s, l, q in runs for i in range(s + q, s + l)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id,
        len(runs),
        *(best or (None,) * 3),
        1000 * best[1] // best[2] if best else None,
        digest("".join(f"{s},{l},{q}\n" for s, l, q in runs)),
        digest(" ".join(w for i, w in enumerate(got) if i not in gone)),
    )


def made(rng):
    """Texts over few words, with powers planted in them."""
    letters = "abcdefgh"[: rng.choice([1, 2, 2, 3, 8])]
    out = []
    while len(out) < rng.randrange(1, 120):
        piece = [rng.choice(letters) for _ in range(rng.randrange(1, 7))]
        out += piece * rng.choice([1, 1, 2, 4, 5, 9])
    return out[: rng.randrange(0, len(out) + 1)]


@pytest.mark.parametrize("least, exponent", [(6, 4), (3, 3), (9, 5)])
def test_same_runs_as_a_search_over_all_periods(least, exponent):
    rng = random.Random(least)
    texts = [made(rng) for _ in range(400)]
    got = runs_of([[w.encode() for w in t] for t in texts], least, exponent)
    for text, runs in zip(texts, got):
        want = sorted(plain_runs(text, least, exponent), key=lambda r: (r[0], r[2]))
        assert runs == want, text


def test_long_text_of_one_word_and_positions_in_blocks():
    assert runs_of([[b"a"] * 30_000, [b"a", b"b"] * 4]) == [[(0, 30_000, 1)], [(0, 8, 2)]]
    rng = random.Random(1)
    held = Positions(0)
    values = rng.sample(range(1, 50_000), 9_000)
    for v in values:
        held.add(v)
    values = sorted([0, *values])
    assert len(held.blocks) > 2 and list(held) == values
    for v in rng.sample(range(50_000), 300):
        assert held.first_from(v) == min((x for x in values if x >= v), default=None)
        assert held.last_until(v) == max((x for x in values if x <= v), default=None)


def test_whole_table_like_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = sorted(tuple(r) for r in op13_periodic_runs(spark, SF).collect())
    assert got == sorted(expected(d["doc_id"], d["text"]) for d in docs)
    assert sum(r[1] > 0 for r in got) > 5


def test_odd_rows_clashing_names_and_small_slices(spark, tmp_path, monkeypatch):
    rows = odd_rows() + [(i, "x y " * i + "z", "en", "a", 1) for i in range(30, 60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in op13_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(map(str, got)) == sorted(str(expected(r[0], r[1])) for r in rows)
    monkeypatch.setattr(periodic_runs, "SLICE_WORDS", 3)
    odd = docs.selectExpr("*", "1 AS periodic", "2 AS w", "3 AS n", "4 AS best", "5 AS runs")
    out = with_runs(odd)
    assert out.columns == [c for c in odd.columns if c != "periodic"] + ["periodic"]
    assert out.filter("doc_id = 30").first()["periodic"]["runs"][0].asDict() == {
        "start": 0, "length": 60, "period": 2
    }
    assert with_runs(docs.limit(0)).count() == 0


def test_refuses_parameters_below_its_bound(spark):
    with pytest.raises(ValueError):
        with_runs(spark.createDataFrame([("a",)], "text string"), min_exponent=2)
