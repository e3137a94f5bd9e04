"""The source audit against plain Python: whole rows, all ranks, small shards and blocks."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from brute import SCHEMA, lower, odd_rows

from riskloom.llm import source_audit
from riskloom.llm.source_audit import audited, shard_counts


def terms_of(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text or ""))


def plain(rows, least):
    """Dense counts of every group, term by term."""
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        found = terms_of(text)
        docs[lang or ""].update(set(found))
        counts[lang or "", source or ""].update(found)
    out = []
    for lang in docs:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        groups = sorted(s for g, s in counts if g == lang)
        total = {s: sum(counts[lang, s][t] for t in kept) for s in groups}
        whole = {t: sum(counts[lang, s][t] for s in groups) for t in kept}
        share = lambda n, of: 1 + 10**9 * (n + 2) // (of + 2 * len(kept))  # noqa: B023, E731
        f = lambda p, q: (p - q) ** 2 // (p + q)
        p = {s: {t: share(counts[lang, s][t], total[s]) for t in kept} for s in groups}
        q = {t: share(whole[t], sum(whole.values())) for t in kept}
        for s in groups:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in groups if o != s]
            above = [
                (-f(p[s][t], q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]
            ]
            for part, found in (("pair", pairs), ("term", above)):
                found.sort(key=lambda x: (x[0], x[1].encode()))
                for rank, (value, item) in enumerate(found, 1):
                    if part == "pair" or rank <= 10:
                        out.append((lang, s, part, item, -value, rank))
    return sorted(out)


def many_sources():
    """Sources with their own words, one language without frequent words, and odd rows."""
    rng = np.random.default_rng(3)
    rows = odd_rows()
    for i in range(240):
        own = [f"wort{rng.zipf(1.6) % 50}ähnlichlanges" for _ in range(20)]
        own += [f"Common{rng.zipf(1.4) % 40}." for _ in range(30)] + ["A-b_c\x00d'É"]
        rows.append((100 + i, " ".join(own), "de", f"s{rng.integers(7)}", 1))
    return rows + [(900, "seldom words", "xx", "b", 1), (901, "", "xx", "a", 1)]


@pytest.mark.parametrize("least", [3, 10])
def test_like_plain_python(spark, least):
    rows = many_sources()
    got = audited(spark.createDataFrame(rows, SCHEMA), min_docs=least).collect()
    assert sorted(map(tuple, got)) == plain(rows, least)


def test_small_shards_slices_and_blocks_of_sources(spark, monkeypatch):
    rows = many_sources()
    for name, value in (
        ("SHARD_BYTES", 2_000), ("SMALL", 4), ("SOURCES", 3), ("BLOCK_ROWS", 40), ("CHUNK_CELLS", 30)
    ):
        monkeypatch.setattr(source_audit, name, value)
    odd = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS term", "2 AS n", "3 AS idx")
    assert sorted(map(tuple, audited(odd).collect())) == plain(rows, 10)


def test_shard_counts_over_sliced_buffers():
    texts = ["skipped", "ab AB abcdefgh abcdefghi", "ab", "", "abcdefghi\x7fabcdefgh ab" * 3]
    groups, words, n, docs = shard_counts(pa.array(texts)[1:], np.array([0, 1, 0, 1]))
    want = defaultdict(lambda: [0, 0])
    for group, text in zip([0, 1, 0, 1], texts[1:]):
        for term, times in Counter(terms_of(text)).items():
            want[group, term][0] += times
            want[group, term][1] += 1
    got = zip(groups.tolist(), words.to_pylist(), n.tolist(), docs.tolist())
    assert {(g, w): [a, b] for g, w, a, b in got} == dict(want)


def test_empty_table(spark):
    assert audited(spark.createDataFrame([], SCHEMA)).count() == 0
