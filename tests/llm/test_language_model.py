import math
import os
import resource
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from brute import SCHEMA, SF, lower, odd_rows, words  # noqa: E402

from riskloom.llm import kneser_ney as kn  # noqa: E402
from riskloom.llm import lm_score  # noqa: E402


class PlainModel:
    """Interpolated modified Kneser-Ney on dictionaries."""

    def __init__(self, texts, order):
        self.order = order
        grams = Counter()
        for t in texts:
            line = ["<s>"] * (order - 1) + t + ["</s>"]
            grams.update(tuple(line[i - order + 1 : i + 1]) for i in range(order - 1, len(line)))
        self.raw = Counter()
        for g, n in grams.items():
            self.raw[g[-1]] += n
        self.counts = {order: grams}
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.discounts, self.contexts = {}, {}
        for k, grams in self.counts.items():
            n = Counter(min(c, 5) for c in grams.values())
            y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
            self.discounts[k] = [0] + [
                min(max(i - (i + 1) * y * n[i + 1] / n[i], 0), i) if n[i] else i / 2
                for i in (1, 2, 3)
            ]
            self.contexts[k] = defaultdict(lambda: [0, 0.0])
            for g, c in grams.items():
                held = self.contexts[k][g[:-1]]
                held[0] += c
                held[1] += self.discounts[k][min(c, 3)]

    def p(self, gram):
        if not gram:
            return 1 / (len(self.counts[1]) + 1)
        k = len(gram)
        total, mass = self.contexts[k].get(gram[:-1], (0, 0))
        if not total:
            return self.p(gram[1:])
        c = self.counts[k].get(gram, 0)
        return max(c - self.discounts[k][min(c, 3)], 0) / total + mass / total * self.p(gram[1:])

    def score(self, text):
        line = ["<s>"] * (self.order - 1) + text + ["</s>"]
        return sum(
            math.log10(self.p(tuple(line[i - self.order + 1 : i + 1])))
            for i in range(self.order - 1, len(line))
        )


SPLIT = {"words": lambda t: words(lower(t or "")), "chars": lambda t: list(t or "")}


@pytest.mark.parametrize("symbols,order", [("words", 1), ("words", 2), ("words", 3), ("chars", 4)])
def test_scores_are_those_of_a_plain_model(spark, symbols, order):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 60").select("text")
    odd = spark.createDataFrame(odd_rows(), SCHEMA).filter("n_chars < 1000").select("text")
    texts = [r.text for r in docs.collect()]
    model = kn.train(docs, symbols=symbols, order=order, flush=3000)
    plain = PlainModel([SPLIT[symbols](t) for t in texts], order)
    both = docs.unionByName(odd).withColumn("lm", kn.F.lit(1))
    for row in lm_score.scored(both, model).collect():
        want = plain.score(SPLIT[symbols](row.text))
        assert math.isclose(row.lm["score"], want, rel_tol=1e-9), row.text[:50]
        assert row.lm["n_tokens"] == len(SPLIT[symbols](row.text)) + 1


def test_long_texts_are_scored_in_blocks(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 20").select("text")
    scorer = kn.Scorer(kn.train(docs, order=3))
    texts = [r.text.encode() for r in docs.collect()]
    whole = scorer.score(texts)
    monkeypatch.setattr(kn, "BLOCK", 97)
    parts = scorer.score(texts)
    assert all(np.allclose(whole[k], parts[k], rtol=1e-12) for k in whole)


def test_probabilities_sum_to_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 40").select("text")
    model = kn.train(docs, order=2)
    texts = [kn.word_symbols(r.text.encode()) for r in docs.collect()]
    vocabulary = np.unique(np.concatenate([*texts, [np.uint64(kn.END), np.uint64(12345)]]))
    assert len(vocabulary) == model.types + 1
    line, at, _ = kn._line([texts[0][:3]], 2)
    columns = kn._columns(line, at, 2)
    for context in columns[0]:
        p, _ = kn.Scorer(model).probabilities([np.full(len(vocabulary), context), vocabulary])
        assert math.isclose(p.sum(), 1, rel_tol=1e-9)


def test_scores_without_training_rows(spark):
    odd = spark.createDataFrame(odd_rows(), SCHEMA)
    model = kn.train(odd.limit(0))
    rows = lm_score.scored(odd, model).collect()
    assert len(rows) == len(odd_rows()) and all(r.lm["score"] == 0 for r in rows)
    assert lm_score.scored(odd.limit(0), model).count() == 0


def test_query_counts_and_base_scores(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    held = {d.doc_id: zlib.crc32(str(d.doc_id).encode()) % 10 == 0 for d in docs}
    counts = Counter()
    for d in docs:
        if not held[d.doc_id]:
            counts.update([*SPLIT["words"](d.text), None])
    total, types = sum(counts.values()), len(counts)
    text = {d.doc_id: [*SPLIT["words"](d.text), None] for d in docs}
    better = 0
    for r in lm_score.op9_lm_score(spark, SF).collect():
        tokens = text[r.doc_id]
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (types + 1))) for t in tokens)
        assert (r.held_out, r.train_tokens) == (held[r.doc_id], total)
        assert r.n_tokens == len(tokens) and r.n_known == sum(counts[t] > 0 for t in tokens)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        better += r.score > r.base_score
    assert better > 0.9 * len(docs)


def test_many_shards_under_a_small_limit_of_open_files(spark, monkeypatch):
    """Shards follow the text, open files do not; equal scores, whatever stays open."""
    rows = [(f"w{i % 700} v{i % 311} x{i}",) for i in range(3_000)]
    docs = spark.createDataFrame(rows, "text string")
    few = kn.train(docs, shard_symbols=1 << 20)
    many = kn.train(docs, shard_symbols=2)
    assert many.shards > 2_500 > few.shards
    texts = [f"w{i % 700} v{i % 311} y{i % 5} x{i}".encode() for i in range(2_000)]
    want = kn.Scorer(few).score(texts)
    soft, hard = resource.getrlimit(resource.RLIMIT_NOFILE)
    resource.setrlimit(resource.RLIMIT_NOFILE, (512, hard))
    try:
        scorer = kn.Scorer(many)
        got = scorer.score(texts)
    finally:
        resource.setrlimit(resource.RLIMIT_NOFILE, (soft, hard))
    assert len(scorer.open) <= kn.OPEN_SHARDS
    for name, values in want.items():
        assert np.allclose(got[name], values), name
    # As on a store that cannot be mapped: bytes that stay are bounded.
    monkeypatch.setattr(kn, "READ_BYTES", 5_000)
    reader = kn.Scorer(many)
    monkeypatch.setattr(reader.folder, "local", False)
    assert np.allclose(reader.score(texts)["score"], want["score"])
    assert reader.bytes <= 5_000 or len(reader.open) == 1


def test_a_missing_shard_is_an_error_and_the_folder_has_a_scheme(spark):
    model = kn.train(spark.createDataFrame([("a b a b c",)], "text string"))
    assert model.folder.startswith("file:///")
    assert kn._qualified(spark, "/shared/x") == "file:///shared/x"
    kn.Scorer(model).score([b"a b d"])
    folder = model.folder.removeprefix("file://")
    assert len(os.listdir(folder)) >= 2 * model.shards
    for name in os.listdir(folder):
        os.remove(f"{folder}/{name}")
    with pytest.raises(FileNotFoundError):
        kn.Scorer(model).score([b"a b d"])
