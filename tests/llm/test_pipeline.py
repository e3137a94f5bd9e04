import os
import sys

sys.path.insert(0, os.path.dirname(__file__))
from brute import SCHEMA, least_reachable, odd_rows, simhash, words  # noqa: E402
from test_dedup import kept_lines  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

import corpus_pipeline  # noqa: E402
from riskloom.llm import decontaminate, quality  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark):
    """Each stage on what the one before kept; the model's verdicts are taken from its operator."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rejected = {r.doc_id for r in quality.op4_quality(spark, SF).filter("rejected").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in rejected]
    rows = kept_lines(rows)
    group = least_reachable({d: simhash(t) for d, t in rows})
    rows = [(d, t) for d, t in rows if group[d] == d]
    items = [dict.fromkeys(decontaminate.windows_of(decontaminate.words_of(r.text.encode())))
             for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {w for i in items for w in i}
    sizes = {len(w) for w in windows}

    def clean(text):
        found = decontaminate.words_of(text.encode())
        return not any(
            tuple(found[i : i + n]) in windows for n in sizes for i in range(len(found) - n + 1)
        )

    rows = [(d, t) for d, t in rows if clean(t)]
    total = sum(len(words(t)) for _, t in rows)
    texts = dict(rows)

    stage = docs
    for name, run in corpus_pipeline.STAGES[:-1]:
        stage = run(spark, stage, SF)
        assert stage.columns == docs.columns, name
    assert {r.doc_id: r.text for r in stage.collect()} == texts
    mixed = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in mixed} <= set(texts)
    assert all(texts[r.doc_id] == r.text and r.n_chars == len(r.text) for r in mixed)
    assert abs(sum(r.words for r in mixed) - 1.5 * total) < 20
    assert [r.position for r in mixed] == sorted(r.position for r in mixed)


def test_awkward_documents(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    names = ["_id", "_hash", "_source", "_pass", "_drops", "_lang"]
    df = df.withColumns({c: F.lit(i) for i, c in enumerate(names)})
    for docs in (df, df.limit(0)):
        for _, run in corpus_pipeline.STAGES:
            docs = run(spark, docs, SF)
        rows = docs.collect()
        assert len(rows) == len({(r.doc_id, r.position) for r in rows})
        assert all([r[c] for c in names] == list(range(len(names))) for r in rows)
