import math
import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
from brute import SCHEMA, odd_rows  # noqa: E402

from riskloom.llm import quality  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_junk_is_rejected_and_good_text_stays(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = (
        quality.op4_quality(spark, SF)
        .join(labels, "doc_id")
        .withColumn("back", quality.remainder("doc_id", quality.KEPT_BACK) == 0)
        .collect()
    )
    good = [r.rejected for r in rows if r.quality == 1]
    junk = [r.rejected for r in rows if r.quality == 0]
    assert sum(good) <= 0.03 * len(good)
    assert sum(junk) >= 0.6 * len(junk)
    every = quality.op4_quality(spark, SF).collect()
    assert len(every) == docs.count()
    # Thresholds and verdicts by the rule itself, from perplexities of kept-back good documents.
    kept_back = {}
    for i in {r.doc_id for r in rows if r.quality == 1 and r.back}:
        kept_back.setdefault(next(r.lang for r in rows if r.doc_id == i), []).extend(
            r.perplexity for r in every if r.doc_id == i and r.perplexity is not None
        )
    assert kept_back
    for r in every:
        if drawn := sorted(kept_back.get(r.lang, [])):
            limit = quality.MARGIN * drawn[math.ceil(quality.QUANTILE * len(drawn)) - 1]
            assert math.isclose(r.threshold, limit, rel_tol=1e-9)
        assert r.rejected == (r.perplexity is not None and r.perplexity > r.threshold)


def test_awkward_rows_and_empty_tables(spark):
    odd = spark.createDataFrame(odd_rows(), SCHEMA).withColumn("mean", F.lit(1))
    labels = spark.createDataFrame(
        [(1, 1, 0), (5, 1, 0), (6, 1, 0), (8, 1, 0), (8, 1, 1), (99, 1, 0), (9, None, None)],
        "doc_id long, quality int, toxic int",
    )
    rows = quality.rated(odd, labels).collect()
    assert len(rows) == len(odd_rows())
    assert all(r.quality["perplexity"] is None for r in rows if not r.text)
    assert not any(r.quality["rejected"] for r in rows if not r.text)
    clash = odd.withColumns({"_lang": F.lit(1), "_LM": F.lit(2), "_quality": F.lit(3)})
    rows = quality.rated(clash, labels).select("_lang", "_LM", "_quality").distinct().collect()
    assert [tuple(r) for r in rows] == [(1, 2, 3)]
    kept = quality.without_rejected(odd, labels.limit(0))
    assert kept.columns == odd.columns and kept.count() == len(odd_rows())
    assert quality.without_rejected(odd.limit(0), labels).count() == 0


def test_all_trusted_documents_are_trained_on(spark, monkeypatch):
    class Trained(Exception):
        pass

    def counted(texts, **_):
        raise Trained(texts.count())

    monkeypatch.setattr(quality, "train", counted)
    docs = spark.range(70_000).select(F.col("id").alias("doc_id"), F.lit("a").alias("text"), F.lit("en").alias("lang"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    want = labels.filter(quality.remainder("doc_id", quality.KEPT_BACK) != 0).count()
    for listed in (quality.LISTED_IDS, 1_000):
        monkeypatch.setattr(quality, "LISTED_IDS", listed)
        with pytest.raises(Trained) as found:
            quality.rated(docs, labels)
        assert found.value.args[0] == want > 50_000
