import math
import os
import sys

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from brute import SCHEMA, odd_rows  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from riskloom.llm import toxicity as tx  # noqa: E402


def test_gradient_is_that_of_the_noisy_or():
    weights = np.array([0.7, -0.3, 1.1, -2.0])
    bags = [[[0], [1, 2]], [], [[2]], [[0, 1]]]
    toxic, bare = [True, False, False, True], [2, 3, 0, 0]

    def loss(w):
        total = 0.0
        for t, n, sentences in zip(toxic, bare, bags):
            none = (1 - 1 / (1 + math.exp(-w[-1]))) ** n
            for s in sentences:
                none *= 1 - 1 / (1 + math.exp(-(w[-1] + sum(w[i] for i in s))))
            total -= math.log(1 - none if t else none)
        return total

    batch = pa.RecordBatch.from_arrays(
        [pa.array(toxic), pa.array(bare, pa.int64()), pa.array(bags, pa.list_(pa.list_(pa.int32())))],
        names=["toxic", "bare", "bags"],
    )
    gradient, value = tx._gradient(batch, weights)
    assert math.isclose(value, loss(weights), rel_tol=1e-9)
    for i in range(4):
        step = np.zeros(4)
        step[i] = 1e-6
        slope = (loss(weights + step) - loss(weights - step)) / 2e-6
        assert math.isclose(gradient[i], slope, rel_tol=1e-5, abs_tol=1e-7)


@pytest.mark.parametrize("sf,least", [("sf0.1", 0.85)])
def test_held_out_documents(spark, sf, least):
    labels = spark.read.parquet(f"/root/testdata/{sf}/labels.parquet")
    rows = tx.op2_toxicity(spark, f"/root/testdata/{sf}").join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out and r.quality == 1]
    good = sum(r.predicted and r.toxic for r in held)
    assert good >= least * sum(r.toxic for r in held)
    assert sum(r.predicted and not r.toxic for r in held) <= 0.02 * len(held)


def test_offending_sentences_and_awkward_rows(spark):
    clean = ["the day was fine", "we saw a house", "it rained. all stayed in", "a red door"]
    rows = [(i, f"{clean[i % 4]} number {i}. More of it here", i % 2) for i in range(60)]
    rows = [(i, t + ("! You vile fool. Go on" if y else ""), y) for i, t, y in rows]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(99, 1), (1, 1), (None, 0)],
                                   "doc_id long, toxic int")
    model = tx.train(docs, labels)
    odd = spark.createDataFrame([*odd_rows(), (77, "All fine.\nYou vile fool. 🙂 The end", None, None, 1)], SCHEMA)
    found = {r.doc_id: r for r in tx.scored(odd.withColumn("toxicity", F.lit(1)), model).collect()}
    spans = found[77].toxicity["sentences"]
    assert [found[77].text[s["start"] : s["end"]].strip() for s in spans] == ["You vile fool"]
    assert found[77].toxicity["score"] > 0.5 > found[6].toxicity["score"]
    assert found[3].toxicity["score"] == found[4].toxicity["score"] == 0
    for kept in (labels.limit(0), labels.filter("toxic = 0")):
        none = tx.train(docs, kept)
        assert tx.scored(odd, none).filter("toxicity.score >= 0.5").count() == 0
    assert tx.scored(odd.limit(0), model).count() == 0
