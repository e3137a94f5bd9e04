"""Log-probabilities of documents under an n-gram model trained on the corpus."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import annotated, remainder, utf8
from riskloom.llm.kneser_ney import Model, scorer, train

HELD_OUT = 10
RESULT = (
    T.StructType()
    .add("n_tokens", T.LongType())
    .add("n_known", T.LongType())
    .add("score", T.DoubleType())
    .add("base_score", T.DoubleType())
)


def scored(documents: DataFrame, model: Model, text: str = "text", into: str = "lm") -> DataFrame:
    """``documents`` with a struct ``into`` of tokens, known tokens and log10 probabilities.

    ``score`` is the model's, ``base_score`` that of additively smoothed unigrams. Null and empty
    texts are one end symbol. Repeated rows stay, equal texts have equal scores, and an empty table
    stays empty. Other columns pass through; one named ``into`` is replaced.
    """

    def rows(columns: list[pa.Array]) -> pa.Array:
        found = scorer(model).score(utf8(columns[0]))
        return pa.StructArray.from_arrays(
            [pa.array(found[f.name]) for f in RESULT.fields], names=[f.name for f in RESULT.fields]
        )

    return annotated(documents, [text], into, RESULT, rows)


def op9_lm_score(spark, sf_dir: str) -> DataFrame:
    """All documents under a bigram model of nine tenths of them."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held_out = remainder("doc_id", HELD_OUT) == 0
    model = train(documents.filter(~held_out), symbols="words", order=2)
    return scored(documents.withColumn("held_out", held_out), model).select(
        "doc_id",
        "held_out",
        "lm.n_tokens",
        "lm.n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "lm.base_score",
        "lm.score",
    )
