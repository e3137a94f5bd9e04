"""Quality by perplexity: documents unlike trusted text, for their language, are rejected.

A character n-gram model (interpolated modified Kneser-Ney) is trained on all documents labelled as
good but a fifth, which sets thresholds instead. While the list of their ids is small it goes to the
texts, which then need no shuffle. Counts live in shards by n-gram; the distinct
n-grams of a batch of documents are joined to the shards that hold them, and a document's perplexity
is summed from its own. A language's threshold is a high quantile of the perplexities of its
kept-back good documents, times a margin for what the few of them cannot show. A document's
perplexity is drawn towards the mean of its language by the weight of a few symbols, so that a
handful of characters is not judged by chance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import free_names, remainder
from riskloom.llm.kneser_ney import train
from riskloom.llm.lm_score import scored
from riskloom.operators.joins import attach
from riskloom.session import write_out

ORDER = 4
KEPT_BACK = 5
LISTED_IDS = 1_500_000  # ids that go to the texts; beyond that both are shuffled
QUANTILE = 0.995
PRIOR = 60
MARGIN = 1.1


def rated(
    documents: DataFrame,
    labels: DataFrame,
    order: int = ORDER,
    quantile: float = QUANTILE,
    prior: float = PRIOR,
    margin: float = MARGIN,
    into: str = "quality",
) -> DataFrame:
    """``documents`` (doc_id, text, lang) with a struct ``into``: perplexity, threshold, rejected.

    ``labels`` has ``doc_id`` and ``quality``; 1 is trusted. Every fifth trusted document, by
    crc32 of its id, sets thresholds and is not trained on. Languages without such documents use
    the quantile over all of them. A null language is a language of its own. Texts without a
    character are not rejected, nor is anything where no trusted document is kept back. Labels of
    unknown documents are ignored, and repeated labels count once. Repeated rows are documents like
    any other; an empty table stays empty. Other columns pass through, whatever their names; one
    named ``into`` is replaced.
    """
    base = documents.drop(into)
    good = write_out(labels.filter("quality = 1").select("doc_id").distinct())
    kept_back = remainder("doc_id", KEPT_BACK) == 0
    texts = base.select("doc_id", "text", "lang")

    def of(ids: DataFrame, rows: DataFrame) -> DataFrame:
        return attach(rows, ids, ["doc_id"], "left_semi", max_rows=LISTED_IDS, settled=True)

    trusted = of(good.filter(~kept_back), texts.filter(~kept_back))
    model = train(write_out(trusted.select("text")), symbols="chars", order=order)
    checks = of(good.filter(kept_back), texts.filter(kept_back))
    # Sums of the kept-back trusted documents give each language its mean, then its quantile.
    checked = write_out(
        scored(checks, model, into="_lm")
        .select(
            F.coalesce("lang", F.lit("")).alias("_lang"),
            F.col("_lm.score").alias("score"),
            F.col("_lm.n_tokens").alias("n"),
        )
        .filter("n > 1")
    )
    means = checked.groupBy("_lang").agg((-F.sum("score") / F.sum("n")).alias("mean"))
    overall = checked.agg((-F.sum("score") / F.sum("n")).alias("mean")).first()["mean"]

    def drawn(score, n, mean):
        return F.pow(F.lit(10.0), (-score + prior * mean) / (n + prior))

    ppl = checked.join(means, "_lang").select(
        "_lang", "mean", drawn(F.col("score"), F.col("n"), F.col("mean")).alias("ppl")
    )
    limits = ppl.groupBy("_lang").agg(
        F.first("mean").alias("mean"),
        (margin * F.percentile_approx("ppl", quantile, 100_000)).alias("limit"),
    )
    every = ppl.agg(margin * F.percentile_approx("ppl", quantile, 100_000)).first()[0]
    lm, lang, own_lang = free_names(base, "_lm", "_lang", "_of_lang")
    made = scored(base, model, into=lm).withColumn(lang, F.coalesce("lang", F.lit("")))
    limits = limits.select(F.col("_lang").alias(lang), F.struct("mean", "limit").alias(own_lang))
    joined = made.join(limits, lang, "left")
    mean = F.coalesce(f"{own_lang}.mean", F.lit(overall).cast("double"))
    limit = F.coalesce(f"{own_lang}.limit", F.lit(every).cast("double"))
    own = drawn(F.col(f"{lm}.score"), F.col(f"{lm}.n_tokens"), mean)
    empty = F.col(f"{lm}.n_tokens") <= 1
    return joined.select(
        *base.columns,
        F.struct(
            F.when(~empty, own).alias("perplexity"),
            limit.alias("threshold"),
            F.coalesce(~empty & (own > limit), F.lit(False)).alias("rejected"),
        ).alias(into),
    )


def without_rejected(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with their own columns."""
    into = free_names(documents, "_quality")[0]
    made = rated(documents, labels, into=into)
    return made.filter(~F.col(f"{into}.rejected")).select(*documents.columns)


def op4_quality(spark, sf_dir: str) -> DataFrame:
    """Per document: perplexity under trusted text, its language's threshold, and the verdict."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return rated(documents, labels).select(
        "doc_id", "lang", "quality.perplexity", "quality.threshold", "quality.rejected"
    )
