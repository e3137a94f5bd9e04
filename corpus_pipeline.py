"""A corpus made ready for training: five stages, each on what the one before it kept.

Stages take ``(spark, docs, sf_dir)`` and return a DataFrame that is written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of ``documents``:

1. the quality classifier rejects documents unlike trusted text of their language;
2. line dedup drops lines that a document with a smaller id holds too, and sets ``n_chars`` anew;
3. one document of each group of near copies (SimHash of three-word shingles, two bits) stays;
4. documents that hold a window of a benchmark item go;
5. mixing gives the training order, a row per pass that takes a document.

Null and empty texts pass the first stage as one text, and leave one document after the third, which
the last stage does not take, having no words. Repeated rows are near duplicates. Empty tables give
an empty result; other columns pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import curriculum, decontaminate, line_dedup, quality, simhash
from riskloom.session import write_out


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.without_rejected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.with_unique_lines(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.without_near_duplicates(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_contaminated(docs, benchmark)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return curriculum.mixed(docs)


STAGES = [
    ("quality", good_quality),
    ("line_dedup", unique_lines),
    ("near_dedup", without_copies),
    ("decontamination", uncontaminated),
    ("mixing", mix),
]

#: Perplexities and fingerprints have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = write_out(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
