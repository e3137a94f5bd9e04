"""Toxicity by multiple-instance learning: sentence scores, a noisy-or, document labels.

A document is toxic if any sentence is: with sentence probabilities p, its score is
1 - prod(1 - p). Only documents carry labels, so the gradient of the document's loss is passed to
its sentences through the noisy-or, and sentences that explain the label take it up. A sentence's
probability is a logistic function of the selected features it holds: whole words and their first
letters, so that unseen forms of a word count too.

Training uses at most ``SAMPLE`` labelled rows, by hash of the id; their features are counted, and
the gradient summed, by Spark. The driver holds the selected weights only.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import annotated, remainder, slices
from riskloom.session import write_out

HELD_OUT = 5
SAMPLE = 40_000
FEATURES = 4096
LEAST_DOCUMENTS = 3
LEAST_GAIN = 10.0  # log-likelihood that a feature must explain, against chance finds
STEPS = 40
STARTS = (3, 4, 5)
CACHED = 300_000
_SENTENCE, _ENDS = re.compile(r"[^.!?\n]+"), re.compile(r"[.!?\n]+")
_EDGES = ".,;:!?()[]{}\"'*#-_/\\|<>&%$"
RESULT = (
    T.StructType()
    .add("score", T.DoubleType())
    .add(
        "sentences",
        T.ArrayType(
            T.StructType()
            .add("start", T.IntegerType())
            .add("end", T.IntegerType())
            .add("score", T.DoubleType())
        ),
    )
)


def word_features(word: str) -> list[int]:
    """Hashes of a word, without case and outer marks, and of its first letters."""
    word = word.lower().strip(_EDGES)
    forms = [word] if word else []
    forms += [f"{word[:n]}~" for n in STARTS if len(word) > n]
    return [xxhash.xxh3_64_intdigest(f) >> 1 for f in forms]


def _features_of(text: str | None) -> set[int]:
    return {f for w in set((text or "").split()) for f in word_features(w)}


class _Selected:
    """Places of the selected features of words; words without any are remembered as such."""

    def __init__(self, places: dict[int, int]):
        self.places, self.held, self.blank = places, {}, set()

    def __call__(self, words: set[str]) -> dict[str, tuple[int, ...]]:
        """The words that have selected features, and these."""
        out = {}
        for word in words - self.blank:
            found = self.held.get(word)
            if found is None:
                found = tuple(self.places[f] for f in word_features(word) if f in self.places)
                if found:
                    self.held[word] = found
                else:
                    self.blank.add(word)
            if found:
                out[word] = found
        if len(self.blank) > CACHED or len(self.held) > CACHED:
            self.blank.clear()
            self.held.clear()
        return out

    def sentences(self, text: str | None):
        """Number of sentences; start, end and features of those that hold any."""
        text = text or ""
        whole = text.replace(".", " ").replace("!", " ").replace("?", " ")
        words = self(set(whole.split()))
        if not words:
            return sum(map(bool, map(str.strip, _ENDS.split(text)))), []
        n, out = 0, []
        for m in _SENTENCE.finditer(text):
            own = m[0].split()
            n += bool(own)
            own = words.keys() & own
            if own:
                out.append((m.start(), m.end(), sorted({i for w in own for i in words[w]})))
        return n, out


def _counted(rows: DataFrame, only=None) -> DataFrame:
    """Documents that hold each feature, toxic or not; ``only`` limits to a set of features."""

    def stage(batches):
        for batch in slices(batches, 512):
            sums: dict[int, int] = {}
            for text in batch.column(0):
                held = _features_of(text.as_py())
                for f in held if only is None else held & only.value:
                    sums[f] = sums.get(f, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.int64())],
                names=["feature", "n"],
            )

    counted = rows.select("text").mapInArrow(stage, "feature long, n long")
    return counted.groupBy("feature").agg(F.sum("n").alias("n"))


def _gain(a, n_a, b, n_b) -> np.ndarray:
    """Log-likelihood ratio of a feature in a of n_a toxic and b of n_b other documents."""

    def part(x, total, share):
        with np.errstate(divide="ignore", invalid="ignore"):
            yes = np.where(x > 0, x * np.log(x / (total * share)), 0)
            no = np.where(total > x, (total - x) * np.log((total - x) / (total * (1 - share))), 0)
        return yes + no

    share = np.clip((a + b) / (n_a + n_b), 1e-12, 1 - 1e-12)
    return part(a, n_a, share) + part(b, n_b, share)


@dataclass
class Model:
    features: dict[int, int]
    weights: np.ndarray  # the last one is the bias


def train(
    documents: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    features: int = FEATURES,
    steps: int = STEPS,
) -> Model:
    """A model of documents (doc_id, text) with ``labels`` (doc_id, toxic).

    Rows without a toxic label are left out. Of repeated labels the largest counts. Without both
    kinds of label, every score is the share of toxic ones, at least 0 for none.
    """
    spark = documents.sparkSession
    known = (
        labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("_toxic"))
        .orderBy(F.xxhash64("doc_id"))
        .limit(sample)  # the documented bound of the labelled sample, so fit to broadcast
    )
    rows = write_out(
        documents.select("doc_id", "text")
        .join(F.broadcast(write_out(known)), "doc_id")
        .select("text", (F.col("_toxic") >= 1).alias("toxic"))
    )
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_toxic, n_other = n.get(True, 0), n.get(False, 0)
    if not n_toxic or not n_other:
        share = n_toxic / max(n_toxic + n_other, 1)
        return Model({}, np.array([_logit(min(max(share, 1e-6), 1 - 1e-6))]))
    toxic = write_out(_counted(rows.filter("toxic")).filter(F.col("n") >= LEAST_DOCUMENTS))
    # Bounded by the sample: features that some documents of the sample share.
    marked = toxic.toArrow()
    keys, a = marked["feature"].to_numpy(), marked["n"].to_numpy().astype(float)
    only = spark.sparkContext.broadcast(set(keys.tolist()))
    others = _counted(rows.filter("NOT toxic"), only).toArrow()
    b_of = dict(zip(others["feature"].to_pylist(), others["n"].to_pylist()))
    b = np.array([b_of.get(k, 0) for k in keys.tolist()], float)
    gain = _gain(a, n_toxic, b, n_other) * np.sign(a / n_toxic - b / n_other)
    best = np.argsort(-gain, kind="stable")[:features]
    best = best[gain[best] >= LEAST_GAIN]
    places = {int(keys[i]): at for at, i in enumerate(best)}
    odds = np.log((a[best] + 0.5) / (n_toxic + 1)) - np.log((b[best] + 0.5) / (n_other + 1))
    weights = np.append(np.clip(odds - 3, 0, 4), -5.0)
    return Model(places, _fitted(_bags(rows, places), weights, steps))


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def _bags(rows: DataFrame, places: dict[int, int]) -> DataFrame:
    """Per document its label, its sentences without features, and the features of the others."""
    held = rows.sparkSession.sparkContext.broadcast(places)

    def stage(batches):
        pick = _Selected(held.value)
        for batch in slices(batches, 2048):
            bare, bags = [], []
            for text in batch.column(0).to_pylist():
                n, found = pick.sentences(text)
                bare.append(n - len(found))
                bags.append([f for _, _, f in found])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    pa.array(bare, pa.int64()),
                    pa.array(bags, pa.list_(pa.list_(pa.int32()))),
                ],
                names=["toxic", "bare", "bags"],
            )

    made = rows.select("text", "toxic").mapInArrow(
        stage, "toxic boolean, bare long, bags array<array<int>>"
    )
    return write_out(made)


def _gradient(batch: pa.RecordBatch, weights: np.ndarray) -> tuple[np.ndarray, float]:
    """Sum of the loss's gradient over the documents of a batch, and the loss."""
    toxic = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
    bare = batch.column(1).to_numpy()
    sentences = batch.column(2)
    per_doc = np.diff(sentences.offsets.to_numpy())
    flat = sentences.flatten()
    per_sentence = np.diff(flat.offsets.to_numpy())
    index = flat.flatten().to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(toxic)), per_doc)
    sentence = np.repeat(np.arange(len(doc)), per_sentence)
    bias = weights[-1]
    z = bias + np.bincount(sentence, weights[index], len(doc))
    p, p0 = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-bias))
    none = -np.bincount(doc, np.logaddexp(0, z), len(toxic)) - bare * np.logaddexp(0, bias)
    any_ = np.maximum(-np.expm1(none), 1e-12)
    pull = np.where(toxic, -np.exp(none) / any_, 1.0)
    each = pull[doc] * p
    gradient = np.bincount(index, each[sentence], len(weights))
    gradient[-1] = each.sum() + (pull * bare * p0).sum()
    return gradient, float(-np.where(toxic, np.log(any_), none).sum())


def _fitted(bags: DataFrame, weights: np.ndarray, steps: int) -> np.ndarray:
    """Adam on the full gradient, which Spark sums; a little shrinkage."""
    spark = bags.sparkSession
    n = bags.count()
    mean, spread = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        sent = spark.sparkContext.broadcast(weights)

        def stage(batches, sent=sent):
            total, loss = np.zeros(len(sent.value)), 0.0
            for batch in batches:
                gradient, part = _gradient(batch, sent.value)
                total, loss = total + gradient, loss + part
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(total[at])], names=["place", "g"]
            )

        sums = bags.mapInArrow(stage, "place long, g double").groupBy("place")
        gradient = np.zeros_like(weights)
        for r in sums.agg(F.sum("g").alias("g")).collect():
            gradient[r["place"]] = r["g"]
        gradient = gradient / n
        gradient[:-1] += 1e-6 * weights[:-1]
        mean = 0.9 * mean + 0.1 * gradient
        spread = 0.99 * spread + 0.01 * gradient**2
        move = mean / (1 - 0.9**step) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-9)
        weights = weights - 0.25 * move
        sent.unpersist()
    return weights


def scored(
    documents: DataFrame, model: Model, text: str = "text", into: str = "toxicity"
) -> DataFrame:
    """``documents`` with a struct ``into``: the score, and the sentences that offend.

    ``sentences`` holds start, end (code points) and score of sentences of at least 0.5. Null and
    empty texts score 0. Repeated rows stay, equal texts have equal scores, and an empty table stays
    empty. Other columns pass through; one named ``into`` is replaced.
    """
    held = documents.sparkSession.sparkContext.broadcast((model.features, model.weights))
    made: list[_Selected] = []

    def rows(columns: list[pa.Array]) -> pa.Array:
        if not made:
            made.append(_Selected(held.value[0]))
        weights, scores, offending = held.value[1], [], []
        base = math.log1p(math.exp(weights[-1]))
        for value in columns[0].to_pylist():
            n, found = made[0].sentences(value)
            none, bad = (n - len(found)) * base, []
            for start, end, at in found:
                z = float(weights[-1] + weights[at].sum())
                none += math.log1p(math.exp(z)) if z < 30 else z
                if z >= 0:
                    bad.append({"start": start, "end": end, "score": 1 / (1 + math.exp(-z))})
            scores.append(-math.expm1(-none))
            offending.append(bad)
        return pa.StructArray.from_arrays(
            [
                pa.array(scores, pa.float64()),
                pa.array(
                    offending,
                    pa.list_(
                        pa.struct(
                            [("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]
                        )
                    ),
                ),
            ],
            names=["score", "sentences"],
        )

    return annotated(documents, [text], into, RESULT, rows)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """All documents, scored by a model of four fifths of the labelled ones."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    held_out = remainder("doc_id", HELD_OUT) == 0
    model = train(documents.filter(~held_out), labels.filter(~held_out))
    return scored(documents.withColumn("held_out", held_out), model).select(
        "doc_id",
        "held_out",
        "toxicity.score",
        (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"),
        F.transform("toxicity.sentences", lambda s: F.array(s["start"], s["end"])).alias(
            "offending"
        ),
    )
