"""Mixing sources to target weights along a curriculum that changes during training.

Each weight class has a schedule: its weight as a piecewise linear function of training progress
(0 to 1). The integral of the schedule is the source's share of the token budget. A source may be
repeated up to ``REPEATS`` times; what it cannot give is shared among the others by weight. A source
of target T that holds S words is read as one stream of its documents in hash order, over and over,
up to T words; the word at place c of the stream is due when the source's cumulative demand, the
integral of its schedule, reaches c. Inverting that integral gives each document its position, and
a range sort by position is the training order.

Only DataFrame functions: sums per source and running totals over documents are the only shuffles
and hold no texts. The hot source is laid out by range, so no task gets it whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import free_names
from riskloom.operators.ordered import running_totals
from riskloom.session import write_out

SHARE = 1.5
REPEATS = 2
#: Weight against progress per class; the integrals are the weights 5, 2 and 1.
SCHEDULES = (((0.0, 7.5), (1.0, 2.5)), ((0.0, 2.0), (1.0, 2.0)), ((0.0, 0.5), (1.0, 1.5)))

Schedule = Sequence[tuple[float, float]]


def words_in(text: str) -> Column:
    """Number of words; zero for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def integral(schedule: Schedule) -> float:
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:]))


def progress(share: Column, schedule: Schedule) -> Column:
    """The progress at which this share of the schedule's integral is reached."""
    need = share * F.lit(integral(schedule))
    done, out = 0.0, None
    pieces = []
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        slope = (w1 - w0) / (t1 - t0)
        rest = need - F.lit(done)
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * rest, F.lit(0.0)))
        below = F.lit(w0) + root
        at = F.when(below > 0, F.lit(t0) + F.lit(2.0) * rest / below).otherwise(F.lit(t0))
        done += (t1 - t0) * (w0 + w1) / 2
        pieces.append((F.lit(done), F.least(at, F.lit(t1))))
    for end, at in reversed(pieces):
        out = at if out is None else F.when(need <= end, at).otherwise(out)
    return out


def targets(
    sizes: DataFrame,
    schedules: Sequence[Schedule] = SCHEDULES,
    share: float = SHARE,
    repeats: int = REPEATS,
) -> DataFrame:
    """``source, source_size, class, target`` per source of ``sizes`` (source, size).

    Sources take the weight classes in code point order, null last. Sorted by the level at which
    they are full (``repeats * size / weight``), the full ones are those whose level the budget
    reaches; the others share what is left by weight.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = by_source.select(
        F.col("source").isNull().alias("none"),
        F.coalesce("source", F.lit("")).alias("name"),
        "source",
        "source_size",
        F.lit(1).cast("long").alias("one"),
    )
    ranked = running_totals(ordered, ["none", "name"], ["one"])
    kind = F.pmod("one_before", F.lit(len(schedules))).cast("int")
    weights = F.array(*[F.lit(integral(s)) for s in schedules])
    classed = ranked.withColumn("class", kind).withColumn(
        "weight", F.element_at(weights, F.col("class") + 1)
    )
    levels = classed.select(
        "none",
        "name",
        "source",
        "source_size",
        "class",
        "weight",
        (F.lit(repeats) * F.col("source_size")).alias("cap"),
        (F.lit(float(repeats)) * F.col("source_size") / F.col("weight")).alias("level"),
    )
    filled = running_totals(levels, ["level", "none", "name"], ["cap", "weight", "source_size"])
    budget = F.lit(share) * F.col("source_size_total")
    at_level = F.col("cap_before") + F.col("level") * (
        F.col("weight_total") - F.col("weight_before")
    )
    judged = write_out(
        filled.select(
            "source",
            F.col("source_size"),
            "class",
            "weight",
            "cap",
            budget.alias("budget"),
            (at_level <= budget).alias("full"),
        )
    )
    rest = judged.agg(
        F.max("budget").alias("budget"),
        F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))), F.lit(0)).alias("given"),
        F.sum(F.when(~F.col("full"), F.col("weight"))).alias("open"),
    ).first()
    level = (rest["budget"] - rest["given"]) / rest["open"] if rest["open"] else 0.0
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
        F.least(F.lit(float(level)) * F.col("weight"), F.col("cap").cast("double"))
    )
    return judged.select("source", "source_size", "class", target.alias("target"))


def curriculum(
    documents: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    schedules: Sequence[Schedule] = SCHEDULES,
    share: float = SHARE,
    repeats: int = REPEATS,
) -> DataFrame:
    """One row per document row with its part in the mix, sorted by first position.

    ``doc_id, source, size, text_hash``; ``source_size`` and ``target`` of its source; ``taken``:
    words the mix takes of it over all passes; ``passes``: an array of (position, words) of the
    passes that take it, empty if none does; ``position``: the first of them or null. The last
    document of a source's stream is taken only up to the target. Documents without words have no
    part. Null sources are one source; null ids and repeated rows are documents like any other.
    Other columns are ignored. An empty table stays empty.
    """
    sizes = write_out(
        documents.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            words_in(text).alias("size"),
            F.xxhash64(text).alias("text_hash"),
        )
    )
    goals = targets(sizes, schedules, share, repeats).select(
        F.coalesce("source", F.lit("")).alias("g_name"),
        F.col("source").isNull().alias("g_none"),
        "source_size",
        "class",
        "target",
        F.round("target").cast("long").alias("quota"),
    )
    mark = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    streams = running_totals(
        sizes.withColumn("place", mark),
        ["place", "doc_id", "size", "text_hash"],
        ["size"],
        ["source"],
    )
    joined = streams.join(
        goals,
        (F.coalesce("source", F.lit("")) == F.col("g_name"))
        & (F.col("source").isNull() == F.col("g_none")),
    )
    passes = F.array(
        *[
            F.struct(
                _due(
                    (F.col("source_size") * n + F.col("size_before"))
                    / F.nullif("quota", F.lit(0)),
                    schedules,
                ).alias("position"),
                F.greatest(
                    F.lit(0).cast("long"),
                    F.least("size", F.col("quota") - F.col("source_size") * n - F.col("size_before")),
                ).alias("words"),
            )
            for n in range(repeats)
        ]
    )
    made = joined.withColumn("passes", F.filter(passes, lambda p: p["words"] > 0))
    return made.select(
        "doc_id",
        "source",
        "size",
        "text_hash",
        "source_size",
        "target",
        F.aggregate(
            "passes", F.lit(0).cast("long"), lambda total, p: total + p["words"]
        ).alias("taken"),
        "passes",
        F.try_element_at("passes", F.lit(1))["position"].alias("position"),
    ).orderBy(F.asc_nulls_last("position"), "doc_id", "text_hash")


def _due(share: Column, schedules: Sequence[Schedule]) -> Column:
    share = F.least(share, F.lit(1.0))
    out = progress(share, schedules[-1])
    for kind, schedule in reversed(list(enumerate(schedules[:-1]))):
        out = F.when(F.col("class") == kind, progress(share, schedule)).otherwise(out)
    return out


def mixed(documents: DataFrame) -> DataFrame:
    """Documents in training order: a row per pass that takes one, with ``position, words``.

    ``words`` of the text, counted from its start, belong to the mix. Rows that agree in id, source
    and text have the same part in it. Columns named ``position`` or ``words`` are replaced, others
    pass through, whatever their names. An empty table stays empty.
    """
    base = documents.drop("position", "words")
    id_, source, none, hash_, one = free_names(
        base, "_id", "_source", "_none", "_text_hash", "_pass"
    )
    key = {
        id_: F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        source: F.coalesce("source", F.lit("")),
        none: F.col("source").isNull(),
    }
    plan = (
        curriculum(documents)
        .filter("taken > 0")
        .select("passes", F.col("text_hash").alias(hash_), *[c.alias(n) for n, c in key.items()])
        .groupBy(hash_, *key)
        .agg(F.max("passes").alias(one))
    )
    joined = base.withColumns({**key, hash_: F.xxhash64("text")}).join(plan, [hash_, *key])
    return (
        joined.select(*base.columns, F.explode(one).alias(one))
        .select(*base.columns, f"{one}.position", f"{one}.words")
        .orderBy("position", "doc_id")
    )


def op7_curriculum(spark, sf_dir: str) -> DataFrame:
    """Per document: its size, its source's size and target, words taken, and its positions."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return curriculum(documents).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "taken",
        F.round("position", 9).alias("position"),
    )


OP7_SQL = r"""
WITH sized AS (
  SELECT row_number() OVER () AS r, doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS o,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS kind
  FROM sized GROUP BY source
), levels AS (
  SELECT *, CASE kind WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM sources
), placed AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS budget,
    coalesce(sum(2 * source_size) OVER before, 0) AS given,
    sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS open
  FROM levels
  WINDOW before AS (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), judged AS (
  SELECT *, given + 2.0::DOUBLE * source_size / w * open <= budget AS is_full FROM placed
), goals AS (
  SELECT source, source_size, kind,
    CASE WHEN is_full THEN CAST(2 * source_size AS DOUBLE)
    ELSE (max(budget) OVER () - coalesce(sum(2 * source_size) FILTER (is_full) OVER (), 0))
      / sum(w) FILTER (NOT is_full) OVER () * w END AS target
  FROM judged
), streams AS (
  SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY o, doc_id, size, r
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS begun
  FROM sized
), due AS (
  SELECT doc_id, size, source_size, target, kind, begun,
    CAST(round(target) AS BIGINT) AS quota
  FROM streams JOIN goals ON streams.source IS NOT DISTINCT FROM goals.source
), mixed AS (
  SELECT *, greatest(0, least(size, quota - begun)) AS first_words,
    greatest(0, least(size, quota - source_size - begun)) AS second_words,
    least(CAST(begun AS DOUBLE) / nullif(quota, 0), 1.0::DOUBLE) AS part
  FROM due
)
SELECT doc_id, size, source_size, target, CAST(first_words + second_words AS BIGINT) AS taken,
  round(CASE WHEN first_words = 0 THEN NULL
    WHEN kind = 0 THEN 2 * 5 * part / (7.5 + sqrt(7.5 * 7.5 - 2 * 5 * 5 * part))
    WHEN kind = 1 THEN 2 * 2 * part / (2 + sqrt(2 * 2 + 2 * 0 * 2 * part))
    ELSE 2 * 1 * part / (0.5 + sqrt(0.5 * 0.5 + 2 * 1 * 1 * part)) END, 9) AS position
FROM mixed
"""
