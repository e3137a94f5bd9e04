"""Queries for ranks, AUC, folds, encodings, neighbours and blends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import aggregates as A
from riskloom.functions import expressions as X
from riskloom.operators import aggregate as G
from riskloom.operators import blend as B
from riskloom.operators import clean as C
from riskloom.operators import encode as E
from riskloom.operators import folds
from riskloom.operators import models as M
from riskloom.operators.lsh import lsh_recall, lsh_target_mean
from riskloom.operators.neighbors import knn_target_mean, vector
from riskloom.operators.ordered import auc_by_column, rank_normalize, roc_auc
from riskloom.plans.registry import ORACLES, money, money_mean_sql, query, rounded, table
from riskloom.session import settle

SCORES = ["s1", "s2", "s3", "s4"]
# Static blend weights.
WEIGHTS = {"s1": 0.65, "s2": 0.0, "s3": 0.15, "s4": 0.20}


def _hash_sql(key: str, seed: int, digits: int = 8) -> str:
    return f"CAST(('0x' || substr(md5('{seed}:' || {key}), 1, {digits})) AS BIGINT)"


def _fold_sql(key: str, strata: str, k: int, seed: int = 42) -> str:
    return (
        f"CAST((row_number() OVER (PARTITION BY {strata} "
        f"ORDER BY {_hash_sql(key, seed, 12)}, {key}) - 1) % {k} AS INTEGER)"
    )


SCORED_SQL = f"""
  SELECT l.doc_id, l.quality AS y, {_fold_sql("l.doc_id", "l.quality", 5)} AS fold,
         nullif(d.lang, 'de') AS lang, d.source,
         n_chars / (n_chars + 2000.0) AS s1, (n_chars % 977) / 977.0 AS s2,
         {_hash_sql("l.doc_id", 7)} / 4294967296.0 AS s3,
         (length(text) - length(replace(text, ' ', ''))) / CAST(length(text) AS DOUBLE) AS s4
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id
"""


def _labelled(spark, sf) -> DataFrame:
    text = F.col("text")
    spaces = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    documents = table(spark, sf, "documents").select(
        "doc_id",
        F.nullif("lang", F.lit("de")).alias("lang"),
        "source",
        (F.col("n_chars") / (F.col("n_chars") + 2000.0)).alias("s1"),
        ((F.col("n_chars") % 977) / 977.0).alias("s2"),
        (X.hash_fraction(F.col("doc_id"), 7) / 4294967296.0).alias("s3"),
        (spaces / F.length(text).cast("double")).alias("s4"),
    )
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("y"))
    return labels.join(documents, "doc_id")


def _scored(spark, sf) -> DataFrame:
    return folds.stratified_folds(_labelled(spark, sf), "doc_id", "y", 5)


def _auc_sql(source: str, label: str, score: str) -> str:
    return f"""
      SELECT sum(pos * (2 * neg_before + neg)) / (2.0 * sum(pos) * sum(neg))
      FROM (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING
                                                    AND 1 PRECEDING), 0) AS neg_before
            FROM (SELECT {score} AS s, sum({label}) AS pos, sum(1 - {label}) AS neg
                  FROM ({source}) WHERE {score} IS NOT NULL GROUP BY 1))"""


@query(
    "roc_auc",
    " UNION ALL ".join(
        f"SELECT '{s}' AS name, round(({_auc_sql(SCORED_SQL, 'y', s)}), 9) AS auc, "
        f"(SELECT CAST(sum(y) AS BIGINT) FROM ({SCORED_SQL})) AS positives, "
        f"(SELECT CAST(sum(1 - y) AS BIGINT) FROM ({SCORED_SQL})) AS negatives"
        for s in SCORES
    ),
)
def roc_auc_table(spark, sf):
    out = auc_by_column(_labelled(spark, sf), "y", SCORES)
    return out.select("name", *rounded(9, "auc"), "positives", "negatives")


@query(
    "roc_auc_ties",
    f"""
    SELECT l_linestatus, round(sum(pos * (2 * neg_before + neg)) / (2.0 * sum(pos) * sum(neg)), 9)
             AS auc
    FROM (SELECT l_linestatus, pos, neg, coalesce(sum(neg) OVER (
                   PARTITION BY l_linestatus ORDER BY l_quantity
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before
          FROM (SELECT l_linestatus, l_quantity,
                       sum(CAST(l_returnflag = 'R' AS INTEGER)) AS pos,
                       sum(CAST(l_returnflag <> 'R' AS INTEGER)) AS neg
                FROM lineitem GROUP BY 1, 2))
    GROUP BY 1
    """,
)
def roc_auc_ties(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("y", F.col("l_returnflag") == "R")
    return roc_auc(lines, "y", "l_quantity", by=["l_linestatus"]).select(
        "l_linestatus", *rounded(9, "auc")
    )


@query(
    "rank_normalize",
    """
    SELECT event_id, round((rank() OVER (ORDER BY value)
             + (count(*) OVER (PARTITION BY value) - 1) / 2.0) / count(*) OVER (), 9) AS value_rank
    FROM events
    """,
)
def rank_normalize_events(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "value")
    return rank_normalize(rows, ["value"]).select("event_id", *rounded(9, "value_rank"))


@query(
    "stratified_folds",
    f"SELECT o_orderkey, {_fold_sql('o_orderkey', 'o_orderstatus', 5)} AS fold FROM orders",
)
def stratified_folds(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return folds.stratified_folds(orders, "o_orderkey", "o_orderstatus", 5).select(
        "o_orderkey", "fold"
    )


@query(
    "hash_folds",
    f"""
    SELECT o_orderkey, CAST({_hash_sql("o_orderkey", 42)} % 5 AS INTEGER) AS fold FROM orders
    """,
)
def hash_folds(spark, sf):
    return folds.hash_folds(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 5)


@query(
    "group_folds",
    f"""
    SELECT o_orderkey, o_custkey, fold
    FROM orders JOIN (SELECT o_custkey, {_fold_sql("o_custkey", "top", 5)} AS fold
                      FROM (SELECT o_custkey, max(CAST(o_totalprice > 400000 AS INTEGER)) AS top
                            FROM orders GROUP BY 1)) USING (o_custkey)
    """,
)
def group_folds(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", (F.col("o_totalprice") > 400000).cast("int").alias("top")
    )
    return folds.group_folds(orders, "o_custkey", "top", 5).select(
        "o_orderkey", "o_custkey", "fold"
    )


@query(
    "stratified_sample",
    f"""
    SELECT o_orderkey, o_orderstatus
    FROM (SELECT o_orderkey, o_orderstatus,
                 row_number() OVER (PARTITION BY o_orderstatus
                   ORDER BY {_hash_sql("o_orderkey", 42, 12)}, o_orderkey) - 1 AS place,
                 count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
    WHERE place < round(n * 0.15)
    """,
)
def stratified_sample(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return folds.stratified_sample(orders, "o_orderkey", "o_orderstatus", 0.15)


def _oof_te_sql(column: str) -> str:
    return f"""
      round(CASE WHEN {column} IS NULL THEN mu
            ELSE (sum(y) OVER (PARTITION BY {column}) - sum(y) OVER (PARTITION BY {column}, fold)
                  + 10.0 * mu)
                 / (count(*) OVER (PARTITION BY {column})
                    - count(*) OVER (PARTITION BY {column}, fold) + 10.0) END, 9)"""


@query(
    "target_encode_oof",
    f"""
    SELECT doc_id, {_oof_te_sql("lang")} AS lang_TE, {_oof_te_sql("source")} AS source_TE
    FROM ({SCORED_SQL}) CROSS JOIN (SELECT avg(quality) AS mu FROM labels)
    """,
)
def target_encode_oof(spark, sf):
    encoded = E.encode_out_of_fold(_scored(spark, sf), ["lang", "source"], "y", 5)
    return encoded.select("doc_id", *rounded(9, "lang_TE", "source_TE"))


def _fold_te_sql(column: str) -> str:
    others = "FILTER (r.fold <> f)"
    return f"""
      (SELECT {column}, f, (coalesce(sum(y) {others}, 0) + 10.0 * max(mu))
                           / (count(*) {others} + 10.0) AS te
       FROM r CROSS JOIN range(5) t(f) CROSS JOIN m WHERE {column} IS NOT NULL GROUP BY 1, 2)"""


@query(
    "target_encode_per_fold",
    f"""
    WITH r AS ({SCORED_SQL}), m AS (SELECT avg(quality) AS mu FROM labels)
    SELECT doc_id, CAST(t.f AS INTEGER) AS held_out, round(coalesce(a.te, mu), 9) AS lang_TE,
           round(coalesce(b.te, mu), 9) AS source_TE
    FROM r CROSS JOIN range(5) t(f) CROSS JOIN m
    LEFT JOIN {_fold_te_sql("lang")} a ON a.lang = r.lang AND a.f = t.f
    LEFT JOIN {_fold_te_sql("source")} b ON b.source = r.source AND b.f = t.f
    """,
)
def target_encode_per_fold(spark, sf):
    encoded = E.encode_per_fold(_scored(spark, sf), ["lang", "source"], "y", 5)
    long = encoded.select(
        "doc_id", F.posexplode(F.arrays_zip("lang_TE", "source_TE")).alias("held_out", "te")
    )
    return long.select(
        "doc_id", "held_out",
        *rounded(9, lang_TE=F.col("te.lang_TE"), source_TE=F.col("te.source_TE")),
    )


def _full_te_sql(column: str) -> str:
    return f"""
      (SELECT {column}, (sum(y) + 10.0 * max(mu)) / (count(*) + 10.0) AS te
       FROM ({SCORED_SQL}) CROSS JOIN (SELECT avg(quality) AS mu FROM labels)
       WHERE {column} IS NOT NULL GROUP BY 1)"""


@query(
    "target_encode_full",
    f"""
    SELECT doc_id, round(coalesce(a.te, mu), 9) AS lang_TE, round(coalesce(b.te, mu), 9) AS source_TE
    FROM (SELECT doc_id, nullif(lang, 'de') AS lang, source FROM documents) d
    CROSS JOIN (SELECT avg(quality) AS mu FROM labels)
    LEFT JOIN {_full_te_sql("lang")} a ON a.lang = d.lang
    LEFT JOIN {_full_te_sql("source")} b ON b.source = d.source
    """,
)
def target_encode_full(spark, sf):
    documents = table(spark, sf, "documents").select(
        "doc_id", F.nullif("lang", F.lit("de")).alias("lang"), "source"
    )
    encoded = E.encode_full(_labelled(spark, sf), documents, ["lang", "source"], "y")
    return encoded.select("doc_id", *rounded(9, "lang_TE", "source_TE"))


DRIFT_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "column_drift_auc",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS name, round(({_auc_sql(
            "SELECT *, CAST(l_linestatus = 'O' AS INTEGER) AS origin FROM lineitem", "origin", c
        )}), 9) AS auc"""
        for c in DRIFT_COLUMNS
    ),
)
def column_drift_auc(spark, sf):
    lines = table(spark, sf, "lineitem")
    test = F.col("l_linestatus") == "O"
    drift = M.column_drift(lines.filter(~test), lines.filter(test), DRIFT_COLUMNS)
    return drift.select("name", *rounded(9, "auc"))


@query(
    "static_blend",
    f"""
    SELECT doc_id, round(0.65 * s1 + 0.0 * s2 + 0.15 * s3 + 0.2 * s4, 9) AS blended,
           round(0.65 * s1 / 0.85 + 0.0 * s2 + 0.2 * s4 / 0.85, 9) AS without_third
    FROM ({SCORED_SQL})
    """,
)
def static_blend(spark, sf):
    return _labelled(spark, sf).select(
        "doc_id", *rounded(9, blended=B.blend(WEIGHTS), without_third=B.blend(WEIGHTS, ["s3"]))
    )


def _rank_sql(score: str) -> str:
    return (
        f"((rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0)"
        " / count(*) OVER ())"
    )


@query(
    "rank_blend",
    f"""
    SELECT doc_id, round(0.65 * {_rank_sql("s1")} + 0.0 * {_rank_sql("s2")}
                         + 0.15 * {_rank_sql("s3")} + 0.2 * {_rank_sql("s4")}, 9) AS blended
    FROM ({SCORED_SQL})
    """,
)
def rank_blend(spark, sf):
    ranked = rank_normalize(_labelled(spark, sf), SCORES)
    weights = {f"{s}_rank": w for s, w in WEIGHTS.items()}
    return ranked.select("doc_id", *rounded(9, blended=B.blend(weights)))


@query(
    "simplex_blend",
    f"""
    WITH w AS (
      SELECT row_number() OVER (ORDER BY a, b, c) AS wid, a / 20.0 AS w1, b / 20.0 AS w2,
             c / 20.0 AS w3, (20 - a - b - c) / 20.0 AS w4
      FROM range(21) t1(a), range(21) t2(b), range(21) t3(c) WHERE a + b + c <= 20),
    cells AS (
      SELECT wid, w1 * s1 + w2 * s2 + w3 * s3 + w4 * s4 AS s, sum(y) AS pos, sum(1 - y) AS neg
      FROM ({SCORED_SQL}) CROSS JOIN w GROUP BY 1, 2),
    aucs AS (
      SELECT wid, sum(pos * (2 * neg_before + neg)) / (2.0 * sum(pos) * sum(neg)) AS auc
      FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY wid ORDER BY s
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before FROM cells)
      GROUP BY 1)
    SELECT w1 AS s1, w2 AS s2, w3 AS s3, w4 AS s4, round(auc, 9) AS auc
    FROM aucs JOIN w USING (wid) ORDER BY aucs.auc DESC, wid LIMIT 1
    """,
)
def simplex_blend(spark, sf):
    weights, auc = B.simplex_blend(_labelled(spark, sf), "y", SCORES, 0.05)
    return spark.createDataFrame(
        [(*[weights[s] for s in SCORES], round(auc, 9))],
        ", ".join(f"{s} double" for s in [*SCORES, "auc"]),
    )


def _ridge_sql(alpha: float = 1.0) -> str:
    names = ["s1", "s3", "s4"]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    sums = ", ".join(
        ["count(*) AS n", "sum(y) AS s_y"]
        + [f"sum({a}) AS s_{a}, sum({a} * y) AS p_{a}_y" for a in names]
        + [f"sum({a} * {b}) AS p_{a}_{b}" for a, b in pairs]
    )
    cov = {
        (a, b): f"(p_{a}_{b} - s_{a} * s_{b} / n{f' + {alpha}' if a == b else ''})" for a, b in pairs
    }
    cov |= {(b, a): c for (a, b), c in cov.items()}
    rhs = {a: f"(p_{a}_y - s_{a} * s_y / n)" for a in names}

    def det(m):
        return (
            f"({m[0][0]} * ({m[1][1]} * {m[2][2]} - {m[1][2]} * {m[2][1]})"
            f" - {m[0][1]} * ({m[1][0]} * {m[2][2]} - {m[1][2]} * {m[2][0]})"
            f" + {m[0][2]} * ({m[1][0]} * {m[2][1]} - {m[1][1]} * {m[2][0]}))"
        )

    full = [[cov[a, b] for b in names] for a in names]
    slopes = ", ".join(
        f"{det([[rhs[a] if j == i else full[r][j] for j in range(3)] for r, a in enumerate(names)])}"
        f" / {det(full)} AS w_{name}"
        for i, name in enumerate(names)
    )
    score = " + ".join(f"w_{a} * (d.{a} - s_{a} / n)" for a in names)
    return f"""
      WITH d AS ({SCORED_SQL}),
      held AS (SELECT f.fold, {sums} FROM d JOIN (SELECT DISTINCT fold FROM d) f
               ON d.fold <> f.fold GROUP BY f.fold),
      fits AS (SELECT *, {slopes} FROM held)
      SELECT d.doc_id, d.y, s_y / n + {score} AS stacked FROM d JOIN fits USING (fold)
    """


@query("ridge_stack", f"SELECT doc_id, round(stacked, 7) AS stacked FROM ({_ridge_sql()})")
def ridge_stack(spark, sf):
    scores = ["s1", "s3", "s4"]
    rows = _scored(spark, sf)
    fits = B.fit_ridge(rows, "y", scores, (1.0,))[1.0]
    return rows.select("doc_id", *rounded(7, stacked=B.ridge_out_of_fold(scores, fits)))


ALPHAS = (0.1, 1.0, 3.0, 10.0)


@query(
    "ridge_sweep",
    " UNION ALL ".join(
        f"SELECT {a} :: DOUBLE AS alpha, round(({_auc_sql(_ridge_sql(a), 'y', 'stacked')}), 9) AS auc"
        for a in ALPHAS
    ),
)
def ridge_sweep(spark, sf):
    scores = ["s1", "s3", "s4"]
    rows = _scored(spark, sf)
    fits = B.fit_ridge(rows, "y", scores, ALPHAS)
    names = {f"a{i}": a for i, a in enumerate(ALPHAS)}
    wide = rows.select(
        "y", *[B.ridge_out_of_fold(scores, fits[a]).alias(n) for n, a in names.items()]
    )
    alpha = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return auc_by_column(wide, "y", list(names)).select(
        alpha[F.col("name")].alias("alpha"), *rounded(9, "auc")
    )


GAIN_SQL = " UNION ALL ".join(
    f"""
    SELECT '{c}' AS name, l_linenumber % 3 AS fold,
           abs(sum(pos * (2 * neg_before + neg)) / (2.0 * sum(pos) * sum(neg)) - 0.5) AS importance
    FROM (SELECT l_linenumber, pos, neg, coalesce(sum(neg) OVER (
                   PARTITION BY l_linenumber ORDER BY v
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before
          FROM (SELECT l_linenumber % 3 AS l_linenumber, {c} AS v,
                       sum(CAST(l_returnflag = 'R' AS INTEGER)) AS pos,
                       sum(CAST(l_returnflag <> 'R' AS INTEGER)) AS neg
                FROM lineitem GROUP BY 1, 2))
    GROUP BY 1, 2"""
    for c in DRIFT_COLUMNS
)


@query(
    "drift_gate",
    f"""
    WITH drift AS ({ORACLES["column_drift_auc"]}), gain AS (
      SELECT name, avg(importance) AS gain FROM ({GAIN_SQL}) GROUP BY 1)
    SELECT name AS feature, round(greatest(auc, 1 - auc), 8) AS drift, round(gain, 8) AS gain,
           greatest(auc, 1 - auc) > 0.501 AND gain < 0.004 AS dropped
    FROM drift JOIN gain USING (name)
    """,
)
def drift_gate(spark, sf):
    # The gain of a column in a fold: how far its AUC for the label is from chance.
    lines = table(spark, sf, "lineitem")
    test = F.col("l_linestatus") == "O"
    drift = M.column_drift(lines.filter(~test), lines.filter(test), DRIFT_COLUMNS)
    long = lines.select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_linenumber") % 3).alias("fold"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("v"))
                            for c in DRIFT_COLUMNS])).alias("s"),
    ).select("y", "fold", "s.feature", "s.v")
    gains = roc_auc(long, "y", "v", by=["feature", "fold"]).select(
        "feature", "fold", F.abs(F.col("auc") - 0.5).alias("importance")
    )
    gate = M.drift_gate(drift, gains, threshold=0.501, min_gain=0.004)
    return gate.select("feature", *rounded(8, "drift", "gain"), "dropped")


STRATEGY_SQL = f"""
  SELECT doc_id, y, 0.65 * s1 + 0.0 * s2 + 0.15 * s3 + 0.2 * s4 AS static,
         0.65 * {_rank_sql("s1")} + 0.0 * {_rank_sql("s2")} + 0.15 * {_rank_sql("s3")}
           + 0.2 * {_rank_sql("s4")} AS static_rank, s1 AS single
  FROM ({SCORED_SQL})
"""


@query(
    "select_strategy",
    f"""
    WITH s AS ({STRATEGY_SQL}), a AS (
      SELECT 0 AS place, 'static' AS name, ({_auc_sql("SELECT * FROM s", "y", "static")}) AS auc
      UNION ALL
      SELECT 1, 'static_rank', ({_auc_sql("SELECT * FROM s", "y", "static_rank")})
      UNION ALL SELECT 2, 'single', ({_auc_sql("SELECT * FROM s", "y", "single")})),
    best AS (SELECT name, auc FROM a ORDER BY auc DESC, place LIMIT 1)
    SELECT doc_id, name AS strategy, round(auc, 9) AS selection_auc,
           round(CASE name WHEN 'static' THEN static WHEN 'static_rank' THEN static_rank
                 ELSE single END, 9) AS score
    FROM s CROSS JOIN best
    """,
)
def select_strategy(spark, sf):
    ranked = rank_normalize(_labelled(spark, sf), SCORES)
    rank_weights = {f"{s}_rank": w for s, w in WEIGHTS.items()}
    candidates = ranked.select(
        "doc_id",
        "y",
        B.blend(WEIGHTS).alias("static"),
        B.blend(rank_weights).alias("static_rank"),
        F.col("s1").alias("single"),
    )
    name, aucs = B.best_strategy(candidates, "y", ["static", "static_rank", "single"])
    auc = aucs.filter(F.col("name") == name).first()["auc"]
    return candidates.select(
        "doc_id",
        F.lit(name).alias("strategy"),
        F.lit(round(auc, 9)).alias("selection_auc"),
        F.round(name, 9).alias("score"),
    )


@query(
    "zero_importance",
    """
    SELECT feature, count(*) AS n_zero
    FROM (SELECT event_type || '-' || (event_id % 50) AS feature, user_id % 5 AS fold,
                 sum(CAST(value > 120 AS INTEGER)) AS importance
          FROM events GROUP BY 1, 2)
    WHERE importance = 0 GROUP BY 1 HAVING count(*) = 5
    """,
)
def zero_importance(spark, sf):
    per_fold = G.to_parent(
        table(spark, sf, "events").select(
            F.concat_ws("-", "event_type", F.col("event_id") % 50).alias("feature"),
            (F.col("user_id") % 5).alias("fold"),
            "value",
        ),
        ["feature", "fold"],
        {"importance": A.tally(F.col("value") > 120)},
    )
    return B.zero_in_all_folds(per_fold, 5)


KS = [5, 25, 100]


def _knn_sql(points: str, pair_filter: str) -> str:
    means = ", ".join(
        f"round(avg(y) FILTER (place <= {k}), 9) AS KNN_TARGET_MEAN_K{k}" for k in KS
    )
    return f"""
      WITH p AS ({points})
      SELECT id, {means}
      FROM (SELECT q.id, r.y, row_number() OVER (PARTITION BY q.id
                     ORDER BY list_distance(q.vec, r.vec), r.id) AS place
            FROM p q JOIN p r ON {pair_filter})
      WHERE place <= {max(KS)} GROUP BY 1
    """


@query(
    "knn_target_mean",
    _knn_sql(
        "SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, "
        "CAST(label = 0 AS INTEGER) AS y FROM embeddings",
        "q.id <> r.id",
    ),
)
def knn_embeddings(spark, sf):
    points = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").cast("array<double>").alias("vec"),
        (F.col("label") == 0).cast("int").alias("y"),
    )
    # Small cells, so that the tree is used on small tables too.
    out = knn_target_mean(
        points, points.select("id", "vec"), KS, exclude="self", cell_points=256
    )
    return out.select("id", *rounded(9, *[f"KNN_TARGET_MEAN_K{k}" for k in KS]))


KNN_POINTS_SQL = f"""
  SELECT id, [bal, coalesce(price, m), n, bal / (coalesce(price, m) + 1e-8)] AS vec, y,
         CAST({_hash_sql("id", 42)} % 5 AS INTEGER) AS fold
  FROM (SELECT c_custkey AS id, c_acctbal AS bal, CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS y,
               CAST(coalesce(n, 0) AS DOUBLE) AS n, CASE WHEN n > 6 THEN price END AS price
        FROM customer LEFT JOIN (
          SELECT o_custkey, count(*) AS n, round({money_mean_sql("o_totalprice")}, 6) AS price
          FROM orders GROUP BY 1) ON o_custkey = c_custkey) t
  CROSS JOIN (SELECT median(price) AS m FROM (
      SELECT round({money_mean_sql("o_totalprice")}, 6) AS price FROM orders
      WHERE o_custkey IN (SELECT c_custkey FROM customer) GROUP BY o_custkey
      HAVING count(*) > 6))
"""


def _knn_points(spark, sf) -> DataFrame:
    per_customer = G.to_parent(
        table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey"),
        "c_custkey",
        {"n": A.rows(), "price": F.round(A.mean(money("o_totalprice")).cast("double"), 6)},
    )
    rows = G.left_onto(table(spark, sf, "customer"), per_customer, on="c_custkey").select(
        F.col("c_custkey").alias("id"),
        F.col("c_acctbal").alias("bal"),
        F.coalesce("n", F.lit(0)).cast("double").alias("n"),
        F.when(F.col("n") > 6, F.col("price")).alias("price"),
        (F.col("c_mktsegment") == "BUILDING").cast("int").alias("y"),
    )
    filled = C.fill(rows, C.fit_medians(rows, ["price"])).withColumn(
        "ratio", X.guarded_ratio(F.col("bal"), F.col("price"), 1e-8)
    )
    folded = folds.hash_folds(filled, "id", 5)
    return folded.select("id", vector(["bal", "price", "n", "ratio"]).alias("vec"), "y", "fold")


@query("knn_target_mean_oof", _knn_sql(KNN_POINTS_SQL, "q.fold <> r.fold"))
def knn_out_of_fold(spark, sf):
    points = _knn_points(spark, sf)
    out = knn_target_mean(
        points, points.select("id", "vec", "fold"), KS, exclude="fold", cell_points=128
    )
    return out.select("id", *rounded(9, *[f"KNN_TARGET_MEAN_K{k}" for k in KS]))


@query("knn_target_mean_loo", _knn_sql(KNN_POINTS_SQL, "q.id <> r.id"))
def knn_leave_one_out(spark, sf):
    points = _knn_points(spark, sf)
    out = knn_target_mean(
        points, points.select("id", "vec"), KS, exclude="self", cell_points=64, chunk_cells=4
    )
    return out.select("id", *rounded(9, *[f"KNN_TARGET_MEAN_K{k}" for k in KS]))


@query("knn_buckets_oof", _knn_sql(KNN_POINTS_SQL, "q.fold <> r.fold"))
def knn_buckets_out_of_fold(spark, sf):
    points = settle(_knn_points(spark, sf))
    out = lsh_target_mean(
        points, points.select("id", "vec", "fold"), KS, "fold", exact=True, bucket_points=32
    )
    return out.select("id", *rounded(9, *[f"KNN_TARGET_MEAN_K{k}" for k in KS]))


@query("knn_buckets_loo", _knn_sql(KNN_POINTS_SQL, "q.id <> r.id"))
def knn_buckets_leave_one_out(spark, sf):
    points = settle(_knn_points(spark, sf))
    out = lsh_target_mean(
        points, points.select("id", "vec"), KS, "self", exact=True, bucket_points=32
    )
    return out.select("id", *rounded(9, *[f"KNN_TARGET_MEAN_K{k}" for k in KS]))


@query(
    "knn_lsh_recall",
    """
      WITH size AS (SELECT count(*) AS n FROM embeddings),
           asked AS (SELECT vec_id FROM embeddings, size WHERE vec_id % (n // 100 + 1) = 0)
      SELECT count(*) AS queries, CAST(count(*) * least(25, any_value(n) - 1) AS BIGINT) AS found,
             TRUE AS recall_reached, TRUE AS distances_exact
      FROM asked, size
    """,
)
def knn_lsh_recall(spark, sf):
    """At most 100 queries spread over the ids against all vectors, by buckets and by brute force."""
    points = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec")
    )
    step = points.count() // 100 + 1
    asked = points.filter(F.col("id") % step == 0)
    return lsh_recall(points, asked, 25, bucket_points=16).select(
        "queries", "found", (F.col("recall") >= 0.9).alias("recall_reached"), "distances_exact"
    )
