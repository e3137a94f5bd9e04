"""Queries for sources, sinks, cleaning and row-wise columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import aggregates as A
from riskloom.functions import expressions as X
from riskloom.operators import aggregate as G
from riskloom.operators import clean as C
from riskloom.operators import folds
from riskloom.plans.registry import days_from, days_sql, query, rounded, scratch, table
from riskloom.sources import catalogue
from riskloom.sources import tables as S

ORDER_DAYS = days_sql("o_orderdate")


@query("csv_to_parquet", "SELECT * FROM customer")
def csv_to_parquet(spark, sf):
    folder = scratch(spark, "csv")
    source = table(spark, sf, "customer")
    source.write.option("header", True).csv(f"{folder}/customer.csv")
    return S.csv_to_parquet(
        spark, f"{folder}/customer.csv", f"{folder}/customer.parquet", source.schema
    )


@query(
    "staged_roundtrip",
    """
    SELECT o_custkey, count(*) AS n_orders, round(coalesce(sum(o_totalprice), 0), 2) AS total
    FROM orders GROUP BY 1
    """,
)
def staged_roundtrip(spark, sf):
    root, orders = scratch(spark, "stage"), table(spark, sf, "orders")

    def build():
        return G.to_parent(
            orders,
            "o_custkey",
            {"n_orders": A.rows(), "total": F.round(A.total(F.col("o_totalprice")), 2)},
        )

    S.staged(build, root, "orders", {"seed": 42, "sample": 1.0}, [orders])
    return S.staged(build, root, "orders", {"seed": 42, "sample": 1.0}, [orders])


@query(
    "prediction_sink",
    """
    SELECT doc_id, round(CAST(CAST(n_chars / (n_chars + 1000.0) AS FLOAT) AS DOUBLE), 5) AS TARGET
    FROM documents
    """,
)
def prediction_sink(spark, sf):
    path = f"{scratch(spark, 'scores')}/submission_full"
    scored = table(spark, sf, "documents").select(
        "doc_id", (F.col("n_chars") / (F.col("n_chars") + 1000.0)).alias("score")
    )
    S.write_scores(scored, "doc_id", "score", path)
    back = spark.read.option("header", True).schema("doc_id long, TARGET float").csv(path)
    return back.select("doc_id", *rounded(5, "TARGET"))


def _profile_sql() -> str:
    columns = {
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string",
    }
    source = "(SELECT * REPLACE (nullif(o_orderpriority, '5-LOW') AS o_orderpriority) FROM orders)"
    return " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS type, count(*) AS rows, "
        f"count(*) - count({c}) AS nulls, CAST(min({c}) AS VARCHAR) AS low, "
        f"CAST(max({c}) AS VARCHAR) AS high FROM {source}"
        for i, (c, t) in enumerate(columns.items())
    )


@query("table_profile", _profile_sql())
def table_profile(spark, sf):
    orders = table(spark, sf, "orders").withColumn(
        "o_orderpriority", X.without(F.col("o_orderpriority"), "5-LOW")
    )
    return S.profile(orders).withColumnRenamed("column", "column_name")


@query(
    "table_head",
    "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
)
def table_head(spark, sf):
    return S.head(table(spark, sf, "orders"), ["o_orderkey"], 5)


@query(
    "hash_sample",
    """
    SELECT * FROM orders
    WHERE CAST(('0x' || substr(md5('42:' || o_orderkey), 1, 8)) AS BIGINT) < 644245094
    """,
)
def hash_sample(spark, sf):
    return folds.hash_sample(table(spark, sf, "orders"), "o_orderkey", 0.15)


@query(
    "sentinel_clean",
    f"""
    SELECT o_orderkey, CAST(o_custkey = 0 AS INTEGER) AS cust_anom, nullif(o_custkey, 0) AS cust,
           nullif(o_orderpriority, '5-LOW') AS priority, abs({ORDER_DAYS}) AS days_order,
           round(ln(1 + o_totalprice), 6) AS price_log
    FROM orders
    """,
)
def sentinel_clean(spark, sf):
    rows = table(spark, sf, "orders").withColumns(
        {
            "cust_anom": X.is_sentinel(F.col("o_custkey"), 0),
            "cust": X.without(F.col("o_custkey"), 0),
            "priority": X.without(F.col("o_orderpriority"), "5-LOW"),
            "days_order": days_from("o_orderdate"),
            "price_log": F.round(F.log1p("o_totalprice"), 6),
        }
    )
    rows = X.transform_prefix(rows, "days_", F.abs)
    return rows.select("o_orderkey", "cust_anom", "cust", "priority", "days_order", "price_log")


@query(
    "winsorize_p99",
    """
    SELECT o_orderkey, CASE WHEN p > cap THEN cap ELSE p END AS price
    FROM (SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS p
          FROM orders)
    CROSS JOIN (SELECT s[CAST(round(0.99 * (len(s) - 1)) AS INTEGER) + 1] AS cap
                FROM (SELECT list_sort(list(o_totalprice)) AS s FROM orders
                      WHERE o_orderpriority <> '5-LOW'))
    """,
)
def winsorize_p99(spark, sf):
    kept = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice"))
    rows = table(spark, sf, "orders").select("o_orderkey", kept.alias("price"))
    return C.apply_cap(rows, "price", C.fit_cap(rows, "price"))


@query(
    "median_impute",
    """
    SELECT event_id, round(coalesce(v, m), 6) AS value
    FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)
    CROSS JOIN (SELECT median(value) AS m FROM events WHERE event_type <> 'error')
    """,
)
def median_impute(spark, sf):
    known = F.when(F.col("event_type") != "error", F.col("value"))
    rows = table(spark, sf, "events").select("event_id", known.alias("value"))
    filled = C.fill(rows, C.fit_medians(rows, ["value"]))
    return filled.select("event_id", *rounded(6, "value"))


@query(
    "fill_policy",
    """
    SELECT event_id, coalesce(v, 0) AS zero_fill, coalesce(v, -999) AS marker_fill,
           coalesce(t, 'MISSING') AS type_fill, round(coalesce(v, m), 6) AS mean_fill
    FROM (SELECT event_id, CASE WHEN event_type <> 'error' AND value <> 0 THEN value END AS v,
                 nullif(event_type, 'click') AS t FROM events)
    CROSS JOIN (SELECT avg(value) AS m FROM events WHERE event_type <> 'error' AND value <> 0)
    """,
)
def fill_policy(spark, sf):
    # Division by zero stands in for the infinities that the clean-up turns into nulls.
    endless = F.when(F.col("value") == 0, F.lit(float("inf"))).otherwise(F.col("value"))
    known = F.when(F.col("event_type") != "error", endless)
    rows = table(spark, sf, "events").select(
        "event_id",
        *[known.alias(n) for n in ("zero_fill", "marker_fill", "mean_fill")],
        X.without(F.col("event_type"), "click").alias("type_fill"),
    )
    mean = rows.agg(F.avg(C.finite(F.col("mean_fill")))).first()[0]
    filled = C.fill(
        rows,
        {"zero_fill": 0.0, "marker_fill": -999.0, "type_fill": "MISSING", "mean_fill": mean},
    )
    return filled.select("event_id", "zero_fill", "marker_fill", "type_fill",
                         *rounded(6, "mean_fill"))


@query(
    "category_index",
    """
    SELECT p_partkey, coalesce(code, -1) AS type_code
    FROM part LEFT JOIN (
      SELECT p_type, CAST(row_number() OVER (ORDER BY p_type) - 1 AS INTEGER) AS code
      FROM (SELECT DISTINCT p_type FROM part WHERE p_size <= 40 AND p_type <> 'ECONOMY')) c
    USING (p_type)
    """,
)
def category_index(spark, sf):
    parts = table(spark, sf, "part")
    train = parts.filter((F.col("p_size") <= 40) & (F.col("p_type") != "ECONOMY"))
    codes = C.category_codes(train, "p_type", "type_code")
    return C.index_category(parts, codes, "p_type", "type_code").select("p_partkey", "type_code")


@query("prune_columns", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def prune_columns(spark, sf):
    return C.prune(
        table(spark, sf, "orders"), ["o_orderstatus", "FLAG_MOBIL", "o_orderpriority"]
    )


@query(
    "narrow_types",
    """
    SELECT o_orderkey * 4294967296 AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
           o_orderstatus, CAST(o_totalprice AS FLOAT) AS o_totalprice
    FROM orders
    """,
)
def narrow_types(spark, sf):
    orders = table(spark, sf, "orders").withColumn("o_orderkey", F.col("o_orderkey") * 2**32)
    rows = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return X.narrowed(rows, whole=["o_custkey"])


@query(
    "rowwise_stats",
    """
    SELECT l_orderkey, l_partkey, l_quantity, round(a * b * c, 6) AS prod,
           round((coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0))
                 / nullif(CAST(a IS NOT NULL AS INTEGER) + CAST(b IS NOT NULL AS INTEGER)
                          + CAST(c IS NOT NULL AS INTEGER), 0), 6) AS mean,
           least(a, b, c) AS low,
           CAST(a IS NULL AS INTEGER) + CAST(b IS NULL AS INTEGER) + CAST(c IS NULL AS INTEGER)
             AS n_null,
           CAST(a IS NOT NULL AS INTEGER) + CAST(b IS NOT NULL AS INTEGER)
             + CAST(c IS NOT NULL AS INTEGER) AS n_known
    FROM (SELECT *, nullif(l_discount, 0) AS a, nullif(l_tax, 0) AS b,
                 CASE WHEN l_quantity > 25 THEN l_quantity / 50 END AS c FROM lineitem)
    """,
)
def rowwise_stats(spark, sf):
    rows = table(spark, sf, "lineitem").withColumns(
        {
            "a": F.nullif("l_discount", F.lit(0.0)),
            "b": F.nullif("l_tax", F.lit(0.0)),
            "c": F.when(F.col("l_quantity") > 25, F.col("l_quantity") / 50),
        }
    )
    abc = ["a", "b", "c"]
    return rows.select(
        "l_orderkey",
        "l_partkey",
        "l_quantity",
        F.round(X.row_product(abc), 6).alias("prod"),
        F.round(X.row_mean(abc), 6).alias("mean"),
        X.row_min(abc).alias("low"),
        X.null_count(abc).alias("n_null"),
        X.known_count(abc).alias("n_known"),
    )


@query(
    "decile_bins",
    """
    WITH e AS (SELECT list_sort(list_distinct(quantile_cont(l_quantity,
                 [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS q,
               list_sort(list_distinct(quantile_cont(l_discount,
                 [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS d FROM lineitem)
    SELECT CAST(len(list_filter(q[2:len(q) - 1], lambda x: l_quantity > x)) AS INTEGER) AS q_bin,
           CAST(len(list_filter(d[2:len(d) - 1], lambda x: l_discount > x)) AS INTEGER) AS d_bin,
           count(*) AS n, min(l_quantity) AS q_low, max(l_quantity) AS q_high,
           min(l_discount) AS d_low, max(l_discount) AS d_high
    FROM lineitem, e GROUP BY 1, 2
    """,
)
def decile_bins(spark, sf):
    lines = table(spark, sf, "lineitem")
    edges = C.fit_bins(lines, ["l_quantity", "l_discount"], 10)
    bins = {
        "q_bin": C.bin_of(F.col("l_quantity"), edges["l_quantity"]),
        "d_bin": C.bin_of(F.col("l_discount"), edges["l_discount"]),
    }
    return G.to_parent(
        lines.withColumns(bins),
        list(bins),
        {
            "n": A.rows(),
            "q_low": A.low(F.col("l_quantity")),
            "q_high": A.high(F.col("l_quantity")),
            "d_low": A.low(F.col("l_discount")),
            "d_high": A.high(F.col("l_discount")),
        },
    )


@query(
    "stage_metrics",
    """
    SELECT 'orders' AS stage, (SELECT count(*) FROM orders) AS rows, 6 AS columns,
           CAST(0 AS BIGINT) AS nulls
    UNION ALL
    SELECT 'merged', (SELECT count(*) FROM customer), 4,
           CAST((SELECT 2 * count(*) FROM customer
                 WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)) AS BIGINT)
    """,
)
def stage_metrics(spark, sf):
    orders, seen_orders = S.watched(table(spark, sf, "orders"), "orders")
    per_customer = G.to_parent(
        orders.withColumnRenamed("o_custkey", "c_custkey"),
        "c_custkey",
        {
            "n": A.rows(),
            "total": A.total(F.col("o_totalprice")),
        },
    )
    parents = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    merged, seen_merged = S.watched(G.left_onto(parents, per_customer, on="c_custkey"), "merged")
    merged.write.format("noop").mode("overwrite").save()
    stages = {"orders": seen_orders.get, "merged": seen_merged.get}
    return spark.createDataFrame(
        [(s, int(m["rows"]), int(m["columns"]), int(m["nulls"])) for s, m in stages.items()],
        "stage string, rows long, columns int, nulls long",
    )


@query(
    "joined_stages",
    """
    SELECT c_custkey, n_orders, total, n_nations, CAST('meta_absent,meta_part' AS VARCHAR) AS absent
    FROM customer
    LEFT JOIN (SELECT o_custkey AS c_custkey, count(*) AS n_orders,
                      round(coalesce(sum(o_totalprice), 0), 2) AS total
               FROM orders GROUP BY 1) USING (c_custkey)
    LEFT JOIN (SELECT c_custkey, count(*) AS n_nations
               FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1) USING (c_custkey)
    """,
)
def joined_stages(spark, sf):
    """Stages found by their entries: two are there, one was never made, one was not finished."""
    root, key = scratch(spark, "catalogue"), "c_custkey"
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", key)
    customer = table(spark, sf, "customer")
    nations = customer.join(
        table(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey")
    )
    builds = {
        "meta_orders": lambda: G.to_parent(
            orders, key, {"n_orders": A.rows(), "total": F.round(A.total(F.col("o_totalprice")), 2)}
        ),
        "meta_nation": lambda: G.to_parent(nations, key, {"n_nations": A.rows()}),
    }
    for name, build in builds.items():
        catalogue.publish(build, root, name, [key], {"seed": 42}, [orders, customer])
    customer.select(key).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{root}/meta_part-0")
    wanted = ["meta_absent", "meta_nation", "meta_orders", "meta_part"]
    found, absent = catalogue.join_present(customer.select(key), root, wanted, [key])
    return found.withColumn("absent", F.lit(",".join(absent)))


@query(
    "csv_declared",
    """
    SELECT s_suppkey, s_name, s_acctbal, NULL::VARCHAR AS broken, FALSE AS replaced FROM supplier
    UNION ALL
    SELECT NULL, 'Supplier x', s_acctbal, 'x' || s_suppkey || ',Supplier x,' || s_acctbal, FALSE
    FROM supplier WHERE s_suppkey % 7 = 0
    UNION ALL
    SELECT s_suppkey, chr(65533), NULL, s_suppkey || ',' || chr(65533), TRUE
    FROM supplier WHERE s_suppkey % 11 = 0
    """,
)
def csv_declared(spark, sf):
    """Good lines, lines with a key that is no number, short lines with an undecodable byte."""
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    folder = scratch(spark, "declared")
    rows.write.option("header", True).csv(f"{folder}/good.csv")
    number = F.col("s_suppkey").cast("string")
    wrong = rows.filter("s_suppkey % 7 = 0").select(
        F.concat(F.lit("x"), number, F.lit(",Supplier x,"), F.col("s_acctbal").cast("string"))
    )
    wrong.write.text(f"{folder}/wrong.csv")
    # Byte FF, which no UTF-8 text holds.
    short = rows.filter("s_suppkey % 11 = 0").select(number, F.lit("\u00ff"))
    short.write.option("encoding", "ISO-8859-1").csv(f"{folder}/short.csv")
    good = S.csv_to_parquet(
        spark, f"{folder}/good.csv", f"{folder}/good.parquet", rows.schema, keep_faults=True
    )
    parts = [good] + [
        S.read_declared(spark, f"{folder}/{name}.csv", rows.schema, header=False)
        for name in ("wrong", "short")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumnsRenamed(
        {S.BROKEN: "broken", S.REPLACED: "replaced"}
    )
