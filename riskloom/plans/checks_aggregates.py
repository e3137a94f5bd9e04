"""Queries for child-to-parent aggregation, windows, ordered aggregates and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import aggregates as A
from riskloom.functions import expressions as X
from riskloom.operators import aggregate as G
from riskloom.operators import sketches as S
from riskloom.operators.joins import attach, only_members, with_group_key
from riskloom.operators.ordered import ewm_last, rank_normalize
from riskloom.plans.registry import (
    EVENTS_AS_OF,
    days_from,
    days_sql,
    money,
    money_mean_sql,
    query,
    rounded,
    table,
)
from riskloom.session import settle

ORDER_DAYS = days_sql("o_orderdate")
SHIP_DAYS = days_sql("l_shipdate")
EVENT_DAYS = days_sql("ts", EVENTS_AS_OF)


def _orders(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").withColumn("days", days_from("o_orderdate"))


def _events(spark, sf) -> DataFrame:
    return table(spark, sf, "events").withColumn("days", days_from("ts", EVENTS_AS_OF))


@query(
    "child_to_parent",
    f"""
    SELECT c.c_custkey, a.n_rows, a.n_known, a.total, a.mean_price, a.low, a.high
    FROM customer c LEFT JOIN (
      SELECT o_custkey, count(*) AS n_rows,
             count(CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END) AS n_known,
             round(coalesce(sum(CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END), 0), 2)
               AS total,
             round({money_mean_sql("o_totalprice")}, 6) AS mean_price, min(o_totalprice) AS low,
             max(o_totalprice) AS high
      FROM orders GROUP BY 1) a ON a.o_custkey = c.c_custkey
    """,
)
def child_to_parent(spark, sf):
    known = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice"))
    price = F.col("o_totalprice")
    per_customer = G.to_parent(
        table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey"),
        "c_custkey",
        {
            "n_rows": A.rows(),
            "n_known": A.known(known),
            "total": A.total(known),
            "mean_price": A.mean(money("o_totalprice")),
            "low": A.low(price),
            "high": A.high(price),
        },
    )
    customers = table(spark, sf, "customer").select("c_custkey")
    return G.left_onto(customers, per_customer, on="c_custkey").select(
        "c_custkey", "n_rows", "n_known", *rounded(2, "total"), *rounded(6, "mean_price"),
        "low", "high",
    )


@query(
    "guarded_ratios",
    f"""
    SELECT c.c_custkey, a.n_orders, round(a.total, 2) AS total, round(a.open_frac, 6) AS open_frac,
           round(a.total / (c.bal + 1), 3) AS total_bal_ratio,
           round(a.open_frac / (CAST(a.n_open AS DOUBLE) + 1e-8), 6) AS open_ratio,
           round(c.bal - a.mean_price, 6) AS bal_gap
    FROM (SELECT c_custkey, abs(c_acctbal) AS bal FROM customer) c
    LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, coalesce(sum(o_totalprice), 0) AS total,
                      avg(CAST(o_orderstatus = 'O' AS INTEGER)) AS open_frac,
                      coalesce(sum(CAST(o_orderstatus = 'O' AS INTEGER)), 0) AS n_open,
                      {money_mean_sql("o_totalprice")} AS mean_price
               FROM orders GROUP BY 1) a ON a.o_custkey = c.c_custkey
    """,
)
def guarded_ratios(spark, sf):
    open_order = F.col("o_orderstatus") == "O"
    per_customer = G.to_parent(
        table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey"),
        "c_custkey",
        {
            "n_orders": A.rows(),
            "total": A.total(F.col("o_totalprice")),
            "open_frac": A.share(open_order),
            "n_open": A.tally(open_order),
            "mean_price": A.mean(money("o_totalprice")).cast("double"),
        },
    )
    customers = table(spark, sf, "customer").select(
        "c_custkey", F.abs("c_acctbal").alias("bal")
    )
    joined = G.left_onto(customers, per_customer, on="c_custkey")
    return joined.select(
        "c_custkey",
        "n_orders",
        *rounded(2, "total"),
        *rounded(6, "open_frac"),
        *rounded(3, total_bal_ratio=X.guarded_ratio(F.col("total"), F.col("bal"), 1)),
        *rounded(6, open_ratio=X.guarded_ratio(F.col("open_frac"), F.col("n_open"), 1e-8)),
        *rounded(6, bal_gap=F.col("bal") - F.col("mean_price")),
    )


@query(
    "status_counts",
    """
    SELECT l_orderkey, count(*) AS n, coalesce(sum(CAST(f = 'A' AS INTEGER)), 0)::BIGINT AS n_a,
           coalesce(sum(CAST(f IN ('A', 'R') AS INTEGER)), 0)::BIGINT AS n_late,
           round(avg(CAST(f = 'A' AS INTEGER)), 6) AS frac_a,
           round(avg(CAST(f IN ('A', 'R') AS INTEGER)), 6) AS frac_late
    FROM (SELECT l_orderkey,
                 nullif(l_returnflag, CASE WHEN l_quantity > 40 THEN 'N' ELSE '-' END) AS f
          FROM lineitem)
    GROUP BY 1
    """,
)
def status_counts(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.nullif("l_returnflag", F.when(F.col("l_quantity") > 40, "N").otherwise("-")).alias("f"),
    )
    late = F.col("f").isin("A", "R")
    return G.to_parent(
        rows,
        "l_orderkey",
        {
            "n": A.rows(),
            "n_a": A.tally(F.col("f") == "A"),
            "n_late": A.tally(late),
            "frac_a": F.round(A.share(F.col("f") == "A"), 6),
            "frac_late": F.round(A.share(late), 6),
        },
    )


def _window_sql(days: int, tag: str) -> str:
    seen = f"days >= -{days}"
    return f"""
      CASE WHEN count(*) FILTER ({seen}) > 0 THEN count(*) FILTER ({seen}) END AS n_{tag},
      CASE WHEN count(*) FILTER ({seen}) > 0
           THEN round(coalesce(sum(o_totalprice) FILTER ({seen}), 0), 2) END AS total_{tag},
      round({money_mean_sql("o_totalprice", seen)}, 6) AS mean_{tag},
      max(o_totalprice) FILTER ({seen}) AS high_{tag},
      round(avg(CAST(o_orderstatus = 'F' AS INTEGER)) FILTER ({seen}), 6) AS refused_{tag}"""


@query(
    "recency_windows",
    f"""
    SELECT o_custkey, {_window_sql(365, "1y")}, {_window_sql(730, "2y")}
    FROM (SELECT *, {ORDER_DAYS} AS days FROM orders) GROUP BY 1
    """,
)
def recency_windows(spark, sf):
    price, refused = F.col("o_totalprice"), F.col("o_orderstatus") == "F"
    specs = {}
    for tag, days in {"1y": 365, "2y": 730}.items():
        seen = F.col("days") >= -days
        specs |= {
            f"n_{tag}": A.rows(seen),
            f"total_{tag}": F.round(A.total(price, seen), 2),
            f"mean_{tag}": F.round(A.mean(money("o_totalprice"), seen).cast("double"), 6),
            f"high_{tag}": A.high(price, seen),
            f"refused_{tag}": F.round(A.share(refused, seen), 6),
        }
    return G.to_parent(_orders(spark, sf), "o_custkey", specs)


@query(
    "decayed_sum",
    f"""
    SELECT o_custkey,
           round(coalesce(sum(o_totalprice * exp(-0.01 * abs(days))), 0), 3) AS open_decayed,
           round(avg(days * exp(-0.01 * abs(days))), 6) AS days_decayed
    FROM (SELECT *, {ORDER_DAYS} AS days FROM orders) WHERE o_orderstatus = 'O' GROUP BY 1
    """,
)
def decayed_sum(spark, sf):
    rows = _orders(spark, sf).filter(F.col("o_orderstatus") == "O")
    return G.to_parent(
        rows,
        "o_custkey",
        {
            "open_decayed": F.round(A.total(X.decayed(F.col("o_totalprice"), F.col("days"))), 3),
            "days_decayed": F.round(A.mean(X.decayed(F.col("days"), F.col("days"))), 6),
        },
    )


STATUS_SQL = f"""
  SELECT l_orderkey, CAST(floor({SHIP_DAYS} / 30.0) AS INTEGER) AS month,
         CASE l_returnflag WHEN 'A' THEN 'C' WHEN 'N' THEN 'X'
              ELSE CASE WHEN l_linenumber = 7 THEN 'late' ELSE CAST(l_linenumber % 6 AS VARCHAR) END
         END AS status
  FROM lineitem
"""


def _months(spark, sf) -> DataFrame:
    other = F.when(F.col("l_linenumber") == 7, "late").otherwise(
        (F.col("l_linenumber") % 6).cast("string")
    )
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.floor(days_from("l_shipdate") / F.lit(30.0)).cast("int").alias("month"),
        F.when(F.col("l_returnflag") == "A", "C")
        .when(F.col("l_returnflag") == "N", "X")
        .otherwise(other)
        .alias("status"),
    )


@query(
    "ordered_first_last",
    f"""
    SELECT l_orderkey, min(month) AS first_month, max(month) AS last_month,
           arg_min(sev, month * 8 + sev) AS first_sev, arg_max(sev, month * 8 + sev) AS last_sev,
           min(CASE WHEN status = 'C' THEN abs(month) END) AS closed,
           abs(max(month)) - min(CASE WHEN status = 'C' THEN abs(month) END) AS closed_to_end
    FROM (SELECT *, CASE status WHEN 'C' THEN -1 WHEN 'X' THEN 0
                    ELSE coalesce(try_cast(status AS INTEGER), 0) END AS sev
          FROM ({STATUS_SQL}))
    GROUP BY 1
    """,
)
def ordered_first_last(spark, sf):
    month, severity = F.col("month"), F.col("sev")
    rows = _months(spark, sf).withColumn("sev", X.ordinal(F.col("status"), {"C": -1, "X": 0}))
    place = month * 8 + severity
    wide = G.to_parent(
        rows,
        "l_orderkey",
        {
            "first_month": A.low(month),
            "last_month": A.high(month),
            "first_sev": A.earliest(severity, place),
            "last_sev": A.latest(severity, place),
            "closed": A.low(F.abs(month), F.col("status") == "C"),
        },
    )
    return wide.withColumn("closed_to_end", F.abs("last_month") - F.col("closed"))


@query(
    "two_level_rollup",
    """
    SELECT o.o_custkey, round(avg(l.lines), 6) AS lines_mean,
           coalesce(sum(l.n_late), 0)::BIGINT AS late_sum,
           round(avg(l.late_frac), 6) AS late_frac_mean, max(l.top) AS top_max,
           count(*) AS n_orders
    FROM orders o LEFT JOIN (
      SELECT l_orderkey, count(*) AS lines, sum(CAST(l_returnflag = 'R' AS INTEGER)) AS n_late,
             avg(CAST(l_returnflag = 'R' AS INTEGER)) AS late_frac, max(l_extendedprice) AS top
      FROM lineitem GROUP BY 1) l ON l.l_orderkey = o.o_orderkey
    GROUP BY 1
    """,
)
def two_level_rollup(spark, sf):
    late = F.col("l_returnflag") == "R"
    lines = G.to_parent(
        table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"),
        "o_orderkey",
        {
            "lines": A.rows(),
            "n_late": A.tally(late),
            "late_frac": A.share(late),
            "top": A.high(F.col("l_extendedprice")),
        },
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return G.to_parent(
        G.left_onto(orders, lines, on="o_orderkey"),
        "o_custkey",
        {
            "lines_mean": F.round(A.mean(F.col("lines")), 6),
            "late_sum": A.total(F.col("n_late")),
            "late_frac_mean": F.round(A.mean(F.col("late_frac")), 6),
            "top_max": A.high(F.col("top")),
            "n_orders": A.rows(),
        },
    )


@query(
    "restructure_flag",
    """
    SELECT o_custkey, coalesce(sum(many), 0)::BIGINT AS n_restructured,
           round(avg(many), 6) AS restructured_frac
    FROM (SELECT o_custkey, l_orderkey,
                 CAST(count(DISTINCT v) + max(CAST(v IS NULL AS INTEGER)) > 2 AS INTEGER) AS many
          FROM (SELECT l_orderkey, nullif(l_linenumber, 7) AS v FROM lineitem) l
          JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2)
    GROUP BY 1
    """,
)
def restructure_flag(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.nullif("l_linenumber", F.lit(7)).alias("v")
    )
    per_order = G.version_counts(lines, "o_orderkey", "v")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    out = G.restructured_share(per_order.join(orders, "o_orderkey"), "o_custkey")
    return out.select("o_custkey", "n_restructured", *rounded(6, "restructured_frac"))


@query(
    "util_p95",
    f"""
    SELECT user_id, round(s[CAST(round(0.95 * (len(s) - 1)) AS INTEGER) + 1], 6) AS util_p95
    FROM (SELECT user_id, list_sort(list(value)) AS s
          FROM (SELECT *, {EVENT_DAYS} AS days FROM events) WHERE value > 0 AND days >= -20
          GROUP BY 1)
    """,
)
def util_p95(spark, sf):
    rows = _events(spark, sf).filter(F.col("value") > 0)
    out = G.quantile_by_parent(rows, "user_id", "value", 0.95, "util_p95", F.col("days") >= -20)
    return out.select("user_id", *rounded(6, "util_p95"))


@query(
    "ewm_last",
    """
    SELECT user_id, round(sum(value * w) / sum(w), 6) AS value_ewm
    FROM (SELECT user_id, value, pow(2.0, -(row_number() OVER (
                 PARTITION BY user_id ORDER BY ts DESC, event_id DESC) - 1) / 3.0) AS w
          FROM events)
    GROUP BY 1
    """,
)
def ewm_last_by_user(spark, sf):
    out = ewm_last(
        table(spark, sf, "events"), "user_id", ["ts", "event_id"], "value", 3.0, "value_ewm"
    )
    return out.select("user_id", *rounded(6, "value_ewm"))


@query(
    "group_score_stats",
    """
    SELECT user_id, event_type, round(avg(value), 6) AS score_mean, max(value) AS score_max,
           min(value) AS score_min, round(stddev_samp(value), 6) AS score_std
    FROM events GROUP BY 1, 2
    """,
)
def group_score_stats(spark, sf):
    value = F.col("value")
    return G.to_parent(
        table(spark, sf, "events"),
        ["user_id", "event_type"],
        {
            "score_mean": F.round(A.mean(value), 6),
            "score_max": A.high(value),
            "score_min": A.low(value),
            "score_std": F.round(A.spread(value), 6),
        },
    )


@query(
    "trend_deltas",
    f"""
    SELECT user_id,
           round(coalesce(max(value) FILTER (days >= -6), 0)
                 - coalesce(max(value) FILTER (days < -6), 0), 6) AS high_accel,
           round(coalesce(avg(CAST(event_type = 'error' AS INTEGER)) FILTER (days >= -6), 0)
                 - coalesce(avg(CAST(event_type = 'error' AS INTEGER)), 0), 6) AS error_delta,
           round(coalesce(sum(CAST(event_type = 'error' AS INTEGER)) FILTER (days >= -6), 0)
                 / (count(*) FILTER (days >= -6) + 1e-8), 6) AS error_velocity
    FROM (SELECT *, {EVENT_DAYS} AS days FROM events) GROUP BY 1
    """,
)
def trend_deltas(spark, sf):
    recent, value = F.col("days") >= -6, F.col("value")
    error = F.col("event_type") == "error"
    wide = G.to_parent(
        _events(spark, sf),
        "user_id",
        {
            "high_now": A.high(value, recent),
            "high_then": A.high(value, F.col("days") < -6),
            "error_now": A.share(error, recent),
            "error_all": A.share(error),
            "n_error": A.tally(error, recent),
            "n": A.rows(recent),
        },
    )
    or_zero = lambda c: F.coalesce(c, F.lit(0))
    return wide.select(
        "user_id",
        *rounded(
            6,
            high_accel=or_zero("high_now") - or_zero("high_then"),
            error_delta=or_zero("error_now") - or_zero("error_all"),
            error_velocity=X.guarded_ratio(or_zero("n_error"), or_zero("n"), 1e-8),
        ),
    )


@query(
    "semi_split",
    """
    SELECT o_orderkey, o_custkey, o_totalprice, 'train' AS origin FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
    UNION ALL
    SELECT o_orderkey, o_custkey, o_totalprice, 'test' FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal <= 0)
    """,
)
def semi_split(spark, sf):
    customers = table(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    parts = {"train": F.col("c_acctbal") > 0, "test": F.col("c_acctbal") <= 0}
    train, test = (
        only_members(orders, customers.filter(p), "o_custkey").withColumn("origin", F.lit(name))
        for name, p in parts.items()
    )
    return train.unionByName(test, allowMissingColumns=True)


@query(
    "status_pivot",
    f"""
    SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS n_refused_2y,
           count(*) FILTER (o_orderstatus = 'O') AS n_open_2y,
           count(*) FILTER (o_orderstatus = 'P') AS n_pending_2y
    FROM orders WHERE {ORDER_DAYS} >= -730 GROUP BY 1
    """,
)
def status_pivot(spark, sf):
    names = {"F": "n_refused_2y", "O": "n_open_2y", "P": "n_pending_2y"}
    return G.status_pivot(
        _orders(spark, sf), "o_custkey", "o_orderstatus", names, F.col("days") >= -730
    )


@query(
    "debt_acceleration",
    f"""
    SELECT o_custkey,
           round((coalesce(sum(o_totalprice) FILTER (days >= -365), 0) / 365.0)
             / (coalesce(sum(o_totalprice) FILTER (days < -365 AND days >= -1095), 0) / 730.0 + 1),
             6) AS debt_accel
    FROM (SELECT *, {ORDER_DAYS} AS days FROM orders) GROUP BY 1
    """,
)
def debt_acceleration(spark, sf):
    price, days = F.col("o_totalprice"), F.col("days")
    wide = G.to_parent(
        _orders(spark, sf),
        "o_custkey",
        {
            "now": F.coalesce(A.total(price, days >= -365), F.lit(0)),
            "then": F.coalesce(A.total(price, (days < -365) & (days >= -1095)), F.lit(0)),
        },
    )
    accel = X.guarded_ratio(F.col("now") / 365.0, F.col("then") / 730.0, 1)
    return wide.select("o_custkey", *rounded(6, debt_accel=accel))


@query(
    "weighted_util",
    f"""
    SELECT user_id, round(sum(value * w) FILTER (days >= -12)
                          / sum(CASE WHEN value IS NOT NULL THEN w END) FILTER (days >= -12), 6)
             AS util_weighted
    FROM (SELECT user_id, nullif(value, 0) AS value, days, exp(-0.01 * abs(days)) AS w
          FROM (SELECT *, {EVENT_DAYS} AS days FROM events))
    GROUP BY 1
    """,
)
def weighted_util(spark, sf):
    days = F.col("days")
    value = F.nullif(F.col("value"), F.lit(0.0))
    util = G.weighted_mean(value, X.decayed(F.lit(1.0), days), days >= -12)
    return G.to_parent(_events(spark, sf), "user_id", {"util_weighted": F.round(util, 6)})


@query(
    "mean_of_means",
    """
    SELECT o_custkey, round(avg(m), 3) AS deficit_mean
    FROM (SELECT o_custkey, o_orderkey, avg(l_extendedprice * l_discount) AS m
          FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2)
    GROUP BY 1
    """,
)
def mean_of_means(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_extendedprice", "l_discount"
    )
    deficit = F.col("l_extendedprice") * F.col("l_discount")
    per_order = G.to_parent(lines, "o_orderkey", {"m": A.mean(deficit)})
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    out = G.to_parent(
        per_order.join(orders, "o_orderkey"), "o_custkey", {"deficit_mean": A.mean(F.col("m"))}
    )
    return out.select("o_custkey", *rounded(3, "deficit_mean"))


@query(
    "grandparent_rows",
    """
    SELECT l_orderkey, l_partkey, l_quantity, l_shipdate, o_custkey
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    """,
)
def grandparent_rows(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_shipdate"
    )
    bridge = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    return with_group_key(lines, bridge, "l_orderkey", ["o_custkey"])


@query(
    "event_mean_of_means",
    """
    SELECT user_id, round(avg(m), 6) AS value_mean
    FROM (SELECT user_id, event_type, avg(value) AS m FROM events GROUP BY 1, 2) GROUP BY 1
    """,
)
def event_mean_of_means(spark, sf):
    out = G.mean_of_means(
        table(spark, sf, "events"), "event_type", "user_id", F.col("value"), "value_mean"
    )
    return out.select("user_id", *rounded(6, "value_mean"))


@query(
    "residual_feature",
    f"""
    SELECT o_orderkey, round(o_totalprice - p, 6) AS price_residual
    FROM orders JOIN (SELECT o_orderpriority, round({money_mean_sql("o_totalprice")}, 6) AS p
                      FROM orders GROUP BY 1)
    USING (o_orderpriority)
    """,
)
def residual_feature(spark, sf):
    orders = table(spark, sf, "orders")
    means = G.to_parent(
        orders, "o_orderpriority", {"PRED_PRICE": A.mean(money("o_totalprice"))}
    )
    rows = attach(orders, means, ["o_orderpriority"]).withColumn(
        "PRED_PRICE", F.col("PRED_PRICE").cast("double")
    )
    out = X.residual(rows, "o_totalprice", "PRED_PRICE", "price_residual")
    return out.select("o_orderkey", *rounded(6, "price_residual"))


PROBS = [0.05, 0.25, 0.5, 0.75, 0.95]


@query(
    "quantile_sketch",
    f"""
    SELECT event_type, p, count(value) AS n, TRUE AS within
    FROM events, (SELECT CAST(unnest({PROBS}) AS DOUBLE) AS p) GROUP BY 1, 2
    """,
)
def quantile_sketch(spark, sf):
    """Sketches per kind and user, merged per kind; the true ranks of their quantiles."""
    events = table(spark, sf, "events")
    fine = S.quantile_sketches(events, "value", ["event_type", "user_id"])
    found = S.quantiles(S.merged(fine, ["event_type"]), PROBS)
    asked = found.select(
        "event_type",
        F.explode(
            F.arrays_zip(F.array(*[F.lit(p) for p in PROBS]).alias("p"), F.col("quantiles").alias("v"))
        ).alias("x"),
    ).select("event_type", "x.p", "x.v")
    below, until = (F.avg(c.cast("double")) for c in (F.col("value") < F.col("v"),
                                                      F.col("value") <= F.col("v")))
    # One row per kind and quantile.
    return events.join(F.broadcast(settle(asked)), "event_type").groupBy("event_type", "p").agg(
        F.count("value").alias("n"),
        ((below - 2 * S.rank_error() <= F.col("p")) & (F.col("p") <= until + 2 * S.rank_error()))
        .alias("within"),
    )


@query(
    "sketched_ranks", "SELECT count(value) AS n, TRUE AS within FROM events"
)
def sketched_ranks(spark, sf):
    """Percentile ranks read off a sketch against the exact ones."""
    rows = table(spark, sf, "events").select("event_id", "value", F.col("value").alias("again"))
    both = rank_normalize(S.rank_columns(rows, ["value"], "_near"), ["again"], "_exact")
    off = F.abs(F.col("value_near") - F.col("again_exact"))
    return both.agg(
        F.count("value_near").alias("n"), (F.max(off) <= 2 * S.rank_error()).alias("within")
    )
