"""Credit-shaped tables derived from the star-schema tables, row for row.

The text runs unchanged on Spark and DuckDB but for the day difference, so a check can state its
input once. Amounts are whole numbers, which keeps sums and means exact in both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.plans.registry import EVENTS_AS_OF, ORDERS_AS_OF, days_sql


def _days_spark(column: str, as_of: str) -> str:
    return f"datediff(CAST({column} AS DATE), DATE '{as_of}')"


def statements(days=days_sql) -> dict[str, str]:
    """One SELECT per credit table."""
    order_days = days("o_orderdate", ORDERS_AS_OF)
    ship_days = days("l_shipdate", ORDERS_AS_OF)
    event_days = days("ts", EVENTS_AS_OF)
    amount = "floor(o_totalprice / 100)"
    application = """
      SELECT CAST(c_custkey AS INT) AS SK_ID_CURR, CAST(c_acctbal < 1500 AS INT) AS TARGET,
             CAST(CASE WHEN c_custkey % 7 = 0 THEN 365243 ELSE -(c_custkey * 37 % 12000) END AS INT)
               AS DAYS_EMPLOYED,
             CAST(-(9000 + c_custkey * 53 % 15000) AS INT) AS DAYS_BIRTH,
             CAST(CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE -(c_custkey * 29 % 4000) END AS DOUBLE)
               AS DAYS_LAST_PHONE_CHANGE,
             CAST(-(c_custkey * 31 % 6000) AS INT) AS DAYS_ID_PUBLISH,
             CAST(-(c_custkey * 41 % 9000) AS INT) AS DAYS_REGISTRATION,
             CASE c_nationkey % 5 WHEN 0 THEN 'XNA' WHEN 1 THEN 'F' WHEN 2 THEN 'F' ELSE 'M' END
               AS CODE_GENDER,
             c_mktsegment AS OCCUPATION_TYPE,
             CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey * 13 % 64 AS DOUBLE) END
               AS OWN_CAR_AGE,
             CAST(1000 + c_custkey * 71 % 9000 AS DOUBLE) AS AMT_INCOME_TOTAL,
             CAST(2000 + c_custkey * 97 % 40000 AS DOUBLE) AS AMT_CREDIT,
             CASE WHEN c_custkey % 13 = 0 THEN NULL
                  ELSE CAST(100 + c_custkey * 19 % 1500 AS DOUBLE) END AS AMT_ANNUITY,
             CAST(1500 + c_custkey * 89 % 38000 AS DOUBLE) AS AMT_GOODS_PRICE,
             CAST(1 + c_custkey % 5 AS DOUBLE) AS CNT_FAM_MEMBERS,
             CAST(c_custkey % 4 AS INT) AS CNT_CHILDREN,
             CAST(c_nationkey + 1 AS DOUBLE) / 32 AS REGION_POPULATION_RELATIVE,
             CASE WHEN c_custkey % 2 = 0 THEN NULL
                  ELSE CAST(c_custkey * 17 % 128 AS DOUBLE) / 128 END AS EXT_SOURCE_1,
             floor((c_acctbal + 1000) / 50) / 256 AS EXT_SOURCE_2,
             CASE WHEN c_custkey % 5 = 0 THEN NULL
                  ELSE CAST(c_custkey * 23 % 256 AS DOUBLE) / 256 END AS EXT_SOURCE_3,
             CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE CAST(c_custkey % 3 AS DOUBLE) END
               AS AMT_REQ_CREDIT_BUREAU_MON,
             CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE CAST(c_custkey % 6 AS DOUBLE) END
               AS AMT_REQ_CREDIT_BUREAU_YEAR,
             1 AS FLAG_MOBIL, CAST(c_custkey % 2 AS INT) AS FLAG_DOCUMENT_2,
             CAST(c_custkey % 2 AS INT) AS FLAG_DOCUMENT_3,
             CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 1 END AS FLAG_DOCUMENT_8
      FROM customer
    """
    bureau = f"""
      SELECT CAST(o_orderkey AS INT) AS SK_ID_BUREAU, CAST(o_custkey AS INT) AS SK_ID_CURR,
             CASE o_orderstatus WHEN 'O' THEN 'Active' ELSE 'Closed' END AS CREDIT_ACTIVE,
             CAST({order_days} AS INT) AS DAYS_CREDIT,
             CAST(o_orderkey % 40 AS INT) AS CREDIT_DAY_OVERDUE,
             CAST(o_orderkey % 3 AS INT) AS CNT_CREDIT_PROLONG,
             CAST({order_days} + o_orderkey % 50 AS INT) AS DAYS_CREDIT_UPDATE,
             CASE WHEN o_orderkey % 6 = 0 THEN NULL
                  ELSE CAST({order_days} + 300 AS DOUBLE) END AS DAYS_CREDIT_ENDDATE,
             CASE o_orderstatus WHEN 'O' THEN NULL
                  ELSE CAST({order_days} + o_orderkey % 400 AS DOUBLE) END AS DAYS_ENDDATE_FACT,
             CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE {amount} * 1.0E0 END AS AMT_CREDIT_SUM,
             CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE floor(o_totalprice / 300) * 1.0E0 END
               AS AMT_CREDIT_SUM_DEBT,
             CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE floor(o_totalprice / 500) * 1.0E0 END
               AS AMT_CREDIT_SUM_LIMIT,
             CAST(o_orderkey % 90 AS DOUBLE) AS AMT_CREDIT_SUM_OVERDUE
      FROM orders
    """
    balance = f"""
      SELECT CAST(l_orderkey AS INT) AS SK_ID_BUREAU,
             CAST(floor({ship_days} / 30.0E0) AS INT) AS MONTHS_BALANCE,
             CASE WHEN l_returnflag = 'A' THEN 'C' WHEN l_returnflag = 'N' AND l_linenumber > 2 THEN 'X'
                  WHEN l_quantity > 48 THEN NULL ELSE CAST(l_partkey % 6 AS STRING) END AS STATUS
      FROM lineitem
    """
    installments = f"""
      SELECT CAST(l_orderkey AS INT) AS SK_ID_PREV, CAST(o_custkey AS INT) AS SK_ID_CURR,
             nullif(CAST(l_linenumber % 5 AS DOUBLE), 4.0E0) AS NUM_INSTALMENT_VERSION,
             CAST({ship_days} AS DOUBLE) AS DAYS_INSTALMENT,
             CASE WHEN l_quantity > 49 THEN NULL
                  ELSE CAST({ship_days} + l_partkey % 9 - 6 AS DOUBLE) END AS DAYS_ENTRY_PAYMENT,
             floor(l_extendedprice / 16) * 1.0E0 AS AMT_INSTALMENT,
             CASE WHEN l_quantity > 49 THEN NULL
                  ELSE floor(l_extendedprice / 16) - (l_suppkey % 3) * 1.0E0 END AS AMT_PAYMENT
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    """
    card = f"""
      SELECT CAST(user_id * 10 + event_id % 3 AS INT) AS SK_ID_PREV,
             CAST(user_id AS INT) AS SK_ID_CURR,
             CAST({event_days} AS INT) AS MONTHS_BALANCE, floor(value) * 1.0E0 AS AMT_BALANCE,
             event_id % 4 * 256 AS AMT_CREDIT_LIMIT_ACTUAL,
             CASE WHEN event_type = 'error' THEN NULL ELSE floor(value * 2) * 1.0E0 END
               AS AMT_DRAWINGS_CURRENT,
             floor(value / 2) * 1.0E0 AS AMT_PAYMENT_CURRENT,
             CAST(event_id % 7 AS INT) AS CNT_DRAWINGS_CURRENT, CAST(event_id % 5 AS INT) AS SK_DPD
      FROM events
    """
    pos = f"""
      SELECT CAST(user_id * 10 + event_id % 3 AS INT) AS SK_ID_PREV,
             CAST(user_id AS INT) AS SK_ID_CURR,
             CAST({event_days} AS INT) AS MONTHS_BALANCE, CAST(event_id % 11 AS INT) AS SK_DPD,
             CAST(event_id % 4 AS INT) AS SK_DPD_DEF,
             nullif(CAST(event_id % 24 AS DOUBLE), 0.0E0) AS CNT_INSTALMENT_FUTURE,
             CASE event_type WHEN 'purchase' THEN 'Completed' ELSE event_type END
               AS NAME_CONTRACT_STATUS
      FROM events
    """
    previous = f"""
      SELECT CAST(o_orderkey AS INT) AS SK_ID_PREV, CAST(o_custkey AS INT) AS SK_ID_CURR,
             {amount} * 1.0E0 AS AMT_CREDIT,
             CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE floor(o_totalprice / 1200) * 1.0E0 END
               AS AMT_ANNUITY,
             nullif(floor(o_totalprice / 700) * 1.0E0, 0.0E0) AS AMT_DOWN_PAYMENT,
             CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 50 AS DOUBLE) / 50 END
               AS RATE_DOWN_PAYMENT,
             CAST(6 + o_orderkey % 6 * 6 AS DOUBLE) AS CNT_PAYMENT,
             CAST({order_days} AS INT) AS DAYS_DECISION,
             CASE o_orderstatus WHEN 'F' THEN 'Refused' ELSE 'Approved' END AS NAME_CONTRACT_STATUS
      FROM orders
    """
    return {
        "application": application,
        "bureau": bureau,
        "bureau_balance": balance,
        "installments_payments": installments,
        "credit_card_balance": card,
        "POS_CASH_balance": pos,
        "previous_application": previous,
    }


SOURCES = ("customer", "orders", "lineitem", "events")


def credit_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The credit tables as lazy frames over the Parquet files."""
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in SOURCES}
    out = {}
    for name, text in statements(_days_spark).items():
        for source in SOURCES:
            text = text.replace(f"FROM {source}", f"FROM {{{source}}}")
            text = text.replace(f"JOIN {source}", f"JOIN {{{source}}}")
        out[name] = spark.sql(text, **{t: f for t, f in frames.items() if f"{{{t}}}" in text})
    return out
