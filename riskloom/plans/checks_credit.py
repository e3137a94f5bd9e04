"""Queries for the credit feature set over credit-shaped tables derived from the given ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import clean
from riskloom.plans import credit
from riskloom.plans.registry import query
from riskloom.plans.standins import credit_tables, statements

KEY = credit.APPLICANT
TABLES = statements()


def _comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Numbers as doubles, rounded; text and the key as they are."""
    kept = {KEY, *[c for c, kind in df.dtypes if kind == "string"]}
    return df.select(
        *[
            F.col(c) if c in kept else F.round(F.col(c).cast("double"), digits).alias(c)
            for c in df.columns
        ]
    )


def _shown(columns: dict[str, str], digits: int = 6) -> str:
    return ", ".join(
        f"round(CAST({text} AS DOUBLE), {digits}) AS {name}" for name, text in columns.items()
    )


def _late(members: str) -> dict[str, str]:
    inside = f"CAST(STATUS IN ({members}) AS INT)"
    return {"COUNT": f"coalesce(sum({inside}), 0)", "FRAC": f"avg({inside})"}


def _balance_sql() -> str:
    columns = {
        "BB_MONTHS_COUNT": "count(*)",
        "BB_MONTHS_BALANCE_MIN": "min(MONTHS_BALANCE)",
        "BB_MONTHS_BALANCE_MAX": "max(MONTHS_BALANCE)",
        "BB_STATUS_C_FRAC": "avg(CAST(STATUS = 'C' AS INT))",
        "BB_FIRST_STATUS_SEVERITY": "arg_min(sev, MONTHS_BALANCE * 16 + sev)",
        "BB_LAST_STATUS_SEVERITY": "arg_max(sev, MONTHS_BALANCE * 16 + sev)",
        "BB_WHEN_CLOSED_MONTH_ABS": "min(CASE WHEN STATUS = 'C' THEN abs(MONTHS_BALANCE) END)",
        "BB_MONTH_CLOSED_TO_END": "abs(max(MONTHS_BALANCE)) "
        "- min(CASE WHEN STATUS = 'C' THEN abs(MONTHS_BALANCE) END)",
    }
    groups = {"LATE": "'1','2','3','4','5'", "SEVERE": "'3','4','5'"}
    groups |= {str(i): f"'{i}'" for i in range(6)}
    for name, members in groups.items():
        for kind, text in _late(members).items():
            columns[f"BB_STATUS_{name}_{kind}"] = text
    inner = ", ".join(f"{t} AS {n}" for n, t in columns.items())
    return f"""
      SELECT SK_ID_BUREAU, {inner}
      FROM (SELECT *, CASE STATUS WHEN 'C' THEN -1 WHEN 'X' THEN 0
                      ELSE coalesce(try_cast(STATUS AS INT), 0) END AS sev
            FROM ({TABLES["bureau_balance"]})) GROUP BY 1"""


def _bureau_sql() -> str:
    active = "CREDIT_ACTIVE = 'Active'"

    def when_active(text: str) -> str:
        return f"CASE WHEN count(*) FILTER ({active}) > 0 THEN {text} FILTER ({active}) END"

    columns = {
        "BUREAU_DAYS_CREDIT_MIN": "min(DAYS_CREDIT)",
        "BUREAU_DAYS_CREDIT_MEAN": "avg(DAYS_CREDIT)",
        "BUREAU_AMT_CREDIT_SUM": "coalesce(sum(AMT_CREDIT_SUM), 0)",
        "BUREAU_AMT_CREDIT_MEAN": "avg(AMT_CREDIT_SUM)",
        "BUREAU_DEBT_SUM": "coalesce(sum(AMT_CREDIT_SUM_DEBT), 0)",
        "BUREAU_MAX_OVERDUE": "max(CREDIT_DAY_OVERDUE)",
        "BUREAU_PROLONG_SUM": "coalesce(sum(CNT_CREDIT_PROLONG), 0)",
        "BUREAU_ACTIVE_COUNT": f"count(*) FILTER ({active})",
        "BUREAU_BB_MONTHS_MEAN": "avg(BB_MONTHS_COUNT)",
        "BUREAU_LATE_STATUS_SUM": "coalesce(sum(BB_STATUS_LATE_COUNT), 0)",
        "BUREAU_BB_LATE_FRAC_MEAN": "avg(BB_STATUS_LATE_FRAC)",
        "BUREAU_BB_SEVERE_STATUS_SUM": "coalesce(sum(BB_STATUS_SEVERE_COUNT), 0)",
        "BUREAU_BB_SEVERE_FRAC_MEAN": "avg(BB_STATUS_SEVERE_FRAC)",
        "BUREAU_BB_FIRST_STATUS_SEV_MEAN": "avg(BB_FIRST_STATUS_SEVERITY)",
        "BUREAU_BB_LAST_STATUS_SEV_MEAN": "avg(BB_LAST_STATUS_SEVERITY)",
        "BUREAU_BB_LAST_STATUS_SEV_MAX": "max(BB_LAST_STATUS_SEVERITY)",
        "BUREAU_BB_MONTH_CLOSED_TO_END_MEAN": "avg(BB_MONTH_CLOSED_TO_END)",
        "BUREAU_CREDIT_MINUS_DEBT_MEAN": "avg(AMT_CREDIT_SUM - AMT_CREDIT_SUM_DEBT)",
        "BUREAU_CREDIT_MINUS_DEBT_SUM": "coalesce(sum(AMT_CREDIT_SUM - AMT_CREDIT_SUM_DEBT), 0)",
        "BUREAU_CREDIT_MINUS_LIMIT_MEAN": "avg(AMT_CREDIT_SUM - AMT_CREDIT_SUM_LIMIT)",
        "BUREAU_CREDIT_MINUS_LIMIT_SUM": "coalesce(sum(AMT_CREDIT_SUM - AMT_CREDIT_SUM_LIMIT), 0)",
        "BUREAU_CREDIT_MINUS_OVERDUE_MEAN": "avg(AMT_CREDIT_SUM - AMT_CREDIT_SUM_OVERDUE)",
        "BUREAU_DEBT_CREDIT_RATIO_MEAN": "avg(AMT_CREDIT_SUM_DEBT / (AMT_CREDIT_SUM + 1e-8))",
        "BUREAU_DEBT_CREDIT_RATIO_MAX": "max(AMT_CREDIT_SUM_DEBT / (AMT_CREDIT_SUM + 1e-8))",
        "BUREAU_OVERDUE_CREDIT_RATIO_MEAN":
            "avg(AMT_CREDIT_SUM_OVERDUE / (AMT_CREDIT_SUM + 1e-8))",
        "BUREAU_DAYS_CREDIT_OVERDUE_GAP_MEAN": "avg(DAYS_CREDIT - CREDIT_DAY_OVERDUE)",
        "BUREAU_DAYS_CREDIT_ENDDATE_GAP_MEAN": "avg(DAYS_CREDIT - DAYS_CREDIT_ENDDATE)",
        "BUREAU_DAYS_CREDIT_FACT_GAP_MEAN": "avg(DAYS_CREDIT - DAYS_ENDDATE_FACT)",
        "BUREAU_ENDDATE_FACT_GAP_MEAN": "avg(DAYS_CREDIT_ENDDATE - DAYS_ENDDATE_FACT)",
        "BUREAU_UPDATE_ENDDATE_GAP_MEAN": "avg(DAYS_CREDIT_UPDATE - DAYS_CREDIT_ENDDATE)",
        "ACTIVE_CREDIT_SUM": when_active("sum(coalesce(AMT_CREDIT_SUM, 0))"),
        "ACTIVE_CREDIT_COUNT": when_active("count(*)"),
    }
    aged = when_active("sum(coalesce(AMT_CREDIT_SUM * exp(abs(DAYS_CREDIT) * -0.01), 0))")
    columns["ACTIVE_CREDIT_SUM_DECAYED"] = f"round({aged}, 5)"
    for i in range(6):
        columns[f"BUREAU_BB_STATUS_{i}_COUNT_SUM"] = f"coalesce(sum(BB_STATUS_{i}_COUNT), 0)"
        columns[f"BUREAU_BB_STATUS_{i}_FRAC_MEAN"] = f"avg(BB_STATUS_{i}_FRAC)"
    return f"""
      SELECT SK_ID_CURR, {_shown(columns, 8)}
      FROM ({TABLES["bureau"]}) LEFT JOIN ({_balance_sql()}) USING (SK_ID_BUREAU) GROUP BY 1"""


def _installments_sql() -> str:
    ratio = "AMT_PAYMENT / (AMT_INSTALMENT + 1e-8)"
    late_days = "(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT)"
    is_late = "CAST(DAYS_ENTRY_PAYMENT > DAYS_INSTALMENT AS INT)"
    partial = "CAST(AMT_PAYMENT > 0 AND AMT_PAYMENT < AMT_INSTALMENT AS INT)"
    aged = f"{late_days} * exp(abs(DAYS_INSTALMENT) * -0.01)"
    columns = {
        "INST_PAYMENT_DIFF_MEAN": "avg(AMT_INSTALMENT - AMT_PAYMENT)",
        "INST_PAYMENT_DIFF_SUM": "coalesce(sum(AMT_INSTALMENT - AMT_PAYMENT), 0)",
        "INST_PAYMENT_RATIO_MEAN": f"avg({ratio})",
        "INST_DAYS_LATE_MAX": f"max({late_days})",
        "INST_DAYS_LATE_MEAN": f"avg({late_days})",
        "INST_LATE_FRAC": f"avg({is_late})",
        "INST_MAX_INSTALMENT": "max(AMT_INSTALMENT)",
        "INST_TOTAL_PAID": "coalesce(sum(AMT_PAYMENT), 0)",
        "INST_FRACTIONAL_PAY_COUNT": f"coalesce(sum({partial}), 0)",
        "INST_FRACTIONAL_PAY_FRAC": f"avg({partial})",
        "INST_EWMA_LATE_SUM": f"coalesce(sum({aged}), 0)",
        "INST_EWMA_LATE_MEAN": f"avg({aged})",
        "INST_DEFICIT_MEAN_3Y": "avg(AMT_PAYMENT - AMT_INSTALMENT) FILTER (DAYS_INSTALMENT > -1000)",
    }
    for years in (1, 2):
        seen = f"FILTER (DAYS_INSTALMENT >= -{365 * years})"
        tag = f"INST_{years}YR"
        columns |= {
            f"{tag}_PAYMENT_RATIO_MEAN": f"avg({ratio}) {seen}",
            f"{tag}_PAYMENT_RATIO_MIN": f"min({ratio}) {seen}",
            f"{tag}_DAYS_LATE_MEAN": f"avg({late_days}) {seen}",
            f"{tag}_DAYS_LATE_MAX": f"max({late_days}) {seen}",
            f"{tag}_LATE_FRAC": f"avg({is_late}) {seen}",
            f"{tag}_COUNT": f"nullif(count(*) {seen}, 0)",
        }
    columns["INST_1YR_LATE_FRAC_DELTA"] = (
        f"coalesce({columns['INST_1YR_LATE_FRAC']}, 0) - coalesce(avg({is_late}), 0)"
    )
    return f"""
      WITH i AS ({TABLES["installments_payments"]}), loans AS (
        SELECT SK_ID_CURR, sum(many) AS c, avg(many) AS f
        FROM (SELECT SK_ID_CURR, SK_ID_PREV,
                     CAST(count(DISTINCT NUM_INSTALMENT_VERSION)
                          + max(CAST(NUM_INSTALMENT_VERSION IS NULL AS INT)) > 2 AS INT) AS many
              FROM i GROUP BY 1, 2) GROUP BY 1)
      SELECT w.*, round(CAST(c AS DOUBLE), 6) AS INST_RESTRUCTURED_COUNT,
             round(f, 6) AS INST_RESTRUCTURED_FRAC
      FROM (SELECT SK_ID_CURR, {_shown(columns)} FROM i GROUP BY 1) w
      LEFT JOIN loans USING (SK_ID_CURR)"""


def _card_sql() -> str:
    recent = "FILTER (MONTHS_BALANCE >= -12)"
    columns = {
        "CC_UTIL_MEAN_ALL": "avg(u)",
        "CC_UTIL_MAX_ALL": "max(u)",
        "CC_PAYMENT_MEAN": "avg(AMT_PAYMENT_CURRENT)",
        "CC_DPD_MAX": "max(SK_DPD)",
        "CC_DPD_MEAN": "avg(SK_DPD)",
        "CC_DRAWINGS_COUNT": "coalesce(sum(CNT_DRAWINGS_CURRENT), 0)",
        "CC_UTIL_MEAN_12M": f"avg(u) {recent}",
        "CC_DRAWINGS_12M": f"CASE WHEN count(*) {recent} > 0 "
        f"THEN coalesce(sum(AMT_DRAWINGS_CURRENT) {recent}, 0) END",
        "CC_UTIL_P95_12M": f"list_sort(list(u) {recent})"
        f"[CAST(round(0.95 * (count(u) {recent} - 1)) AS INT) + 1]",
    }
    return f"""
      SELECT SK_ID_CURR, {_shown(columns)}
      FROM (SELECT *, AMT_BALANCE / (AMT_CREDIT_LIMIT_ACTUAL + 1e-8) AS u
            FROM ({TABLES["credit_card_balance"]}) WHERE AMT_CREDIT_LIMIT_ACTUAL > 0)
      GROUP BY 1"""


def _pos_sql() -> str:
    columns = {
        "POS_DPD_MAX": "max(SK_DPD)",
        "POS_DPD_MEAN": "avg(SK_DPD)",
        "POS_DPD_DEF_MAX": "max(SK_DPD_DEF)",
        "POS_CNT_INSTALMENT_FUTURE_MEAN": "avg(CNT_INSTALMENT_FUTURE)",
        "POS_MONTHS_COUNT": "count(MONTHS_BALANCE)",
        "POS_COMPLETED_FRAC": "avg(CAST(NAME_CONTRACT_STATUS = 'Completed' AS INT))",
        "POS_DPD_MAX_6M": "max(SK_DPD) FILTER (MONTHS_BALANCE >= -6)",
        "POS_DPD_MAX_PRIOR": "max(SK_DPD) FILTER (MONTHS_BALANCE < -6)",
        "POS_DPD_EMA_3M": "sum(SK_DPD * w) / sum(w)",
        "POS_DPD_ACCELERATION": "coalesce(max(SK_DPD) FILTER (MONTHS_BALANCE >= -6), 0) "
        "- coalesce(max(SK_DPD) FILTER (MONTHS_BALANCE < -6), 0)",
    }
    return f"""
      SELECT SK_ID_CURR, {_shown(columns)}
      FROM (SELECT *, pow(0.5, (row_number() OVER (PARTITION BY SK_ID_CURR
                   ORDER BY MONTHS_BALANCE DESC, SK_ID_PREV DESC, SK_DPD DESC) - 1) / 3.0) AS w
            FROM ({TABLES["POS_CASH_balance"]}))
      GROUP BY 1"""


def _previous_sql() -> str:
    recent = "FILTER (DAYS_DECISION >= -730)"
    refused = "CAST(NAME_CONTRACT_STATUS = 'Refused' AS INT)"
    columns = {
        "PREV_AMT_CREDIT_MEAN": "avg(AMT_CREDIT)",
        "PREV_AMT_ANNUITY_MEAN": "avg(AMT_ANNUITY)",
        "PREV_DOWN_PAYMENT_MEAN": "avg(AMT_DOWN_PAYMENT)",
        "PREV_DAYS_DECISION_MAX": "max(DAYS_DECISION)",
        "PREV_CNT_PAYMENT_MEAN": "avg(CNT_PAYMENT)",
        "PREV_TOTAL_APPS": "count(*)",
        "PREV_REFUSED_FRAC": f"avg({refused})",
        "PREV_RATE_DOWN_MEAN": "avg(RATE_DOWN_PAYMENT)",
        "PREV_2YR_TOTAL_APPS": f"nullif(count(*) {recent}, 0)",
        "PREV_2YR_REFUSED_COUNT": f"sum({refused}) {recent}",
        "PREV_2YR_REFUSED_VELOCITY": f"coalesce(sum({refused}) {recent}, 0) "
        f"/ (count(*) {recent} + 1e-8)",
    }
    return f"""
      SELECT SK_ID_CURR, {_shown(columns)} FROM ({TABLES["previous_application"]}) GROUP BY 1"""


def _clean_sql() -> str:
    days = ["DAYS_BIRTH", "DAYS_LAST_PHONE_CHANGE", "DAYS_ID_PUBLISH", "DAYS_REGISTRATION"]
    changed = ", ".join(f"abs({d}) AS {d}" for d in days)
    return f"""
      SELECT * EXCLUDE (FLAG_MOBIL, FLAG_DOCUMENT_2, cap) REPLACE (
               {changed}, abs(nullif(DAYS_EMPLOYED, 365243)) AS DAYS_EMPLOYED,
               nullif(CODE_GENDER, 'XNA') AS CODE_GENDER,
               CASE WHEN OWN_CAR_AGE > cap THEN cap ELSE OWN_CAR_AGE END AS OWN_CAR_AGE),
             ln(1 + AMT_INCOME_TOTAL) AS AMT_INCOME_TOTAL_LOG
      FROM ({TABLES["application"]}) CROSS JOIN (
        SELECT s[CAST(round(0.99 * (len(s) - 1)) AS INT) + 1] AS cap
        FROM (SELECT list_sort(list(OWN_CAR_AGE)) AS s FROM ({TABLES["application"]})
              WHERE OWN_CAR_AGE IS NOT NULL))"""


CLEAN_NUMBERS = [
    "TARGET", "DAYS_EMPLOYED", "DAYS_BIRTH", "DAYS_LAST_PHONE_CHANGE", "DAYS_ID_PUBLISH",
    "DAYS_REGISTRATION", "OWN_CAR_AGE", "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY",
    "AMT_GOODS_PRICE", "CNT_FAM_MEMBERS", "CNT_CHILDREN", "REGION_POPULATION_RELATIVE",
    "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "AMT_REQ_CREDIT_BUREAU_MON",
    "AMT_REQ_CREDIT_BUREAU_YEAR", "FLAG_DOCUMENT_3", "FLAG_DOCUMENT_8", "AMT_INCOME_TOTAL_LOG",
]


def _ratios(source: str) -> dict[str, str]:
    known = " + ".join(f"CAST(EXT_SOURCE_{i} IS NOT NULL AS INT)" for i in (1, 2, 3))
    total = " + ".join(f"coalesce(EXT_SOURCE_{i}, 0)" for i in (1, 2, 3))
    return {
        "EXT_SRC_PROD": "EXT_SOURCE_1 * EXT_SOURCE_2 * EXT_SOURCE_3",
        "EXT_SRC_MEAN": f"({total}) / nullif({known}, 0)",
        "EXT_SRC_MIN": "least(EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3)",
        "EXT1_AGE_RATIO": "EXT_SOURCE_1 / (DAYS_BIRTH / -365.25 + 1e-8)",
        "EXT1_INCOME_RATIO": "EXT_SOURCE_1 / (AMT_INCOME_TOTAL + 1e-8)",
        "CREDIT_EXT3_RATIO":
            "AMT_CREDIT / (EXT_SOURCE_3 + 1e-8) / CASE WHEN EXT_SOURCE_3 > 0 THEN 1 ELSE 1e8 END",
        "EXT2_EMPLOYED_PROD": "EXT_SOURCE_2 * DAYS_EMPLOYED",
        "LOAN_TERM_MONTHS": "AMT_CREDIT / (AMT_ANNUITY + 1e-8)",
        "INCOME_PER_FAMILY_MEMBER": "AMT_INCOME_TOTAL / (CNT_FAM_MEMBERS + 1)",
        "PHONE_CHANGE_STABILITY": "DAYS_LAST_PHONE_CHANGE / (DAYS_BIRTH + 1)",
        "CREDIT_INCOME_RATIO": "AMT_CREDIT / (AMT_INCOME_TOTAL + 1)",
        "ANNUITY_INCOME_RATIO": "AMT_ANNUITY / (AMT_INCOME_TOTAL + 1)",
        "GOODS_INCOME_RATIO": "AMT_GOODS_PRICE / (AMT_INCOME_TOTAL + 1)",
        "GOODS_CREDIT_RATIO": "AMT_CREDIT / (AMT_GOODS_PRICE + 1)",
        "DOWNPAYMENT_INCOME_STRAIN": "(AMT_GOODS_PRICE - AMT_CREDIT) / (AMT_INCOME_TOTAL + 1)",
        "CREDIT_SEEK_VELOCITY": "AMT_REQ_CREDIT_BUREAU_MON / "
        "(AMT_REQ_CREDIT_BUREAU_YEAR / 12 + 1e-8) / "
        "CASE WHEN AMT_REQ_CREDIT_BUREAU_YEAR > 0 THEN 1 ELSE 1e8 END",
        "ANNUAL_ANNUITY_INCOME_RATIO": "AMT_ANNUITY * 12 / (AMT_INCOME_TOTAL + 1)",
        "EMPLOYMENT_DURATION_FRAC": "DAYS_EMPLOYED / (DAYS_BIRTH + 1)",
    }


#: Ratios whose denominator may be the epsilon alone, with what then was zero.
OVER_EPSILON = {
    "CREDIT_EXT3_RATIO": "EXT_SOURCE_3",
    "CREDIT_SEEK_VELOCITY": "AMT_REQ_CREDIT_BUREAU_YEAR",
    "LATE_TO_ACTIVE_RATIO": "BUREAU_ACTIVE_COUNT",
}


def _at_one_scale(df: DataFrame) -> DataFrame:
    """Ratios over the epsilon alone brought to the scale of the others, to round alike."""
    scale = {c: F.when(F.col(d) > 0, 1.0).otherwise(1e8) for c, d in OVER_EPSILON.items()}
    return df.withColumns({c: F.col(c) / by for c, by in scale.items()})


CROSS = {
    "TOTAL_DTI": "(ACTIVE_CREDIT_SUM + AMT_CREDIT) / (AMT_INCOME_TOTAL + 1)",
    "TIME_DECAYED_DTI": "(ACTIVE_CREDIT_SUM_DECAYED + AMT_CREDIT) / (AMT_INCOME_TOTAL + 1)",
    "DEBT_ACCEL_RATE": "BUREAU_AMT_CREDIT_SUM / (BUREAU_AMT_CREDIT_MEAN * 2 + 1e-8)",
    "LATE_TO_ACTIVE_RATIO": "INST_LATE_FRAC / (BUREAU_ACTIVE_COUNT + 1e-8) / "
    "CASE WHEN BUREAU_ACTIVE_COUNT > 0 THEN 1 ELSE 1e8 END",
    "ANNUITY_TO_PEAK_INST_RATIO": "AMT_ANNUITY / (INST_MAX_INSTALMENT + 1e-8)",
}


def _feature_sql() -> str:
    base = {c: c for c in CLEAN_NUMBERS}
    counted = [c for c in CLEAN_NUMBERS if c != "TARGET"] + ["CODE_GENDER", "OCCUPATION_TYPE"]
    nulls = " + ".join(f"CAST({c} IS NULL AS INT)" for c in counted)
    ratios = _ratios("a")
    return f"""
      WITH a AS ({_clean_sql()}), b AS ({_bureau_sql()}), i AS ({_installments_sql()}),
      cc AS ({_card_sql()}), p AS ({_pos_sql()}), pr AS ({_previous_sql()})
      SELECT SK_ID_CURR, CODE_GENDER, OCCUPATION_TYPE, {_shown(base | ratios | CROSS, 4)},
             round(CAST({nulls} AS DOUBLE), 4) AS NAN_COUNT,
             round(CC_UTIL_P95_12M, 4) AS CC_UTIL_P95_12M,
             round(POS_DPD_EMA_3M, 4) AS POS_DPD_EMA_3M,
             round(PREV_2YR_REFUSED_VELOCITY, 4) AS PREV_2YR_REFUSED_VELOCITY
      FROM a LEFT JOIN b USING (SK_ID_CURR) LEFT JOIN i USING (SK_ID_CURR)
      LEFT JOIN cc USING (SK_ID_CURR) LEFT JOIN p USING (SK_ID_CURR)
      LEFT JOIN pr USING (SK_ID_CURR)"""


def _cleaned(tables) -> DataFrame:
    application = tables["application"]
    return credit.clean_application(application, clean.fit_cap(application, "OWN_CAR_AGE"))


@query("credit_application", f"""
    SELECT SK_ID_CURR, CODE_GENDER, OCCUPATION_TYPE, {_shown({c: c for c in CLEAN_NUMBERS})}
    FROM ({_clean_sql()})
""")
def credit_application(spark, sf):
    return _comparable(_cleaned(credit_tables(spark, sf)))


@query("credit_bureau", _bureau_sql())
def credit_bureau(spark, sf):
    t = credit_tables(spark, sf)
    aged = F.round("ACTIVE_CREDIT_SUM_DECAYED", 5)
    wide = credit.bureau_features(t["bureau"], t["bureau_balance"])
    return _comparable(wide.withColumn("ACTIVE_CREDIT_SUM_DECAYED", aged), 8)


@query("credit_installments", _installments_sql())
def credit_installments(spark, sf):
    t = credit_tables(spark, sf)
    return _comparable(credit.installment_features(t["installments_payments"]))


@query("credit_card", _card_sql())
def credit_card(spark, sf):
    return _comparable(credit.card_features(credit_tables(spark, sf)["credit_card_balance"]))


@query("credit_pos", _pos_sql())
def credit_pos(spark, sf):
    return _comparable(credit.pos_features(credit_tables(spark, sf)["POS_CASH_balance"]))


@query("credit_previous", _previous_sql())
def credit_previous(spark, sf):
    t = credit_tables(spark, sf)
    return _comparable(credit.previous_features(t["previous_application"]))


@query("credit_features", _feature_sql())
def credit_features(spark, sf):
    t = credit_tables(spark, sf)
    application = _cleaned(t)
    raw = [c for c in application.columns if c not in (credit.TARGET, KEY)]
    children = credit.child_features(t)
    wide = credit.G.left_onto(application, *children.values(), on=KEY)
    wide = credit.cross_table_features(credit.applicant_features(wide, raw))
    wide = _at_one_scale(wide)
    last = ["CC_UTIL_P95_12M", "POS_DPD_EMA_3M", "PREV_2YR_REFUSED_VELOCITY"]
    wide = wide.withColumns({c: F.round(c, 6) for c in last})
    shown = [*CLEAN_NUMBERS, *_ratios("a"), *CROSS, "NAN_COUNT", *last]
    return _comparable(wide.select(KEY, "CODE_GENDER", "OCCUPATION_TYPE", *shown), 4)


@query(
    "credit_proposed",
    f"""
    WITH prev AS (
      SELECT SK_ID_CURR,
             {", ".join(
                 f"coalesce(sum(CAST(NAME_CONTRACT_STATUS = '{s}' AS INT)), 0) AS {c}"
                 for s, c in credit.OUTCOMES.items())}
      FROM ({TABLES["previous_application"]}) WHERE DAYS_DECISION >= -730 GROUP BY 1
    ), debt AS (
      SELECT SK_ID_CURR,
             coalesce(sum(AMT_CREDIT_SUM) FILTER (DAYS_CREDIT >= -365), 0) AS now,
             coalesce(sum(AMT_CREDIT_SUM)
               FILTER (DAYS_CREDIT < -365 AND DAYS_CREDIT >= -1095), 0) AS past
      FROM ({TABLES["bureau"]}) GROUP BY 1
    ), card AS (
      SELECT SK_ID_CURR, sum(u * w) / sum(CASE WHEN u IS NOT NULL THEN w END) AS used
      FROM (SELECT SK_ID_CURR, AMT_BALANCE / (AMT_CREDIT_LIMIT_ACTUAL + 1e-8) AS u,
                   exp(abs(MONTHS_BALANCE) * -0.01) AS w
            FROM ({TABLES["credit_card_balance"]})
            WHERE AMT_CREDIT_LIMIT_ACTUAL > 0 AND MONTHS_BALANCE >= -12) GROUP BY 1
    ), paid AS (
      SELECT SK_ID_CURR, avg(m) AS deficit
      FROM (SELECT SK_ID_CURR, SK_ID_PREV, avg(AMT_PAYMENT - AMT_INSTALMENT) AS m
            FROM ({TABLES["installments_payments"]}) WHERE DAYS_INSTALMENT > -1000 GROUP BY 1, 2)
      GROUP BY 1
    )
    SELECT SK_ID_CURR, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in credit.OUTCOMES.values())},
           round(now / (past / 2 + 1e-8) / CASE WHEN past > 0 THEN 1 ELSE 1e8 END, 4)
             AS BUREAU_DEBT_ACCELERATION,
           round(used, 6) AS CC_UTIL_WEIGHTED_12M, round(deficit, 4) AS INST_DEFICIT_MEAN
    FROM ({TABLES["application"]}) LEFT JOIN prev USING (SK_ID_CURR)
    LEFT JOIN debt USING (SK_ID_CURR) LEFT JOIN card USING (SK_ID_CURR)
    LEFT JOIN paid USING (SK_ID_CURR)
    """,
)
def credit_proposed(spark, sf):
    t = credit_tables(spark, sf)
    rows = credit.G.left_onto(
        t["application"].select(KEY), *credit.proposed_features(t), on=KEY
    )
    days, amount = F.col("DAYS_CREDIT"), F.col("AMT_CREDIT_SUM")
    past = t["bureau"].groupBy(KEY).agg(
        F.sum(F.when((days < -365) & (days >= -1095), amount)).alias("past")
    )
    scale = F.when(F.col("past") > 0, 1.0).otherwise(1e8)
    rows = rows.join(past, KEY, "left")
    return rows.select(
        KEY,
        *[F.col(c).cast("double").alias(c) for c in credit.OUTCOMES.values()],
        F.round(F.col("BUREAU_DEBT_ACCELERATION") / scale, 4).alias("BUREAU_DEBT_ACCELERATION"),
        F.round("CC_UTIL_WEIGHTED_12M", 6).alias("CC_UTIL_WEIGHTED_12M"),
        F.round("INST_DEFICIT_MEAN", 4).alias("INST_DEFICIT_MEAN"),
    )
