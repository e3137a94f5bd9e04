"""The credit feature set: five child tables to applicant grain, and the applicant's own columns.

Every child table is read once and grouped once per grain; recency windows are conditions inside
that one aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import aggregates as A
from riskloom.functions import expressions as X
from riskloom.operators import aggregate as G
from riskloom.operators import clean
from riskloom.operators.ordered import ewm_last

# Fixed values of the credit feature set: keys, sentinels, status codes, windows, column lists.
APPLICANT, CREDIT, LOAN = "SK_ID_CURR", "SK_ID_BUREAU", "SK_ID_PREV"
TARGET = "TARGET"
NEVER_EMPLOYED = 365243
UNKNOWN_GENDER = "XNA"
EPS = 1e-8
STATUS_CODES = {"C": -1, "X": 0}
MONTHLY_STATUS = ["0", "1", "2", "3", "4", "5"]
LATE_STATUS = ["1", "2", "3", "4", "5"]
SEVERE_STATUS = ["3", "4", "5"]
EXT_SOURCES = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
TARGET_ENCODED = [
    "CODE_GENDER",
    "NAME_CONTRACT_TYPE",
    "NAME_EDUCATION_TYPE",
    "NAME_FAMILY_STATUS",
    "NAME_TYPE_SUITE",
    "ORGANIZATION_TYPE",
    "OCCUPATION_TYPE",
    "WEEKDAY_APPR_PROCESS_START",
]
RECONSTRUCTION_FEATURES = [
    "DAYS_BIRTH",
    "DAYS_EMPLOYED",
    "AMT_INCOME_TOTAL",
    "AMT_CREDIT",
    "AMT_ANNUITY",
    "AMT_GOODS_PRICE",
    "REGION_POPULATION_RELATIVE",
    "DAYS_ID_PUBLISH",
    "DAYS_REGISTRATION",
    "CNT_FAM_MEMBERS",
    "CNT_CHILDREN",
]
# Columns without importance, in their given order.
PRUNED = [
    "FLAG_MOBIL",
    "FLAG_EMP_PHONE",
    "FLAG_CONT_MOBILE",
    "FONDKAPREMONT_MODE",
    "NAME_INCOME_TYPE",
    "FLAG_DOCUMENT_2",
    "FLAG_DOCUMENT_4",
    "FLAG_DOCUMENT_5",
    "FLAG_DOCUMENT_7",
    "FLAG_DOCUMENT_9",
    "FLAG_DOCUMENT_10",
    "FLAG_DOCUMENT_11",
    "FLAG_DOCUMENT_12",
    "FLAG_DOCUMENT_13",
    "FLAG_DOCUMENT_14",
    "FLAG_DOCUMENT_15",
    "FLAG_DOCUMENT_16",
    "FLAG_DOCUMENT_17",
    "FLAG_DOCUMENT_19",
    "FLAG_DOCUMENT_20",
    "NAME_HOUSING_TYPE",
    "EMERGENCYSTATE_MODE",
    "FLAG_DOCUMENT_21",
    "AMT_REQ_CREDIT_BUREAU_HOUR",
    "AMT_REQ_CREDIT_BUREAU_DAY",
    "DOCUMENT_COUNT",
    "HOUSETYPE_MODE",
    "WALLSMATERIAL_MODE",
    "DAYS_EMPLOYED_ANOM",
    "REG_REGION_NOT_LIVE_REGION",
    "FLAG_EMAIL",
    "BUREAU_BB_STATUS_3_COUNT_SUM",
    "BUREAU_BB_STATUS_4_COUNT_SUM",
    "BUREAU_BB_STATUS_5_COUNT_SUM",
    "BUREAU_PROLONG_SUM",
    "BUREAU_BB_SEVERE_STATUS_SUM",
    "FLAG_DOCUMENT_6",
]


def _c(name: str) -> Column:
    return F.col(name)


def _or_zero(name: str) -> Column:
    return F.coalesce(name, F.lit(0))


def clean_application(df: DataFrame, car_age_cap: float | None = None) -> DataFrame:
    """Sentinels to null, days made positive, car age capped, income on a log scale.

    Fit ``car_age_cap`` once on the training table with ``clean.fit_cap(df, "OWN_CAR_AGE")``.
    """
    df = df.withColumns(
        {
            "DAYS_EMPLOYED_ANOM": X.is_sentinel(_c("DAYS_EMPLOYED"), NEVER_EMPLOYED),
            "DAYS_EMPLOYED": X.without(_c("DAYS_EMPLOYED"), NEVER_EMPLOYED),
            "CODE_GENDER": X.without(_c("CODE_GENDER"), UNKNOWN_GENDER),
        }
    )
    df = X.transform_prefix(df, "DAYS_", F.abs)
    df = clean.apply_cap(df, "OWN_CAR_AGE", car_age_cap)
    df = df.withColumn("AMT_INCOME_TOTAL_LOG", F.log1p("AMT_INCOME_TOTAL"))
    return clean.prune(df, PRUNED)


def balance_by_credit(balance: DataFrame) -> DataFrame:
    """Monthly status rows brought to one row per bureau credit."""
    status, month, severity = _c("STATUS"), _c("MONTHS_BALANCE"), _c("STATUS_SEVERITY")
    rows = balance.withColumn("STATUS_SEVERITY", X.ordinal(status, STATUS_CODES))
    # One number orders rows by month and then severity; a null month comes first.
    place = F.coalesce(month.cast("long"), F.lit(-(2**31))) * 16 + severity
    specs = {
        "BB_MONTHS_COUNT": A.rows(),
        "BB_MONTHS_BALANCE_MIN": A.low(month),
        "BB_MONTHS_BALANCE_MAX": A.high(month),
        "BB_STATUS_C_FRAC": A.share(status == "C"),
    }
    for name, members in {"LATE": LATE_STATUS, "SEVERE": SEVERE_STATUS}.items():
        specs[f"BB_STATUS_{name}_COUNT"] = A.tally(status.isin(members))
        specs[f"BB_STATUS_{name}_FRAC"] = A.share(status.isin(members))
    for s in MONTHLY_STATUS:
        specs[f"BB_STATUS_{s}_COUNT"] = A.tally(status == s)
        specs[f"BB_STATUS_{s}_FRAC"] = A.share(status == s)
    specs |= {
        "BB_FIRST_STATUS_SEVERITY": A.earliest(severity, place),
        "BB_LAST_STATUS_SEVERITY": A.latest(severity, place),
        "BB_WHEN_CLOSED_MONTH_ABS": A.low(F.abs(month), status == "C"),
    }
    gap = F.abs("BB_MONTHS_BALANCE_MAX") - _c("BB_WHEN_CLOSED_MONTH_ABS")
    return G.to_parent(rows, CREDIT, specs).withColumn("BB_MONTH_CLOSED_TO_END", gap)


def bureau_features(bureau: DataFrame, balance: DataFrame) -> DataFrame:
    """Bureau credits and their monthly balances per applicant."""
    rows = G.left_onto(bureau, balance_by_credit(balance), on=CREDIT)
    amount, days, active = _c("AMT_CREDIT_SUM"), _c("DAYS_CREDIT"), _c("CREDIT_ACTIVE") == "Active"
    minus = {n: amount - _c(f"AMT_CREDIT_SUM_{n}") for n in ("DEBT", "LIMIT", "OVERDUE")}
    ratio = {
        n: X.guarded_ratio(_c(f"AMT_CREDIT_SUM_{n}"), amount, EPS) for n in ("DEBT", "OVERDUE")
    }
    gaps = {
        "DAYS_CREDIT_OVERDUE": days - _c("CREDIT_DAY_OVERDUE"),
        "DAYS_CREDIT_ENDDATE": days - _c("DAYS_CREDIT_ENDDATE"),
        "DAYS_CREDIT_FACT": days - _c("DAYS_ENDDATE_FACT"),
        "ENDDATE_FACT": _c("DAYS_CREDIT_ENDDATE") - _c("DAYS_ENDDATE_FACT"),
        "UPDATE_ENDDATE": _c("DAYS_CREDIT_UPDATE") - _c("DAYS_CREDIT_ENDDATE"),
    }
    specs = {
        "BUREAU_DAYS_CREDIT_MIN": A.low(days),
        "BUREAU_DAYS_CREDIT_MEAN": A.mean(days),
        "BUREAU_AMT_CREDIT_SUM": A.total(amount),
        "BUREAU_AMT_CREDIT_MEAN": A.mean(amount),
        "BUREAU_DEBT_SUM": A.total(_c("AMT_CREDIT_SUM_DEBT")),
        "BUREAU_MAX_OVERDUE": A.high(_c("CREDIT_DAY_OVERDUE")),
        "BUREAU_PROLONG_SUM": A.total(_c("CNT_CREDIT_PROLONG")),
        "BUREAU_ACTIVE_COUNT": A.tally(active),
        "BUREAU_BB_MONTHS_MEAN": A.mean(_c("BB_MONTHS_COUNT")),
        "BUREAU_LATE_STATUS_SUM": A.total(_c("BB_STATUS_LATE_COUNT")),
        "BUREAU_BB_LATE_FRAC_MEAN": A.mean(_c("BB_STATUS_LATE_FRAC")),
        "BUREAU_BB_SEVERE_STATUS_SUM": A.total(_c("BB_STATUS_SEVERE_COUNT")),
        "BUREAU_BB_SEVERE_FRAC_MEAN": A.mean(_c("BB_STATUS_SEVERE_FRAC")),
        "BUREAU_BB_FIRST_STATUS_SEV_MEAN": A.mean(_c("BB_FIRST_STATUS_SEVERITY")),
        "BUREAU_BB_LAST_STATUS_SEV_MEAN": A.mean(_c("BB_LAST_STATUS_SEVERITY")),
        "BUREAU_BB_LAST_STATUS_SEV_MAX": A.high(_c("BB_LAST_STATUS_SEVERITY")),
        "BUREAU_BB_MONTH_CLOSED_TO_END_MEAN": A.mean(_c("BB_MONTH_CLOSED_TO_END")),
    }
    for s in MONTHLY_STATUS:
        specs[f"BUREAU_BB_STATUS_{s}_COUNT_SUM"] = A.total(_c(f"BB_STATUS_{s}_COUNT"))
        specs[f"BUREAU_BB_STATUS_{s}_FRAC_MEAN"] = A.mean(_c(f"BB_STATUS_{s}_FRAC"))
    specs |= {f"BUREAU_CREDIT_MINUS_{n}_MEAN": A.mean(d) for n, d in minus.items()}
    specs |= {f"BUREAU_CREDIT_MINUS_{n}_SUM": A.total(minus[n]) for n in ("DEBT", "LIMIT")}
    specs |= {f"BUREAU_{n}_CREDIT_RATIO_MEAN": A.mean(r) for n, r in ratio.items()}
    specs["BUREAU_DEBT_CREDIT_RATIO_MAX"] = A.high(ratio["DEBT"])
    specs |= {f"BUREAU_{n}_GAP_MEAN": A.mean(g) for n, g in gaps.items()}
    specs |= {
        "ACTIVE_CREDIT_SUM": A.total(amount, active),
        "ACTIVE_CREDIT_COUNT": A.rows(active),
        "ACTIVE_CREDIT_SUM_DECAYED": A.total(X.decayed(amount, days), active),
    }
    return G.to_parent(rows, APPLICANT, specs)


def installment_features(installments: DataFrame) -> DataFrame:
    """Payment behaviour per applicant: overall, three recency windows, restructured loans."""
    due, paid = _c("AMT_INSTALMENT"), _c("AMT_PAYMENT")
    due_day, paid_day = _c("DAYS_INSTALMENT"), _c("DAYS_ENTRY_PAYMENT")
    days_late, is_late = paid_day - due_day, paid_day > due_day
    ratio = X.guarded_ratio(paid, due, EPS)
    partial = (paid > 0) & (paid < due)
    aged = X.decayed(days_late, due_day)
    specs = {
        "INST_PAYMENT_DIFF_MEAN": A.mean(due - paid),
        "INST_PAYMENT_DIFF_SUM": A.total(due - paid),
        "INST_PAYMENT_RATIO_MEAN": A.mean(ratio),
        "INST_DAYS_LATE_MAX": A.high(days_late),
        "INST_DAYS_LATE_MEAN": A.mean(days_late),
        "INST_LATE_FRAC": A.share(is_late),
        "INST_MAX_INSTALMENT": A.high(due),
        "INST_TOTAL_PAID": A.total(paid),
        "INST_FRACTIONAL_PAY_COUNT": A.tally(partial),
        "INST_FRACTIONAL_PAY_FRAC": A.share(partial),
        "INST_EWMA_LATE_SUM": A.total(aged),
        "INST_EWMA_LATE_MEAN": A.mean(aged),
        "INST_DEFICIT_MEAN_3Y": A.mean(paid - due, due_day > -1000),
    }
    for years in (1, 2):
        recent, tag = due_day >= -365 * years, f"INST_{years}YR"
        specs |= {
            f"{tag}_PAYMENT_RATIO_MEAN": A.mean(ratio, recent),
            f"{tag}_PAYMENT_RATIO_MIN": A.low(ratio, recent),
            f"{tag}_DAYS_LATE_MEAN": A.mean(days_late, recent),
            f"{tag}_DAYS_LATE_MAX": A.high(days_late, recent),
            f"{tag}_LATE_FRAC": A.share(is_late, recent),
            f"{tag}_COUNT": A.rows(recent),
        }
    loans = G.restructured(installments, LOAN, APPLICANT, "NUM_INSTALMENT_VERSION").select(
        APPLICANT,
        _c("n_restructured").alias("INST_RESTRUCTURED_COUNT"),
        _c("restructured_frac").alias("INST_RESTRUCTURED_FRAC"),
    )
    wide = G.left_onto(G.to_parent(installments, APPLICANT, specs), loans, on=APPLICANT)
    return wide.withColumn(
        "INST_1YR_LATE_FRAC_DELTA", _or_zero("INST_1YR_LATE_FRAC") - _or_zero("INST_LATE_FRAC")
    )


def card_features(card: DataFrame) -> DataFrame:
    """Card use per applicant; rows without a positive limit do not count at all."""
    rows = card.filter(_c("AMT_CREDIT_LIMIT_ACTUAL") > 0).withColumn(
        "UTIL_RATIO", X.guarded_ratio(_c("AMT_BALANCE"), _c("AMT_CREDIT_LIMIT_ACTUAL"), EPS)
    )
    used, recent = _c("UTIL_RATIO"), _c("MONTHS_BALANCE") >= -12
    wide = G.to_parent(
        rows,
        APPLICANT,
        {
            "CC_UTIL_MEAN_ALL": A.mean(used),
            "CC_UTIL_MAX_ALL": A.high(used),
            "CC_PAYMENT_MEAN": A.mean(_c("AMT_PAYMENT_CURRENT")),
            "CC_DPD_MAX": A.high(_c("SK_DPD")),
            "CC_DPD_MEAN": A.mean(_c("SK_DPD")),
            "CC_DRAWINGS_COUNT": A.total(_c("CNT_DRAWINGS_CURRENT")),
            "CC_UTIL_MEAN_12M": A.mean(used, recent),
            "CC_DRAWINGS_12M": A.total(_c("AMT_DRAWINGS_CURRENT"), recent),
        },
    )
    p95 = G.quantile_by_parent(rows, APPLICANT, "UTIL_RATIO", 0.95, "CC_UTIL_P95_12M", recent)
    return G.left_onto(wide, p95, on=APPLICANT)


def pos_features(pos: DataFrame) -> DataFrame:
    """Point-of-sale loans per applicant: arrears now, before, and as a weighted mean."""
    dpd, month = _c("SK_DPD"), _c("MONTHS_BALANCE")
    wide = G.to_parent(
        pos,
        APPLICANT,
        {
            "POS_DPD_MAX": A.high(dpd),
            "POS_DPD_MEAN": A.mean(dpd),
            "POS_DPD_DEF_MAX": A.high(_c("SK_DPD_DEF")),
            "POS_CNT_INSTALMENT_FUTURE_MEAN": A.mean(_c("CNT_INSTALMENT_FUTURE")),
            "POS_MONTHS_COUNT": A.known(month),
            "POS_COMPLETED_FRAC": A.share(_c("NAME_CONTRACT_STATUS") == "Completed"),
            "POS_DPD_MAX_6M": A.high(dpd, month >= -6),
            "POS_DPD_MAX_PRIOR": A.high(dpd, month < -6),
        },
    )
    # Months repeat over an applicant's loans; the loan and then the value settle the order.
    arrears = ewm_last(
        pos, APPLICANT, ["MONTHS_BALANCE", LOAN, "SK_DPD"], "SK_DPD", 3.0, "POS_DPD_EMA_3M"
    )
    return G.left_onto(wide, arrears, on=APPLICANT).withColumn(
        "POS_DPD_ACCELERATION", _or_zero("POS_DPD_MAX_6M") - _or_zero("POS_DPD_MAX_PRIOR")
    )


def previous_features(previous: DataFrame) -> DataFrame:
    """Earlier applications per applicant and how often they were refused."""
    refused = _c("NAME_CONTRACT_STATUS") == "Refused"
    recent = _c("DAYS_DECISION") >= -730
    wide = G.to_parent(
        previous,
        APPLICANT,
        {
            "PREV_AMT_CREDIT_MEAN": A.mean(_c("AMT_CREDIT")),
            "PREV_AMT_ANNUITY_MEAN": A.mean(_c("AMT_ANNUITY")),
            "PREV_DOWN_PAYMENT_MEAN": A.mean(_c("AMT_DOWN_PAYMENT")),
            "PREV_DAYS_DECISION_MAX": A.high(_c("DAYS_DECISION")),
            "PREV_CNT_PAYMENT_MEAN": A.mean(_c("CNT_PAYMENT")),
            "PREV_TOTAL_APPS": A.rows(),
            "PREV_REFUSED_FRAC": A.share(refused),
            "PREV_RATE_DOWN_MEAN": A.mean(_c("RATE_DOWN_PAYMENT")),
            "PREV_2YR_TOTAL_APPS": A.rows(recent),
            "PREV_2YR_REFUSED_COUNT": A.tally(refused, recent),
        },
    )
    velocity = X.guarded_ratio(
        _or_zero("PREV_2YR_REFUSED_COUNT"), _or_zero("PREV_2YR_TOTAL_APPS"), EPS
    )
    return wide.withColumn("PREV_2YR_REFUSED_VELOCITY", velocity)


def applicant_features(df: DataFrame, null_columns: Sequence[str] | None = None) -> DataFrame:
    """Ratios, interactions and counts over the applicant's own columns.

    ``NAN_COUNT`` covers ``null_columns``, by default all columns the frame has here.
    """
    counted = null_columns or [c for c in df.columns if c not in (TARGET, APPLICANT)]
    documents = [c for c in (f"FLAG_DOCUMENT_{i}" for i in range(2, 22)) if c in df.columns]
    income, credit, annuity = _c("AMT_INCOME_TOTAL"), _c("AMT_CREDIT"), _c("AMT_ANNUITY")
    goods, born, employed = _c("AMT_GOODS_PRICE"), _c("DAYS_BIRTH"), _c("DAYS_EMPLOYED")
    ext = {i: _c(f"EXT_SOURCE_{i}") for i in (1, 2, 3)}
    seen_year = _c("AMT_REQ_CREDIT_BUREAU_YEAR") / 12
    return df.withColumns(
        {
            "NAN_COUNT": X.null_count(counted),
            "EXT_SRC_PROD": X.row_product(EXT_SOURCES),
            "EXT_SRC_MEAN": X.row_mean(EXT_SOURCES),
            "EXT_SRC_MIN": X.row_min(EXT_SOURCES),
            # Days of birth are positive here, so this ratio is negative.
            "EXT1_AGE_RATIO": X.guarded_ratio(ext[1], born / F.lit(-365.25), EPS),
            "EXT1_INCOME_RATIO": X.guarded_ratio(ext[1], income, EPS),
            "CREDIT_EXT3_RATIO": X.guarded_ratio(credit, ext[3], EPS),
            "EXT2_EMPLOYED_PROD": ext[2] * employed,
            "LOAN_TERM_MONTHS": X.guarded_ratio(credit, annuity, EPS),
            "INCOME_PER_FAMILY_MEMBER": X.guarded_ratio(income, _c("CNT_FAM_MEMBERS"), 1),
            "PHONE_CHANGE_STABILITY": X.guarded_ratio(_c("DAYS_LAST_PHONE_CHANGE"), born, 1),
            "CREDIT_INCOME_RATIO": X.guarded_ratio(credit, income, 1),
            "ANNUITY_INCOME_RATIO": X.guarded_ratio(annuity, income, 1),
            "GOODS_INCOME_RATIO": X.guarded_ratio(goods, income, 1),
            "GOODS_CREDIT_RATIO": X.guarded_ratio(credit, goods, 1),
            "DOWNPAYMENT_INCOME_STRAIN": X.guarded_ratio(goods - credit, income, 1),
            "CREDIT_SEEK_VELOCITY": X.guarded_ratio(
                _c("AMT_REQ_CREDIT_BUREAU_MON"), seen_year, EPS
            ),
            "ANNUAL_ANNUITY_INCOME_RATIO": X.guarded_ratio(annuity * 12, income, 1),
            "EMPLOYMENT_DURATION_FRAC": X.guarded_ratio(employed, born, 1),
            "DOCUMENT_COUNT": X.known_count(documents),
        }
    )


def cross_table_features(df: DataFrame) -> DataFrame:
    """Ratios between applicant columns and child aggregates; skipped without bureau columns."""
    if "ACTIVE_CREDIT_SUM" not in df.columns:
        return df
    income, credit = _c("AMT_INCOME_TOTAL"), _c("AMT_CREDIT")
    return df.withColumns(
        {
            "TOTAL_DTI": X.guarded_ratio(_c("ACTIVE_CREDIT_SUM") + credit, income, 1),
            "TIME_DECAYED_DTI": X.guarded_ratio(
                _c("ACTIVE_CREDIT_SUM_DECAYED") + credit, income, 1
            ),
            "DEBT_ACCEL_RATE": X.guarded_ratio(
                _c("BUREAU_AMT_CREDIT_SUM"), _c("BUREAU_AMT_CREDIT_MEAN") * 2, EPS
            ),
            "LATE_TO_ACTIVE_RATIO": X.guarded_ratio(
                _c("INST_LATE_FRAC"), _c("BUREAU_ACTIVE_COUNT"), EPS
            ),
            "ANNUITY_TO_PEAK_INST_RATIO": X.guarded_ratio(
                _c("AMT_ANNUITY"), _c("INST_MAX_INSTALMENT"), EPS
            ),
        }
    )


# The five child aggregations and the tables each one reads.
CHILDREN = {
    "bureau": (bureau_features, ["bureau", "bureau_balance"]),
    "installments": (installment_features, ["installments_payments"]),
    "credit_card": (card_features, ["credit_card_balance"]),
    "pos_cash": (pos_features, ["POS_CASH_balance"]),
    "prev_app": (previous_features, ["previous_application"]),
}


def child_features(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The five child aggregations, one row per applicant each."""
    return {n: build(*[tables[t] for t in reads]) for n, (build, reads) in CHILDREN.items()}


# Previous-application outcomes that get a count of their own.
OUTCOMES = {
    "Approved": "PREV_Approved_CNT_2Y",
    "Refused": "PREV_Refused_CNT_2Y",
    "Canceled": "PREV_Canceled_CNT_2Y",
    "Unused offer": "PREV_Unused_offer_CNT_2Y",
}


def proposed_features(tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Further columns per applicant: outcomes of two years, debt acceleration, decayed use of the
    card's limit, and the mean over loans of the mean payment deficit."""
    days = _c("DAYS_CREDIT")
    now = F.coalesce(A.total(_c("AMT_CREDIT_SUM"), days >= -365), F.lit(0))
    then = F.coalesce(
        A.total(_c("AMT_CREDIT_SUM"), (days < -365) & (days >= -1095)), F.lit(0)
    )
    months = _c("MONTHS_BALANCE")
    card = tables["credit_card_balance"].filter(_c("AMT_CREDIT_LIMIT_ACTUAL") > 0)
    used = X.guarded_ratio(_c("AMT_BALANCE"), _c("AMT_CREDIT_LIMIT_ACTUAL"), EPS)
    paid = tables["installments_payments"].filter(_c("DAYS_INSTALMENT") > -1000)
    return [
        G.status_pivot(
            tables["previous_application"], APPLICANT, "NAME_CONTRACT_STATUS", OUTCOMES,
            _c("DAYS_DECISION") >= -730,
        ),
        G.to_parent(
            tables["bureau"], APPLICANT,
            {"BUREAU_DEBT_ACCELERATION": X.guarded_ratio(now, then / 2, EPS)},
        ),
        G.to_parent(
            card, APPLICANT,
            {"CC_UTIL_WEIGHTED_12M": G.weighted_mean(
                used, X.decayed(F.lit(1.0), months), months >= -12)},
        ),
        G.mean_of_means(
            paid, LOAN, APPLICANT, _c("AMT_PAYMENT") - _c("AMT_INSTALMENT"), "INST_DEFICIT_MEAN"
        ),
    ]


def full_features(
    application: DataFrame, children: Mapping[str, DataFrame], metas: Sequence[DataFrame] = ()
) -> DataFrame:
    """A cleaned application with child aggregates, optional model features and all ratios."""
    wide = G.left_onto(application, *children.values(), *metas, on=APPLICANT)
    for source in EXT_SOURCES:
        wide = X.residual(wide, source, f"PRED_{source}", f"{source}_RESIDUAL")
    return clean.prune(cross_table_features(applicant_features(wide)), PRUNED)
