"""Schemas, table specs and the fixed domain vocabulary.

Raw landing (one wide row per account, six statement months, month 1 = newest),
a customer dimension, two monthly facts and the per-account feature fact.
Types follow the declared DDL: money DECIMAL(14,2), totals DECIMAL(16,2),
ratios DECIMAL(6,3), score DECIMAL(8,2), average DPD DECIMAL(6,2).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONTHS = (1, 2, 3, 4, 5, 6)

MONEY = T.DecimalType(14, 2)
TOTAL = T.DecimalType(16, 2)
RATIO = T.DecimalType(6, 3)
SCORE = T.DecimalType(8, 2)
AVG_DPD = T.DecimalType(6, 2)

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's labels and thresholds exactly)
# ---------------------------------------------------------------------------
# Credit-limit bands, upper bounds (exclusive in the SQL rule) and labels, in order:
LIMIT_BAND_LABELS = ("<50K", "50K-100K", "100K-200K", "200K-300K", "300K-500K", "500K+")
LIMIT_BAND_EDGES = (50000, 100000, 200000, 300000, 500000)
# Age bands, upper bounds (exclusive) and labels, in order:
AGE_BAND_LABELS = ("<25", "25-34", "35-44", "45-54", "55-64", "65+")
AGE_BAND_EDGES = (25, 35, 45, 55, 65)
# Education codes -> labels (anything else, including NULL, is 'Unknown'):
EDUCATION_MAP = {
    "grad": "Graduate School",
    "uni": "University",
    "hs": "High School",
    "other1": "Other",
    "other2": "Other",
    "other3": "Other",
}
# Marital codes -> labels (anything else is 'Unknown'):
MARITAL_MAP = {"married": "Married", "single": "Single", "other": "Other"}
UNKNOWN = "Unknown"
# Collections stages by current DPD: <=0, <=2, <=5, else.
STAGE_LABELS = ("1-Current", "2-Early DPD (1-2mo)", "3-Mid DPD (3-5mo)", "4-Severe DPD (6mo+)")
STAGE_EDGES = (0, 2, 5)
# Risk grades by score: <5, <15, <30, else.
GRADE_LABELS = ("A - Low Risk", "B - Moderate Risk", "C - High Risk", "D - Severe Risk")
GRADE_EDGES = (5, 15, 30)
# Risk score weights: worst DPD x10, months delinquent x5,
# utilization above 0.8 x20, payment ratio below 0.3 x30.
SCORE_WORST_DPD_WEIGHT = 10
SCORE_MONTHS_WEIGHT = 5
SCORE_UTIL_FLOOR = "0.8"
SCORE_UTIL_WEIGHT = 20
SCORE_RATIO_CAP = "0.3"
SCORE_RATIO_WEIGHT = 30
# Default text counted as a default (case-insensitive in the SQL rule):
DEFAULT_YES = "yes"
# Report thresholds (parameters; these are the reference's defaults):
TOP_RISK_MIN_ACCOUNTS = 100
EFFICIENCY_MIN_ACCOUNTS = 50
TOP_N = 10
DECILES = 10
# ---------------------------------------------------------------------------

TIMELINESS = tuple(f"timeliness_{i}" for i in MONTHS)
BALANCES = tuple(f"balance_{i}" for i in MONTHS)
PAYMENTS = tuple(f"payment_{i}" for i in MONTHS)
DPD_WIDE = tuple(f"timeliness_{i}_dpd" for i in MONTHS)


def _raw_fields(with_id: bool, default_name: str) -> list[T.StructField]:
    fields = []
    if with_id:
        fields.append(T.StructField("customer_id", T.LongType(), False))
    fields += [
        T.StructField("credit_limit", MONEY, True),
        T.StructField("gender", T.StringType(), True),
        T.StructField("education", T.StringType(), True),
        T.StructField("marital_status", T.StringType(), True),
        T.StructField("age", T.ShortType(), True),
    ]
    fields += [T.StructField(c, T.StringType(), True) for c in TIMELINESS]
    fields += [T.StructField(c, MONEY, True) for c in BALANCES]
    fields += [T.StructField(c, MONEY, True) for c in PAYMENTS]
    fields += [
        T.StructField("avg_balance", MONEY, True),
        T.StructField("avg_payment", MONEY, True),
        T.StructField(default_name, T.StringType(), True),
    ]
    return fields


# Landing table: customer_id is the contiguous surrogate key, 'default' renamed.
RAW_SCHEMA = T.StructType(_raw_fields(True, "default_raw"))
# Source CSV as delivered: no id column, the flag column is called 'default'.
CSV_SCHEMA = T.StructType(_raw_fields(False, "default"))
RAW_COLUMNS = tuple(f.name for f in RAW_SCHEMA.fields)

DIM_COLUMNS = (
    "customer_id", "credit_limit", "credit_limit_band", "gender",
    "education", "marital_status", "age", "age_band",
)
FACT_RISK_COLUMNS = (
    "customer_id", "current_dpd", "worst_dpd_6mo", "months_delinquent_6mo", "avg_dpd_6mo",
    "collections_stage", "total_bill_6mo", "total_paid_6mo", "payment_to_bill_ratio",
    "credit_utilization", "risk_score", "risk_grade", "default_flag",
)
REPAYMENT_COLUMNS = ("customer_id", "statement_month", "timeliness_code", "dpd")
STATEMENT_COLUMNS = ("customer_id", "statement_month", "bill_amount", "payment_amount")
# Denormalised mart = dimension columns + feature columns, one row per account.
MART_COLUMNS = DIM_COLUMNS + FACT_RISK_COLUMNS[1:]

# Engineered wide output, 47 columns in the published order.
ENGINEERED_COLUMNS = (
    ("customer_id", "credit_limit", "gender", "education", "marital_status", "age",
     "age_band", "credit_limit_band")
    + TIMELINESS + DPD_WIDE
    + ("current_dpd", "worst_dpd_6mo", "months_delinquent_6mo", "avg_dpd_6mo", "collections_stage")
    + BALANCES + PAYMENTS
    + ("total_bill_6mo", "total_paid_6mo", "payment_to_bill_ratio", "avg_balance", "avg_payment",
       "credit_utilization", "risk_score", "risk_grade", "default", "default_flag")
)


@dataclass(frozen=True)
class TableSpec:
    """Declared constraints, checked by the audits instead of enforced on write."""

    name: str
    key: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    numeric: dict[str, tuple[int, int]] = field(default_factory=dict)
    varchar: dict[str, int] = field(default_factory=dict)
    checks: dict[str, str] = field(default_factory=dict)
    parent: tuple[str, str] | None = None  # (parent table, key column)


TABLE_SPECS = {
    "staging_raw_credit_data": TableSpec(
        "staging_raw_credit_data", ("customer_id",),
        not_null=("customer_id", "credit_limit"),
        numeric={"credit_limit": (14, 2), "avg_balance": (14, 2), "avg_payment": (14, 2),
                 **{c: (14, 2) for c in BALANCES + PAYMENTS}},
        varchar={"gender": 10, "education": 20, "marital_status": 20, "default_raw": 5,
                 **{c: 5 for c in TIMELINESS}},
    ),
    "dim_customers": TableSpec(
        "dim_customers", ("customer_id",),
        not_null=("customer_id", "credit_limit", "credit_limit_band"),
        numeric={"credit_limit": (14, 2)},
        varchar={"credit_limit_band": 20, "gender": 10, "education": 20,
                 "marital_status": 20, "age_band": 10},
        parent=("staging_raw_credit_data", "customer_id"),
    ),
    "fact_repayment_history": TableSpec(
        "fact_repayment_history", ("customer_id", "statement_month"),
        not_null=("customer_id", "statement_month", "dpd"),
        varchar={"timeliness_code": 5},
        checks={"statement_month": "statement_month BETWEEN 1 AND 6"},
        parent=("dim_customers", "customer_id"),
    ),
    "fact_statements": TableSpec(
        "fact_statements", ("customer_id", "statement_month"),
        not_null=("customer_id", "statement_month", "bill_amount", "payment_amount"),
        numeric={"bill_amount": (14, 2), "payment_amount": (14, 2)},
        checks={"statement_month": "statement_month BETWEEN 1 AND 6"},
        parent=("dim_customers", "customer_id"),
    ),
    "fact_credit_risk": TableSpec(
        "fact_credit_risk", ("customer_id",),
        not_null=FACT_RISK_COLUMNS,
        numeric={"avg_dpd_6mo": (6, 2), "total_bill_6mo": (16, 2), "total_paid_6mo": (16, 2),
                 "payment_to_bill_ratio": (6, 3), "credit_utilization": (6, 3),
                 "risk_score": (8, 2)},
        varchar={"collections_stage": 30, "risk_grade": 20},
        checks={"default_flag": "default_flag IN (0, 1)"},
        parent=("dim_customers", "customer_id"),
    ),
}
