"""Per-account features.

Wide path (canonical): every feature is a narrow expression over the account's own
wide row (six DPDs, six bills, six payments), so building the feature fact needs
no shuffle and no join. The long path re-derives the same fact the SQL way
(unpivot -> group by customer -> join back) and serves as the cross-check Q17.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import encodings as enc
from ..functions.numeric import dec, dlit, fit_decimal, sum_skip_null
from ..schema import BALANCES, DIM_COLUMNS, DPD_WIDE, FACT_RISK_COLUMNS, MART_COLUMNS, MONTHS, PAYMENTS


def _ratio(paid: Column, bill: Column, lenient: bool) -> Column:
    """Bill > 0 ? round(paid / bill, 3) : 1.0 (NULL bill -> 1.0)."""
    r = F.when(bill > F.lit(0), F.round(paid / bill, 3)).otherwise(dlit("1.000"))
    return fit_decimal(r, 6, 3, lenient)


def _utilization(avg_balance: Column, limit: Column, lenient: bool) -> Column:
    """round(avg_balance / nullif(limit, 0), 3); zero limit -> NULL."""
    return fit_decimal(F.round(avg_balance / F.nullif(limit, F.lit(0)), 3), 6, 3, lenient)


def _score(worst: Column, months: Column, util: Column, ratio: Column, lenient: bool) -> Column:
    return fit_decimal(F.round(enc.risk_score_raw(worst, months, util, ratio), 2), 8, 2, lenient)


def _avg_dpd(total_dpd: Column, n: int, lenient: bool) -> Column:
    return fit_decimal(F.round(dec(total_dpd) / F.lit(n), 2), 6, 2, lenient)


def dimension_columns(raw: DataFrame) -> dict[str, Column]:
    """P1, P3-P6 on the landing row."""
    return {
        "credit_limit_band": enc.limit_band(F.col("credit_limit")),
        "gender": enc.gender_label(F.col("gender")),
        "education": enc.education_label(F.col("education")),
        "marital_status": enc.marital_label(F.col("marital_status")),
        "age_band": enc.age_band(F.col("age")),
    }


def with_wide_features(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """Landing rows + P10-P19 (keeps the raw columns, labels not yet mapped)."""
    df = raw.withColumns({f"timeliness_{i}_dpd": enc.dpd(F.col(f"timeliness_{i}"), lenient) for i in MONTHS})
    d = [F.col(c) for c in DPD_WIDE]
    df = df.withColumns({
        "current_dpd": d[0],
        "worst_dpd_6mo": F.greatest(*d),
        "months_delinquent_6mo": sum(((x > 0).cast("int") for x in d[1:]), (d[0] > 0).cast("int")),
        "avg_dpd_6mo": _avg_dpd(sum(d[1:], d[0]), len(d), lenient),
        "total_bill_6mo": fit_decimal(sum_skip_null([F.col(c) for c in BALANCES]), 16, 2, lenient),
        "total_paid_6mo": fit_decimal(sum_skip_null([F.col(c) for c in PAYMENTS]), 16, 2, lenient),
    })
    df = df.withColumns({
        "collections_stage": enc.stage(F.col("current_dpd")),
        "payment_to_bill_ratio": _ratio(F.col("total_paid_6mo"), F.col("total_bill_6mo"), lenient),
        "credit_utilization": _utilization(F.col("avg_balance"), F.col("credit_limit"), lenient),
        "default_flag": enc.default_flag(F.col("default_raw")),
    })
    df = df.withColumn(
        "risk_score",
        _score(F.col("worst_dpd_6mo"), F.col("months_delinquent_6mo"),
               F.col("credit_utilization"), F.col("payment_to_bill_ratio"), lenient),
    )
    return df.withColumn("risk_grade", enc.risk_grade(F.col("risk_score")))


def _fact_columns() -> list[Column]:
    """Feature-fact columns in DDL order with their SMALLINT casts."""
    small = ("current_dpd", "worst_dpd_6mo", "months_delinquent_6mo", "default_flag")
    return [F.col(c).cast("smallint").alias(c) if c in small else F.col(c) for c in FACT_RISK_COLUMNS]


def _typed_fact(df: DataFrame) -> DataFrame:
    return df.select(*_fact_columns())


def risk_mart(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """Denormalised mart: dimension + feature fact, one row per account, no shuffle."""
    df = with_wide_features(raw, lenient).withColumns(dimension_columns(raw))
    return df.select(*[F.col(c) for c in DIM_COLUMNS], *_fact_columns()[1:]).select(*MART_COLUMNS)


def engineered_wide(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """The 47-column engineered table in its published order."""
    df = with_wide_features(raw, lenient).withColumns(dimension_columns(raw))
    return df.withColumnRenamed("default_raw", "default").select(
        "customer_id", "credit_limit", "gender", "education", "marital_status", "age",
        "age_band", "credit_limit_band",
        *[f"timeliness_{i}" for i in MONTHS], *DPD_WIDE,
        "current_dpd", "worst_dpd_6mo", "months_delinquent_6mo", "avg_dpd_6mo", "collections_stage",
        *BALANCES, *PAYMENTS,
        "total_bill_6mo", "total_paid_6mo", "payment_to_bill_ratio", "avg_balance", "avg_payment",
        "credit_utilization", "risk_score", "risk_grade", "default", "default_flag",
    )


def dpd_wide(raw: DataFrame, lenient: bool = False) -> DataFrame:
    """Every column whose name contains 'dpd' (``filter(like='dpd')``)."""
    df = with_wide_features(raw, lenient)
    return df.select("customer_id", *[c for c in df.columns if "dpd" in c])


def long_path_fact(repayment: DataFrame, statements: DataFrame, dim: DataFrame,
                   staging: DataFrame, lenient: bool = False) -> DataFrame:
    """The SQL-shaped derivation of fact_credit_risk: two per-customer aggregates over
    the long facts joined back to dimension and staging (J1, J2, A3, A5, A6)."""
    rep = repayment.groupBy("customer_id").agg(
        F.max(F.when(F.col("statement_month") == 1, F.col("dpd"))).alias("current_dpd"),
        F.max("dpd").alias("worst_dpd_6mo"),
        F.count_if(F.col("dpd") > 0).alias("months_delinquent_6mo"),
        fit_decimal(F.round(dec(F.sum("dpd")) / dec(F.count("dpd")), 2), 6, 2, lenient).alias("avg_dpd_6mo"),
    )
    st = statements.groupBy("customer_id").agg(
        fit_decimal(F.sum("bill_amount"), 16, 2, lenient).alias("total_bill_6mo"),
        fit_decimal(F.sum("payment_amount"), 16, 2, lenient).alias("total_paid_6mo"),
    )
    base = (
        dim.select("customer_id", "credit_limit")
        .join(rep, "customer_id")
        .join(st, "customer_id")
        .join(staging.select("customer_id", "avg_balance", "default_raw"), "customer_id")
        .withColumns({
            "payment_to_bill_ratio": _ratio(F.col("total_paid_6mo"), F.col("total_bill_6mo"), lenient),
            "credit_utilization": _utilization(F.col("avg_balance"), F.col("credit_limit"), lenient),
        })
    )
    scored = base.withColumn(
        "risk_score",
        _score(F.col("worst_dpd_6mo"), F.col("months_delinquent_6mo"),
               F.col("credit_utilization"), F.col("payment_to_bill_ratio"), lenient),
    )
    out = scored.withColumns({
        "collections_stage": enc.stage(F.col("current_dpd")),
        "risk_grade": enc.risk_grade(F.col("risk_score")),
        "default_flag": enc.default_flag(F.col("default_raw")),
    })
    return _typed_fact(out).select(*FACT_RISK_COLUMNS)
