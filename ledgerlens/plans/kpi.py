"""Executive KPIs, BI views and the dashboard refresh extract (K1, V1-V4, K6, K7).

KPI and view queries take the mart (``agg=ROWS``) or its segment cube (``agg=CUBE``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import INT_DIGITS, dec, pct, quotient, round_money
from ..operators.segments import CUBE, ROWS, Aggregator, build_cube, efficiency_pct, segment_report
from ..schema import GRADE_LABELS

HIGH_RISK = list(GRADE_LABELS[2:])   # grades C and D
LOW_RISK = GRADE_LABELS[0]           # grade A
SEVERE_DPD = 6


def _kpis(src: DataFrame, agg: Aggregator, with_grade_rates: bool) -> DataFrame:
    src = agg.prepare(src)
    grade = F.col("risk_grade")
    high = grade.isin(HIGH_RISK)
    low = grade == F.lit(LOW_RISK)
    aggs = [
        agg.n().cast("bigint").alias("total_accounts"),
        pct(agg.s("default_flag"), agg.c("default_flag"), 2).alias("overall_default_rate_pct"),
        round_money(agg.s("credit_limit")).alias("total_credit_exposure"),
        round_money(agg.s("total_bill_6mo")).alias("total_outstanding_bill"),
        round_money(agg.s("total_paid_6mo")).alias("total_collected_6mo"),
        efficiency_pct(agg).alias("collection_efficiency_pct"),
        agg.n_if(F.col("dpd_capped") >= SEVERE_DPD).cast("bigint").alias("severe_dpd_accounts"),
        agg.n_if(high).cast("bigint").alias("high_risk_plus_accounts"),
    ]
    if with_grade_rates:
        # AVG(x) FILTER (WHERE cond): NULL when no row qualifies.
        aggs += [
            pct(agg.s_if("default_flag", high), agg.c_if("default_flag", high), 2)
            .alias("high_risk_default_rate_pct"),
            pct(agg.s_if("default_flag", low), agg.c_if("default_flag", low), 2)
            .alias("low_risk_default_rate_pct"),
        ]
    return src.agg(*aggs)


def executive_summary(src: DataFrame, agg: Aggregator = ROWS) -> DataFrame:
    """K1: one row, ten portfolio metrics."""
    return _kpis(src, agg, with_grade_rates=True)


def vw_dashboard_kpi_summary(src: DataFrame, agg: Aggregator = ROWS) -> DataFrame:
    """V1: the first eight K1 metrics."""
    return _kpis(src, agg, with_grade_rates=False)


def vw_risk_grade_summary(src: DataFrame, agg: Aggregator = ROWS) -> DataFrame:
    """V2."""
    return segment_report(src, ["risk_grade"], ["accounts", "default_rate_pct", "avg_risk_score"], agg=agg)


def vw_collections_stage_summary(src: DataFrame, agg: Aggregator = ROWS) -> DataFrame:
    """V3."""
    return segment_report(src, ["collections_stage"], ["accounts", "default_rate_pct", "total_outstanding",
                                                       "total_collected", "collection_efficiency_pct"], agg=agg)


def vw_credit_limit_band_trend(src: DataFrame, agg: Aggregator = ROWS) -> DataFrame:
    """V4."""
    return segment_report(src, ["credit_limit_band"], ["accounts", "default_rate_pct"], agg=agg)


VIEWS = {
    "vw_dashboard_kpi_summary": vw_dashboard_kpi_summary,
    "vw_risk_grade_summary": vw_risk_grade_summary,
    "vw_collections_stage_summary": vw_collections_stage_summary,
    "vw_credit_limit_band_trend": vw_credit_limit_band_trend,
}


def _quotient_sql(num: str, den: str, scale: int = 2, mult: int = 1, num_frac: int = 0, den_frac: int = 0) -> str:
    """``numeric.quotient`` as SQL text."""
    digits = lambda frac: f"DECIMAL({INT_DIGITS + frac}, {frac})"
    return f"CAST(ROUND(CAST({num} AS {digits(num_frac)}) * {mult} / NULLIF(CAST({den} AS {digits(den_frac)}), 0), {scale}) AS DOUBLE)"


_RATE = _quotient_sql("SUM(default_flag)", "COUNT(default_flag)", mult=100) + " AS default_rate_pct"
_EFFICIENCY = _quotient_sql("SUM(total_paid_6mo)", "SUM(total_bill_6mo)", mult=100, num_frac=2, den_frac=2) + " AS collection_efficiency_pct"
_STAR = "FROM {fact_credit_risk} JOIN {dim_customers} USING (customer_id)"
#: The BI views as SQL over the stored tables (``store`` keeps them beside its manifest).
VIEW_SQL = {
    "vw_dashboard_kpi_summary": f"""SELECT COUNT(*) AS total_accounts, {_RATE.replace("default_rate_pct", "overall_default_rate_pct")},
        CAST(ROUND(SUM(credit_limit), 0) AS BIGINT) AS total_credit_exposure, CAST(ROUND(SUM(total_bill_6mo), 0) AS BIGINT) AS total_outstanding_bill,
        CAST(ROUND(SUM(total_paid_6mo), 0) AS BIGINT) AS total_collected_6mo, {_EFFICIENCY},
        COUNT(*) FILTER (WHERE current_dpd >= {SEVERE_DPD}) AS severe_dpd_accounts,
        COUNT(*) FILTER (WHERE risk_grade IN ({", ".join(repr(g) for g in HIGH_RISK)})) AS high_risk_plus_accounts {_STAR}""",
    "vw_risk_grade_summary": f"""SELECT risk_grade, COUNT(*) AS accounts, {_RATE},
        {_quotient_sql("SUM(risk_score)", "COUNT(risk_score)", num_frac=2)} AS avg_risk_score FROM {{fact_credit_risk}} GROUP BY risk_grade""",
    "vw_collections_stage_summary": f"""SELECT collections_stage, COUNT(*) AS accounts, {_RATE},
        CAST(ROUND(SUM(total_bill_6mo), 0) AS BIGINT) AS total_outstanding, CAST(ROUND(SUM(total_paid_6mo), 0) AS BIGINT) AS total_collected,
        {_EFFICIENCY} FROM {{fact_credit_risk}} GROUP BY collections_stage""",
    "vw_credit_limit_band_trend": f"""SELECT credit_limit_band, COUNT(*) AS accounts, {_RATE} {_STAR} GROUP BY credit_limit_band""",
}


def register_views(src: DataFrame, agg: Aggregator = ROWS, prefix: str = "") -> list[str]:
    """CREATE OR REPLACE VIEW for each BI view (temp views; every pull re-runs the
    aggregate, as database views do)."""
    names = []
    for name, fn in VIEWS.items():
        fn(src, agg).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


def monthly_trend(statements: DataFrame) -> DataFrame:
    """K6: average bill and payment per statement month, newest month last (DESC).

    AVG(payment) / AVG(bill) is the product of SUM(payment) / SUM(bill) and COUNT(bill) /
    COUNT(payment), each carried at 12 digits or more and rounded once: no intermediate
    grows with the number of accounts as SUM * COUNT would."""
    bill, paid = F.col("bill_amount"), F.col("payment_amount")
    sums = (dec(F.sum(paid), 2) / F.nullif(dec(F.sum(bill), 2), F.lit(0))).cast("decimal(26,14)")
    counts = (dec(F.count(bill)) / F.nullif(dec(F.count(paid)), F.lit(0))).cast("decimal(24,12)")
    ratio = F.round(sums * counts * F.lit(100), 2)
    return (statements.groupBy("statement_month").agg(
        quotient(F.sum(bill), F.count(bill), 0, 1, 2, 0).cast("bigint").alias("avg_bill_amount"),
        quotient(F.sum(paid), F.count(paid), 0, 1, 2, 0).cast("bigint").alias("avg_payment_amount"),
        ratio.cast("double").alias("avg_payment_ratio_pct"),
    ).withColumn("statement_month", F.col("statement_month").cast("bigint"))
        .orderBy(F.col("statement_month").desc()))


DASHBOARD_KEYS = ("credit_limit_band", "age_band", "education", "marital_status", "gender",
                  "risk_grade", "collections_stage")


def dashboard_refresh(src: DataFrame, agg: Aggregator = ROWS) -> DataFrame:
    """K7: GROUPING SETS of the seven single keys, plus ``grouping_set`` naming the key
    (a NULL gender group and a 'not grouped by gender' row are otherwise identical).

    Measures are algebraic, so the grouping-set ``Expand`` runs on segment-cube cells
    (at most a few hundred thousand) instead of on every account: account rows are
    first aggregated into the cube (ROWS), or the stored cube is used directly (CUBE)."""
    cells = build_cube(src) if agg is ROWS else src
    gid = F.grouping_id(*DASHBOARD_KEYS)
    full = (1 << len(DASHBOARD_KEYS)) - 1
    name = None
    for i, key in enumerate(DASHBOARD_KEYS):
        # grouping_id bit for key i is set when the key is aggregated away.
        only = full ^ (1 << (len(DASHBOARD_KEYS) - 1 - i))
        name = F.when(gid == only, F.lit(key)) if name is None else name.when(gid == only, F.lit(key))
    return cells.groupingSets([[k] for k in DASHBOARD_KEYS], *DASHBOARD_KEYS).agg(
        CUBE.n().cast("bigint").alias("accounts"),
        pct(CUBE.s("default_flag"), CUBE.c("default_flag"), 2).alias("default_rate_pct"),
        round_money(CUBE.s("total_bill_6mo")).alias("total_outstanding"),
        round_money(CUBE.s("total_paid_6mo")).alias("total_collected"),
        name.alias("grouping_set"),
    )
