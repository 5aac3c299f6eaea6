"""Oracle SQL (DuckDB) for every registered key.

Each statement = portfolio CTE chain (``oracle.portfolio.cte``) + the report written
directly in SQL with integer cents / milli-ratios / centi-scores and integer half-up
rounding. Outputs use BIGINT for counts and DOUBLE for rounded values, matching the
Spark side's output types.
"""

from __future__ import annotations

from .portfolio import cents_round0, cte, hu_bigint, hu_double, scaled

M = range(1, 7)

DR = hu_double("SUM(default_flag)", "COUNT(*)", 2, 100)
SHARE = hu_double("COUNT(*)", "SUM(COUNT(*)) OVER ()", 2, 100)
AVG_SCORE = hu_double("SUM(score_c)", "100 * COUNT(score_c)", 2)
AVG_UTIL_PCT = hu_double("SUM(util_m)", "10 * COUNT(util_m)", 1)
AVG_RATIO_PCT = hu_double("SUM(ratio_m)", "10 * COUNT(ratio_m)", 1)
AVG_LIMIT = hu_bigint("SUM(limit_c)", "100 * COUNT(limit_c)")
OUT = cents_round0("SUM(bill_c)")
COLL = cents_round0("SUM(paid_c)")
EFF = hu_double("SUM(paid_c)", "SUM(bill_c)", 2, 100)

# Output-typed relations over the oracle mart.
RAW_SELECT = ", ".join(
    ["customer_id", f"{scaled('limit_c', 2)} AS credit_limit", "gender", "education", "marital_status",
     "CAST(age AS DOUBLE) AS age"]
    + [f"timeliness_{i}" for i in M]
    + [f"{scaled(f'c{i}', 2)} AS balance_{i}" for i in M]
    + [f"{scaled(f'p{i}', 2)} AS payment_{i}" for i in M]
    + [f"{scaled('avgbal_c', 2)} AS avg_balance", f"{scaled('avgpay_c', 2)} AS avg_payment", "default_raw"])

DIM_SELECT = ", ".join([
    "customer_id", f"{scaled('limit_c', 2)} AS credit_limit", "credit_limit_band", "gender_l AS gender",
    "education_l AS education", "marital_l AS marital_status", "CAST(age AS DOUBLE) AS age", "age_band"])

FACT_SELECT = ", ".join([
    "customer_id", "CAST(current_dpd AS BIGINT) AS current_dpd", "CAST(worst_dpd_6mo AS BIGINT) AS worst_dpd_6mo",
    "CAST(months_delinquent_6mo AS BIGINT) AS months_delinquent_6mo",
    f"{scaled('avg_dpd_c', 2)} AS avg_dpd_6mo", "collections_stage",
    f"{scaled('bill_c', 2)} AS total_bill_6mo", f"{scaled('paid_c', 2)} AS total_paid_6mo",
    f"{scaled('ratio_m', 3)} AS payment_to_bill_ratio", f"{scaled('util_m', 3)} AS credit_utilization",
    f"{scaled('score_c', 2)} AS risk_score", "risk_grade", "CAST(default_flag AS BIGINT) AS default_flag"])

REPAY_UNION = " UNION ALL ".join(
    f"SELECT customer_id, CAST({i} AS BIGINT) AS statement_month, timeliness_{i} AS timeliness_code, "
    f"CAST(d{i} AS BIGINT) AS dpd FROM mart" for i in M)
STMT_UNION = " UNION ALL ".join(
    f"SELECT customer_id, CAST({i} AS BIGINT) AS statement_month, c{i} AS bill_c, p{i} AS pay_c FROM mart"
    for i in M)


def _q(body: str, dirty: bool = False) -> str:
    return cte(dirty) + body


def _tables_cte() -> str:
    """Extra CTEs exposing the five star-schema tables (output-typed)."""
    return (f", t_staging AS (SELECT {RAW_SELECT} FROM mart)"
            f", t_dim AS (SELECT {DIM_SELECT} FROM mart)"
            f", t_repay AS ({REPAY_UNION})"
            f", t_stmt AS (SELECT customer_id, statement_month, {scaled('bill_c', 2)} AS bill_amount, "
            f"{scaled('pay_c', 2)} AS payment_amount FROM ({STMT_UNION}))"
            f", t_fact AS (SELECT {FACT_SELECT} FROM mart)\n")


def _set(column: str, modulus: int, value: str, where: str = "TRUE") -> str:
    return f"CASE WHEN (customer_id - 1) % {modulus} = 0 AND {where} THEN {value} ELSE {column} END AS {column}"


def _broken_cte() -> str:
    """The five tables with the audit fixture's defects."""
    changes = {
        "staging": [_set("gender", 601, "'not disclosed'"), _set("timeliness_2", 607, "'m+x'"),
                    _set("credit_limit", 613, "credit_limit + 1000000000000")],
        "dim": [_set("age_band", 617, "'age not given'"), _set("customer_id", 619, "-customer_id")],
        "repay": [_set("timeliness_code", 631, "'m+late'", "statement_month = 2"),
                  _set("statement_month", 641, "7", "statement_month = 6")],
        "stmt": [_set("bill_amount", 643, "bill_amount + 1000000000000", "statement_month = 3"),
                 _set("statement_month", 647, "0", "statement_month = 1")],
        "fact": [_set("risk_score", 653, "risk_score + 1000000"), _set("default_flag", 659, "2"),
                 _set("customer_id", 661, "-customer_id")],
    }
    return "".join(f", b_{t} AS (SELECT * REPLACE ({', '.join(c)}) FROM t_{t})" for t, c in changes.items()) + "\n"


TABLE_REL = {"staging_raw_credit_data": "b_staging", "dim_customers": "b_dim",
             "fact_repayment_history": "b_repay", "fact_statements": "b_stmt", "fact_credit_risk": "b_fact"}

# The declared constraints, restated here from the table definitions.
KEYS = {"staging_raw_credit_data": "customer_id", "dim_customers": "customer_id",
        "fact_repayment_history": "customer_id,statement_month", "fact_statements": "customer_id,statement_month",
        "fact_credit_risk": "customer_id"}
PARENTS = {"dim_customers": "staging_raw_credit_data", "fact_repayment_history": "dim_customers",
           "fact_statements": "dim_customers", "fact_credit_risk": "dim_customers"}
CHECKS = {"fact_repayment_history": "statement_month BETWEEN 1 AND 6",
          "fact_statements": "statement_month BETWEEN 1 AND 6", "fact_credit_risk": "default_flag IN (0, 1)"}
NOT_NULL = {
    "staging_raw_credit_data": "customer_id credit_limit",
    "dim_customers": "customer_id credit_limit credit_limit_band",
    "fact_repayment_history": "customer_id statement_month dpd",
    "fact_statements": "customer_id statement_month bill_amount payment_amount",
    "fact_credit_risk": "customer_id current_dpd worst_dpd_6mo months_delinquent_6mo avg_dpd_6mo collections_stage "
                        "total_bill_6mo total_paid_6mo payment_to_bill_ratio credit_utilization risk_score "
                        "risk_grade default_flag"}
NUMERIC = {
    "staging_raw_credit_data": {c: (14, 2) for c in ["credit_limit", "avg_balance", "avg_payment"]
                                + [f"balance_{i}" for i in M] + [f"payment_{i}" for i in M]},
    "dim_customers": {"credit_limit": (14, 2)},
    "fact_statements": {"bill_amount": (14, 2), "payment_amount": (14, 2)},
    "fact_credit_risk": {"avg_dpd_6mo": (6, 2), "total_bill_6mo": (16, 2), "total_paid_6mo": (16, 2),
                         "payment_to_bill_ratio": (6, 3), "credit_utilization": (6, 3), "risk_score": (8, 2)}}
VARCHAR = {
    "staging_raw_credit_data": {"gender": 10, "education": 20, "marital_status": 20, "default_raw": 5,
                                **{f"timeliness_{i}": 5 for i in M}},
    "dim_customers": {"credit_limit_band": 20, "gender": 10, "education": 20, "marital_status": 20, "age_band": 10},
    "fact_repayment_history": {"timeliness_code": 5},
    "fact_credit_risk": {"collections_stage": 30, "risk_grade": 20}}

STAGES = ("1-Current", "2-Early DPD (1-2mo)", "3-Mid DPD (3-5mo)", "4-Severe DPD (6mo+)")


def _stage_sql(x: str) -> str:
    return (f"CASE WHEN {x} <= 0 THEN '1-Current' WHEN {x} <= 2 THEN '2-Early DPD (1-2mo)' "
            f"WHEN {x} <= 5 THEN '3-Mid DPD (3-5mo)' ELSE '4-Severe DPD (6mo+)' END")


def _pk_sql() -> str:
    parts = []
    for name, rel in TABLE_REL.items():
        key = KEYS[name]
        parts.append(
            f"SELECT '{name}' AS table_name, '{key}' AS key_columns, "
            f"CAST(COALESCE(SUM(n), 0) AS BIGINT) AS total_rows, COUNT(*) AS distinct_keys, "
            f"COUNT(*) FILTER (WHERE n > 1) AS duplicate_keys, CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS excess_rows "
            f"FROM (SELECT {key}, COUNT(*) AS n FROM {rel} GROUP BY {key})")
    return " UNION ALL ".join(parts)


def _fk_sql() -> str:
    parts = []
    for name, rel in TABLE_REL.items():
        if name not in PARENTS:
            continue
        parent = PARENTS[name]
        parts.append(
            f"SELECT '{name}' AS child_table, '{parent}' AS parent_table, COUNT(*) AS orphan_rows "
            f"FROM {rel} c WHERE NOT EXISTS (SELECT 1 FROM {TABLE_REL[parent]} p WHERE p.customer_id = c.customer_id)")
    return " UNION ALL ".join(parts)


def _check_sql() -> str:
    parts = []
    for name, cond in CHECKS.items():
        parts.append(f"SELECT '{name}' AS table_name, '{cond}' AS check_name, "
                     f"COUNT(*) FILTER (WHERE NOT ({cond})) AS violations FROM {TABLE_REL[name]}")
    return " UNION ALL ".join(parts)


def _notnull_sql() -> str:
    parts = []
    for name, rel in TABLE_REL.items():
        for c in NOT_NULL[name].split():
            parts.append(f"SELECT '{name}' AS table_name, '{c}' AS column_name, "
                         f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM {rel}")
    return " UNION ALL ".join(parts)


def _domain_sql() -> str:
    parts = []
    for name, rel in TABLE_REL.items():
        for c, (p, s) in NUMERIC.get(name, {}).items():
            bound = 10 ** (p - s)
            parts.append(f"SELECT '{name}' AS table_name, '{c}' AS column_name, 'NUMERIC({p},{s})' AS rule, "
                         f"COUNT(*) FILTER (WHERE abs(round({c}, {s})) >= {bound}) AS violations FROM {rel}")
        for c, n in VARCHAR.get(name, {}).items():
            parts.append(f"SELECT '{name}' AS table_name, '{c}' AS column_name, 'VARCHAR({n})' AS rule, "
                         f"COUNT(*) FILTER (WHERE length({c}) > {n}) AS violations FROM {rel}")
        if name in ("staging_raw_credit_data", "fact_repayment_history"):
            for c in VARCHAR[name]:
                if c.startswith("timeliness"):
                    parts.append(
                        f"SELECT '{name}' AS table_name, '{c}' AS column_name, 'repayment code' AS rule, "
                        f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST(REPLACE({c}, 'm', '') AS INTEGER) "
                        f"IS NULL) AS violations FROM {rel}")
    return " UNION ALL ".join(parts)


def _describe_sql() -> str:
    text = ["gender", "education", "marital_status"] + [f"timeliness_{i}" for i in range(1, 6)]
    stacked = " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS value FROM mart" for c in text)
    str_part = (
        f"SELECT column_name, CAST(SUM(n) AS BIGINT) AS count, CAST(COUNT(*) AS DOUBLE) AS unique, "
        f"max(CASE WHEN r = 1 THEN value END) AS top, CAST(max(CASE WHEN r = 1 THEN n END) AS DOUBLE) AS freq, "
        f"CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min, "
        f"CAST(NULL AS DOUBLE) AS p25, CAST(NULL AS DOUBLE) AS p50, CAST(NULL AS DOUBLE) AS p75, "
        f"CAST(NULL AS DOUBLE) AS max FROM ("
        f"SELECT column_name, value, n, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS r "
        f"FROM (SELECT column_name, value, COUNT(*) AS n FROM ({stacked}) WHERE value IS NOT NULL "
        f"GROUP BY column_name, value)) GROUP BY column_name")
    nums = []
    for c, x in (("credit_limit", "CAST(limit_c AS DOUBLE) / 100"), ("age", "CAST(age AS DOUBLE)")):
        nums.append(
            f"SELECT '{c}' AS column_name, COUNT({x}) AS count, CAST(NULL AS DOUBLE) AS unique, "
            f"CAST(NULL AS VARCHAR) AS top, CAST(NULL AS DOUBLE) AS freq, round(avg({x}), 6) AS mean, "
            f"round(stddev_samp({x}), 6) AS std, min({x}) AS min, quantile_cont({x}, 0.25) AS p25, "
            f"quantile_cont({x}, 0.5) AS p50, quantile_cont({x}, 0.75) AS p75, max({x}) AS max FROM mart")
    return " UNION ALL ".join([str_part] + nums)


def _corr_sql() -> str:
    feats = {
        "worst_dpd_6mo": "worst_dpd_6mo", "months_delinquent_6mo": "months_delinquent_6mo",
        "avg_dpd_6mo": "avg_dpd_c / 100.0", "payment_to_bill_ratio": "ratio_m / 1000.0",
        "credit_utilization": "util_m / 1000.0", "risk_score": "score_c / 100.0", "age": "age",
        "credit_limit": "limit_c / 100.0",
    }
    cols = ", ".join(f"corr(CAST({x} AS DOUBLE), CAST(default_flag AS DOUBLE)) AS {n}" for n, x in feats.items())
    return (f"SELECT feature, round(corr, 9) AS corr FROM (SELECT {cols} FROM mart) "
            f"UNPIVOT (corr FOR feature IN ({', '.join(feats)}))")


def _engineered_sql() -> str:
    cols = (["customer_id", f"{scaled('limit_c', 2)} AS credit_limit", "gender_l AS gender",
             "education_l AS education", "marital_l AS marital_status", "CAST(age AS DOUBLE) AS age",
             "age_band", "credit_limit_band"]
            + [f"timeliness_{i}" for i in M]
            + [f"CAST(d{i} AS BIGINT) AS timeliness_{i}_dpd" for i in M]
            + ["CAST(current_dpd AS BIGINT) AS current_dpd", "CAST(worst_dpd_6mo AS BIGINT) AS worst_dpd_6mo",
               "CAST(months_delinquent_6mo AS BIGINT) AS months_delinquent_6mo",
               f"{scaled('avg_dpd_c', 2)} AS avg_dpd_6mo", "collections_stage"]
            + [f"{scaled(f'c{i}', 2)} AS balance_{i}" for i in M]
            + [f"{scaled(f'p{i}', 2)} AS payment_{i}" for i in M]
            + [f"{scaled('bill_c', 2)} AS total_bill_6mo", f"{scaled('paid_c', 2)} AS total_paid_6mo",
               f"{scaled('ratio_m', 3)} AS payment_to_bill_ratio", f"{scaled('avgbal_c', 2)} AS avg_balance",
               f"{scaled('avgpay_c', 2)} AS avg_payment", f"{scaled('util_m', 3)} AS credit_utilization",
               f"{scaled('score_c', 2)} AS risk_score", "risk_grade", 'default_raw AS "default"',
               "CAST(default_flag AS BIGINT) AS default_flag"])
    return f"SELECT {', '.join(cols)} FROM mart"


def _dpd_wide_sql() -> str:
    cols = (["customer_id"] + [f"CAST(d{i} AS BIGINT) AS timeliness_{i}_dpd" for i in M]
            + ["CAST(current_dpd AS BIGINT) AS current_dpd", "CAST(worst_dpd_6mo AS BIGINT) AS worst_dpd_6mo",
               f"{scaled('avg_dpd_c', 2)} AS avg_dpd_6mo"])
    return f"SELECT {', '.join(cols)} FROM mart"


def _reconcile_sql() -> str:
    """Q17 in SQL: the long path (unpivot -> aggregate per customer -> features) against
    the wide integer features (with the fact table's defects), full outer join on customer_id."""
    pairs = [("cur", "current_dpd", "current_dpd"), ("worst", "worst_dpd_6mo", "worst_dpd_6mo"),
             ("late", "months_delinquent_6mo", "months_delinquent_6mo"), ("avgd", "avg_dpd_c", "avg_dpd_6mo"),
             ("stage", "collections_stage", "collections_stage"), ("bill", "bill_c", "total_bill_6mo"),
             ("paid", "paid_c", "total_paid_6mo"), ("ratio", "ratio_m", "payment_to_bill_ratio"),
             ("util", "util_m", "credit_utilization"), ("score", "score_c", "risk_score"),
             ("grade", "risk_grade", "risk_grade"), ("flag", "default_flag", "default_flag")]
    differing = [f"COUNT(*) FILTER (WHERE l.customer_id IS NOT NULL AND w.customer_id IS NOT NULL "
                 f"AND l.{a} IS DISTINCT FROM w.{b})" for a, b, _ in pairs]
    months = " UNION ALL ".join(
        f"SELECT customer_id, {i} AS m, d{i} AS d, c{i} AS b, p{i} AS p FROM mart" for i in M)
    return f"""
, lng AS (
  SELECT customer_id, MAX(d) FILTER (WHERE m = 1) AS cur, MAX(d) AS worst,
         COUNT(*) FILTER (WHERE d > 0) AS late, (2 * SUM(d) * 100 + COUNT(d)) // (2 * COUNT(d)) AS avgd,
         SUM(b) AS bill, SUM(p) AS paid
  FROM ({months}) GROUP BY customer_id
), lng2 AS (
  SELECT l.*, w.limit_c, w.avgbal_c, w.default_raw,
    CASE WHEN bill > 0 THEN (2 * paid * 1000 + bill) // (2 * bill) ELSE 1000 END AS ratio,
    CASE WHEN w.limit_c = 0 THEN NULL ELSE (2 * w.avgbal_c * 1000 + w.limit_c) // (2 * w.limit_c) END AS util
  FROM lng l JOIN mart w USING (customer_id)
), lng3 AS (
  SELECT *, worst * 1000 + late * 500 + (CASE WHEN util > 800 THEN (util - 800) * 2 ELSE 0 END)
            + (CASE WHEN ratio < 300 THEN (300 - ratio) * 3 ELSE 0 END) AS score,
         {_stage_sql('cur')} AS stage,
         CASE WHEN lower(default_raw) = 'yes' THEN 1 ELSE 0 END AS flag
  FROM lng2
), lng4 AS (
  SELECT *, CASE WHEN score < 500 THEN 'A - Low Risk' WHEN score < 1500 THEN 'B - Moderate Risk'
                 WHEN score < 3000 THEN 'C - High Risk' ELSE 'D - Severe Risk' END AS grade
  FROM lng3
), wide AS (
  SELECT * REPLACE ({_set("score_c", 653, "score_c + 100000000")}, {_set("default_flag", 659, "2")},
                    {_set("customer_id", 661, "-customer_id")}) FROM mart
)
SELECT c.column_name, c.customers_differing, c.customers_compared, c.only_long, c.only_wide FROM (
  SELECT UNNEST([{", ".join(f"'{name}'" for _, _, name in pairs)}]) AS column_name,
         UNNEST([{", ".join(differing)}]) AS customers_differing,
         COUNT(*) AS customers_compared,
         COUNT(*) FILTER (WHERE w.customer_id IS NULL) AS only_long,
         COUNT(*) FILTER (WHERE l.customer_id IS NULL) AS only_wide
  FROM lng4 l FULL OUTER JOIN wide w ON l.customer_id = w.customer_id) c"""


def _place(values: tuple[str, ...], column: str) -> str:
    return f"list_position([{', '.join(repr(v) for v in values)}], {column})"


_BANDS = _place(("<50K", "50K-100K", "100K-200K", "200K-300K", "300K-500K", "500K+"), "credit_limit_band")
_AGES = _place(("<25", "25-34", "35-44", "45-54", "55-64", "65+"), "age_band")
#: (report, ORDER BY, columns that name a row)
ORDERS = [
    ("risk_grade_segments", "risk_grade", "risk_grade"), ("limit_band_segments", _BANDS, "credit_limit_band"), ("age_band_segments", _AGES, "age_band"),
    ("edu_marital_segments", "education, marital_status", "education, marital_status"),
    ("top_risk_segments", "default_rate_pct DESC NULLS FIRST, age_band, education, credit_limit_band", "age_band, education, credit_limit_band"),
    ("risk_deciles", "risk_decile", "risk_decile"), ("grade_behaviour", "risk_grade", "risk_grade"), ("collections_funnel", "collections_stage", "collections_stage"),
    ("dpd_distribution", "try_cast(regexp_extract(dpd_bucket, '^[0-9]+') AS INT)", "dpd_bucket"),
    ("roll_rate_matrix", "prior_stage, current_stage", "prior_stage, current_stage"), ("roll_rate_pivot", "prior_stage", "prior_stage"),
    ("exposure_concentration", "collections_stage", "collections_stage"),
    ("efficiency_ranking", "collection_efficiency_pct NULLS LAST, credit_limit_band, age_band", "credit_limit_band, age_band"),
    ("monthly_trend", "statement_month DESC", "statement_month"), ("eda_limit_band_curve", _BANDS, "credit_limit_band"),
    ("eda_stage_counts", "collections_stage", "collections_stage"), ("stage_value_counts", "accounts DESC, collections_stage", "collections_stage"),
    ("default_correlation", "corr NULLS LAST, feature", "feature"),
]


def _segment(keys: str, metrics: str, having: str = "") -> str:
    return f"SELECT {keys}, {metrics} FROM mart GROUP BY {keys} {having}"


def _roll_base() -> str:
    return f"SELECT {_stage_sql('d2')} AS prior_stage, {_stage_sql('d1')} AS current_stage FROM mart"


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    T = _tables_cte()
    # --- sources, tables, projections -------------------------------------------------
    q["src_raw_scan"] = _q(f"SELECT {RAW_SELECT} FROM mart")
    q["dim_customers"] = _q(f"SELECT {DIM_SELECT} FROM mart")
    q["fact_repayment_history"] = _q(REPAY_UNION)
    q["fact_statements"] = _q(
        f"SELECT customer_id, statement_month, {scaled('bill_c', 2)} AS bill_amount, "
        f"{scaled('pay_c', 2)} AS payment_amount FROM ({STMT_UNION})")
    q["fact_credit_risk"] = _q(f"SELECT {FACT_SELECT} FROM mart")
    q["star_join_mart"] = _q(
        f"SELECT f.*, d.credit_limit, d.credit_limit_band, d.gender, d.education, d.marital_status, d.age, "
        f"d.age_band FROM (SELECT {FACT_SELECT} FROM mart) f JOIN (SELECT {DIM_SELECT} FROM mart) d "
        f"USING (customer_id)")
    q["engineered_wide"] = _q(_engineered_sql())
    q["dpd_wide"] = _q(_dpd_wide_sql())
    q["limit_band_right_closed"] = _q(
        f"SELECT customer_id, {scaled('limit_c', 2)} AS credit_limit, credit_limit_band, "
        f"CASE WHEN limit_c <= 0 THEN NULL WHEN limit_c <= 5000000 THEN '<50K' WHEN limit_c <= 10000000 "
        f"THEN '50K-100K' WHEN limit_c <= 20000000 THEN '100K-200K' WHEN limit_c <= 30000000 THEN '200K-300K' "
        f"WHEN limit_c <= 50000000 THEN '300K-500K' ELSE '500K+' END AS credit_limit_band_right_closed FROM mart")
    q["surrogate_key"] = "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS customer_id FROM orders"
    # --- data quality (dirty fixture unless noted) --------------------------------------
    q["dq_row_count"] = _q("SELECT COUNT(*) AS total_rows FROM mart", True)
    q["dq_null_profile"] = _q(
        "SELECT COUNT(*) FILTER (WHERE limit_c IS NULL) AS null_credit_limit, "
        "COUNT(*) FILTER (WHERE gender IS NULL) AS null_gender, "
        "COUNT(*) FILTER (WHERE education IS NULL) AS null_education, "
        "COUNT(*) FILTER (WHERE marital_status IS NULL) AS null_marital_status, "
        "COUNT(*) FILTER (WHERE age IS NULL) AS null_age, "
        "COUNT(*) FILTER (WHERE default_raw IS NULL) AS null_default FROM mart", True)
    src_cols = (["limit_c", "gender", "education", "marital_status", "age"] + [f"timeliness_{i}" for i in M]
                + [f"c{i}" for i in M] + [f"p{i}" for i in M] + ["avgbal_c", "avgpay_c", "default_raw"])
    q["dq_missing_total"] = _q(
        "SELECT CAST(" + " + ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL)" for c in src_cols)
        + " AS BIGINT) AS missing_cells FROM mart", True)
    q["dq_duplicate_keys"] = _q(
        "SELECT customer_id, COUNT(*) AS row_count FROM mart GROUP BY customer_id HAVING COUNT(*) > 1", True)
    q["dq_duplicate_rows"] = _q(
        f"SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_rows FROM "
        f"(SELECT COUNT(*) AS n FROM mart GROUP BY {', '.join(src_cols)})", True)
    q["dq_range_check"] = _q(
        f"SELECT customer_id, CAST(age AS DOUBLE) AS age, {scaled('limit_c', 2)} AS credit_limit FROM mart "
        f"WHERE age NOT BETWEEN 18 AND 100 OR limit_c <= 0", True)
    q["dq_category_audit"] = _q(
        "SELECT DISTINCT * FROM (" + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {c} AS value FROM mart"
            for c in ("gender", "education", "marital_status", "timeliness_1")) + ")", True)
    q["dq_layer_reconcile"] = _q(
        T + "SELECT s.staging_rows, d.dim_customer_rows, f.fact_risk_rows, r.repayment_rows_expect_6x, "
        "t.statement_rows_expect_6x, CAST((d.dim_customer_rows = s.staging_rows AND f.fact_risk_rows = s.staging_rows "
        "AND r.repayment_rows_expect_6x = 6 * s.staging_rows AND t.statement_rows_expect_6x = 6 * s.staging_rows) "
        "AS BIGINT) AS layers_ok FROM "
        "(SELECT COUNT(*) AS staging_rows FROM t_staging) s, (SELECT COUNT(*) AS dim_customer_rows FROM t_dim) d, "
        "(SELECT COUNT(*) AS fact_risk_rows FROM t_fact) f, "
        "(SELECT COUNT(*) AS repayment_rows_expect_6x FROM t_repay) r, "
        "(SELECT COUNT(*) AS statement_rows_expect_6x FROM t_stmt) t", True)
    q["dq_pk_audit"] = _q(T + _broken_cte() + _pk_sql(), True)
    q["dq_fk_audit"] = _q(T + _broken_cte() + _fk_sql(), True)
    q["dq_check_audit"] = _q(T + _broken_cte() + _check_sql(), True)
    q["dq_notnull_audit"] = _q(T + _broken_cte() + _notnull_sql(), True)
    q["dq_domain_audit"] = _q(T + _broken_cte() + _domain_sql(), True)
    q["dq_default_rate"] = _q(
        f"SELECT {hu_double('COUNT(*) FILTER (WHERE default_raw = ' + chr(39) + 'yes' + chr(39) + ')', 'COUNT(*)', 4)}"
        f" AS default_rate, "
        f"{hu_double('COUNT(*) FILTER (WHERE lower(default_raw) = ' + chr(39) + 'yes' + chr(39) + ')', 'COUNT(*)', 4)}"
        f" AS default_rate_sql FROM mart", True)
    q["dq_describe"] = _q(_describe_sql(), True)
    q["reconcile_long_wide"] = _q(_reconcile_sql())
    # --- risk segmentation -----------------------------------------------------------------
    q["risk_grade_segments"] = _q(_segment(
        "risk_grade", f"COUNT(*) AS accounts, {SHARE} AS pct_of_portfolio, {DR} AS default_rate_pct, "
        f"{AVG_LIMIT} AS avg_credit_limit, {AVG_UTIL_PCT} AS avg_utilization_pct, {AVG_SCORE} AS avg_risk_score"))
    q["limit_band_segments"] = _q(_segment(
        "credit_limit_band", f"COUNT(*) AS accounts, {DR} AS default_rate_pct, {AVG_SCORE} AS avg_risk_score"))
    q["age_band_segments"] = _q(_segment("age_band", f"COUNT(*) AS accounts, {DR} AS default_rate_pct"))
    q["edu_marital_segments"] = _q(
        f"SELECT education_l AS education, marital_l AS marital_status, COUNT(*) AS accounts, "
        f"{DR} AS default_rate_pct FROM mart GROUP BY education_l, marital_l")
    q["top_risk_segments"] = _q(
        f"SELECT age_band, education_l AS education, credit_limit_band, COUNT(*) AS accounts, "
        f"{DR} AS default_rate_pct, "
        f"RANK() OVER (ORDER BY CAST(SUM(default_flag) AS DOUBLE) / COUNT(*) DESC) AS risk_rank "
        f"FROM mart GROUP BY age_band, education_l, credit_limit_band HAVING COUNT(*) >= 100 "
        f"ORDER BY default_rate_pct DESC, age_band, education, credit_limit_band LIMIT 10")
    q["risk_deciles"] = _q(
        f"SELECT CAST(risk_decile AS BIGINT) AS risk_decile, COUNT(*) AS accounts, "
        f"{scaled('MIN(score_c)', 2)} AS min_score, {scaled('MAX(score_c)', 2)} AS max_score, {DR} AS default_rate_pct "
        f"FROM (SELECT *, NTILE(10) OVER (ORDER BY score_c, customer_id) AS risk_decile FROM mart) "
        f"GROUP BY risk_decile")
    q["decile_inversions"] = _q(
        f"SELECT risk_decile, default_rate_pct, LAG(default_rate_pct) OVER (ORDER BY risk_decile) "
        f"AS prev_default_rate_pct, CAST(COALESCE(default_rate_pct < LAG(default_rate_pct) OVER "
        f"(ORDER BY risk_decile), false) AS BIGINT) AS is_inversion FROM ("
        f"SELECT CAST(risk_decile AS BIGINT) AS risk_decile, {DR} AS default_rate_pct FROM "
        f"(SELECT *, NTILE(10) OVER (ORDER BY score_c, customer_id) AS risk_decile FROM mart) GROUP BY risk_decile)")
    q["grade_behaviour"] = _q(_segment(
        "risk_grade",
        f"{AVG_UTIL_PCT} AS avg_utilization_pct, {AVG_RATIO_PCT} AS avg_payment_to_bill_pct, "
        f"{hu_double('SUM(months_delinquent_6mo)', 'COUNT(*)', 2)} AS avg_months_delinquent, "
        f"{hu_double('SUM(worst_dpd_6mo)', 'COUNT(*)', 2)} AS avg_worst_dpd"))
    q["gender_segments"] = _q(
        f"SELECT gender_l AS gender, COUNT(*) AS accounts, {DR} AS default_rate_pct FROM mart GROUP BY gender_l")
    q["marital_segments"] = _q(
        f"SELECT marital_l AS marital_status, COUNT(*) AS accounts, {DR} AS default_rate_pct FROM mart "
        f"GROUP BY marital_l")
    q["education_segments"] = _q(
        f"SELECT education_l AS education, COUNT(*) AS accounts, {DR} AS default_rate_pct FROM mart "
        f"GROUP BY education_l")
    # --- collections -------------------------------------------------------------------------
    q["collections_funnel"] = _q(_segment(
        "collections_stage",
        f"COUNT(*) AS accounts, {SHARE} AS pct_of_portfolio, {DR} AS default_rate_pct, "
        f"{OUT} AS total_outstanding_bill, {COLL} AS total_collected, {EFF} AS collection_efficiency_pct, "
        f"{AVG_SCORE} AS avg_risk_score"))
    q["dpd_distribution"] = _q(
        f"SELECT dpd_bucket, accounts, pct_of_portfolio, default_rate_pct FROM ("
        f"SELECT CASE WHEN current_dpd >= 8 THEN '8+ months' ELSE CAST(current_dpd AS VARCHAR) || ' months' END "
        f"AS dpd_bucket, CASE WHEN current_dpd >= 8 THEN 999 ELSE current_dpd END AS o, COUNT(*) AS accounts, "
        f"{SHARE} AS pct_of_portfolio, {DR} AS default_rate_pct FROM mart GROUP BY 1, 2)")
    q["roll_rate_matrix"] = _q(
        f"SELECT prior_stage, current_stage, accounts, "
        f"{hu_double('accounts', 'SUM(accounts) OVER (PARTITION BY prior_stage)', 1, 100)} AS pct_of_prior_stage "
        f"FROM (SELECT prior_stage, current_stage, COUNT(*) AS accounts FROM ({_roll_base()}) "
        f"GROUP BY prior_stage, current_stage)")
    piv = ", ".join(
        f"{hu_double(f'COUNT(*) FILTER (WHERE current_stage = {chr(39)}{s}{chr(39)})', 'COUNT(*)', 1, 100)} AS {n}"
        for s, n in zip(STAGES, ("to_current_pct", "to_early_pct", "to_mid_pct", "to_severe_pct")))
    q["roll_rate_pivot"] = _q(
        f"SELECT prior_stage, {piv}, COUNT(*) AS total_accounts_in_prior_stage FROM ({_roll_base()}) "
        f"GROUP BY prior_stage")
    q["exposure_concentration"] = _q(_segment(
        "collections_stage",
        f"COUNT(*) AS accounts, {OUT} AS outstanding_exposure, "
        f"{hu_double('SUM(bill_c)', 'SUM(SUM(bill_c)) OVER ()', 2, 100)} AS pct_of_total_exposure"))
    q["efficiency_ranking"] = _q(
        f"SELECT credit_limit_band, age_band, COUNT(*) AS accounts, {OUT} AS outstanding, {COLL} AS collected, "
        f"{EFF} AS collection_efficiency_pct, RANK() OVER (ORDER BY CAST(SUM(paid_c) AS DOUBLE) / "
        f"NULLIF(SUM(bill_c), 0) ASC NULLS LAST) AS worst_efficiency_rank FROM mart "
        f"GROUP BY credit_limit_band, age_band HAVING COUNT(*) >= 50 "
        f"ORDER BY collection_efficiency_pct ASC NULLS LAST, credit_limit_band, age_band LIMIT 10")
    # --- KPI / views -------------------------------------------------------------------------
    hi = "risk_grade IN ('C - High Risk', 'D - Severe Risk')"
    kpi8 = (f"COUNT(*) AS total_accounts, {DR} AS overall_default_rate_pct, "
            f"{cents_round0('SUM(limit_c)')} AS total_credit_exposure, {OUT} AS total_outstanding_bill, "
            f"{COLL} AS total_collected_6mo, {EFF} AS collection_efficiency_pct, "
            f"COUNT(*) FILTER (WHERE current_dpd >= 6) AS severe_dpd_accounts, "
            f"COUNT(*) FILTER (WHERE {hi}) AS high_risk_plus_accounts")
    hi_rate = hu_double(f"SUM(default_flag) FILTER (WHERE {hi})", f"COUNT(*) FILTER (WHERE {hi})", 2, 100)
    lo_rate = hu_double("SUM(default_flag) FILTER (WHERE risk_grade = 'A - Low Risk')",
                        "COUNT(*) FILTER (WHERE risk_grade = 'A - Low Risk')", 2, 100)
    q["executive_summary"] = _q(
        f"SELECT {kpi8}, {hi_rate} AS high_risk_default_rate_pct, {lo_rate} AS low_risk_default_rate_pct FROM mart")
    q["vw_dashboard_kpi_summary"] = _q(f"SELECT {kpi8} FROM mart")
    q["vw_risk_grade_summary"] = _q(_segment(
        "risk_grade", f"COUNT(*) AS accounts, {DR} AS default_rate_pct, {AVG_SCORE} AS avg_risk_score"))
    q["vw_collections_stage_summary"] = _q(_segment(
        "collections_stage", f"COUNT(*) AS accounts, {DR} AS default_rate_pct, {OUT} AS total_outstanding, "
        f"{COLL} AS total_collected, {EFF} AS collection_efficiency_pct"))
    q["vw_credit_limit_band_trend"] = _q(_segment(
        "credit_limit_band", f"COUNT(*) AS accounts, {DR} AS default_rate_pct"))
    q["monthly_trend"] = _q(
        f"SELECT CAST(statement_month AS BIGINT) AS statement_month, "
        f"{hu_bigint('SUM(bill_c)', '100 * COUNT(bill_c)')} AS avg_bill_amount, "
        f"{hu_bigint('SUM(pay_c)', '100 * COUNT(pay_c)')} AS avg_payment_amount, "
        f"{hu_double('SUM(pay_c) * COUNT(bill_c)', 'COUNT(pay_c) * SUM(bill_c)', 2, 100)} AS avg_payment_ratio_pct "
        f"FROM ({STMT_UNION}) GROUP BY statement_month")
    keys = ["credit_limit_band", "age_band", "education_l", "marital_l", "gender_l", "risk_grade",
            "collections_stage"]
    names = ["credit_limit_band", "age_band", "education", "marital_status", "gender", "risk_grade",
             "collections_stage"]
    gs = " ".join(f"WHEN GROUPING({k}) = 0 THEN '{n}'" for k, n in zip(keys, names))
    q["dashboard_refresh"] = _q(
        f"SELECT {', '.join(f'{k} AS {n}' for k, n in zip(keys, names))}, COUNT(*) AS accounts, "
        f"{DR} AS default_rate_pct, {OUT} AS total_outstanding, {COLL} AS total_collected, "
        f"CASE {gs} END AS grouping_set FROM mart "
        f"GROUP BY GROUPING SETS ({', '.join(f'({k})' for k in keys)})")
    # --- exploratory tables -----------------------------------------------------------------------
    q["eda_grade_summary"] = _q(_segment(
        "risk_grade", f"COUNT(*) AS accounts, {hu_double('SUM(default_flag)', 'COUNT(*)', 3)} AS default_rate"))
    q["eda_limit_band_curve"] = _q(
        "SELECT b.band AS credit_limit_band, CAST(b.ord AS BIGINT) AS band_order, "
        "CAST(COALESCE(a.accounts, 0) AS BIGINT) AS accounts, a.default_rate_pct FROM "
        "(VALUES ('<50K', 1), ('50K-100K', 2), ('100K-200K', 3), ('200K-300K', 4), ('300K-500K', 5), "
        "('500K+', 6)) b(band, ord) LEFT JOIN ("
        f"SELECT band, COUNT(*) AS accounts, {hu_double('SUM(default_flag)', 'COUNT(*)', 4, 100)} AS default_rate_pct "
        "FROM (SELECT *, CASE WHEN limit_c <= 0 THEN NULL WHEN limit_c <= 5000000 THEN '<50K' "
        "WHEN limit_c <= 10000000 THEN '50K-100K' WHEN limit_c <= 20000000 THEN '100K-200K' "
        "WHEN limit_c <= 30000000 THEN '200K-300K' WHEN limit_c <= 50000000 THEN '300K-500K' ELSE '500K+' END "
        "AS band FROM mart) WHERE band IS NOT NULL GROUP BY band) a ON a.band = b.band")
    q["eda_stage_summary"] = _q(_segment(
        "collections_stage",
        f"COUNT(*) AS accounts, {hu_double('SUM(default_flag)', 'COUNT(*)', 3)} AS default_rate, "
        f"{scaled('SUM(bill_c)', 2)} AS total_outstanding, {scaled('SUM(paid_c)', 2)} AS total_collected"))
    q["eda_stage_counts"] = _q(_segment("collections_stage", "COUNT(*) AS accounts"))
    pcols = ", ".join(
        f"{hu_double(f'SUM(default_flag) FILTER (WHERE marital_l = {chr(39)}{s}{chr(39)})', f'COUNT(*) FILTER (WHERE marital_l = {chr(39)}{s}{chr(39)})', 2, 100)} AS {s.lower()}_pct"
        for s in ("Married", "Single", "Other", "Unknown"))
    q["eda_edu_marital_pivot"] = _q(f"SELECT education_l AS education, {pcols} FROM mart GROUP BY education_l")
    q["ratio_histogram"] = _q(
        "SELECT bin, CAST(bin * 2 AS DOUBLE) / 30 AS bin_lower, CAST((bin + 1) * 2 AS DOUBLE) / 30 AS bin_upper, "
        "default_flag, accounts FROM (SELECT CAST(LEAST(LEAST(GREATEST(ratio_m, 0), 2000) * 30 // 2000, 29) AS BIGINT)"
        " AS bin, CAST(default_flag AS BIGINT) AS default_flag, COUNT(*) AS accounts FROM mart GROUP BY 1, 2)")
    q["default_correlation"] = _q(_corr_sql())
    q["stage_value_counts"] = q["eda_stage_counts"]
    # --- rows in the order of the result ------------------------------------------------------
    q["report_order"] = " UNION ALL ".join(
        f"SELECT '{key}' AS report, row_number() OVER (ORDER BY {order}) AS ordinal, concat_ws(' | ', {entry}) AS entry FROM ({q[key]})"
        for key, order, entry in ORDERS)
    # --- stored star schema, CSV sink and scan ------------------------------------------------
    q["stored_tables"] = _q(
        "SELECT t.name AS table_name, CAST(COUNT(*) AS BIGINT) * t.per AS n_rows, MIN(customer_id) AS first_id, MAX(customer_id) AS last_id, "
        "COUNT(DISTINCT customer_id) AS customers FROM mart, (VALUES ('staging_raw_credit_data', 1), ('dim_customers', 1), "
        "('fact_repayment_history', 6), ('fact_statements', 6), ('fact_credit_risk', 1)) t(name, per) GROUP BY t.name, t.per")
    q["stored_dashboard_refresh"] = q["dashboard_refresh"]
    for view in ("vw_dashboard_kpi_summary", "vw_risk_grade_summary", "vw_collections_stage_summary", "vw_credit_limit_band_trend"):
        q[f"stored_{view}"] = q[view]
    q["stored_pk_audit"], q["stored_fk_audit"] = q["dq_pk_audit"], q["dq_fk_audit"]
    q["serial_ids"] = ("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey <= (SELECT (min(o_orderkey) + max(o_orderkey)) // 2 FROM orders), "
                       "o_orderkey) AS customer_id FROM orders")
    q["csv_landing"] = f"SELECT * REPLACE (row_number() OVER (ORDER BY customer_id) AS customer_id) FROM ({q['src_raw_scan']})"
    q["engineered_csv"] = q["engineered_wide"]
    return q
