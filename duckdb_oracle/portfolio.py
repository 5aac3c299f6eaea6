"""DuckDB oracle: the portfolio and its features re-derived in integer arithmetic.

Independent of the Spark code on purpose: money is carried in integer cents, ratios
in integer thousandths and the score in integer hundredths; every half-up rounding
is the integer form ``(2*n*10^k + d) // (2*d)`` (all operands are >= 0 here).
Labels and cut points are restated literally rather than imported.

``cte(dirty)`` returns a ``WITH`` chain ending in two relations:
  ``src``  landing rows in integer form (limit_c, c1..c6 bills, p1..p6 payments, ...)
  ``mart`` one row per landing row with all features (d1..d6, ratio_m, util_m, score_c, ...)
"""

from __future__ import annotations


def _n(i: int) -> str:
    wave = f"(k * {31 * i + 7})"
    return (
        f"CASE WHEN lvl = 0 THEN (CASE {wave} % 5 WHEN 0 THEN -2 WHEN 1 THEN -1 "
        f"WHEN 4 THEN (CASE WHEN (k * {17 * i + 3}) % 7 < 3 THEN 1 ELSE 0 END) ELSE 0 END) "
        f"ELSE GREATEST(LEAST(lvl + {wave} % 3 - 1, 8), -2) END AS n{i}"
    )


def _cte_src() -> str:
    months = range(1, 7)
    line_sums = ",\n    ".join(
        f"SUM(CASE WHEN l_linenumber IN ({i}, {i + 6}) THEN CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * 100 AS BIGINT) "
        f"ELSE 0 END) AS c{i}" for i in months)
    acct_cols = ", ".join(f"CAST(COALESCE(li.c{i}, 0) AS BIGINT) AS c{i}" for i in months)
    ns = ",\n    ".join(_n(i) for i in months)
    codes = ",\n    ".join(
        f"'m' || (CASE WHEN n{i} < 0 THEN '-' ELSE '+' END) || CAST(ABS(n{i}) AS VARCHAR) AS timeliness_{i}"
        for i in months)
    pays = ", ".join(f"(c{i} * pp) // 100 AS p{i}" for i in months)
    bills = ", ".join(f"c{i}" for i in months)
    bill_sum = " + ".join(f"c{i}" for i in months)
    pay_sum = " + ".join(f"p{i}" for i in months)
    return f"""
li AS (
  SELECT l_orderkey AS k,
    {line_sums}
  FROM lineitem GROUP BY l_orderkey
),
acct AS (
  SELECT o.o_orderkey AS k, {acct_cols},
         (o.o_orderkey * 48271) % 1000 AS s, (o.o_orderkey * 13 + 17) % 120 AS pp
  FROM orders o LEFT JOIN li ON li.k = o.o_orderkey
),
lv AS (
  SELECT *, CASE WHEN s < 700 THEN 0 WHEN s < 850 THEN 1 WHEN s < 950 THEN 2
                 WHEN s < 985 THEN 4 WHEN s < 997 THEN 6 ELSE 8 END AS lvl
  FROM acct
),
nm AS (
  SELECT *,
    {ns}
  FROM lv
),
pm AS (
  SELECT *, {pays} FROM nm
),
src_clean AS (
  SELECT k, k + 1 AS customer_id,
    1000000 * (1 + ((k * 7919) % 90) * ((k * 7919) % 90) // 100) AS limit_c,
    CASE k % 4 WHEN 0 THEN ' male' WHEN 1 THEN 'FEMALE ' WHEN 2 THEN 'female' ELSE 'Female' END AS gender,
    CASE (k * 11) % 13 WHEN 0 THEN 'other1' WHEN 1 THEN 'hs' WHEN 2 THEN ' HS' WHEN 3 THEN '0'
      WHEN 4 THEN 'grad' WHEN 5 THEN 'GRAD ' WHEN 6 THEN 'grad' WHEN 7 THEN 'other3'
      WHEN 8 THEN 'other2' ELSE 'uni' END AS education,
    CASE (k * 5) % 11 WHEN 0 THEN 'na' WHEN 1 THEN 'other' WHEN 2 THEN 'Married '
      WHEN 3 THEN 'married' WHEN 4 THEN 'married' WHEN 5 THEN 'married' ELSE 'single' END AS marital_status,
    CASE WHEN k % 997 = 0 THEN NULL WHEN k % 499 = 0 THEN 17
      ELSE 21 + ((k * 104729) % 55) * ((k * 104729) % 55) // 55 END AS age,
    {codes},
    {bills}, {", ".join(f"p{i}" for i in months)},
    (2 * ({bill_sum}) + 6) // 12 AS avgbal_c,
    (2 * ({pay_sum}) + 6) // 12 AS avgpay_c,
    CASE WHEN (k * 7907) % 100 < LEAST(10 + 9 * lvl, 80)
      THEN (CASE WHEN k % 3 = 0 THEN 'Yes' ELSE 'yes' END) ELSE 'no' END AS default_raw
  FROM pm
)"""


def _cte_dirty() -> str:
    return """,
src_mod AS (
  SELECT * REPLACE (
    CASE WHEN k % 211 = 0 THEN NULL ELSE education END AS education,
    CASE WHEN k % 307 = 0 THEN NULL ELSE timeliness_1 END AS timeliness_1,
    CASE WHEN k % 401 = 0 THEN 0 ELSE limit_c END AS limit_c)
  FROM src_clean
),
src AS (
  SELECT * FROM src_mod UNION ALL SELECT * FROM src_mod WHERE k % 500 = 0
)"""


def _cte_mart() -> str:
    months = range(1, 7)
    dpds = ",\n    ".join(f"GREATEST(CAST(REPLACE(timeliness_{i}, 'm', '') AS INTEGER), 0) AS d{i}" for i in months)
    d_sum = " + ".join(f"d{i}" for i in months)
    late = " + ".join(f"(CASE WHEN d{i} > 0 THEN 1 ELSE 0 END)" for i in months)
    return f""",
f1 AS (
  SELECT *,
    {dpds},
    CAST({" + ".join(f"c{i}" for i in months)} AS BIGINT) AS bill_c,
    CAST({" + ".join(f"p{i}" for i in months)} AS BIGINT) AS paid_c
  FROM src
),
f2 AS (
  SELECT *,
    d1 AS current_dpd,
    GREATEST({", ".join(f"d{i}" for i in months)}) AS worst_dpd_6mo,
    {late} AS months_delinquent_6mo,
    (2 * ({d_sum}) * 100 + 6) // 12 AS avg_dpd_c,
    CASE WHEN bill_c > 0 THEN (2 * paid_c * 1000 + bill_c) // (2 * bill_c) ELSE 1000 END AS ratio_m,
    CASE WHEN limit_c = 0 THEN NULL ELSE (2 * avgbal_c * 1000 + limit_c) // (2 * limit_c) END AS util_m
  FROM f1
),
f3 AS (
  SELECT *,
    worst_dpd_6mo * 1000 + months_delinquent_6mo * 500
      + (CASE WHEN util_m > 800 THEN (util_m - 800) * 2 ELSE 0 END)
      + (CASE WHEN ratio_m < 300 THEN (300 - ratio_m) * 3 ELSE 0 END) AS score_c
  FROM f2
),
mart AS (
  SELECT *,
    CASE WHEN limit_c < 5000000 THEN '<50K' WHEN limit_c < 10000000 THEN '50K-100K'
         WHEN limit_c < 20000000 THEN '100K-200K' WHEN limit_c < 30000000 THEN '200K-300K'
         WHEN limit_c < 50000000 THEN '300K-500K' ELSE '500K+' END AS credit_limit_band,
    CASE WHEN age < 25 THEN '<25' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44'
         WHEN age < 55 THEN '45-54' WHEN age < 65 THEN '55-64' ELSE '65+' END AS age_band,
    upper(left(trim(gender), 1)) || lower(substr(trim(gender), 2)) AS gender_l,
    CASE lower(trim(education)) WHEN 'grad' THEN 'Graduate School' WHEN 'uni' THEN 'University'
         WHEN 'hs' THEN 'High School' WHEN 'other1' THEN 'Other' WHEN 'other2' THEN 'Other'
         WHEN 'other3' THEN 'Other' ELSE 'Unknown' END AS education_l,
    CASE lower(trim(marital_status)) WHEN 'married' THEN 'Married' WHEN 'single' THEN 'Single'
         WHEN 'other' THEN 'Other' ELSE 'Unknown' END AS marital_l,
    CASE WHEN current_dpd <= 0 THEN '1-Current' WHEN current_dpd <= 2 THEN '2-Early DPD (1-2mo)'
         WHEN current_dpd <= 5 THEN '3-Mid DPD (3-5mo)' ELSE '4-Severe DPD (6mo+)' END AS collections_stage,
    CASE WHEN score_c < 500 THEN 'A - Low Risk' WHEN score_c < 1500 THEN 'B - Moderate Risk'
         WHEN score_c < 3000 THEN 'C - High Risk' ELSE 'D - Severe Risk' END AS risk_grade,
    CASE WHEN lower(default_raw) = 'yes' THEN 1 ELSE 0 END AS default_flag
  FROM f3
)"""


def cte(dirty: bool = False) -> str:
    """WITH-chain ending in ``src`` and ``mart`` (no trailing comma)."""
    body = _cte_src()
    if dirty:
        body += _cte_dirty()
    else:
        body += ",\nsrc AS (SELECT * FROM src_clean)"
    return "WITH" + body + _cte_mart() + "\n"


def hu(num: str, den: str, scale: int, mult: int = 1) -> str:
    """Integer half-up of mult*num/den at ``scale`` decimals, as a scaled integer."""
    f = mult * 10 ** scale
    return f"((2 * ({f}) * CAST({num} AS HUGEINT) + ({den})) // (2 * ({den})))"


def hu_double(num: str, den: str, scale: int, mult: int = 1) -> str:
    """Half-up quotient as DOUBLE (NULL when den is 0 or NULL)."""
    return f"(CAST({hu(num, f'NULLIF({den}, 0)', scale, mult)} AS DOUBLE) / {10 ** scale})"


def hu_bigint(num: str, den: str, mult: int = 1) -> str:
    return f"CAST({hu(num, f'NULLIF({den}, 0)', 0, mult)} AS BIGINT)"


def cents_round0(cents: str) -> str:
    """ROUND(money, 0) from an integer cents sum, as BIGINT."""
    return f"CAST((2 * CAST({cents} AS HUGEINT) + 100) // 200 AS BIGINT)"


def scaled(x: str, scale: int) -> str:
    """Integer in 10^-scale units -> DOUBLE."""
    return f"(CAST({x} AS DOUBLE) / {10 ** scale})"
