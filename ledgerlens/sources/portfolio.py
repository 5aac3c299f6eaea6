"""Portfolio landing table derived from the order tables (FIXTURES.md section 4).

One account per order; line n of an order belongs to month (n - 1) mod 6 + 1, so every
line is in one of the six monthly bills. The
derivation is one shuffle: order heads and line rows are unioned and aggregated
by order key (partial aggregation runs map-side, so each map task ships at most
one row per order it saw). Everything else is a narrow projection of integers,
so the same rows come out on any number of executors.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import MONEY, MONTHS, RAW_COLUMNS

# ---------------------------------------------------------------------------
# Fixed values of the fixture mapping (FIXTURES.md section 4), in table order.
# ---------------------------------------------------------------------------
LEVEL_MULT = 48271                     # s = (k * 48271) % 1000
LEVEL_CUTS = ((700, 0), (850, 1), (950, 2), (985, 4), (997, 6))   # else 8
LEVEL_TOP = 8
WAVE_MULT, WAVE_ADD = 31, 7            # w_i = (k * (31*i + 7)) % 5
SPIKE_MULT, SPIKE_ADD = 17, 3          # (k * (17*i + 3)) % 7 < 3
PAY_PCT = (13, 17, 120)                # (k*13 + 17) % 120
LIMIT_MULT = 7919                      # m = (k*7919) % 90; limit = 10000 * (1 + m*m // 100)
GENDERS = (" male", "FEMALE ", "female", "Female")                     # k % 4
EDUCATIONS = ("other1", "hs", " HS", "0", "grad", "GRAD ", "grad", "other3", "other2")  # (k*11) % 13, else 'uni'
MARITALS = ("na", "other", "Married ", "married", "married", "married")  # (k*5) % 11, else 'single'
AGE_MULT = 104729                      # a = (k*104729) % 55; age = 21 + a*a // 55
AGE_NULL_MOD, AGE_LOW_MOD, AGE_LOW = 997, 499, 17
DEFAULT_MULT = 7907                    # (k*7907) % 100 < least(10 + 9*lvl, 80)
# Dirty variant: education NULL if k%211=0; timeliness_1 NULL if k%307=0;
# credit_limit 0 if k%401=0; then a second copy of every row with k%500=0.
DIRTY_EDU_MOD, DIRTY_T1_MOD, DIRTY_LIMIT_MOD, DIRTY_COPY_MOD = 211, 307, 401, 500
# Defects of the audited tables: (table, column, modulus, condition, value) sets the column to
# the SQL value where k % modulus = 0 and the condition holds.
DEFECTS = (
    ("staging_raw_credit_data", "gender", 601, "true", "'not disclosed'"),
    ("staging_raw_credit_data", "timeliness_2", 607, "true", "'m+x'"),
    ("staging_raw_credit_data", "credit_limit", 613, "true", "credit_limit + 1000000000000"),
    ("dim_customers", "age_band", 617, "true", "'age not given'"),
    ("dim_customers", "customer_id", 619, "true", "-customer_id"),
    ("fact_repayment_history", "timeliness_code", 631, "statement_month = 2", "'m+late'"),
    ("fact_repayment_history", "statement_month", 641, "statement_month = 6", "7"),
    ("fact_statements", "bill_amount", 643, "statement_month = 3", "bill_amount + 1000000000000"),
    ("fact_statements", "statement_month", 647, "statement_month = 1", "0"),
    ("fact_credit_risk", "risk_score", 653, "true", "risk_score + 1000000"),
    ("fact_credit_risk", "default_flag", 659, "true", "2"),
    ("fact_credit_risk", "customer_id", 661, "true", "-customer_id"),
)
# ---------------------------------------------------------------------------
# Tables in which a defect moves rows to another key.
REKEYED = frozenset(table for table, column, *_ in DEFECTS if column == "customer_id")


def _pick(idx: Column, values) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(idx == i, F.lit(v)) if expr is None else expr.when(idx == i, F.lit(v))
    return expr


def _cents_to_money(c: Column) -> Column:
    """Integer cents -> DECIMAL(14,2), exactly (multiplication, no decimal division)."""
    return (c.cast("decimal(16,0)") * F.lit(Decimal("0.01"))).cast(MONEY)


def monthly_bills(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """(k, b1..b6 cents) for every order; orders without lines get zeros.

    Left-join semantics via union + aggregate: a single Exchange on the order key
    instead of aggregate-exchange + order-exchange + sort-merge join.
    """
    # A price within a quarter of a cent of whole cents is those cents (below 1e11 a double and its
    # shortest decimal differ by far less); any other is rounded as a decimal.
    cents = F.expr("""CASE WHEN abs(l_extendedprice) < 1e11D AND abs(l_extendedprice * 100 - rint(l_extendedprice * 100)) < 0.25D
                           THEN CAST(rint(l_extendedprice * 100) AS BIGINT)
                           ELSE CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * 100 AS BIGINT) END""")
    month = F.pmod(F.col("l_linenumber") - 1, F.lit(len(MONTHS))) + 1
    lines = lineitem.select(
        F.col("l_orderkey").alias("k"),
        F.lit(0).alias("is_order"),
        *[F.when(month == i, cents).otherwise(F.lit(0).cast("bigint")).alias(f"b{i}")
          for i in MONTHS],
    )
    heads = orders.select(
        F.col("o_orderkey").alias("k"),
        F.lit(1).alias("is_order"),
        *[F.lit(0).cast("bigint").alias(f"b{i}") for i in MONTHS],
    )
    return (
        heads.unionByName(lines)
        .groupBy("k")
        .agg(F.max("is_order").alias("is_order"), *[F.sum(f"b{i}").alias(f"b{i}") for i in MONTHS])
        .where(F.col("is_order") == 1)
        .drop("is_order")
    )


def raw_from_bills(bills: DataFrame) -> DataFrame:
    """Narrow projection (k, b1..b6) -> landing schema (RAW_SCHEMA)."""
    k = F.col("k")
    s = (k * LEVEL_MULT) % 1000
    lvl = None
    for cut, level in LEVEL_CUTS:
        lvl = F.when(s < cut, F.lit(level)) if lvl is None else lvl.when(s < cut, F.lit(level))
    lvl = lvl.otherwise(F.lit(LEVEL_TOP))

    df = bills.select("*", lvl.alias("lvl"), ((k * PAY_PCT[0] + PAY_PCT[1]) % PAY_PCT[2]).alias("pay_pct"))
    # Payments in cents, then half-up means of the six months (integer ``div`` on BIGINT).
    df = df.select("*", *[F.expr(f"(b{i} * pay_pct) div 100").alias(f"q{i}") for i in MONTHS])
    df = df.select(
        "*",
        F.expr("(2 * ({}) + 6) div 12".format(" + ".join(f"b{i}" for i in MONTHS))).alias("avg_b"),
        F.expr("(2 * ({}) + 6) div 12".format(" + ".join(f"q{i}" for i in MONTHS))).alias("avg_q"),
    )
    lv = F.col("lvl")

    def n_month(i: int) -> Column:
        w = (k * (WAVE_MULT * i + WAVE_ADD)) % 5
        spike = F.when((k * (SPIKE_MULT * i + SPIKE_ADD)) % 7 < 3, F.lit(1)).otherwise(F.lit(0))
        calm = F.when(w == 0, F.lit(-2)).when(w == 1, F.lit(-1)).when(w == 4, spike).otherwise(F.lit(0))
        late = F.greatest(F.least(lv + (k * (WAVE_MULT * i + WAVE_ADD)) % 3 - 1, F.lit(8)), F.lit(-2))
        return F.when(lv == 0, calm).otherwise(late)

    def code(n: Column) -> Column:
        return F.element_at(F.array(*[F.lit(f"m{i:+d}") for i in range(-2, 9)]), (n + 3).cast("int"))

    age = (F.when(k % AGE_NULL_MOD == 0, F.lit(None))
           .when(k % AGE_LOW_MOD == 0, F.lit(AGE_LOW))
           .otherwise(F.lit(21) + F.expr(f"div(((k * {AGE_MULT}) % 55) * ((k * {AGE_MULT}) % 55), 55)")))
    limit_cents = F.expr(f"1000000 * (1 + div(((k * {LIMIT_MULT}) % 90) * ((k * {LIMIT_MULT}) % 90), 100))")
    defaulted = (k * DEFAULT_MULT) % 100 < F.least(F.lit(10) + lv * 9, F.lit(80))

    return df.select(
        (k + 1).alias("customer_id"),
        _cents_to_money(limit_cents).alias("credit_limit"),
        _pick(k % 4, GENDERS).alias("gender"),
        F.coalesce(_pick((k * 11) % 13, EDUCATIONS), F.lit("uni")).alias("education"),
        F.coalesce(_pick((k * 5) % 11, MARITALS), F.lit("single")).alias("marital_status"),
        age.cast("smallint").alias("age"),
        *[code(n_month(i)).alias(f"timeliness_{i}") for i in MONTHS],
        *[_cents_to_money(F.col(f"b{i}")).alias(f"balance_{i}") for i in MONTHS],
        *[_cents_to_money(F.col(f"q{i}")).alias(f"payment_{i}") for i in MONTHS],
        _cents_to_money(F.col("avg_b")).alias("avg_balance"),
        _cents_to_money(F.col("avg_q")).alias("avg_payment"),
        F.when(defaulted, F.when(k % 3 == 0, F.lit("Yes")).otherwise(F.lit("yes")))
        .otherwise(F.lit("no")).alias("default_raw"),
    )


def portfolio_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing table (RAW_SCHEMA) derived from ``orders`` and ``lineitem`` under ``sf_dir``."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return raw_from_bills(monthly_bills(orders, lineitem)).select(*RAW_COLUMNS)


def make_dirty(raw: DataFrame) -> DataFrame:
    """Audit fixture: NULL education / timeliness_1, zero limits, duplicated rows."""
    k = F.col("customer_id") - 1
    dirty = raw.select(
        *[
            F.when(k % DIRTY_EDU_MOD == 0, F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
            if c == "education" else
            F.when(k % DIRTY_T1_MOD == 0, F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
            if c == "timeliness_1" else
            F.when(k % DIRTY_LIMIT_MOD == 0, F.lit(0).cast(MONEY)).otherwise(F.col(c)).alias(c)
            if c == "credit_limit" else F.col(c)
            for c in raw.columns
        ]
    )
    # Second copy of every k % 500 == 0 row: one Generate over one scan (no self-union).
    copies = F.when((F.col("customer_id") - 1) % DIRTY_COPY_MOD == 0, F.lit(2)).otherwise(F.lit(1))
    return (dirty.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
            .drop("_copy"))


def break_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Audit fixture: the star schema's tables with ``DEFECTS`` injected (orphans, months out of
    range, over-long labels, malformed codes, money beyond its type). Every row stays."""
    k = F.col("customer_id") - 1
    out = {}
    for name, df in tables.items():
        out[name] = df.withColumns({
            c: F.when((k % modulus == 0) & F.expr(condition), F.expr(value)).otherwise(F.col(c))
            for table, c, modulus, condition, value in DEFECTS if table == name})
    return out
