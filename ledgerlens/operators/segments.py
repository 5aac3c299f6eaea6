"""Generic segment reports over the mart or over its segment cube.

Every report metric is algebraic: a count, an exact DECIMAL sum, or a conditional
count on a segment label. A metric is therefore written once against an
*aggregator* and can be evaluated two ways with identical results:

* ``ROWS`` aggregates account rows of the mart (partial + final hash aggregate);
* ``CUBE`` re-aggregates the segment cube (``build_cube``): one row per combination
  of the report labels carrying ``n``, ``sum_<x>`` and ``cnt_<x>``. The cube holds at
  most a few hundred thousand cells however many accounts there are, so a whole
  family of reports costs one scan of the mart instead of one scan each.

Windows used afterwards (share of total, rank) run on the aggregated rows only,
whose number is the number of segments.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import dec, pct, quotient, round_money

# Labels a cube cell is keyed by; ``dpd_capped = least(current_dpd, 8)`` determines both the
# collections stage and the DPD bucket (everything from 8 up shares one bucket).
CUBE_DIMS = ("credit_limit_band", "age_band", "education", "marital_status", "gender",
             "risk_grade", "collections_stage", "dpd_capped")
# Mart columns whose sums and non-NULL counts the cube keeps.
CUBE_MEASURES = ("default_flag", "credit_limit", "credit_utilization", "payment_to_bill_ratio",
                 "risk_score", "months_delinquent_6mo", "worst_dpd_6mo", "total_bill_6mo", "total_paid_6mo")
DPD_CAP = 8


def with_dpd_capped(mart: DataFrame) -> DataFrame:
    return mart.withColumn("dpd_capped", F.least(F.col("current_dpd"), F.lit(DPD_CAP)))


def build_cube(mart: DataFrame) -> DataFrame:
    """One partial/final aggregate of the mart at the grain of all report labels."""
    src = with_dpd_capped(mart)
    return src.groupBy(*CUBE_DIMS).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(m).alias(f"sum_{m}") for m in CUBE_MEASURES],
        *[F.count(m).alias(f"cnt_{m}") for m in CUBE_MEASURES],
    )


def merge_cells(cells: DataFrame) -> DataFrame:
    """Cubes of several disjoint sets of accounts -> the cube of all of them: counts and sums
    add up cell by cell."""
    parts = [c for c in cells.columns if c not in CUBE_DIMS]
    return cells.groupBy(*CUBE_DIMS).agg(*[F.sum(c).alias(c) for c in parts])


class RowAggregator:
    """Aggregate primitives over account rows."""

    name = "rows"

    def prepare(self, df: DataFrame) -> DataFrame:
        return with_dpd_capped(df) if "dpd_capped" not in df.columns else df

    def n(self) -> Column:
        return F.count(F.lit(1))

    def s(self, c: str) -> Column:
        return F.sum(c)

    def c(self, c: str) -> Column:
        return F.count(c)

    def n_if(self, cond: Column) -> Column:
        return F.count_if(cond)

    def s_if(self, c: str, cond: Column) -> Column:
        return F.sum(F.when(cond, F.col(c)))

    def c_if(self, c: str, cond: Column) -> Column:
        return F.count(F.when(cond, F.col(c)))


class CubeAggregator:
    """The same primitives over cube cells (sums of partial counts and sums)."""

    name = "cube"

    def prepare(self, df: DataFrame) -> DataFrame:
        return df

    def n(self) -> Column:
        return F.sum("n")

    def s(self, c: str) -> Column:
        return F.sum(f"sum_{c}")

    def c(self, c: str) -> Column:
        return F.sum(f"cnt_{c}")

    def n_if(self, cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0).cast("bigint"))

    def s_if(self, c: str, cond: Column) -> Column:
        return F.sum(F.when(cond, F.col(f"sum_{c}")))

    def c_if(self, c: str, cond: Column) -> Column:
        return F.sum(F.when(cond, F.col(f"cnt_{c}")))


ROWS = RowAggregator()
CUBE = CubeAggregator()
Aggregator = RowAggregator | CubeAggregator

_FRAC = {"credit_limit": 2, "credit_utilization": 3, "payment_to_bill_ratio": 3, "risk_score": 2,
         "total_bill_6mo": 2, "total_paid_6mo": 2}


def _mean(a: Aggregator, col: str, scale: int, mult: int = 1) -> Column:
    """round(mult * AVG(col), scale) as DOUBLE (NULLs skipped)."""
    return quotient(a.s(col), a.c(col), scale, mult, _FRAC.get(col, 0), 0).cast("double")


def default_rate_pct(a: Aggregator, scale: int = 2) -> Column:
    """ROUND(AVG(default_flag) * 100, scale)."""
    return pct(a.s("default_flag"), a.c("default_flag"), scale)


def default_rate(a: Aggregator, scale: int = 3) -> Column:
    """AVG(default_flag) rounded at ``scale`` (a fraction, not a percent)."""
    return quotient(a.s("default_flag"), a.c("default_flag"), scale).cast("double")


def efficiency_pct(a: Aggregator, scale: int = 2) -> Column:
    """100 * SUM(paid) / NULLIF(SUM(bill), 0)."""
    return pct(a.s("total_paid_6mo"), a.s("total_bill_6mo"), scale, num_frac=2, den_frac=2)


def efficiency_exact(a: Aggregator) -> Column:
    """SUM(paid) / NULLIF(SUM(bill), 0) unrounded (rank key)."""
    return dec(a.s("total_paid_6mo"), 2) / F.nullif(dec(a.s("total_bill_6mo"), 2), F.lit(0))


def default_avg_exact(a: Aggregator) -> Column:
    """AVG(default_flag) unrounded (rank key)."""
    return dec(a.s("default_flag")) / dec(a.c("default_flag"))


METRICS: dict[str, Callable[[Aggregator], Column]] = {
    "accounts": lambda a: a.n().cast("bigint"),
    "default_rate_pct": default_rate_pct,
    "default_rate": default_rate,
    "avg_credit_limit": lambda a: quotient(a.s("credit_limit"), a.c("credit_limit"), 0, 1, 2, 0).cast("bigint"),
    "avg_utilization_pct": lambda a: _mean(a, "credit_utilization", 1, 100),
    "avg_payment_to_bill_pct": lambda a: _mean(a, "payment_to_bill_ratio", 1, 100),
    "avg_risk_score": lambda a: _mean(a, "risk_score", 2),
    "avg_months_delinquent": lambda a: _mean(a, "months_delinquent_6mo", 2),
    "avg_worst_dpd": lambda a: _mean(a, "worst_dpd_6mo", 2),
    "total_outstanding_bill": lambda a: round_money(a.s("total_bill_6mo")),
    "total_outstanding": lambda a: round_money(a.s("total_bill_6mo")),
    "outstanding": lambda a: round_money(a.s("total_bill_6mo")),
    "outstanding_exposure": lambda a: round_money(a.s("total_bill_6mo")),
    "total_collected": lambda a: round_money(a.s("total_paid_6mo")),
    "collected": lambda a: round_money(a.s("total_paid_6mo")),
    "collection_efficiency_pct": efficiency_pct,
}


def accounts() -> Column:
    """COUNT(*) over rows, as BIGINT."""
    return F.count(F.lit(1)).cast("bigint")


def share_of_total(col: str, scale: int = 2, frac: int = 0) -> Column:
    """100 * x / SUM(x) OVER () on aggregated rows (one row per segment)."""
    return pct(F.col(col), F.sum(col).over(Window.partitionBy()), scale, frac, frac)


def segment_report(
    src: DataFrame,
    keys: Sequence[str | Column],
    metrics: Sequence[str],
    extra: dict[str, Callable[[Aggregator], Column]] | None = None,
    min_accounts: int | None = None,
    agg: Aggregator = ROWS,
) -> DataFrame:
    """GROUP BY keys with named metrics (+ ``extra`` aggregate builders);
    ``min_accounts`` is HAVING COUNT(*) >= n. ``src`` is the mart (ROWS) or its cube (CUBE)."""
    src = agg.prepare(src)
    aggs = [METRICS[m](agg).alias(m) for m in metrics]
    if extra:
        aggs += [fn(agg).alias(n) for n, fn in extra.items()]
    if min_accounts is not None and "accounts" not in metrics:
        aggs.append(agg.n().alias("_n"))
    out = src.groupBy(*keys).agg(*aggs)
    if min_accounts is not None:
        n = F.col("accounts") if "accounts" in metrics else F.col("_n")
        out = out.where(n >= F.lit(min_accounts))
        if "accounts" not in metrics:
            out = out.drop("_n")
    return out


def rank_by(col: str, ascending: bool) -> Column:
    """RANK() OVER (ORDER BY col) on aggregated segments; ASC NULLS LAST / DESC NULLS FIRST
    as in PostgreSQL."""
    order = F.col(col).asc_nulls_last() if ascending else F.col(col).desc_nulls_first()
    return F.rank().over(Window.orderBy(order)).cast("bigint")
