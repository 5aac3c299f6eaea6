"""Collections reports.

Stage reports take the mart (``agg=ROWS``) or its segment cube (``agg=CUBE``); the
roll-rate matrix reads the landing rows (months 1 and 2 of each account)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import encodings as enc
from ..functions.numeric import pct
from ..operators.segments import ROWS, Aggregator, efficiency_exact, rank_by, segment_report, share_of_total
from ..schema import EFFICIENCY_MIN_ACCOUNTS, STAGE_LABELS, TOP_N


def collections_funnel(src: DataFrame, agg: Aggregator = ROWS) -> DataFrame:
    """Accounts, exposure and collection efficiency by stage."""
    seg = segment_report(src, ["collections_stage"],
                         ["accounts", "default_rate_pct", "total_outstanding_bill", "total_collected",
                          "collection_efficiency_pct", "avg_risk_score"], agg=agg)
    return seg.select("collections_stage", "accounts", share_of_total("accounts").alias("pct_of_portfolio"),
                      "default_rate_pct", "total_outstanding_bill", "total_collected",
                      "collection_efficiency_pct", "avg_risk_score").orderBy("collections_stage")


def dpd_distribution(src: DataFrame, agg: Aggregator = ROWS) -> DataFrame:
    """Current-month DPD buckets 0..7 and 8+ (grouped with the hidden sort key)."""
    d = F.col("dpd_capped")
    seg = segment_report(src, [enc.dpd_bucket(d).alias("dpd_bucket"), enc.dpd_bucket_order(d).alias("_o")],
                         ["accounts", "default_rate_pct"], agg=agg)
    return (seg.select("dpd_bucket", "accounts", share_of_total("accounts").alias("pct_of_portfolio"),
                       "default_rate_pct", "_o").orderBy("_o").drop("_o"))


def _transitions(staging: DataFrame, lenient: bool = False) -> DataFrame:
    """Prior (month 2) and current (month 1) stage per account, straight from the wide
    row: the SQL self-join of the monthly fact becomes a projection (J3)."""
    return staging.select(
        enc.stage(enc.dpd(F.col("timeliness_2"), lenient)).alias("prior_stage"),
        enc.stage(enc.dpd(F.col("timeliness_1"), lenient)).alias("current_stage"),
    )


def transition_cells(staging: DataFrame, lenient: bool = False) -> DataFrame:
    """(prior_stage, current_stage, accounts): at most 4 x 4 cells whatever the portfolio size."""
    return _transitions(staging, lenient).groupBy("prior_stage", "current_stage").agg(
        F.count(F.lit(1)).cast("bigint").alias("accounts"))


def roll_rate_matrix(staging: DataFrame, lenient: bool = False, cells: DataFrame | None = None) -> DataFrame:
    """Prior -> current stage counts and the share of the prior stage (J4 as a window
    over the <= 16 aggregated cells). ``cells`` = stored ``transition_cells`` if at hand."""
    cells = transition_cells(staging, lenient) if cells is None else cells
    prior_total = F.sum("accounts").over(Window.partitionBy("prior_stage"))
    return cells.select("prior_stage", "current_stage", "accounts",
                        pct(F.col("accounts"), prior_total, 1).alias("pct_of_prior_stage")
                        ).orderBy("prior_stage", "current_stage")


def roll_rate_pivot(staging: DataFrame, lenient: bool = False, cells: DataFrame | None = None) -> DataFrame:
    """One row per prior stage, conditional counts per current stage."""
    cells = transition_cells(staging, lenient) if cells is None else cells
    n = F.sum("accounts")
    names = ("to_current_pct", "to_early_pct", "to_mid_pct", "to_severe_pct")
    aggs = [pct(F.coalesce(F.sum(F.when(F.col("current_stage") == F.lit(label), F.col("accounts"))), F.lit(0)),
                n, 1).alias(name)
            for label, name in zip(STAGE_LABELS, names)]
    return (cells.groupBy("prior_stage")
            .agg(*aggs, n.cast("bigint").alias("total_accounts_in_prior_stage")).orderBy("prior_stage"))


def exposure_concentration(src: DataFrame, agg: Aggregator = ROWS) -> DataFrame:
    """C4: share of total outstanding bill per stage (W2 on aggregated rows)."""
    seg = segment_report(src, ["collections_stage"], ["accounts", "outstanding_exposure"],
                         extra={"_bill": lambda a: a.s("total_bill_6mo")}, agg=agg)
    return seg.select("collections_stage", "accounts", "outstanding_exposure",
                      share_of_total("_bill", 2, frac=2).alias("pct_of_total_exposure")
                      ).orderBy("collections_stage")


def efficiency_ranking(src: DataFrame, min_accounts: int = EFFICIENCY_MIN_ACCOUNTS,
                       top_n: int = TOP_N, agg: Aggregator = ROWS) -> DataFrame:
    """Limit band x age band with >= min_accounts, worst collection efficiency first."""
    keys = ["credit_limit_band", "age_band"]
    seg = segment_report(src, keys, ["accounts", "outstanding", "collected", "collection_efficiency_pct"],
                         extra={"_eff": efficiency_exact}, min_accounts=min_accounts, agg=agg)
    ranked = seg.withColumn("worst_efficiency_rank", rank_by("_eff", ascending=True)).drop("_eff")
    return ranked.orderBy(F.col("collection_efficiency_pct").asc_nulls_last(), *keys).limit(top_n)
