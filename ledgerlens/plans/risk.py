"""Risk segmentation reports.

Segment reports take the mart with ``agg=ROWS`` or its segment cube with ``agg=CUBE``
(same results); the decile report needs account rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import encodings as enc
from ..functions.numeric import pct
from ..operators import positions
from ..operators.segments import ROWS, Aggregator, default_avg_exact, rank_by, segment_report, share_of_total
from ..schema import DECILES, TOP_N, TOP_RISK_MIN_ACCOUNTS


def risk_grade_segments(src: DataFrame, agg: Aggregator = ROWS) -> DataFrame:
    """Default rate by risk grade."""
    seg = segment_report(src, ["risk_grade"], ["accounts", "default_rate_pct", "avg_credit_limit",
                                               "avg_utilization_pct", "avg_risk_score"], agg=agg)
    return seg.select("risk_grade", "accounts", share_of_total("accounts").alias("pct_of_portfolio"),
                      "default_rate_pct", "avg_credit_limit", "avg_utilization_pct",
                      "avg_risk_score").orderBy("risk_grade")


def limit_band_segments(src: DataFrame, agg: Aggregator = ROWS) -> DataFrame:
    """R2: by credit-limit band, in band order."""
    seg = segment_report(src, ["credit_limit_band"], ["accounts", "default_rate_pct", "avg_risk_score"], agg=agg)
    return seg.orderBy(enc.limit_band_order(F.col("credit_limit_band")))


def age_band_segments(src: DataFrame, agg: Aggregator = ROWS) -> DataFrame:
    """By age band, in band order."""
    seg = segment_report(src, ["age_band"], ["accounts", "default_rate_pct"], agg=agg)
    return seg.orderBy(enc.age_band_order(F.col("age_band")))


def edu_marital_segments(src: DataFrame, agg: Aggregator = ROWS) -> DataFrame:
    """Education x marital status (long form)."""
    seg = segment_report(src, ["education", "marital_status"], ["accounts", "default_rate_pct"], agg=agg)
    return seg.orderBy("education", "marital_status")


def top_risk_segments(src: DataFrame, min_accounts: int = TOP_RISK_MIN_ACCOUNTS,
                      top_n: int = TOP_N, agg: Aggregator = ROWS) -> DataFrame:
    """Age x education x limit band with >= min_accounts, ranked by default rate.

    RANK uses the unrounded rate; the top-N order is the rounded rate with the
    segment keys as tie-break, so the cut is deterministic."""
    keys = ["age_band", "education", "credit_limit_band"]
    seg = segment_report(src, keys, ["accounts", "default_rate_pct"],
                         extra={"_rate": default_avg_exact}, min_accounts=min_accounts, agg=agg)
    ranked = seg.withColumn("risk_rank", rank_by("_rate", ascending=False)).drop("_rate")
    return ranked.orderBy(F.col("default_rate_pct").desc_nulls_first(), *keys).limit(top_n)


def risk_deciles(mart: DataFrame, n_tiles: int = DECILES) -> DataFrame:
    """NTILE(10) over risk_score (tie-break customer_id) for the whole portfolio."""
    unscaled = F.expr("CAST(risk_score * 100 AS BIGINT)")
    tiles = positions.tile_aggregate(mart, n_tiles, unscaled, "customer_id", out_col="risk_decile", measures={
        "accounts": ("count", F.lit(1)), "lowest": ("min", F.col("risk_score")), "highest": ("max", F.col("risk_score")),
        "defaults": ("sum", F.col("default_flag").cast("bigint")), "flagged": ("count", F.col("default_flag"))})
    return tiles.select(
        F.col("risk_decile").cast("bigint").alias("risk_decile"), F.col("accounts").cast("bigint").alias("accounts"),
        F.col("lowest").cast("double").alias("min_score"), F.col("highest").cast("double").alias("max_score"),
        pct(F.col("defaults"), F.col("flagged"), 2).alias("default_rate_pct"),
    ).orderBy("risk_decile")


def decile_inversions(deciles: DataFrame) -> DataFrame:
    """Compare each decile's default rate with the previous decile (10 rows)."""
    w = Window.orderBy("risk_decile")
    prev = F.lag("default_rate_pct").over(w)
    return deciles.select(
        "risk_decile", "default_rate_pct", prev.alias("prev_default_rate_pct"),
        F.when(prev.isNull(), F.lit(0)).otherwise((F.col("default_rate_pct") < prev).cast("int"))
        .cast("bigint").alias("is_inversion"),
    )


def grade_behaviour(src: DataFrame, agg: Aggregator = ROWS) -> DataFrame:
    """Utilization and payment behaviour by grade."""
    seg = segment_report(src, ["risk_grade"], ["avg_utilization_pct", "avg_payment_to_bill_pct",
                                               "avg_months_delinquent", "avg_worst_dpd"], agg=agg)
    return seg.orderBy("risk_grade")


def gender_segments(src: DataFrame, agg: Aggregator = ROWS) -> DataFrame:
    """By gender (NULL gender is its own group)."""
    return segment_report(src, ["gender"], ["accounts", "default_rate_pct"], agg=agg)
