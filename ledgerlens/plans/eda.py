"""Numeric tables behind the exploratory charts (N1-N7) and the dashboard drill-downs."""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import encodings as enc
from ..functions.numeric import pct
from ..operators.segments import ROWS, Aggregator, accounts, segment_report
from ..schema import LIMIT_BAND_LABELS, MARITAL_MAP, UNKNOWN

CORR_FEATURES = ("worst_dpd_6mo", "months_delinquent_6mo", "avg_dpd_6mo", "payment_to_bill_ratio",
                 "credit_utilization", "risk_score", "age", "credit_limit")
HIST_BINS = 30
HIST_MAX = 2          # clip(0, 2)


def eda_grade_summary(src: DataFrame, agg: Aggregator = ROWS) -> DataFrame:
    """Accounts and default rate (fraction, 3 dp) per grade."""
    return segment_report(src, ["risk_grade"], ["accounts", "default_rate"], agg=agg)


def eda_limit_band_curve(mart: DataFrame) -> DataFrame:
    """Default % by right-closed limit band, reindexed to the fixed band list (A21):
    bands without accounts appear with 0 accounts and a NULL rate; limits <= 0 drop out."""
    spark = mart.sparkSession
    bands = spark.createDataFrame([(b, i + 1) for i, b in enumerate(LIMIT_BAND_LABELS)],
                                  "credit_limit_band string, band_order int")
    agg = (mart.select(enc.limit_band_right_closed(F.col("credit_limit")).alias("credit_limit_band"),
                       "default_flag")
           .where(F.col("credit_limit_band").isNotNull())
           .groupBy("credit_limit_band")
           .agg(accounts().alias("accounts"), pct(F.sum("default_flag"), F.count("default_flag"), 4)
                .alias("default_rate_pct")))
    # Six-row literal on the left; the aggregate has at most six rows.
    return (bands.join(F.broadcast(agg), "credit_limit_band", "left")
            .select("credit_limit_band", F.col("band_order").cast("bigint").alias("band_order"),
                    F.coalesce("accounts", F.lit(0).cast("bigint")).alias("accounts"), "default_rate_pct")
            .orderBy("band_order"))


def eda_stage_summary(src: DataFrame, agg: Aggregator = ROWS) -> DataFrame:
    """Per stage accounts, default rate (3 dp), outstanding and collected totals."""
    return segment_report(src, ["collections_stage"], ["accounts", "default_rate"], extra={
        "total_outstanding": lambda a: a.s("total_bill_6mo").cast("double"),
        "total_collected": lambda a: a.s("total_paid_6mo").cast("double"),
    }, agg=agg)


def eda_stage_counts(src: DataFrame, agg: Aggregator = ROWS) -> DataFrame:
    """value_counts of the stage, sorted by stage."""
    return segment_report(src, ["collections_stage"], ["accounts"], agg=agg).orderBy("collections_stage")


def eda_edu_marital_pivot(src: DataFrame, agg: Aggregator = ROWS) -> DataFrame:
    """Default % by education (rows) x marital status (columns), fixed column set."""
    statuses = list(dict.fromkeys(MARITAL_MAP.values())) + [UNKNOWN]
    piv = (agg.prepare(src).groupBy("education").pivot("marital_status", statuses)
           .agg(pct(agg.s("default_flag"), agg.c("default_flag"), 2)))
    return piv.select("education", *[F.col(s).alias(f"{s.lower()}_pct") for s in statuses])


def ratio_histogram(mart: DataFrame) -> DataFrame:
    """Payment-to-bill ratio clipped to [0, 2], 30 equal bins (last bin closed), by class."""
    clipped = enc.clip(F.col("payment_to_bill_ratio"), 0, HIST_MAX)
    b = F.least(F.floor(clipped * F.lit(HIST_BINS // HIST_MAX)), F.lit(HIST_BINS - 1)).cast("bigint")
    return (mart.select(b.alias("bin"), F.col("default_flag").cast("bigint").alias("default_flag"))
            .groupBy("bin", "default_flag").agg(accounts().alias("accounts"))
            .select("bin", (F.col("bin") * F.lit(HIST_MAX) / F.lit(HIST_BINS)).alias("bin_lower"),
                    ((F.col("bin") + 1) * F.lit(HIST_MAX) / F.lit(HIST_BINS)).alias("bin_upper"),
                    "default_flag", "accounts"))


def default_correlation(mart: DataFrame, digits: int = 9) -> DataFrame:
    """Pearson correlation of each feature with the default flag (pairwise complete),
    lowest first.

    One aggregate pass takes the exact DECIMAL sums of x, y, x*x, x*y and y*y, so the result
    has the same bits however the rows are partitioned. Each is finished from its five sums
    with integers (a sum of squares beyond 38 digits raises, it does not wrap)."""
    flag = F.col("default_flag").cast("decimal(1,0)")
    sums = []
    for f in CORR_FEATURES:
        x = F.col(f).cast("decimal(16,3)")
        y = F.when(x.isNotNull(), flag)
        x = F.when(y.isNotNull(), x)
        sums += [F.count(x).alias(f"n_{f}"), F.sum(x).alias(f"x_{f}"), F.sum(y).alias(f"y_{f}"), F.sum(x * x).alias(f"xx_{f}"), F.sum(x * y).alias(f"xy_{f}")]
    row = mart.agg(*sums).first()
    rows = []
    for f in CORR_FEATURES:
        n, x, y, xx, xy = (Fraction(row[f"{k}_{f}"] or 0) for k in ("n", "x", "y", "xx", "xy"))
        dx, dy, both = n * xx - x * x, n * y - y * y, n * xy - x * y  # the flag is 0 or 1: y*y is y
        r = None if not dx or not dy else round(float(both) / math.sqrt(float(dx) * float(dy)), digits)
        rows.append((f, r))
    corr = mart.sparkSession.createDataFrame(rows, "feature string, corr double")
    return corr.orderBy(F.col("corr").asc_nulls_last(), "feature")


def value_counts(src: DataFrame, key: str, by: str = "count", agg: Aggregator = ROWS) -> DataFrame:
    """Accounts per value, most frequent first (ties by value) or by value."""
    counts = segment_report(src, [key], ["accounts"], agg=agg)
    value = F.col(key).asc_nulls_last()
    return counts.orderBy(F.desc("accounts"), value) if by == "count" else counts.orderBy(value)


def category_drilldown(src: DataFrame, key: str, agg: Aggregator = ROWS) -> DataFrame:
    """Single-key drill-down (marital-only, education-only) of the refresh extract."""
    return segment_report(src, [key], ["accounts", "default_rate_pct"], agg=agg)


def limit_band_right_closed(mart: DataFrame) -> DataFrame:
    """P2 next to P1 for every account."""
    return mart.select("customer_id", F.col("credit_limit").cast("double").alias("credit_limit"),
                       "credit_limit_band",
                       enc.limit_band_right_closed(F.col("credit_limit")).alias("credit_limit_band_right_closed"))

