"""Rounding policy: Spark decimal quotients equal exact integer half-up rounding."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens.functions.numeric import pct, quotient


def _half_up(num: int, den: int, scale: int, mult: int) -> Decimal:
    q = Decimal(num * mult) / Decimal(den)
    return (Decimal(num * mult * 10 ** scale) / Decimal(den)).quantize(Decimal(1), ROUND_HALF_UP) / 10 ** scale \
        if q >= 0 else None


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10 ** 12), st.integers(1, 10 ** 9)), min_size=1, max_size=60))
def test_pct_is_exact_half_up(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = df.select(pct(F.col("n"), F.col("d"), 2).alias("p"),
                    quotient(F.col("n"), F.col("d"), 3).cast("double").alias("q")).collect()
    for (n, d), r in zip(pairs, got):
        assert r["p"] == float(_half_up(n, d, 2, 100))
        assert r["q"] == float(_half_up(n, d, 3, 1))


def test_ties_round_away_from_zero(spark):
    df = spark.createDataFrame([(1, 8), (5, 1000), (1, 2000)], "n long, d long")
    got = [r[0] for r in df.select(quotient(F.col("n"), F.col("d"), 2).cast("double")).collect()]
    # 0.125 -> 0.13, 0.005 -> 0.01, 0.0005 -> 0.00
    assert got == [0.13, 0.01, 0.0]


def test_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(1, 0)], "n long, d long")
    assert df.select(pct(F.col("n"), F.col("d"))).collect()[0][0] is None
