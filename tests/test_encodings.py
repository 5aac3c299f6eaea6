"""Hand-made edge rows (FIXTURES.md section 5) against the column builders."""

from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException, NumberFormatException
from pyspark.sql import functions as F

from ledgerlens.functions import encodings as enc
from ledgerlens.operators import features
from ledgerlens.schema import RAW_SCHEMA


def _col(spark, values, dtype, expr):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_limit_band_edges(spark):
    vals = [Decimal("49999.99"), Decimal("50000"), Decimal("100000"), Decimal("200000"),
            Decimal("300000"), Decimal("500000"), Decimal("0")]
    assert _col(spark, vals, "decimal(14,2)", enc.limit_band) == [
        "<50K", "50K-100K", "100K-200K", "200K-300K", "300K-500K", "500K+", "<50K"]
    assert _col(spark, vals, "decimal(14,2)", enc.limit_band_right_closed) == [
        "<50K", "<50K", "50K-100K", "100K-200K", "200K-300K", "300K-500K", None]


def test_age_bands(spark):
    ages = [24, 25, 34, 35, 44, 45, 54, 55, 64, 65, None, 17, 101]
    assert _col(spark, ages, "smallint", enc.age_band) == [
        "<25", "25-34", "25-34", "35-44", "35-44", "45-54", "45-54", "55-64", "55-64", "65+", "65+", "<25", "65+"]


def test_codes_to_dpd_and_stage(spark):
    codes = ["m-2", "m-1", "m+0", "m+1", "m+2", "m+3", "m+5", "m+6", "m+8", None]
    assert _col(spark, codes, "string", enc.dpd) == [0, 0, 0, 1, 2, 3, 5, 6, 8, 0]
    stages = _col(spark, codes, "string", lambda c: enc.stage(enc.dpd(c)))
    assert [s[0] for s in stages] == list("1112233441")


def test_malformed_code_strict_and_lenient(spark):
    df = spark.createDataFrame([("",), ("x",)], "x string")
    with pytest.raises((NumberFormatException, Exception)):
        df.select(enc.dpd(F.col("x"))).collect()
    assert [r[0] for r in df.select(enc.dpd(F.col("x"), lenient=True)).collect()] == [0, 0]


def test_labels(spark):
    assert _col(spark, [" GRAD ", "HS", "0", "zzz", None], "string", enc.education_label) == [
        "Graduate School", "High School", "Unknown", "Unknown", "Unknown"]
    assert _col(spark, ["yes", "YES", "no", None], "string", enc.default_flag) == [1, 1, 0, 0]
    assert _col(spark, [" male", "FEMALE ", None], "string", enc.gender_label) == ["Male", "Female", None]
    assert _col(spark, ["Married ", "single", "na", None], "string", enc.marital_label) == [
        "Married", "Single", "Unknown", "Unknown"]


def test_dpd_bucket(spark):
    assert _col(spark, [7, 8, 9, 0], "int", enc.dpd_bucket) == ["7 months", "8+ months", "8+ months", "0 months"]


def _dec(x):
    return None if x is None else Decimal(x)


def _raw_row(limit="100000", codes=("m+0",) * 6, bills=("0",) * 6, pays=("0",) * 6, avg_balance="0"):
    row = [1, Decimal(limit), "male", "uni", "single", 30, *codes,
           *[_dec(b) for b in bills], *[_dec(p) for p in pays], Decimal(avg_balance), Decimal("0"), "no"]
    return row


def _features(spark, rows, lenient=False):
    df = spark.createDataFrame(rows, RAW_SCHEMA)
    return features.risk_mart(df, lenient).collect()


def test_ratio_half_up_tie_and_no_bill(spark):
    # bill 2000.00, paid 1.00 -> 0.0005 -> 0.001 (half-up; binary half-even would give 0.0)
    r = _features(spark, [_raw_row(bills=("2000.00",) + ("0",) * 5, pays=("1.00",) + ("0",) * 5)])[0]
    assert r["payment_to_bill_ratio"] == Decimal("0.001")
    r = _features(spark, [_raw_row()])[0]
    assert r["payment_to_bill_ratio"] == Decimal("1.000")


def test_ratio_overflow_strict_and_lenient(spark):
    row = _raw_row(bills=("0.01",) + ("0",) * 5, pays=("10.00",) + ("0",) * 5)
    with pytest.raises((ArithmeticException, Exception)):
        _features(spark, [row])
    r = _features(spark, [row], lenient=True)[0]
    assert r["payment_to_bill_ratio"] is None


def test_zero_limit_gives_null_utilization(spark):
    r = _features(spark, [_raw_row(limit="0", avg_balance="10")], lenient=True)[0]
    assert r["credit_utilization"] is None and r["credit_limit_band"] == "<50K"


def test_score_and_grade_edges(spark):
    # no dpd, util 0.800, ratio 0.300 -> 0.00, grade A
    r = _features(spark, [_raw_row(limit="1000", avg_balance="800", bills=("1000",) + ("0",) * 5,
                                   pays=("300",) + ("0",) * 5)])[0]
    assert r["risk_score"] == Decimal("0.00") and r["risk_grade"] == "A - Low Risk"
    # ratio 0.134 -> 4.98 A ; 0.133 -> 5.01 B
    r = _features(spark, [_raw_row(bills=("1000",) + ("0",) * 5, pays=("134",) + ("0",) * 5)])[0]
    assert r["risk_score"] == Decimal("4.98") and r["risk_grade"] == "A - Low Risk"
    r = _features(spark, [_raw_row(bills=("1000",) + ("0",) * 5, pays=("133",) + ("0",) * 5)])[0]
    assert r["risk_score"] == Decimal("5.01") and r["risk_grade"] == "B - Moderate Risk"
    # one late month -> 15.00 C ; worst 2 & two late months -> 30.00 D
    r = _features(spark, [_raw_row(codes=("m+1",) + ("m+0",) * 5)])[0]
    assert r["risk_score"] == Decimal("15.00") and r["risk_grade"] == "C - High Risk"
    r = _features(spark, [_raw_row(codes=("m+2", "m+1") + ("m+0",) * 4)])[0]
    assert r["risk_score"] == Decimal("30.00") and r["risk_grade"] == "D - Severe Risk"


def test_avg_dpd_half_up(spark):
    # dpd sum 1 over 6 months = 0.1666.. -> 0.17 ; sum 5 -> 0.83
    r = _features(spark, [_raw_row(codes=("m+1",) + ("m+0",) * 5)])[0]
    assert r["avg_dpd_6mo"] == Decimal("0.17")


def test_null_code_counts_as_current(spark):
    r = _features(spark, [_raw_row(codes=(None,) + ("m+0",) * 5)])[0]
    assert r["current_dpd"] == 0 and r["collections_stage"] == "1-Current"


def test_null_money_sums_skip_nulls(spark):
    """SUM skips NULL amounts; all-NULL bills give a NULL total and the ratio's ELSE branch."""
    row = _raw_row(bills=("100.00", None, "50.00", None, None, None), pays=("30.00",) + (None,) * 5)
    row_all_null = _raw_row(bills=(None,) * 6, pays=(None,) * 6)
    r, z = _features(spark, [row, row_all_null], lenient=True)
    assert r["total_bill_6mo"] == Decimal("150.00") and r["total_paid_6mo"] == Decimal("30.00")
    assert r["payment_to_bill_ratio"] == Decimal("0.200")
    assert z["total_bill_6mo"] is None and z["payment_to_bill_ratio"] == Decimal("1.000")
