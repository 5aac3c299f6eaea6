"""Report edge cases from FIXTURES.md section 5 on hand-made mart rows, through both the
row path and the segment-cube path."""

from decimal import Decimal as D

import pytest

from ledgerlens.operators.segments import CUBE, ROWS, build_cube
from ledgerlens.plans import collections as coll
from ledgerlens.plans import eda, kpi
from ledgerlens.schema import MART_COLUMNS


def _mart(spark, rows):
    """rows: dicts with a few fields; everything else gets a neutral default."""
    base = dict(credit_limit=D("100000.00"), credit_limit_band="100K-200K", gender="Male", education="University",
                marital_status="Single", age=30, age_band="25-34", current_dpd=0, worst_dpd_6mo=0,
                months_delinquent_6mo=0, avg_dpd_6mo=D("0.00"), collections_stage="1-Current",
                total_bill_6mo=D("100.00"), total_paid_6mo=D("10.00"), payment_to_bill_ratio=D("0.100"),
                credit_utilization=D("0.500"), risk_score=D("6.00"), risk_grade="B - Moderate Risk", default_flag=0)
    data = []
    for i, r in enumerate(rows, start=1):
        rec = {**base, **r, "customer_id": i}
        data.append(tuple(rec[c] for c in MART_COLUMNS))
    schema = ("customer_id bigint, credit_limit decimal(14,2), credit_limit_band string, gender string, "
              "education string, marital_status string, age smallint, age_band string, current_dpd smallint, "
              "worst_dpd_6mo smallint, months_delinquent_6mo smallint, avg_dpd_6mo decimal(6,2), "
              "collections_stage string, total_bill_6mo decimal(16,2), total_paid_6mo decimal(16,2), "
              "payment_to_bill_ratio decimal(6,3), credit_utilization decimal(6,3), risk_score decimal(8,2), "
              "risk_grade string, default_flag smallint")
    return spark.createDataFrame(data, schema)


def _both(fn, mart, **kw):
    rows = fn(mart, agg=ROWS, **kw).collect()
    cube = fn(build_cube(mart), agg=CUBE, **kw).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, cube), key=str)
    return rows


def test_zero_bill_segment_has_null_efficiency_and_ranks_last(spark):
    m = _mart(spark, [
        dict(age_band="<25", total_bill_6mo=D("0.00"), total_paid_6mo=D("0.00")),
        dict(age_band="<25", total_bill_6mo=D("0.00"), total_paid_6mo=D("5.00")),
        dict(age_band="25-34", total_bill_6mo=D("100.00"), total_paid_6mo=D("50.00")),
        dict(age_band="35-44", total_bill_6mo=D("100.00"), total_paid_6mo=D("20.00")),
    ])
    rows = _both(coll.efficiency_ranking, m, min_accounts=1)
    by_band = {r["age_band"]: r for r in rows}
    assert by_band["<25"]["collection_efficiency_pct"] is None
    assert by_band["<25"]["worst_efficiency_rank"] == 3
    assert by_band["35-44"]["worst_efficiency_rank"] == 1 and by_band["35-44"]["collection_efficiency_pct"] == 20.0
    assert [r["age_band"] for r in coll.efficiency_ranking(m, min_accounts=1).collect()][-1] == "<25"


def test_right_closed_band_curve_keeps_empty_bands_and_drops_zero_limits(spark):
    m = _mart(spark, [
        dict(credit_limit=D("50000.00"), default_flag=1),   # right-closed: '<50K'
        dict(credit_limit=D("30000.00"), default_flag=0),
        dict(credit_limit=D("900000.00"), default_flag=1),  # '500K+'
        dict(credit_limit=D("0.00"), default_flag=1),       # no band: dropped
    ])
    rows = {r["credit_limit_band"]: r for r in eda.eda_limit_band_curve(m).collect()}
    assert len(rows) == 6
    assert (rows["<50K"]["accounts"], rows["<50K"]["default_rate_pct"]) == (2, 50.0)
    assert (rows["500K+"]["accounts"], rows["500K+"]["default_rate_pct"]) == (1, 100.0)
    assert rows["50K-100K"]["accounts"] == 0 and rows["50K-100K"]["default_rate_pct"] is None


@pytest.mark.parametrize("agg", ["rows", "cube"])
def test_kpis_with_empty_filters(spark, agg):
    m = _mart(spark, [dict(risk_grade="C - High Risk", default_flag=1), dict(risk_grade="B - Moderate Risk")])
    src, a = (m, ROWS) if agg == "rows" else (build_cube(m), CUBE)
    r = kpi.executive_summary(src, agg=a).collect()[0]
    assert r["low_risk_default_rate_pct"] is None          # no grade A account
    assert r["severe_dpd_accounts"] == 0                   # COUNT FILTER over nothing is 0
    assert r["high_risk_plus_accounts"] == 1 and r["high_risk_default_rate_pct"] == 100.0
    assert r["total_accounts"] == 2 and r["overall_default_rate_pct"] == 50.0


def test_top_risk_ties_share_rank_and_cut_is_deterministic(spark):
    from ledgerlens.plans import risk

    rows = []
    for band, flags in (("<25", [1, 0]), ("25-34", [1, 0]), ("35-44", [1, 1]), ("45-54", [0, 0])):
        rows += [dict(age_band=band, default_flag=f) for f in flags]
    m = _mart(spark, rows)
    out = _both(risk.top_risk_segments, m, min_accounts=2, top_n=3)
    got = [(r["age_band"], r["default_rate_pct"], r["risk_rank"])
           for r in risk.top_risk_segments(m, min_accounts=2, top_n=3).collect()]
    assert got == [("35-44", 100.0, 1), ("25-34", 50.0, 2), ("<25", 50.0, 2)]
    assert len(out) == 3


def test_grouping_set_marks_null_gender_group(spark):
    m = _mart(spark, [dict(gender=None), dict(gender="Male"), dict(gender="Female")])
    rows = _both(kpi.dashboard_refresh, m)
    gender_rows = [r for r in rows if r["grouping_set"] == "gender"]
    assert sorted((r["gender"] or "", r["accounts"]) for r in gender_rows) == [("", 1), ("Female", 1), ("Male", 1)]
    assert {r["grouping_set"] for r in rows} == {"credit_limit_band", "age_band", "education", "marital_status",
                                                 "gender", "risk_grade", "collections_stage"}
    assert all(sum(r["accounts"] for r in rows if r["grouping_set"] == g) == 3 for g in {r["grouping_set"] for r in rows})
