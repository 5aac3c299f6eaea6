"""Every segment report evaluated over the segment cube equals the same report over
account rows, exactly (counts and DECIMAL sums are associative)."""

import pytest

from ledgerlens.operators.segments import CUBE, CUBE_DIMS, ROWS
from ledgerlens.plans import collections as coll
from ledgerlens.plans import eda, kpi, mart, risk
from tests.conftest import SF_SMALL

REPORTS = {
    "risk_grade_segments": risk.risk_grade_segments,
    "limit_band_segments": risk.limit_band_segments,
    "age_band_segments": risk.age_band_segments,
    "edu_marital_segments": risk.edu_marital_segments,
    "top_risk_segments": lambda s, agg: risk.top_risk_segments(s, min_accounts=5, agg=agg),
    "grade_behaviour": risk.grade_behaviour,
    "gender_segments": risk.gender_segments,
    "collections_funnel": coll.collections_funnel,
    "dpd_distribution": coll.dpd_distribution,
    "exposure_concentration": coll.exposure_concentration,
    "efficiency_ranking": lambda s, agg: coll.efficiency_ranking(s, min_accounts=5, agg=agg),
    "executive_summary": kpi.executive_summary,
    "vw_dashboard_kpi_summary": kpi.vw_dashboard_kpi_summary,
    "vw_collections_stage_summary": kpi.vw_collections_stage_summary,
    "dashboard_refresh": kpi.dashboard_refresh,
    "eda_grade_summary": eda.eda_grade_summary,
    "eda_stage_summary": eda.eda_stage_summary,
    "eda_edu_marital_pivot": eda.eda_edu_marital_pivot,
    "marital_segments": lambda s, agg: eda.category_drilldown(s, "marital_status", agg),
}


@pytest.mark.parametrize("variant", ["clean", "dirty"])
@pytest.mark.parametrize("name", sorted(REPORTS))
def test_cube_equals_rows(spark, name, variant):
    pf = mart.load(spark, SF_SMALL, variant)
    fn = REPORTS[name]
    rows = sorted(map(tuple, fn(pf.mart, agg=ROWS).collect()), key=str)
    cube = sorted(map(tuple, fn(pf.cube, agg=CUBE).collect()), key=str)
    assert rows == cube


def test_cube_is_small_and_complete(spark):
    pf = mart.load(spark, SF_SMALL)
    assert pf.cube.groupBy().sum("n").collect()[0][0] == pf.mart.count()
    assert pf.cube.count() == pf.cube.select(*CUBE_DIMS).distinct().count()
