"""Physical-plan checks: the shapes the design relies on at scale."""

from ledgerlens.operators import unpivot
from ledgerlens.plans import kpi, mart, risk
from ledgerlens.sources.portfolio import portfolio_raw
from ledgerlens.operators import features
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_mart_build_is_one_exchange(spark):
    plan = _plan(features.risk_mart(portfolio_raw(spark, SF_SMALL)))
    assert plan.count("Exchange") == 1
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan


def test_scans_are_pruned_and_filtered(spark):
    plan = _plan(portfolio_raw(spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double>" in plan
    pf = mart.load(spark, SF_SMALL)
    seg = _plan(risk.gender_segments(pf.mart))
    assert "ReadSchema: struct<gender:string,default_flag:smallint>" in seg


def test_unpivot_scans_source_once(spark):
    pf = mart.load(spark, SF_SMALL)
    plan = _plan(unpivot.statements(pf.staging))
    assert plan.count("FileScan") == 1 and "Generate" in plan


def test_deciles_without_single_partition(spark):
    pf = mart.load(spark, SF_SMALL)
    plan = _plan(risk.risk_deciles(pf.mart))
    # The only global ordering left is the final ORDER BY of ten result rows.
    assert "SinglePartition" not in plan.split("HashAggregate")[-1]
    assert "Window" not in plan


def test_grouping_sets_expand_after_preaggregation(spark):
    pf = mart.load(spark, SF_SMALL)
    plan = _plan(kpi.dashboard_refresh(pf.mart))
    expand_at = plan.index("Expand")
    # a complete aggregation sits below the Expand (pre-aggregated cells)
    assert "HashAggregate" in plan[expand_at:]


def test_star_join_on_bucketed_tables_has_no_exchange(spark):
    pf = mart.load(spark, SF_SMALL)
    fact, dim = pf.bucketed_star(buckets=4)
    # At scale the dimension is as large as the fact; turn off the size-checked
    # broadcast that the planner picks for the tiny fixture to see that plan.
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = mart.star_join(fact, dim)
        plan = _plan(joined)
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        assert "Exchange" not in plan
        assert joined.count() == pf.mart.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_fk_audit_shuffles_each_parent_once(spark):
    """Three children of dim_customers and the parent itself: one keyed aggregate exchange, no
    join (broadcast off so the plan is the large-table one)."""
    import re

    from ledgerlens.operators import quality

    pf = mart.load(spark, SF_SMALL, "dirty")
    t = pf.tables()
    sub = {k: t[k] for k in ("dim_customers", "fact_repayment_history", "fact_statements", "fact_credit_risk")}
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(quality.fk_audit(sub))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "Join" not in plan
