"""Invariants of the reports on the derived portfolio."""

from pyspark.sql import functions as F

from ledgerlens.plans import collections as coll
from ledgerlens.plans import kpi, mart, risk
from ledgerlens.plans.registry import QUERIES
from tests.conftest import SF_SMALL


def _pf(spark):
    return mart.load(spark, SF_SMALL)


def test_shares_sum_to_100(spark):
    pf = _pf(spark)
    for df in (risk.risk_grade_segments(pf.mart), coll.collections_funnel(pf.mart), coll.dpd_distribution(pf.mart)):
        total = sum(r["pct_of_portfolio"] for r in df.collect())
        assert abs(total - 100) < 0.05
    total = sum(r["pct_of_total_exposure"] for r in coll.exposure_concentration(pf.mart).collect())
    assert abs(total - 100) < 0.05


def test_roll_rate_rows_sum_to_100(spark):
    pf = _pf(spark)
    for r in coll.roll_rate_pivot(pf.staging).collect():
        s = r["to_current_pct"] + r["to_early_pct"] + r["to_mid_pct"] + r["to_severe_pct"]
        assert abs(s - 100) <= 0.2
    n = pf.mart.count()
    assert sum(r["accounts"] for r in coll.roll_rate_matrix(pf.staging).collect()) == n


def test_grouping_set_levels_cover_portfolio(spark):
    pf = _pf(spark)
    n = pf.mart.count()
    per_level = kpi.dashboard_refresh(pf.mart).groupBy("grouping_set").agg(F.sum("accounts").alias("n")).collect()
    assert len(per_level) == 7 and all(r["n"] == n for r in per_level)


def test_grades_a_b_never_late(spark):
    pf = _pf(spark)
    bad = pf.mart.where(F.col("risk_grade").isin("A - Low Risk", "B - Moderate Risk")
                        & (F.col("worst_dpd_6mo") > 0)).count()
    assert bad == 0


def test_deciles_sizes_differ_by_at_most_one(spark):
    pf = _pf(spark)
    sizes = [r["accounts"] for r in risk.risk_deciles(pf.mart).collect()]
    assert len(sizes) == 10 and max(sizes) - min(sizes) <= 1 and sum(sizes) == pf.mart.count()


def test_long_and_wide_paths_agree(spark):
    rows = mart.reconcile_long_wide(_pf(spark)).collect()
    assert len(rows) == 12
    assert all(r["customers_differing"] == r["only_long"] == r["only_wide"] == 0 for r in rows)


def test_results_independent_of_shuffle_partitions(spark):
    keys = ["risk_grade_segments", "top_risk_segments", "roll_rate_matrix", "dashboard_refresh", "dq_describe"]
    base = {k: sorted(map(tuple, QUERIES[k](spark, SF_SMALL).collect()), key=str) for k in keys}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            for k in keys:
                assert sorted(map(tuple, QUERIES[k](spark, SF_SMALL).collect()), key=str) == base[k], (k, n)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_dirty_fixture_has_findings(spark):
    q = QUERIES
    assert q["dq_duplicate_rows"](spark, SF_SMALL).collect()[0]["duplicate_rows"] > 0
    assert q["dq_duplicate_keys"](spark, SF_SMALL).count() > 0
    nulls = q["dq_null_profile"](spark, SF_SMALL).collect()[0]
    assert nulls["null_education"] > 0 and nulls["null_age"] > 0
    nn = {(r["table_name"], r["column_name"]): r["null_rows"] for r in q["dq_notnull_audit"](spark, SF_SMALL).collect()}
    assert nn[("fact_credit_risk", "credit_utilization")] > 0


def test_every_audit_family_has_findings(spark):
    q = {k: QUERIES[k](spark, SF_SMALL).collect()
         for k in ("dq_fk_audit", "dq_check_audit", "dq_domain_audit", "dq_pk_audit", "reconcile_long_wide")}
    assert len(q["dq_fk_audit"]) == 4 and all(r["orphan_rows"] > 0 for r in q["dq_fk_audit"])
    assert len(q["dq_check_audit"]) == 3 and all(r["violations"] > 0 for r in q["dq_check_audit"])
    found = {(r["table_name"], r["rule"].split("(")[0]) for r in q["dq_domain_audit"] if r["violations"]}
    assert found == {("staging_raw_credit_data", "NUMERIC"), ("staging_raw_credit_data", "VARCHAR"),
                     ("staging_raw_credit_data", "repayment code"), ("dim_customers", "VARCHAR"),
                     ("fact_repayment_history", "VARCHAR"), ("fact_repayment_history", "repayment code"),
                     ("fact_statements", "NUMERIC"), ("fact_credit_risk", "NUMERIC")}
    assert all(r["duplicate_keys"] > 0 for r in q["dq_pk_audit"])
    differing = {r["column_name"] for r in q["reconcile_long_wide"] if r["customers_differing"]}
    assert differing == {"risk_score", "default_flag"}
    assert all(r["only_long"] == r["only_wide"] > 0 for r in q["reconcile_long_wide"])


def test_audit_profile_equals_direct_audits(spark):
    from ledgerlens.operators import quality

    pf = mart.load(spark, SF_SMALL, "dirty")
    prof, tables = pf.audit_profile(), pf.audited_tables()

    def rows(df):
        return sorted(map(tuple, df.collect()), key=str)

    assert rows(quality.notnull_from_profile(prof)) == rows(quality.notnull_audit(tables))
    assert rows(quality.domain_from_profile(prof)) == rows(quality.domain_audit(tables))
    assert rows(quality.check_from_profile(prof)) == rows(quality.check_audit(tables))
    assert rows(quality.row_count_from_profile(prof)) == rows(quality.row_count(pf.staging))
    assert rows(quality.null_profile_from_profile(prof)) == rows(quality.null_profile(pf.staging))
    assert rows(quality.missing_from_profile(prof)) == rows(quality.missing_total(pf.staging))


def test_describe_means_keep_cents_and_survive_null_columns(spark):
    from ledgerlens.operators import quality

    raw = spark.sql("SELECT CAST(x AS DECIMAL(14,2)) AS credit_limit, CAST(NULL AS SMALLINT) AS age "
                    "FROM VALUES (0.01), (0.02), (0.02), (NULL) AS t(x)")
    by = {r["column_name"]: r for r in quality.describe(raw, columns=("credit_limit", "age")).collect()}
    money, age = by["credit_limit"], by["age"]
    assert (money["count"], money["mean"], money["min"], money["p25"], money["max"]) == (3, 0.016667, 0.01, 0.015, 0.02)
    assert age["count"] == 0 and age["mean"] is age["p50"] is age["max"] is None


def test_duplicate_rows_two_phase_is_exact(spark):
    from pyspark.sql import functions as F

    from ledgerlens.operators import quality

    pf = mart.load(spark, SF_SMALL, "dirty")
    cols = list(quality.SOURCE_COLUMNS)
    brute = (pf.staging.groupBy(*cols).count().agg(F.sum(F.col("count") - 1)).collect()[0][0])
    assert quality.duplicate_rows(pf.staging).collect()[0][0] == brute > 0
    # a group of copies holding a third of the rows, by a broadcast and by a shuffled semi-join
    base = spark.createDataFrame([(i % 3 == 0 and 7 or i, "x") for i in range(3000)], "a long, b string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in (old, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            got = quality.duplicate_rows(base, columns=("a", "b")).collect()[0][0]
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        assert got == 1000  # 1000 rows with i % 3 == 0 plus row 7 share (7, "x")


# Measured shape of the derived portfolio as published in FIXTURES.md section 4
# (an independent check of the mapping, not derived from this code).
FIXTURE_SHAPE = {
    "/root/testdata/sf0.001": (1500, [1036, 338, 108, 18], [479, 85, 435, 501], 27, 401, 2, 3),
    "/root/testdata/sf0.01": (15000, [10354, 3396, 1085, 165], [4710, 835, 4357, 5098], 257, 2549, 16, 30),
}


def test_portfolio_matches_published_fixture_shape(spark):
    from pyspark.sql import functions as F

    for sf, want in FIXTURE_SHAPE.items():
        m = mart.load(spark, sf).mart
        st = {r[0][0]: r[1] for r in m.groupBy("collections_stage").count().collect()}
        gr = {r[0][0]: r[1] for r in m.groupBy("risk_grade").count().collect()}
        got = (m.count(), [st[k] for k in "1234"], [gr[k] for k in "ABCD"],
               m.where(F.col("total_bill_6mo") == 0).count(), m.select("risk_score").distinct().count(),
               m.where(F.col("age").isNull()).count(), m.where(~F.col("age").between(18, 100)).count())
        assert got == want, sf


def test_every_order_line_is_in_a_bill(spark):
    """All lines count: the bills add up to the lines' prices, cent for cent."""
    from pyspark.sql import functions as F

    for sf in FIXTURE_SHAPE:
        staging = mart.load(spark, sf).staging
        bills = staging.agg(*[F.sum(F.col(f"balance_{i}") * 100) for i in range(1, 7)]).first()
        cents = F.expr("CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * 100 AS BIGINT)")
        lines = spark.read.parquet(f"{sf}/lineitem.parquet").agg(F.sum(cents)).first()[0]
        assert int(sum(bills)) == lines, sf


def test_monthly_trend_with_many_accounts(spark):
    """Sums and counts of a hundred million accounts: no intermediate overflows."""
    from decimal import Decimal

    from pyspark.sql import functions as F

    from ledgerlens.plans import kpi

    rows = (spark.range(100_000_000).select(F.lit(1).cast("smallint").alias("statement_month"),
            F.lit(Decimal("30000.00")).cast("decimal(14,2)").alias("bill_amount"),
            F.when(F.col("id") % 4 != 0, F.lit(Decimal("20000.00"))).cast("decimal(14,2)").alias("payment_amount")))
    got = kpi.monthly_trend(rows).collect()
    assert [(r[0], r[1], r[2], r[3]) for r in got] == [(1, 30000, 20000, 66.67)]


def test_ntile_of_repeated_ids_negative_and_null_keys(spark):
    """Tile sizes and order as SQL's NTILE, whatever repeats."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from ledgerlens.operators.positions import ntile

    cases = [
        [(5, 1), (5, 1), (5, 1), (5, 2)],
        [(-5, 1), (None, 2), (-2, 3), (None, 4), (7, 5), (-5, 6), (None, 7)],
        [(k % 3 - 1 if k % 4 else None, k % 5) for k in range(97)],
        [(None, 1)] * 9,
        [(2, 1)] * 20 + [(1, 9), (3, 0)],
    ]
    for rows in cases:
        df = spark.createDataFrame(rows, "k long, id long")
        for n in (1, 2, 3, 7, 10):
            own = [(r.k, r.id, r.tile) for r in ntile(df, n, F.col("k"), "id").collect()]
            order = Window.orderBy(F.col("k").asc_nulls_last(), "id")
            want = [(r.k, r.id, r.tile) for r in df.withColumn("tile", F.ntile(n).over(order)).collect()]
            key = lambda t: tuple((x is None, x) for x in t)
            assert sorted(own, key=key) == sorted(want, key=key), (rows[:8], n)


def test_monthly_bills_with_a_hot_order(spark):
    """One order holds a third of all line rows: partial aggregation collapses it map-side and
    the sums stay exact; orders without lines get zeros, lines without an order are dropped."""
    import pandas as pd

    from ledgerlens.sources.portfolio import monthly_bills

    lines = [(7 if i % 3 == 0 else i % 50, 1 + i % 7, float(i % 997) + 0.25) for i in range(6000)]
    orders = spark.createDataFrame([(k,) for k in range(0, 60)], "o_orderkey long")
    li = spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_extendedprice double").repartition(8)
    got = {r["k"]: tuple(r[f"b{i}"] for i in range(1, 7)) for r in monthly_bills(orders, li).collect()}
    pdf = pd.DataFrame(lines, columns=["k", "ln", "px"])
    pdf["ln"] = (pdf.ln - 1) % 6 + 1
    pdf["c"] = (pdf.px * 100).round().astype("int64")
    want = {k: tuple(0 for _ in range(6)) for k in range(60)}
    for k, g in pdf.groupby("k"):
        want[k] = tuple(int(g[g.ln == i].c.sum()) for i in range(1, 7))
    assert got == want


def test_reconciliation_detects_a_tampered_account(spark):
    from pyspark.sql import functions as F

    pf = mart.load(spark, SF_SMALL)
    victim = pf.mart.where(F.col("risk_score") == 0).agg(F.min("customer_id")).collect()[0][0]
    tampered = pf.mart.withColumn(
        "risk_score", F.when(F.col("customer_id") == victim, F.col("risk_score") + F.lit(0.01).cast("decimal(8,2)"))
        .otherwise(F.col("risk_score")).cast("decimal(8,2)"))
    rows = mart.reconcile_long_wide(mart.Portfolio(staging=pf.staging, mart=tampered, lenient=False)).collect()
    assert {r["column_name"]: r["customers_differing"] for r in rows if r["customers_differing"]} == {"risk_score": 1}
    assert all(r["only_long"] == r["only_wide"] == 0 for r in rows)


def test_equal_sides_are_not_joined_row_by_row(spark):
    from pyspark.sql import functions as F

    pf = mart.load(spark, SF_SMALL)
    assert mart._fingerprints(pf.fact_credit_risk, ["risk_score"]).count() <= mart.RECONCILE_CELLS
    seen, write = [], mart.materialize
    try:
        mart.materialize = lambda df, name: seen.append((name, write(df, name))) or seen[-1][1]
        equal = mart.reconcile_long_wide(pf)
    finally:
        mart.materialize = write
    cells = dict(seen)["reconcile_cells"]
    assert cells.where("not (l_n <=> w_n and l_a <=> w_a and l_b <=> w_b)").count() == 0  # nothing to drill into
    assert equal.first().customers_compared == pf.mart.count()
    one_less = pf.mart.where(F.col("customer_id") > pf.mart.agg(F.min("customer_id")).first()[0])
    rows = mart.reconcile_long_wide(pf, one_less).collect()
    assert all((r.only_long, r.only_wide, r.customers_differing, r.customers_compared) == (1, 0, 0, pf.mart.count()) for r in rows)


def test_every_report_runs_on_the_dirty_portfolio(spark):
    """NULL labels, NULL utilization, zero limits and duplicated ids must not break any report."""
    from ledgerlens.plans.registry import REPORTS

    pf = mart.load(spark, SF_SMALL, "dirty")
    for key, fn in REPORTS.items():
        assert fn(pf).count() >= 0, key


def test_fk_audit_counts_orphans_per_child(spark):
    from ledgerlens.operators import quality

    def keys(*ks):
        return spark.createDataFrame([(k,) for k in ks], "customer_id long")

    tables = {
        "staging_raw_credit_data": keys(1, 2, 3),
        "dim_customers": keys(1, 2, 9),                 # 9 has no staging row
        "fact_repayment_history": keys(1, 1, 4, 4, 4),  # 4 has no dim row (3 rows)
        "fact_statements": keys(2),
        "fact_credit_risk": keys(3, 3),                 # 3 has no dim row (2 rows)
    }
    got = {r["child_table"]: r["orphan_rows"] for r in quality.fk_audit(tables).collect()}
    assert got == {"dim_customers": 1, "fact_repayment_history": 3, "fact_statements": 0, "fact_credit_risk": 2}


def test_value_frequency_table_serves_category_audit_and_describe(spark):
    from ledgerlens.operators import quality

    pf = mart.load(spark, SF_SMALL, "dirty")
    freq = pf.value_frequencies()

    def rows(df):
        return sorted(map(tuple, df.collect()), key=str)

    assert rows(quality.category_audit(pf.staging, freq=freq)) == rows(quality.category_audit(pf.staging))
    assert rows(quality.describe(pf.staging, freq=freq)) == rows(quality.describe(pf.staging))
