"""Sources, sinks and the streaming load path."""

import os
import tempfile

from pyspark.sql import functions as F

from ledgerlens.operators import features
from ledgerlens.plans import mart
from ledgerlens.sources import raw as rawio
from ledgerlens.streaming.ingest import start_mart_stream
from tests.conftest import SF_SMALL


def _scratch():
    return tempfile.mkdtemp(prefix="ledgerlens-io-", dir="/tmp")


def test_csv_roundtrip_assigns_contiguous_ids_in_file_order(spark):
    pf = mart.load(spark, SF_SMALL)
    src = pf.staging.orderBy("customer_id")
    out = os.path.join(_scratch(), "csv")
    # deliver as the source CSV: no id column, flag column named 'default', one file
    rawio.write_csv(src.drop("customer_id").withColumnRenamed("default_raw", "default").coalesce(1), out)
    back = rawio.read_raw_csv(spark, out)
    assert back.count() == pf.staging.count()
    # single file in id order -> ids are reproduced exactly
    diff = back.exceptAll(pf.staging.select(*back.columns))
    assert diff.count() == 0


def test_csv_failfast_on_bad_number(spark):
    d = _scratch()
    with open(os.path.join(d, "bad.csv"), "w") as fh:
        cols = ["credit_limit", "gender", "education", "marital_status", "age"] + \
            [f"timeliness_{i}" for i in range(1, 7)] + [f"balance_{i}" for i in range(1, 7)] + \
            [f"payment_{i}" for i in range(1, 7)] + ["avg_balance", "avg_payment", "default"]
        fh.write(",".join(cols) + "\n")
        fh.write(",".join(["abc"] + ["x"] * (len(cols) - 1)) + "\n")
    import pytest
    with pytest.raises(Exception):
        rawio.read_raw_csv(spark, d).collect()


def test_engineered_csv_sink(spark):
    pf = mart.load(spark, SF_SMALL)
    out = os.path.join(_scratch(), "eng")
    rawio.write_csv(features.engineered_wide(pf.staging), out)
    back = spark.read.option("header", True).csv(out)
    assert back.count() == pf.staging.count() and len(back.columns) == 47


def test_streaming_mart_equals_batch(spark):
    pf = mart.load(spark, SF_SMALL)
    base = _scratch()
    landing, out = os.path.join(base, "landing"), os.path.join(base, "mart")
    # land the accounts in four batches of files
    pf.staging.withColumn("_b", F.col("customer_id") % 4).write.partitionBy("_b").parquet(landing + "_p")
    for b in range(4):
        spark.read.parquet(f"{landing}_p/_b={b}").write.mode("append").parquet(landing)
    q = start_mart_stream(spark, landing, out, checkpoint=os.path.join(base, "ckpt"), max_files_per_trigger=2)
    q.awaitTermination(300)
    streamed = spark.read.parquet(out)
    assert streamed.count() == pf.mart.count()
    assert streamed.exceptAll(pf.mart.select(*streamed.columns)).count() == 0


def test_rebuild_is_idempotent(spark):
    """Building the star schema twice gives the same tables (overwrite semantics)."""
    pf = mart.load(spark, SF_SMALL)
    again = mart.build(pf.staging, lenient=False)
    assert again.mart.exceptAll(pf.mart).count() == 0 and again.mart.count() == pf.mart.count()
    out = os.path.join(_scratch(), "t")
    rawio.write_parquet(pf.mart, out)
    rawio.write_parquet(pf.mart, out)
    assert spark.read.parquet(out).count() == pf.mart.count()


def test_write_star_schema_and_sql_surface(spark):
    """S3 persist + S6: the tables answer SQL written in the reference's dialect
    (FILTER, :: casts, NTILE, GROUPING SETS; Spark spells TEXT as STRING) through Spark SQL."""
    pf = mart.load(spark, SF_SMALL)
    paths = mart.write_star_schema(pf, os.path.join(_scratch(), "star"))
    for name, path in paths.items():
        spark.read.parquet(path).createOrReplaceTempView(f"t_{name}")
    n = pf.mart.count()
    r = spark.sql("""
        SELECT COUNT(*) AS n,
               COUNT(*) FILTER (WHERE fr.current_dpd >= 6) AS severe,
               MAX(fr.current_dpd)::STRING || ' months' AS worst_label
        FROM t_fact_credit_risk fr JOIN t_dim_customers dc ON dc.customer_id = fr.customer_id""").collect()[0]
    assert r["n"] == n and r["worst_label"].endswith(" months")
    assert spark.sql("SELECT COUNT(*) FROM t_fact_repayment_history").collect()[0][0] == 6 * n
    tiles = spark.sql("""SELECT NTILE(10) OVER (ORDER BY risk_score, customer_id) AS d FROM t_fact_credit_risk""")
    assert tiles.select("d").distinct().count() == 10
    gs = spark.sql("""SELECT risk_grade, collections_stage, COUNT(*) AS c FROM t_fact_credit_risk
                      GROUP BY GROUPING SETS ((risk_grade), (collections_stage))""")
    assert gs.groupBy().sum("c").collect()[0][0] == 2 * n


def test_cli_builds_from_csv_and_writes_reports(spark):
    """A user's path: delivered CSV -> star schema -> every report as a Parquet table."""
    from ledgerlens.__main__ import main
    from ledgerlens.plans.registry import REPORTS

    pf = mart.load(spark, SF_SMALL)
    src = os.path.join(_scratch(), "accounts_csv")
    rawio.write_csv(pf.staging.orderBy("customer_id").drop("customer_id")
                    .withColumnRenamed("default_raw", "default").coalesce(1), src)
    out = os.path.join(_scratch(), "reports")
    main(["--csv", src, "--out", out])
    assert sorted(os.listdir(out)) == sorted(REPORTS)
    got = spark.read.parquet(os.path.join(out, "risk_grade_segments"))
    want = REPORTS["risk_grade_segments"](pf)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_streaming_resume_processes_only_new_files(spark):
    """Exactly-once incremental load: a restarted query on the same checkpoint picks up only
    the landing files that arrived since, and the mart has every account exactly once."""
    pf = mart.load(spark, SF_SMALL)
    base = _scratch()
    landing, out, ckpt = (os.path.join(base, x) for x in ("landing", "mart", "ckpt"))
    first = pf.staging.where(F.col("customer_id") % 2 == 0)
    second = pf.staging.where(F.col("customer_id") % 2 == 1)
    first.write.parquet(landing)
    start_mart_stream(spark, landing, out, checkpoint=ckpt).awaitTermination(300)
    assert spark.read.parquet(out).count() == first.count()
    second.write.mode("append").parquet(landing)
    start_mart_stream(spark, landing, out, checkpoint=ckpt).awaitTermination(300)
    streamed = spark.read.parquet(out)
    assert streamed.count() == pf.mart.count()
    assert streamed.select("customer_id").distinct().count() == pf.mart.count()


def test_csv_ids_follow_file_order_across_part_files(spark):
    """Several part files: ids run 1..n in (file, offset) order, contiguous across files."""
    pf = mart.load(spark, SF_SMALL)
    out = os.path.join(_scratch(), "parts")
    src = (pf.staging.repartitionByRange(3, "customer_id").sortWithinPartitions("customer_id")
           .drop("customer_id").withColumnRenamed("default_raw", "default"))
    rawio.write_csv(src, out)
    assert len([f for f in os.listdir(out) if f.endswith(".csv")]) == 3
    back = rawio.read_raw_csv(spark, out)
    assert back.exceptAll(pf.staging.select(*back.columns)).count() == 0


def test_register_views_answers_sql(spark):
    """The star-schema tables and the BI views are queryable by name."""
    from ledgerlens.operators.segments import CUBE
    from ledgerlens.plans import kpi

    pf = mart.load(spark, SF_SMALL)
    pf.register_views(prefix="v_")
    kpi.register_views(pf.cube, CUBE, prefix="v_")
    n = pf.mart.count()
    assert spark.sql("SELECT COUNT(*) FROM v_fact_credit_risk").collect()[0][0] == n
    assert spark.sql("SELECT SUM(accounts) FROM v_vw_risk_grade_summary").collect()[0][0] == n
    assert spark.sql("SELECT total_accounts FROM v_vw_dashboard_kpi_summary").collect()[0][0] == n


def test_csv_columns_matched_by_name(spark):
    """The delivered CSV may order its columns differently; a missing column is an error."""
    import pytest

    pf = mart.load(spark, SF_SMALL)
    src = pf.staging.orderBy("customer_id").drop("customer_id").withColumnRenamed("default_raw", "default")
    out = os.path.join(_scratch(), "shuffled_cols")
    rawio.write_csv(src.select(*reversed(src.columns)).coalesce(1), out)
    back = rawio.read_raw_csv(spark, out)
    assert back.exceptAll(pf.staging.select(*back.columns)).count() == 0
    out2 = os.path.join(_scratch(), "missing_col")
    rawio.write_csv(src.drop("age").coalesce(1), out2)
    with pytest.raises(ValueError):
        rawio.read_raw_csv(spark, out2)


def test_csv_lenient_mode_nulls_bad_values(spark):
    d = _scratch()
    from ledgerlens.schema import CSV_SCHEMA

    cols = [f.name for f in CSV_SCHEMA.fields]
    good = ["50000", "male", "uni", "single", "30"] + ["m+0"] * 6 + ["10.00"] * 14 + ["no"]
    bad = ["abc"] + good[1:4] + ["x"] + good[5:]
    with open(os.path.join(d, "a.csv"), "w") as fh:
        fh.write(",".join(cols) + "\n" + ",".join(good) + "\n" + ",".join(bad) + "\n")
    rows = rawio.read_raw_csv(spark, d, lenient=True).orderBy("customer_id").collect()
    assert [r["customer_id"] for r in rows] == [1, 2]
    assert rows[0]["credit_limit"] is not None and rows[1]["credit_limit"] is None and rows[1]["age"] is None


def test_views_follow_the_portfolio_they_are_pulled_for(spark):
    """Two portfolios in one session: each pull of a BI view reads its own portfolio."""
    from ledgerlens.plans.registry import REPORTS
    from tests.conftest import SF_ORACLE

    small, big = mart.load(spark, SF_SMALL), mart.load(spark, SF_ORACLE)
    for pf in (small, big, small):
        total = REPORTS["vw_dashboard_kpi_summary"](pf).collect()[0]["total_accounts"]
        assert total == pf.mart.count()


def test_engineered_csv_is_refused_as_raw_input(spark):
    """Loading the engineered output as if it were the raw delivery is refused (mapped labels
    would otherwise fall to 'Unknown')."""
    import pytest

    from ledgerlens.operators import features

    pf = mart.load(spark, SF_SMALL)
    out = os.path.join(_scratch(), "engineered")
    rawio.write_csv(features.engineered_wide(pf.staging).coalesce(1), out)
    with pytest.raises(ValueError, match="not the raw delivery"):
        rawio.read_raw_csv(spark, out)


def test_cli_from_landing_table(spark):
    from ledgerlens.__main__ import main

    pf = mart.load(spark, SF_SMALL)
    landing = os.path.join(_scratch(), "landing")
    pf.staging.write.parquet(landing)
    out = os.path.join(_scratch(), "reports")
    main(["--landing", landing, "--out", out, "--report", "executive_summary", "--report", "risk_deciles"])
    assert sorted(os.listdir(out)) == ["executive_summary", "risk_deciles"]
    assert spark.read.parquet(os.path.join(out, "executive_summary")).collect()[0]["total_accounts"] == pf.mart.count()


def test_lazy_portfolio_equals_persisted(spark):
    """build(persist=False) keeps everything lazy; the reports are the same."""
    from ledgerlens.plans.registry import REPORTS

    pf = mart.load(spark, SF_SMALL)
    lazy = mart.build(pf.staging, persist=False)
    for key in ("risk_grade_segments", "collections_funnel", "dashboard_refresh", "fact_credit_risk"):
        a = sorted(map(tuple, REPORTS[key](pf).collect()), key=str)
        b = sorted(map(tuple, REPORTS[key](lazy).collect()), key=str)
        assert a == b, key


def test_prices_become_cents_as_their_decimals_do(spark):
    from ledgerlens.sources.portfolio import monthly_bills

    prices = [0.0, -0.0, 1.005, 1.0049, 2.675, -2.675, 1e-9, 0.125, 12345678.905, 99999999999.99, 123456789012.345, 0.1 + 0.2, -17.1, None]
    lines = spark.createDataFrame([(i, p, 1) for i, p in enumerate(prices)], "l_orderkey long, l_extendedprice double, l_linenumber long")
    orders = lines.selectExpr("l_orderkey AS o_orderkey")
    want = {r[0]: r[1] for r in lines.selectExpr("l_orderkey", "CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * 100 AS BIGINT)").collect()}
    assert {r.k: r.b1 for r in monthly_bills(orders, lines).collect()} == {k: 0 if v is None else v for k, v in want.items()}
