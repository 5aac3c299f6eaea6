"""The stored star schema: versions, increments, ids, views, audits without shuffles."""

import os
import tempfile

import pytest

from ledgerlens import __main__ as cli
from ledgerlens.operators import quality
from ledgerlens.plans import kpi, mart, registry, store
from ledgerlens.plans.mart import Portfolio
from tests.conftest import SF_SMALL


def rows(df):
    return sorted(map(str, registry.normalize(df).collect()))


@pytest.fixture(scope="module")
def pf(spark):
    return mart.load(spark, SF_SMALL)


@pytest.fixture(scope="module")
def two_batches(spark, pf):
    st = store.StarStore(spark, tempfile.mkdtemp(prefix="ledgerlens-star-", dir="/tmp"), buckets=4)
    st.rebuild(pf.staging.where("customer_id <= 900"))
    st.append(pf.staging.where("customer_id > 900"))
    return st


def test_opened_in_another_session_every_report_is_the_same(spark, pf, two_batches):
    other = Portfolio.open(spark.newSession(), two_batches.root)
    for key in ("dq_layer_reconcile", "dq_fk_audit", "dq_pk_audit", "fact_repayment_history", "star_join_mart", "engineered_wide", "risk_deciles",
                "top_risk_segments", "roll_rate_pivot", "executive_summary", "monthly_trend", "dashboard_refresh", "ratio_histogram"):
        assert rows(registry.REPORTS[key](other)) == rows(registry.REPORTS[key](pf)), key


def test_append_reads_the_new_accounts_only_and_keeps_old_files(spark, pf):
    st = store.StarStore(spark, tempfile.mkdtemp(prefix="ledgerlens-star-", dir="/tmp"), buckets=2)
    st.rebuild(pf.staging.where("customer_id <= 700"))
    before = st.manifest()["batches"]
    data = f"{st.root}/data/{before[0]['id']}"
    os.rename(data, data + "-away")  # a load that opened an old file would fail
    try:
        st.append(pf.staging.where("customer_id > 700"))
    finally:
        os.rename(data + "-away", data)
    assert st.manifest()["batches"][0] == before[0] and len(st.manifest()["batches"]) == 2
    assert rows(st.open().cube) == rows(pf.cube)
    assert rows(st.open(1).mart) == rows(pf.mart.where("customer_id <= 700"))  # the old version is whole


def test_a_load_that_dies_leaves_the_last_version(spark, pf, two_batches, monkeypatch):
    version, want = two_batches.versions()[-1], rows(two_batches.open().dim_customers)
    monkeypatch.setattr(store, "build_cube", lambda df: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        two_batches.rebuild(pf.staging.limit(5))
    monkeypatch.undo()
    assert two_batches.versions()[-1] == version and rows(two_batches.open().dim_customers) == want
    assert len(two_batches.vacuum(keep=10)) == 1  # the dead load's folder
    assert rows(two_batches.open().dim_customers) == want


def test_two_loads_at_once_cannot_both_publish(spark, two_batches):
    with pytest.raises(store.ConcurrentLoad):
        two_batches._publish(two_batches.manifest())


def test_ids_are_contiguous_stable_and_never_reused(spark, pf):
    st = store.StarStore(spark, tempfile.mkdtemp(prefix="ledgerlens-star-", dir="/tmp"), buckets=2)
    raw = pf.staging.withColumnRenamed("customer_id", "k")
    order = ["credit_limit", "avg_balance", "avg_payment", "balance_1"]
    st.rebuild(raw.where("k > 600").drop("k"), order_by=order)
    first = {r.customer_id: r.avg_balance for r in st.open().staging.collect()}
    assert sorted(first) == list(range(1, 901))
    st.append(raw.where("k <= 600").drop("k"), order_by=order)
    both = {r.customer_id: r.avg_balance for r in st.open().staging.collect()}
    assert sorted(both) == list(range(1, 1501)) and all(both[i] == b for i, b in first.items())
    with pytest.raises(ValueError, match="taken"):
        st.append(pf.staging.where("customer_id <= 3"))
    assert st.manifest()["next_id"] == 1501 and len(st.versions()) == 2
    with pytest.raises(ValueError, match="order_by"):
        st.append(raw.drop("k"))


def test_views_are_kept_and_can_be_replaced(spark, pf, two_batches):
    other = spark.newSession()
    assert set(store.StarStore(other, two_batches.root).bind_views()) == set(kpi.VIEW_SQL)
    for name in kpi.VIEW_SQL:
        assert rows(other.table(name)) == rows(registry.REPORTS[name](pf)), name
    version = two_batches.versions()[-1]
    two_batches.put_view("severe", "SELECT count(*) AS n FROM {fact_credit_risk} WHERE current_dpd >= 6")
    third = spark.newSession()
    assert "severe" in store.StarStore(third, two_batches.root).bind_views()
    assert third.table("severe").first().n == pf.mart.where("current_dpd >= 6").count()
    assert "severe" not in store.StarStore(spark.newSession(), two_batches.root).bind_views(version)
    two_batches.put_view("severe", None)
    assert set(two_batches.manifest()["views"]) == set(kpi.VIEW_SQL)


def test_audits_and_joins_by_customer_move_no_rows(spark, two_batches):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        opened = two_batches.open()
        for df in (quality.pk_audit(opened.tables()), quality.fk_audit(opened.tables(), co_bucketed=True)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_fk_audit_counts_null_and_orphan_keys(spark):
    from ledgerlens.schema import TABLE_SPECS

    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "customer_id long")
    child = spark.createDataFrame([(1,), (3,), (3,), (None,)], "customer_id long")
    names = [n for n, s in TABLE_SPECS.items() if s.parent and s.parent[0] == "dim_customers"]
    got = quality.fk_audit({"dim_customers": parent, names[0]: child})
    assert [(r.child_table, r.orphan_rows) for r in got.collect() if r.child_table == names[0]] == [(names[0], 3)]


def test_compact_and_vacuum(spark, pf):
    st = store.StarStore(spark, tempfile.mkdtemp(prefix="ledgerlens-star-", dir="/tmp"), buckets=2)
    with pytest.raises(FileNotFoundError):
        st.open()
    st.append(pf.staging.where("customer_id <= 10"))
    st.append(pf.staging.where("customer_id between 11 and 30"))
    st.compact()
    assert len(st.manifest()["batches"]) == 1 and len(st.vacuum()) == 2 and st.versions() == [3]
    assert rows(st.open().mart) == rows(pf.mart.where("customer_id <= 30"))


def test_empty_load(spark, pf):
    st = store.StarStore(spark, tempfile.mkdtemp(prefix="ledgerlens-star-", dir="/tmp"), buckets=2)
    st.rebuild(pf.staging.limit(0))
    assert st.open().mart.count() == 0 and st.manifest()["next_id"] == 1
    st.append(pf.staging.where("customer_id <= 4"))
    assert st.open().mart.count() == 4


def test_command_line_publishes_appends_and_reports(spark, pf, tmp_path):
    lower, upper, star, out = (str(tmp_path / n) for n in ("lower", "upper", "star", "out"))
    pf.staging.where("customer_id <= 800").write.parquet(lower)
    pf.staging.where("customer_id > 800").write.parquet(upper)
    cli.main(["--landing", lower, "--publish", star])
    cli.main(["--landing", upper, "--append", star])
    cli.main(["--star", star, "--out", out, "--report", "risk_grade_segments", "--report", "dashboard_refresh"])
    for key in ("risk_grade_segments", "dashboard_refresh"):
        assert rows(spark.read.parquet(f"{out}/{key}")) == rows(registry.REPORTS[key](pf))


def test_csv_ids_follow_the_files_without_a_sort(spark, pf, tmp_path):
    from ledgerlens.sources import raw as rawio

    path = str(tmp_path / "csv")
    src = pf.staging.orderBy("customer_id").drop("customer_id").withColumnRenamed("default_raw", "default").repartitionByRange(5, "avg_balance")
    rawio.write_csv(src, path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")  # several splits a file
    try:
        got = rawio.read_raw_csv(spark, path)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan
        ids = {r.customer_id: float(r.avg_balance) for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = []
    for name in sorted(n for n in os.listdir(path) if n.endswith(".csv")):
        with open(os.path.join(path, name)) as fh:
            head = fh.readline().rstrip("\n").split(",")
            want += [float(line.rstrip("\n").split(",")[head.index("avg_balance")]) for line in fh]
    assert [ids[i + 1] for i in range(len(want))] == want


def test_correlation_does_not_depend_on_partitions(spark, pf):
    from ledgerlens.plans import eda

    got = [eda.default_correlation(pf.mart.repartition(n), digits=17).collect() for n in (1, 8, 64)]
    assert got[0] == got[1] == got[2]
    assert [r.corr for r in eda.default_correlation(pf.mart.limit(0)).collect()] == [None] * 8


def test_changed_input_is_seen_and_refresh_forgets(spark, tmp_path):
    folder = str(tmp_path)
    for t in ("orders", "lineitem"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{folder}/{t}.parquet")
    one = mart.load(spark, folder)
    assert mart.load(spark, folder) is one
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").limit(10).write.mode("overwrite").parquet(f"{folder}/orders.parquet")
    two = mart.load(spark, folder)
    assert two is not one and two.staging.count() == 10
    mart.refresh(spark)
    assert mart.load(spark, folder) is not two


def test_the_dimension_does_not_wait_for_the_mart(spark, pf, monkeypatch):
    written = []
    write = mart.materialize
    monkeypatch.setattr(mart, "materialize", lambda df, name: (written.append(name), write(df, name))[1])
    fresh = mart.build(pf.staging)
    assert rows(fresh.dim_customers) == rows(pf.dim_customers) and written == ["staging_raw_credit_data"]
    limit = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    assert fresh.mart.count() == fresh.mart.count() == pf.mart.count() and written == ["staging_raw_credit_data", "risk_mart"]
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == limit


def test_edited_tables_lie_in_buckets_without_being_dealt_again(spark, monkeypatch):
    from ledgerlens.sources.portfolio import REKEYED, break_tables

    pf = mart.load(spark, SF_SMALL, "dirty")
    dealt, deal = [], type(pf.staging).repartition
    monkeypatch.setattr(type(pf.staging), "repartition", lambda df, *a: (dealt.append(a), deal(df, *a))[1])
    st = store.StarStore(spark, tempfile.mkdtemp(prefix="ledgerlens-star-", dir="/tmp"), buckets=3)
    st.publish_edited(pf, break_tables, REKEYED)
    assert len(dealt) == 1 + len(REKEYED)  # the landing rows and the tables with other keys
    monkeypatch.undo()
    want, opened = break_tables(pf.tables()), st.open()
    for name, df in opened.tables().items():
        assert rows(df) == rows(want[name]), name
        assert len(df.inputFiles()) <= 3, name
    assert rows(quality.pk_audit(opened.tables())) == rows(quality.pk_audit(want))
    assert len(os.listdir(f"{st.root}/data/{st.manifest()['batches'][0]['id']}")) == len(store.TABLES) + 2


def test_large_landings_get_more_buckets(spark, pf, monkeypatch):
    monkeypatch.setattr(store, "BUCKET_ROWS", 50)
    n = pf.staging.count()
    assert store.buckets_for(pf.staging) == max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // 50)) > n // 51
