"""Shared scratch folder rules."""

from ledgerlens.session import app_id, materialize, scratch_path, scratch_root


def test_scratch_root_reads_the_session_setting(spark):
    root = scratch_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert spark.sparkContext.getCheckpointDir() is not None


def test_scratch_paths_are_unique_and_under_the_root(spark):
    a, b = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert a != b and a.startswith(scratch_root(spark)) and app_id(spark) in a


def test_materialize_round_trip(spark):
    df = spark.range(10).withColumnRenamed("id", "x")
    back = materialize(df, "roundtrip")
    assert sorted(r.x for r in back.collect()) == list(range(10))
    assert "FileScan parquet" in back._jdf.queryExecution().executedPlan().toString()


def test_scratch_of_a_run_is_removed(spark):
    import os

    from ledgerlens.session import materialize, scratch_run

    with scratch_run(spark) as folder:
        assert materialize(spark.range(5), "some").count() == 5 and os.listdir(folder)
        inner = folder
    assert not os.path.exists(inner)
    try:
        with scratch_run(spark) as folder:
            materialize(spark.range(5), "some")
            raise ValueError
    except ValueError:
        assert not os.path.exists(folder)
    with scratch_run(spark, keep=True) as folder:
        kept = materialize(spark.range(5), "some")
    assert kept.count() == 5
    assert materialize(spark.range(3), "outside").count() == 3  # the application's folder, not a run's
