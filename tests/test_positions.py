"""Distributed positions against Spark's own (single-partition) window functions."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators import positions


@pytest.mark.parametrize("n_rows,n_tiles,distinct", [(1003, 10, 7), (150, 10, 40), (7, 10, 3), (10, 10, 1),
                                                     (2000, 7, 2000)])
def test_ntile_matches_window_ntile(spark, n_rows, n_tiles, distinct):
    rnd = random.Random(n_rows * 31 + distinct)
    # heavy ties: one value holds about a third of all rows
    rows = [(i + 1, 0 if rnd.random() < 0.33 else rnd.randrange(distinct)) for i in range(n_rows)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "id long, v long").repartition(5)
    got = positions.ntile(df, n_tiles, F.col("v"), "id", out_col="t", fanout=4, max_buckets=4)
    want = df.withColumn("t", F.ntile(n_tiles).over(Window.orderBy("v", "id")))
    g = {r["id"]: r["t"] for r in got.collect()}
    w = {r["id"]: r["t"] for r in want.collect()}
    assert g == w


def test_ntile_plan_has_no_single_partition(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 13).alias("v"))
    got = positions.ntile(df, 10, F.col("v"), "id", out_col="t").groupBy("t").count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_tile_boundaries_rule():
    for n in (0, 1, 9, 10, 11, 99, 1001):
        bounds = positions.tile_boundaries(n, 10)
        for pos in range(n):
            assert positions.tile_of_position(pos, n, 10) == 1 + sum(b <= pos for b in bounds)


def test_order_statistics_and_quantiles(spark):
    vals = [5, 1, 1, 9, 3, 3, 3, 7, None]
    df = spark.createDataFrame([(v,) for v in vals], "x long")
    srt = sorted(v for v in vals if v is not None)
    stats = positions.order_statistics(df, {"x": F.col("x"), "y": -F.col("x")},
                                       {"x": list(range(len(srt))), "y": [0]}, fanout=2, max_buckets=2)
    assert [stats["x"][i] for i in range(len(srt))] == srt and stats["y"][0] == -9
    n, qs = positions.quantiles_linear(df, {"x": (F.col("x"), 0)}, [0.25, 0.5, 0.75])["x"]
    import numpy as np
    assert n == len(srt) and qs == [float(q) for q in np.quantile(srt, [0.25, 0.5, 0.75])]


def test_row_number_contiguous_in_order(spark):
    rnd = random.Random(7)
    keys = rnd.sample(range(10 ** 6), 500)
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(6)
    out = positions.with_row_number(df, "rn", order_by=["k"]).collect()
    got = sorted((r["k"], r["rn"]) for r in out)
    assert [rn for _, rn in got] == list(range(1, 501))


def test_ntile_with_sparse_huge_ids(spark):
    """Tie groups with few rows but a huge id range are resolved to single values directly."""
    rows = [(i * 10 ** 9 + 7, i % 3) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, v long")
    got = positions.ntile(df, 10, F.col("v"), "id", out_col="t", fanout=64, max_buckets=512)
    want = df.withColumn("t", F.ntile(10).over(Window.orderBy("v", "id")))
    assert {r["id"]: r["t"] for r in got.collect()} == {r["id"]: r["t"] for r in want.collect()}


def test_catalogue_surrogate_key_over_landing_rows(spark):
    from ledgerlens.plans import mart
    from ledgerlens.plans.registry import REPORTS
    from tests.conftest import SF_SMALL

    clean = REPORTS["surrogate_key"](mart.load(spark, SF_SMALL)).collect()
    assert all(r["row_id"] == r["customer_id"] for r in clean)
    dirty_pf = mart.load(spark, SF_SMALL, "dirty")
    ids = sorted(r["row_id"] for r in REPORTS["surrogate_key"](dirty_pf).collect())
    assert ids == list(range(1, dirty_pf.staging.count() + 1))


@pytest.mark.parametrize("n_tiles", [3, 10, 97])
def test_ntile_randomized_against_window(spark, n_tiles):
    rnd = random.Random(n_tiles)
    ids = rnd.sample(range(1, 10 ** 7), 20000)
    rows = [(i, 0 if rnd.random() < 1 / 3 else rnd.randrange(-500, 500)) for i in ids]
    df = spark.createDataFrame(rows, "id long, v long").repartition(7)
    got = positions.ntile(df, n_tiles, F.col("v"), "id", out_col="t", fanout=16, max_buckets=64)
    want = df.withColumn("t", F.ntile(n_tiles).over(Window.orderBy("v", "id")))
    diff = got.select("id", "t").exceptAll(want.select("id", "t")).count()
    assert diff == 0


def test_tiles_are_aggregated_in_two_scans(spark):
    import random

    from pyspark.sql import Window

    rnd = random.Random(3)
    draws = [lambda: rnd.randint(0, 50), lambda: rnd.choice([0, 0, 0, 5, 7, None]), lambda: rnd.randint(-10 ** 15, 10 ** 15), lambda: None,
             lambda: rnd.choice([1] * 9 + [rnd.randint(0, 10 ** 6)])]
    measures = {"n": ("count", F.lit(1)), "lo": ("min", F.col("v")), "hi": ("max", F.col("v")), "s": ("sum", F.col("w")), "c": ("count", F.col("w"))}
    for size, draw in [(3000, d) for d in draws] + [(0, draws[0]), (25, draws[0])]:
        df = spark.createDataFrame([(i, draw(), rnd.choice([None, 0, 1])) for i in range(size)], "id long, v long, w long").repartition(3)
        read = spark.sparkContext.accumulator(0)

        def counted(batches):
            for b in batches:
                read.add(b.num_rows)
                yield b

        got = positions.tile_aggregate(df.mapInArrow(counted, df.schema), 10, F.col("v"), "id", measures, accuracy=200).collect()
        order = Window.orderBy(F.col("v").asc_nulls_last(), "id")
        want = df.withColumn("tile", F.ntile(10).over(order)).groupBy("tile").agg(F.count(F.lit(1)), F.min("v"), F.max("v"), F.sum("w"), F.count("w")).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))
        assert size < 1000 or read.value <= 2 * size
