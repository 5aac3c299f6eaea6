"""Distributed positions: exact NTILE over a whole table (W5) and contiguous keys.

``NTILE(n) OVER (ORDER BY key)`` without PARTITION BY makes Spark move every row to
one task (``Exchange SinglePartition``). Nothing here does that.

Exact NTILE by boundary selection
---------------------------------
Tile sizes are fixed by the row count N alone: with ``b = N div n`` and
``r = N mod n`` the first r tiles hold b+1 rows, so tile t+1 starts at position
``P_t = t*b + min(t, r)``. A row's tile is ``1 + #{t : key(P_t) <= its key}``,
where ``key(P)`` is the (order value, tie-break id) of the row at position P.
The n-1 boundary keys are found by histogram refinement: each pass groups the
rows that can still hold a boundary into value buckets and narrows every boundary
to one bucket (or straight to one value when its range is known to hold few rows).
A pass is a scan plus a partial aggregate, and it returns at most
max((n-1) * fanout, max_buckets) counts to the driver, a bound set by the
parameters and independent of the data. The final pass labels
every row with its tile in a narrow projection, so the report aggregate runs
partial/final like any other group-by. Ties of the order value (one value may hold
a third of all rows) are split by the id, never by a single task.

Tiles of a large table in two scans
-----------------------------------
``tile_aggregate`` needs aggregates per tile, not a label per row. Its first scan takes the row
count and a mergeable quantile sketch, whose error bound brackets every boundary between two
order values. Its second scan aggregates the rows between brackets as they are (each such
stretch lies in one tile) and writes the rows inside brackets, narrow, to a table of their own.
All further passes read that table only: the boundaries are selected in it exactly, as above.

Contiguous keys
---------------
``with_row_number`` is the zipWithIndex pattern: fix the partition contents
(checkpoint), count rows per partition, broadcast the per-partition offsets (their
size is the partition count, not the data), and add the in-partition row index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..session import materialize, scratch_root


def tile_boundaries(n_rows: int, n_tiles: int) -> list[int]:
    """0-based start positions of tiles 2..n (only those < n_rows)."""
    b, r = divmod(n_rows, n_tiles)
    return [p for p in (t * b + min(t, r) for t in range(1, n_tiles)) if p < n_rows]


def tile_of_position(pos: int, n_rows: int, n_tiles: int) -> int:
    """Reference rule (SQL NTILE) for one position; used by tests."""
    b, r = divmod(n_rows, n_tiles)
    if pos < r * (b + 1):
        return pos // (b + 1) + 1
    return r + (pos - r * (b + 1)) // b + 1


MAX_BUCKETS = 1 << 16   # histogram cells collected per refinement round, over all ranges


def _select_values(df: DataFrame, col: str, targets: dict[int, tuple], fanout: int,
                   max_buckets: int = MAX_BUCKETS) -> dict[int, tuple[int, int, int]]:
    """Order statistics by histogram refinement.

    ``targets``: {target: (tag, rank, lo, hi[, rows])} -- find the value v of ``col``
    holding 0-based ``rank`` among the rows with ``_tag == tag`` and lo <= col <= hi,
    ascending; ``rows`` is the number of such rows when already known. Returns
    {target: (v, residual, ties)}: residual is the rank among the ``ties`` rows equal to v.

    Ranges of one tag are identical or disjoint at every round, so each row feeds at most
    one histogram. Each round splits an open range into at most
    split = max(fanout, max_buckets // #ranges) buckets, or straight into single values
    when the range is known to hold at most ``split`` rows (a histogram never returns more
    non-empty cells than rows). Either way a round collects at most
    max(#ranges * fanout, max_buckets) counts whatever the data size.
    """
    pending = {t: (tuple(v) + (None,))[:5] for t, v in targets.items()}
    found: dict[int, tuple[int, int, int]] = {}
    while pending:
        ranges = sorted({(tag, lo, hi) for tag, _, lo, hi, _ in pending.values()})
        split = max(fanout, max_buckets // len(ranges))
        rows = {(tag, lo, hi): n for tag, _, lo, hi, n in pending.values() if n is not None}
        width = {r: 1 if rows.get(r) is not None and rows[r] <= split
                 else max(1, -(-(r[2] - r[1] + 1) // split)) for r in ranges}
        rid = bucket = None
        for i, r in enumerate(ranges):
            tag, lo, hi = r
            inside = (F.col("_tag") == F.lit(tag)) & (F.col(col) >= F.lit(lo)) & (F.col(col) <= F.lit(hi))
            b = F.expr(f"div({col} - ({lo}), {width[r]})")
            rid = F.when(inside, F.lit(i)) if rid is None else rid.when(inside, F.lit(i))
            bucket = F.when(inside, b) if bucket is None else bucket.when(inside, b)
        hist = (df.select(rid.alias("_r"), bucket.alias("_b")).where(F.col("_r").isNotNull())
                .groupBy("_r", "_b").count().collect())
        by_range: dict[int, list[tuple[int, int]]] = {}
        for row in hist:
            by_range.setdefault(row["_r"], []).append((row["_b"], row["count"]))
        nxt = {}
        for target, (tag, rank, lo, hi, _) in pending.items():
            r = (tag, lo, hi)
            w = width[r]
            seen = 0
            for b, cnt in sorted(by_range.get(ranges.index(r), [])):
                if rank < seen + cnt:
                    b_lo = lo + b * w
                    b_hi = min(hi, b_lo + w - 1)
                    if b_lo == b_hi:
                        found[target] = (b_lo, rank - seen, cnt)
                    else:
                        nxt[target] = (tag, rank - seen, b_lo, b_hi, cnt)
                    break
                seen += cnt
            else:
                raise RuntimeError("rank outside the histogram; the input changed between passes")
        pending = nxt
    return found


def ntile(df: DataFrame, n_tiles: int, order_key: Column, id_col: str,
          out_col: str = "tile", fanout: int = 4096, max_buckets: int = MAX_BUCKETS,
          starts: list[int] | None = None) -> DataFrame:
    """Exact ``NTILE(n_tiles) OVER (ORDER BY order_key NULLS LAST, id_col)``; ``starts`` are the
    positions at which tiles 2, 3, ... begin, if they are not those of equal tiles.

    ``order_key`` must be an integral (BIGINT-castable) expression, e.g. the unscaled
    value of a DECIMAL; ``id_col`` a BIGINT tie-break. NULL keys are a group of their own
    after the last value. Rows that share key and id are told apart only where a boundary
    falls among them, by an ordinal over those rows. ``df`` should be a stored table (or
    cached), because it is scanned once per refinement pass.
    """
    base = df.withColumn("_k", order_key.cast("bigint"))
    stats = base.agg(F.count(F.lit(1)).alias("n"), F.count("_k").alias("keyed"), F.min("_k").alias("klo"),
                     F.max("_k").alias("khi"), F.min(id_col).alias("ilo"), F.max(id_col).alias("ihi")).collect()[0]
    bounds = tile_boundaries(stats["n"], n_tiles) if starts is None else starts
    beyond = sum(p >= stats["n"] for p in bounds)  # tiles that begin behind the last row are empty
    bounds = bounds[:len(bounds) - beyond]
    if not bounds:
        return df.withColumn(out_col, F.lit(1))
    # 1) order value at every boundary position (all boundaries in the same passes); positions
    #    past the keyed rows fall among the NULL keys.
    keyed = stats["keyed"]
    inner = {t: (0, p, stats["klo"], stats["khi"], keyed) for t, p in enumerate(bounds) if p < keyed}
    kv: dict[int, tuple] = dict(_select_values(base.withColumn("_tag", F.lit(0)), "_k", inner, fanout, max_buckets)) if inner else {}
    kv |= {t: (None, p - keyed, stats["n"] - keyed) for t, p in enumerate(bounds) if p >= keyed}
    # 2) tie-break id inside the boundary's order value; boundaries on the same value share a tag.
    values = sorted({v for v, _, _ in kv.values()}, key=lambda v: (v is None, v))
    tag = None
    for i, v in enumerate(values):
        hit = F.col("_k").isNull() if v is None else F.col("_k") == F.lit(v)
        tag = F.when(hit, F.lit(i)) if tag is None else tag.when(hit, F.lit(i))
    ties = base.select(tag.alias("_tag"), F.col(id_col).alias("_id")).where(F.col("_tag").isNotNull())
    ids = _select_values(ties, "_id",
                         {t: (values.index(v), res, stats["ilo"], stats["ihi"], n_ties)
                          for t, (v, res, n_ties) in kv.items()},
                         fanout, max_buckets)
    # 3) rows equal in key and id, where a boundary falls among them, get an ordinal.
    split = {(kv[t][0], ids[t][0]) for t in range(len(bounds)) if ids[t][1]}
    base = base.withColumn("_o", F.lit(0).cast("bigint"))
    if split:
        among = F.lit(False)
        for v, i in split:
            among = among | (F.col("_k").eqNullSafe(F.lit(v).cast("bigint")) & (F.col(id_col) == F.lit(i)))
        own = Window.partitionBy("_k", id_col).orderBy(F.xxhash64(*df.columns))
        told = base.where(among).withColumn("_o", F.row_number().over(own).cast("bigint") - 1)
        base = base.where(~F.coalesce(among, F.lit(False))).unionByName(told)
    # 4) narrow labelling: 1 + number of boundary keys <= the row's key.
    tile = F.lit(1)
    for t in range(len(bounds)):
        k_t, (id_t, o_t, _) = kv[t][0], ids[t]
        late = (F.col(id_col) > F.lit(id_t)) | ((F.col(id_col) == F.lit(id_t)) & (F.col("_o") >= F.lit(o_t)))
        null_key = F.col("_k").isNull()
        ge = null_key & late if k_t is None else null_key | (F.col("_k") > F.lit(k_t)) | ((F.col("_k") == F.lit(k_t)) & late)
        tile = tile + F.coalesce(ge, F.lit(False)).cast("int")
    return base.withColumn(out_col, tile).drop("_k", "_o")


_LAST = (1 << 63) - 1
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
_TAKE = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}


def _brackets(quantiles: list[int]) -> list[tuple[int, int]]:
    """Disjoint ranges of order values, ascending, around pairs of quantiles."""
    out: list[tuple[int, int]] = []
    for low, high in zip(quantiles[::2], quantiles[1::2]):
        # the sketch holds doubles
        low, high = max(low - (abs(low) >> 50), -_LAST - 1), min(high + (abs(high) >> 50), _LAST)
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def tile_aggregate(df: DataFrame, n_tiles: int, order_key: Column, id_col: str, measures: dict[str, tuple[str, Column]],
                   out_col: str = "tile", accuracy: int = 2000) -> DataFrame:
    """(out_col, measures) per tile of the exact ``NTILE(n_tiles) OVER (ORDER BY order_key NULLS
    LAST, id_col)``, in two scans of ``df``. ``measures``: {name: (count, sum, min or max,
    expression)}. The sketch is off by at most 1 / ``accuracy`` of the rows; a bracket spans four
    times that, and the value at its ends whole. A table so small that rounding the tiles' sizes
    could leave the brackets is labelled row by row."""
    rows = df.select(order_key.cast("bigint").alias("_k"), F.col(id_col).alias("_id"), *[c.alias(n) for n, (_, c) in measures.items()])
    placed = F.coalesce("_k", F.lit(_LAST))  # NULL keys sort behind all others
    cuts = [min(1.0, max(0.0, t / n_tiles + side * 2 / accuracy)) for t in range(1, n_tiles) for side in (-1, 1)]
    n, *at = rows.agg(F.count(F.lit(1)), *([F.percentile_approx(placed, cuts, accuracy)] if cuts else [])).first()

    def parts(grouped) -> DataFrame:
        return grouped.agg(*[_TAKE[kind](name).alias(name) for name, (kind, _) in measures.items()])

    if n * 2 < (n_tiles + 1) * accuracy or not cuts:
        return parts(ntile(rows, n_tiles, F.col("_k"), "_id", out_col=out_col).groupBy(out_col))
    ranges = _brackets(at[0])
    region = F.lit(len(ranges))  # bracket 0, 1, ... or the stretch of rows below it; above all
    inside = F.lit(False)
    for i in range(len(ranges) - 1, -1, -1):
        region = F.when(placed <= F.lit(ranges[i][1]), i).otherwise(region)
        inside = inside | placed.between(*map(F.lit, ranges[i]))
    seen = Observation()
    between = ~inside
    watched = [F.count_if(between & (region == j)).alias(f"rows_{j}") for j in range(len(ranges) + 1)]
    watched += [_TAKE[kind](F.when(between & (region == j), F.col(name))).alias(f"{name}_{j}")
                for j in range(len(ranges) + 1) for name, (kind, _) in measures.items()]
    bracketed = materialize(rows.observe(seen, *watched).where(inside).withColumn("_r", region), "tile-brackets")
    got = seen.get
    # a boundary at position p of all rows is that many rows further up in the brackets' table
    before = [sum(got[f"rows_{j}"] for j in range(i + 1)) for i in range(len(ranges))]
    sizes = {r["_r"]: r["count"] for r in bracketed.groupBy("_r").count().collect()}  # one row a bracket
    starts, tile_below, i = [], [], 0
    ends = [before[i] + sum(sizes.get(j, 0) for j in range(i + 1)) for i in range(len(ranges))]
    for p in tile_boundaries(n, n_tiles):
        while i < len(ranges) - 1 and p >= ends[i]:
            tile_below.append(len(starts) + 1)
            i += 1
        if not ends[i] - sizes.get(i, 0) <= p <= ends[i]:
            raise RuntimeError("a boundary lies outside its bracket; the input changed between the scans")
        starts.append(p - before[i])
    # stretch j lies between the boundaries of brackets j - 1 and j, all of it in one tile
    tile_below = [1, *tile_below]
    tile_below += [len(starts) + 1] * (len(ranges) + 1 - len(tile_below))
    tiled = parts(ntile(bracketed.drop("_r"), n_tiles, F.col("_k"), "_id", out_col=out_col, starts=starts).groupBy(out_col))
    whole = [(tile_below[j], *[got[f"{name}_{j}"] for name in measures]) for j in range(len(ranges) + 1) if got[f"rows_{j}"]]
    every = tiled.unionByName(df.sparkSession.createDataFrame(whole, tiled.schema)) if whole else tiled
    return every.groupBy(out_col).agg(*[_MERGE[kind](name).alias(name) for name, (kind, _) in measures.items()])


def order_statistics(df: DataFrame, keys: dict[str, Column], ranks, fanout: int = 4096,
                     max_buckets: int = MAX_BUCKETS) -> dict[str, dict[int, int]]:
    """Exact order statistics of several integral expressions in shared passes.

    ``keys``: {name: integral Column}; ``ranks``: {name: 0-based ranks among its
    non-NULL values}, or a function of {name: number of those values} that gives them. Returns
    {name: {rank: value}}. Same bounded histogram refinement as ``ntile``: no row leaves its
    task, the driver sees counts only."""
    names = list(keys)
    stack = "stack({}, {}) AS (_tag, _k)".format(
        len(names), ", ".join(f"{i}, _v{i}" for i in range(len(names))))
    long = (df.select(*[keys[n].cast("bigint").alias(f"_v{i}") for i, n in enumerate(names)])
            .select(F.expr(stack)).where(F.col("_k").isNotNull()))
    bounds = {r["_tag"]: (r["lo"], r["hi"], r["n"]) for r in
              long.groupBy("_tag").agg(F.min("_k").alias("lo"), F.max("_k").alias("hi"),
                                       F.count(F.lit(1)).alias("n")).collect()}
    if callable(ranks):
        ranks = ranks({n: bounds[i][2] if i in bounds else 0 for i, n in enumerate(names)})
    targets, index = {}, {}
    for i, n in enumerate(names):
        if i not in bounds:
            continue
        for r in sorted(set(ranks.get(n, []))):
            index[len(targets)] = (n, r)
            targets[len(targets)] = (i, r, bounds[i][0], bounds[i][1], bounds[i][2])
    got = _select_values(long, "_k", targets, fanout, max_buckets) if targets else {}
    out: dict[str, dict[int, int]] = {n: {} for n in names}
    for t, (v, _, _) in got.items():
        n, r = index[t]
        out[n][r] = v
    return out


def quantiles_linear(df: DataFrame, keys: dict[str, tuple[Column, int]], probs: list[float]
                     ) -> dict[str, tuple[int, list[float | None]]]:
    """Exact quantiles with linear interpolation between closest ranks (the default of
    pandas ``describe`` / SQL ``percentile_cont``) for integral expressions holding
    values in units of 10^-scale: {name: (key Column, scale)} ->
    {name: (non-NULL count, [quantile per prob])}."""
    counts, pos = {}, {}

    def wanted(sizes: dict[str, int]) -> dict[str, list[int]]:
        counts.update(sizes)
        for n, cnt in sizes.items():
            pos[n] = [(cnt - 1) * p for p in probs] if cnt else []
        return {n: sorted({int(x) for x in pos[n]} | {min(int(x) + 1, cnt - 1) for x in pos[n]}) for n, cnt in sizes.items()}

    vals = order_statistics(df, {n: c for n, (c, _) in keys.items()}, wanted)
    out = {}
    for n, (_, scale) in keys.items():
        cnt = counts[n]
        if not cnt:
            out[n] = (0, [None for _ in probs])
            continue
        qs = []
        for x in pos[n]:
            lo_i = int(x)
            hi_i = min(lo_i + 1, cnt - 1)
            lo, hi = vals[n][lo_i] / 10 ** scale, vals[n][hi_i] / 10 ** scale
            qs.append(lo + (hi - lo) * (x - lo_i))
        out[n] = (cnt, qs)
    return out


def with_row_number(df: DataFrame, out_col: str = "row_number", order_by: list[str] | None = None) -> DataFrame:
    """Contiguous 1-based numbering without a single-partition window.

    With ``order_by`` the rows are range-partitioned and sorted first (ties spread by
    the full key); without it the input order of a deterministic scan is used.
    Partition contents are fixed with ``checkpoint()`` (reliable, in the shared
    checkpoint folder) so counting and numbering see the same partitions."""
    spark = df.sparkSession
    scratch_root(spark)  # make sure a reliable checkpoint folder is configured
    if order_by:
        df = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    fixed = df.checkpoint(eager=True)
    numbered = fixed.select("*", F.spark_partition_id().alias("_pid"),
                            F.monotonically_increasing_id().alias("_mid"))
    counts = fixed.groupBy(F.spark_partition_id().alias("_pid")).count().collect()
    offsets, run = [], 0
    for row in sorted(counts, key=lambda r: r["_pid"]):
        offsets.append((row["_pid"], run))
        run += row["count"]
    off_df = spark.createDataFrame(offsets or [(0, 0)], "_pid int, _off long")
    # Broadcast size = number of partitions (one row each), not the data size.
    joined = numbered.join(F.broadcast(off_df), "_pid")
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return joined.withColumn(out_col, F.col("_off") + local + 1).drop("_pid", "_mid", "_off")
