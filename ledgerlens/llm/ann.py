"""Approximate nearest neighbours by inner product: a forest over long hash strings.

Each tree turns a vector into a string of ``levels`` bits (the sides of random hyperplanes,
after the usual extra component that makes a largest inner product a smallest angle). Every
block of rows keeps, per tree, its strings as a sorted array. A query starts at the longest
prefixes that its own strings share with any row and ascends in all trees together, one tree
and one bit at a time, until the rows under its prefixes number ``offer`` of all rows (one
row under several trees counts each time) and one tree alone offers k rows besides the query's
own, or all rows. How many rows lie under a prefix is known from one
grouped count over all rows, at most ``trees * 2^levels`` numbers (``levels`` <= 16), which
is broadcast. In each block the prefixes are ranges of the sorted arrays, found by binary
search; the rows in them are scored exactly and the best k per task go on to a final ranking.

Every row is indexed. On rows without structure (spread evenly in 64 dimensions) no hash
keeps neighbours together well, so a recall of 0.9 needs a large ``offer``; on clustered rows
a small one will do.

Cases: vectors that are null, zero, or hold null or non-finite components take no part, nor
do rows without an id; shorter vectors count as ending in zeros; an id that occurs on several
rows asks once, with the smallest of its vectors, and is no candidate for itself; fewer than
k candidates give them all; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from . import vectors as V


def hyperplanes(dim: int, trees: int, levels: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((trees, dim + 1, levels))


def strings(planes: np.ndarray, m: np.ndarray, extra: np.ndarray) -> np.ndarray:
    """(trees, rows) of hash strings, the first hyperplane in the highest bit."""
    x = np.concatenate([m, extra[:, None]], axis=1)
    bits = 1 << np.arange(planes.shape[2])[::-1]
    return np.stack([(x @ p > 0) @ bits for p in planes]).astype(np.int64)


def ascend(counts: np.ndarray, want: float, least: np.ndarray) -> np.ndarray:
    """Prefix lengths (queries, trees), from ``counts`` (levels + 1, queries, trees): rows
    under each prefix. All trees start at the longest length and give up a bit in turn until
    the rows offered reach ``want``, and those of one tree ``least`` (per query), or all trees
    are at the root."""
    levels = counts.shape[0] - 1
    depth = np.full(counts.shape[1:], levels)
    offered, widest = counts[levels].sum(axis=1), counts[levels].max(axis=1)
    for level in range(levels - 1, -1, -1):
        for t in range(counts.shape[2]):
            up = (offered < want) | (widest < least)
            depth[up, t] = level
            offered = offered + np.where(up, counts[level, :, t] - counts[level + 1, :, t], 0)
            widest = np.where(up, np.maximum(widest, counts[level, :, t]), widest)
    return depth


def forest_search(rows: DataFrame, is_query: str, k: int = 20, trees: int = 20, offer: float = 1.25,
                  levels: int | None = None, seed: int = 7, id_col: str = "vec_id", vec_col: str = "embedding",
                  query_block: int = 1024, row_block: int = 8192) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that the SQL predicate ``is_query``
    (over the id, named ``id``) names, the nearest k of the rows that the forest offers."""
    found = V.vectors(rows, id_col, vec_col).where(F.exists("c1", lambda x: x != 0))
    spark = rows.sparkSession
    size = F.aggregate("c1", F.lit(0.0), lambda a, x: a + x * x)
    n, dim, top = found.agg(F.count(F.lit(1)), F.max(F.size("c1")), F.max(size)).first()
    dim, top = int(dim or 0), float(top or 0.0)
    levels = levels or min(16, max(1, math.ceil(math.log2(max(2, n / 64)))))
    planes = hyperplanes(dim, trees, levels, seed)

    def lifted(m: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, top - (m * m).sum(axis=1)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        under = np.zeros((trees, 1 << levels), np.int64)
        for batch in batches:
            _, m = V.matrix(batch, dim)
            for t, s in enumerate(strings(planes, m, lifted(m))):
                under[t] += np.bincount(s, minlength=1 << levels)
        t, s = np.nonzero(under)
        yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(s), pa.array(under[t, s])], names=["tree", "string", "n"])

    met = found.mapInArrow(count, "tree bigint, string bigint, n bigint").groupBy("tree", "string").agg(F.sum("n"))
    below = np.zeros((trees, (1 << levels) + 1), np.int64)
    for t, s, c in met.collect():  # at most trees * 2^levels rows
        below[t, s + 1] = c
    shared = spark.sparkContext.broadcast(np.cumsum(below, axis=1))

    def ask(ids: np.ndarray, m: np.ndarray) -> tuple:
        m, rows_of_id = np.ascontiguousarray(m[:, :dim]), m[:, dim]
        own, upto = strings(planes, m, np.zeros(len(ids))).T, shared.value
        counts = np.empty((levels + 1, len(ids), trees), np.int64)
        at = np.arange(trees)
        for d in range(levels + 1):
            low = own >> (levels - d) << (levels - d)
            counts[d] = upto[at, low + (1 << (levels - d))] - upto[at, low]
        depth = ascend(counts, offer * n, np.minimum(n, k + rows_of_id))
        low = own >> (levels - depth) << (levels - depth)
        return ids.tobytes(), m.tobytes(), np.stack([low, low + (1 << (levels - depth))]).astype(np.int64).tobytes()

    def sort(ids: np.ndarray, m: np.ndarray) -> tuple:
        s = strings(planes, m, lifted(m))
        order = np.argsort(s, axis=1, kind="stable").astype(np.int32)
        return ids.tobytes(), m.tobytes(), np.take_along_axis(s, order, 1).tobytes(), order.tobytes()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}  # a task's query blocks: k rows a query
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                qids, ids = np.frombuffer(r["qids"], np.int64), np.frombuffer(r["ids"], np.int64)
                q, m = np.frombuffer(r["qbody"]).reshape(len(qids), dim), np.frombuffer(r["body"]).reshape(len(ids), dim)
                s, order = np.frombuffer(r["sorted"], np.int64).reshape(trees, -1), np.frombuffer(r["places"], np.int32).reshape(trees, -1)
                low, high = np.frombuffer(r["ranges"], np.int64).reshape(2, len(qids), trees)
                a = np.stack([np.searchsorted(s[t], low[:, t]) for t in range(trees)], axis=1)
                b = np.stack([np.searchsorted(s[t], high[:, t]) for t in range(trees)], axis=1)
                if r["qids"] not in best:
                    best[r["qids"]] = np.zeros((len(qids), k), np.int64), np.full((len(qids), k), -np.inf)
                top_ids, top_scores = best[r["qids"]]
                for j in range(len(qids)):
                    offered = np.zeros(len(ids), bool)
                    for t in range(trees):
                        offered[order[t, a[j, t]:b[j, t]]] = True
                    offered &= ids != qids[j]
                    c = np.flatnonzero(offered)
                    if not len(c):
                        continue
                    near = m[c] @ q[j]
                    if len(c) > k:  # a little below the k-th, so that the last bits decide nothing
                        kth = np.partition(near, len(c) - k)[len(c) - k]
                        c = c[near >= kth - 1e-9 * max(1.0, abs(kth))]
                    near = (m[c] * q[j]).sum(axis=1)
                    all_ids, all_scores = np.concatenate([top_ids[j], ids[c]]), np.concatenate([top_scores[j], near])
                    first = np.lexsort([all_ids, -all_scores])[:k]
                    top_ids[j], top_scores[j] = all_ids[first], all_scores[first]
        for key, (top_ids, top_scores) in best.items():
            qids = np.repeat(np.frombuffer(key, np.int64), k)
            some = np.isfinite(top_scores.ravel())
            yield pa.RecordBatch.from_arrays([pa.array(qids[some]), pa.array(top_ids.ravel()[some]), pa.array(top_scores.ravel()[some])], names=["query_id", "vec_id", "score"])

    queries = found.where(F.expr(is_query.replace("id", "c0"))).groupBy("c0").agg(F.min("c1").alias("c1"), F.count(F.lit(1)).alias("n"))
    padded = F.expr(f"concat(c1, array_repeat(0.0D, {dim} - size(c1)), array(cast(n as double)))")
    asked = V.blocked(queries.select("c0", padded.alias("c1")), dim + 1, query_block, ask, "qids binary, qbody binary, ranges binary")
    index = V.blocked(found, dim, row_block, sort, "ids binary, body binary, sorted binary, places binary")
    near = asked.crossJoin(index).mapInArrow(search, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
