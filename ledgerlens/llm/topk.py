"""Exact top-k by distributed histogram selection.

Every query is scored against every row. A round counts each query's scores by bins of the
range that still holds its k-th value, sums the counts over all tasks, and keeps the one bin
that the k-th value lies in; the width of the range shrinks by ``bins`` a round, until a bin
is one score. Then one more pass keeps the rows at or above that score, and ties at it go to
the smaller ids. A task reports only its own highest k scores' bins: a bin below k scores of
one task cannot hold the k-th of all.

The state of a query (lowest score of its bin, places left) is a table; nothing of it passes
the driver. Scores are recomputed in each round, not stored: rows x queries of them would
dwarf the input.

Cases: vectors that are null or hold null or non-finite components take no part, nor do
vectors without an id; all others do, whatever the size of their components (scores are exact
integers; one beyond 64 bits, or a scaled component beyond a double, raises as it does in SQL);
shorter vectors count as ending in zeros; an id that occurs on several rows asks once, with the smallest of its vectors, and
is no candidate for itself, while for others each of its rows is a candidate; fewer than k
candidates give them all; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from . import vectors as V

_LONG = 1 << 63


def _products(q: np.ndarray, c: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Exact integer products, whatever their size; those not ``wanted`` may be anything."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if bound < 2 ** 53:
        return np.rint(q @ c.T).astype(np.int64)
    if bound < 2 ** 62:
        return q.astype(np.int64) @ c.astype(np.int64).T
    whole = np.frompyfunc(int, 1, 1)
    exact = whole(q).astype(object) @ whole(c).astype(object).T
    exact = np.where(wanted, exact, 0)
    if exact.size and (exact.max() >= _LONG or exact.min() < -_LONG):
        raise OverflowError("a score does not fit 64 bits")
    return exact.astype(np.int64)


def _above(s: np.ndarray, low: np.ndarray) -> np.ndarray:
    """How far scores lie above ``low`` (modulo 2^64), unsigned: the two may span all longs."""
    return s.view(np.uint64) - low.view(np.uint64)


def exact_top_k(rows: DataFrame, is_query: str, k: int = 10, scale: int = 1024, id_col: str = "vec_id",
                vec_col: str = "embedding", bins: int = 4096, query_block: int = 1024,
                row_block: int = 8192) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that the SQL predicate ``is_query``
    (over the id, named ``id``) names, the k other rows of highest integer inner product."""
    found = V.vectors(rows, id_col, vec_col)
    # floor() makes a long; doubles from 2^53 on are whole as they are
    ints = found.select("c0", F.transform("c1", lambda x: F.when(F.abs(x * scale) < 2.0 ** 53, F.floor(x * scale).cast("double")).otherwise(x * scale)).alias("c1"))
    dim = V.width(ints)
    norm = F.aggregate("c1", F.lit(0.0), lambda a, x: a + x * x)
    top = ints.agg(F.max(norm)).first()[0] or 0.0
    if top == float("inf"):
        raise OverflowError("a scaled vector does not fit a double")
    reach = min(int(top * 1.000001) + 1, _LONG - 1)  # |product| <= product of the two norms

    queries = ints.where(F.expr(is_query.replace("id", "c0"))).groupBy("c0").agg(F.min("c1").alias("c1"))
    queries = C.stored(queries, "topk-queries")
    spark = rows.sparkSession

    def to_rows(ids: np.ndarray, m: np.ndarray) -> tuple:
        return ids.tobytes(), m.tobytes()

    candidates = V.blocked(ints, dim, row_block, to_rows, "ids binary, body binary")

    def query_rows(ids: np.ndarray, m: np.ndarray) -> tuple:
        return ids.tobytes(), m[:, :dim].tobytes(), m[:, dim:].astype(np.int64).tobytes()

    def pairs(state: DataFrame) -> DataFrame:
        # lowest score and places left travel as two more components, in exact halves
        tail = F.array(F.shiftright("low", 31).cast("double"), F.col("low").bitwiseAND((1 << 31) - 1).cast("double"), F.col("need").cast("double"))
        padded = F.expr(f"concat(c1, array_repeat(0.0D, {dim} - size(c1)))")
        joined = queries.join(state, "c0").select("c0", F.concat(padded, tail).alias("c1"))
        blocks = V.blocked(joined, dim + 3, query_block, query_rows, "qids binary, qbody binary, qstate binary")
        return blocks.crossJoin(candidates)

    def unpack(row: dict) -> tuple:
        qids, cids = np.frombuffer(row["qids"], np.int64), np.frombuffer(row["ids"], np.int64)
        state = np.frombuffer(row["qstate"], np.int64).reshape(-1, 3)
        other = qids[:, None] != cids[None, :]
        s = _products(np.frombuffer(row["qbody"]).reshape(len(qids), dim), np.frombuffer(row["body"]).reshape(len(cids), dim), other)
        return qids, cids, (state[:, 0] << 31) + state[:, 1], state[:, 2], s, other

    least = np.iinfo(np.int64).min

    def histogram(span: int, step: int):
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    qids, _, low, need, s, other = unpack(batch.slice(i, 1).to_pylist()[0])
                    inside = other & (s >= low[:, None]) & (_above(s, low[:, None]) < np.uint64(span))
                    s = np.where(inside, s, least)
                    best = np.take_along_axis(s, V.largest(s, k), 1)
                    q = np.repeat(np.arange(len(qids)), best.shape[1])
                    best = best.ravel()
                    q, best = q[best != least], best[best != least]
                    at, n = np.unique(np.stack([q, (_above(best, low[q]) // np.uint64(step)).astype(np.int64)]), axis=1, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(qids[at[0]]), pa.array(at[1]), pa.array(n.astype(np.int64))], names=["c0", "bin", "n"])

        return count

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                qids, cids, low, need, s, other = unpack(batch.slice(i, 1).to_pylist()[0])
                above, tied = other & (s > low[:, None]), other & (s == low[:, None])
                q, c = np.nonzero(above)
                tq, tc = np.nonzero(tied)
                order = np.lexsort([cids[tc], tq])
                tq, tc = tq[order], tc[order]
                place = np.arange(len(tq)) - np.searchsorted(tq, tq)
                keep = place < need[tq]
                q, c = np.concatenate([q, tq[keep]]), np.concatenate([c, tc[keep]])
                yield pa.RecordBatch.from_arrays([pa.array(qids[q]), pa.array(cids[c]), pa.array(s[q, c])], names=["query_id", "vec_id", "score"])

    state = queries.select("c0", F.lit(-reach).alias("low"), F.lit(k).cast("bigint").alias("need"))
    span = 2 * reach + 1
    down = Window.partitionBy("c0").orderBy(F.desc("bin"))
    while span > 1:
        step = -(-span // bins)
        counts = pairs(state).mapInArrow(histogram(span, step), "c0 bigint, bin bigint, n bigint")
        counts = counts.groupBy("c0", "bin").agg(F.sum("n").alias("n"))
        run = counts.select("c0", "bin", "n", F.sum("n").over(down).alias("upto"))
        hit = run.join(state, "c0").where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
        wide = "decimal(38,0)"  # bin * step may pass a long where the sum does not
        hit = hit.select("c0", (F.col("low").cast(wide) + F.col("bin").cast(wide) * F.lit(step).cast(wide)).cast("bigint").alias("low"),
                         (F.col("need") - F.col("upto") + F.col("n")).alias("need"))
        # a query with fewer than k candidates keeps its lowest bound: all of them are taken
        rest = state.join(hit.select("c0"), "c0", "left_anti")
        state = C.stored(hit.unionByName(rest), "topk-state")
        span = step
    chosen = pairs(state).mapInArrow(select, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = chosen.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
