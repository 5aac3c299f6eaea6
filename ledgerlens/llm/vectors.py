"""Vectors as matrix blocks, and the pairing of query blocks with candidate blocks.

A query set against all rows is inherently (queries x rows) scores. It runs as pairs of
blocks, each a dense matrix of at most ``rows`` vectors, so a task holds two blocks and one
score matrix; equal or crowded vectors lie in the blocks of their rows, not in a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

BLOCK_TYPE = "ids binary, body binary"


def usable(vec: Column) -> Column:
    """Not null, and without null or non-finite components."""
    big = F.lit(float("inf"))
    return vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (x < big) & (x > -big))


def vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(c0 id, c1 array<double>) of the rows that take part: usable vectors with an id."""
    rows = C.picked(df, id_col, vec_col).select(F.col("c0").cast("bigint"), F.col("c1").cast("array<double>"))
    return rows.where(F.col("c0").isNotNull() & usable(F.col("c1")))


def matrix(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and the matrix of a batch (id, vector); shorter vectors end in zeros."""
    ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
    lists = batch.column(1)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(ids), dim))
    row = np.repeat(np.arange(len(ids)), lengths)
    out[row, C.spread(np.zeros(len(ids), np.int64), lengths)] = values
    return ids, out


def width(rows: DataFrame) -> int:
    """The longest vector's length (0 for an empty table)."""
    return int(rows.agg(F.max(F.size("c1"))).first()[0] or 0)


def blocked(rows: DataFrame, dim: int, size: int, make, schema: str) -> DataFrame:
    """One row per block: ``make(ids, matrix)`` over runs of at most ``size`` vectors."""
    arrow = C.arrow_schema(rows.sparkSession.createDataFrame([], schema).schema)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, mats, n = [], [], 0
        for batch in batches:
            for a in range(0, batch.num_rows, size):
                i, m = matrix(batch.slice(a, size), dim)
                if n + len(i) > size and n:
                    yield C.batch_of(arrow, [make(np.concatenate(ids), np.concatenate(mats))])
                    ids, mats, n = [], [], 0
                ids.append(i)
                mats.append(m)
                n += len(i)
        if n:
            yield C.batch_of(arrow, [make(np.concatenate(ids), np.concatenate(mats))])

    return rows.mapInArrow(pack, schema)


def largest(scores: np.ndarray, k: int) -> np.ndarray:
    """Column indices of each row's k largest scores (all, if fewer), in no order."""
    if scores.shape[1] <= k:
        return np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
    return np.argpartition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k:]
