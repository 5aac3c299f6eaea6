"""Small helpers shared by the operators: inputs, stored steps, packed integer arrays, blocks.

A *block* is a run of whole input rows of one scan task, closed once it holds
``block_chars`` characters, so what a task keeps in memory is bounded by that parameter
and by the longest single text. Its id is (task partition, ordinal). Two passes over the
same plain scan cut it into the same blocks; ``plain_scan`` makes sure that the input is one.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_root

BLOCK_CHARS = 4 << 20
#: Rows of texts in a batch.
TEXT_ROWS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written below ``spark.checkpoint.dir`` and read back: lineage ends here, and a lost
    executor costs nothing that was finished."""
    return materialize(df, name)


@contextmanager
def _at_most(spark: SparkSession, rows: int, *names: str) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in names}
    for name, now in before.items():
        spark.conf.set(name, str(min(rows, int(now)) if int(now) > 0 else rows))
    try:
        yield
    finally:
        for name, now in before.items():
            spark.conf.set(name, now)


def arrow_rows(spark: SparkSession, rows: int):
    """Steps stored inside exchange at most ``rows`` rows with Python at a time (wide rows)."""
    return _at_most(spark, rows, "spark.sql.execution.arrow.maxRecordsPerBatch")


def text_rows(spark: SparkSession, rows: int = TEXT_ROWS):
    """Steps stored inside read, and exchange with Python, at most ``rows`` rows at a time: whole
    texts in Spark's own 4,096 and 10,000 rows take tens of MB in the reader, on both sides of
    the exchange and in what Python's allocator keeps for the next task."""
    return _at_most(spark, rows, "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")


def plain_scan(df: DataFrame, name: str) -> DataFrame:
    """``df`` if its plan only reads, projects and filters (the same rows in the same
    partitions on every pass); otherwise a stored copy of it."""
    scratch_root(df.sparkSession)
    plan = df._jdf.queryExecution().executedPlan().toString()
    moving = ("Exchange", "Python", "Arrow", "Pandas", "Sample", "Coalesce", "Union")
    return stored(df, name) if any(word in plan for word in moving) else df


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def importable(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it, too (it is there on a
    node that has it installed or shares the folder; else ship it with --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def picked(df: DataFrame, *columns: str) -> DataFrame:
    """Only these columns, under fixed names: other columns of the input never clash."""
    importable(df.sparkSession)
    return df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


# ---- packed integers -------------------------------------------------------------


def squeeze(data: bytes) -> bytes:
    """Compressed bytes (zstandard, which pyarrow brings along)."""
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(data, asbytes=True)


def unsqueeze(blob: bytes) -> bytes:
    size = int.from_bytes(blob[:8], "little")
    return pa.Codec("zstd").decompress(blob[8:], size, asbytes=True) if size else b""


def pack_ints(values) -> bytes:
    """Unsigned 32-bit integers as compressed byte planes (high planes are mostly zero)."""
    a = np.ascontiguousarray(values, dtype="<u4")
    return squeeze(a.view(np.uint8).reshape(-1, 4).T.tobytes())


def unpack_ints(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(unsqueeze(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def pack_words(words: list[bytes]) -> bytes:
    lengths = pack_ints([len(w) for w in words])
    return len(lengths).to_bytes(4, "little") + lengths + squeeze(b"".join(words))


def unpack_words(blob: bytes) -> list[bytes]:
    n = int.from_bytes(blob[:4], "little")
    ends = np.cumsum(unpack_ints(blob[4:4 + n]), dtype=np.int64).tolist()
    body = unsqueeze(blob[4 + n:])
    return [body[a:b] for a, b in zip([0, *ends[:-1]], ends)] if ends else []


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every run, one run after the other."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.repeat(starts.astype(np.int64) - (ends - lengths), lengths) + np.arange(total)


# ---- blocks ----------------------------------------------------------------------


def blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[int, list, list[str]]]:
    """(block id, ids, texts) over columns (id, text); a null text counts as empty."""
    base = TaskContext.get().partitionId() << 32
    ids, texts, size, n = [], [], 0, 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
            t = t.as_py() or ""
            ids.append(i)
            texts.append(t)
            size += len(t)
            if size >= limit:
                yield base + n, ids, texts
                ids, texts, size, n = [], [], 0, n + 1
    if ids:
        yield base + n, ids, texts


def batch_of(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def arrow_schema(ddl_df_schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(ddl_df_schema)
