"""Best-fit packing of token pieces into sequences, in bulk-synchronous supersteps.

Pieces of one length are interchangeable, and so are sequences with one gap. The state of
best fit is therefore the range-sorted list of gaps, each with the runs of sequence numbers
that have it: at most ``capacity`` entries, whatever the corpus. A superstep takes the pieces
of the next smaller length, all at once; a sweep walks the successors of that length among
the gaps (the smallest gap that fits comes first), resolves who goes where by rank (pieces
in rank order meet sequences in number order), updates the gaps, and repeats. The result is
that of best fit decreasing over all pieces.

Spark does what grows with the corpus: tokens, the histogram of lengths, the rank of each
piece within its length (a range sort with partition offsets, so that a length that a third
of the pieces share is spread over many tasks), and the assignment of ranks to sequences.
The sweep itself sees only the histogram of at most ``capacity`` numbers.

Cases: a null text is empty; an empty text is the end token alone; repeated rows and ids are
packed like any others; an empty table gives no pieces; long texts are cut every ``capacity``
tokens and each cut piece is full; other columns are not read.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.positions import with_row_number
from . import common as C

#: Texts of these characters alone take the quick way: their lower case, normal form and
#: pre-tokens are the plain ones. All others go through the tokenizer word by word.
_LETTERS = "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
_PLAIN = "".join(map(chr, range(32, 127))) + "\t\n\r" + _LETTERS
_LOW = "a-zß-öø-ÿ"
#: The vocabulary file's own split, over plain lower-case text.
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LOW}]+|[0-9]|[^\s{_LOW}0-9]+")
_KEEP = 400_000


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return tok


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write a byte that has no visible Latin-1 character as the next
    one from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(seen)]
    return {b: chr(b) for b in seen} | {b: chr(256 + n) for n, b in enumerate(rest)}


class _Words(dict):
    """word -> its ids as packed 32-bit integers. Words in normal form that the split leaves
    whole (``whole``) go to the merges directly."""

    def __init__(self, path: str, whole: bool):
        super().__init__()
        self.tok, self.whole, self.letters = _tokenizer(path), whole, _byte_letters()
        self.merges = self.tok.model

    def __missing__(self, word: str) -> bytes:
        if len(self) > _KEEP:
            self.clear()
        if self.whole:
            ids = [t.id for t in self.merges.tokenize(word.encode().decode("latin-1").translate(self.letters))]
        else:
            ids = self.tok.encode(word, add_special_tokens=False).ids
        got = self[word] = array("I", ids).tobytes()
        return got


@lru_cache(maxsize=4)
def _words(path: str, whole: bool) -> _Words:
    return _Words(path, whole)


def token_ids(text: str | None, path: str) -> bytes:
    """The ids of a text, little-endian unsigned 32-bit. White space never joins tokens, so
    each word is looked up on its own."""
    text = text or ""
    try:
        plain = not text.encode("latin-1").translate(None, _PLAIN.encode("latin-1"))
    except UnicodeEncodeError:
        plain = False
    if plain:
        return b"".join(map(_words(path, True).__getitem__, _SPLIT.findall(text.lower())))
    return b"".join(map(_words(path, False).__getitem__, text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")))


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int,
                     id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32[, ids]): each text's ids and ``end_id``, cut
    every ``capacity`` ids."""
    spark = docs.sparkSession
    ddl = f"`{id_col}` {C.type_of(docs, id_col)}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    schema = C.arrow_schema(spark.createDataFrame([], ddl).schema)
    step = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = int(end_id).to_bytes(4, "little")
        try:
            for batch in batches:
                rows = []
                for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids = token_ids(t.as_py(), tokenizer_path) + end
                    for k, a in enumerate(range(0, len(ids), step)):
                        part = ids[a:a + step]
                        rows.append((i, k, a // 4, len(part) // 4, zlib.crc32(part))
                                    + ((np.frombuffer(part, "<u4").astype(np.int32),) if with_ids else ()))
                yield C.batch_of(schema, rows)
        finally:
            _words.cache_clear()  # Spark keeps the worker for other steps

    return C.picked(docs, id_col, text_col).mapInArrow(cut, ddl)


def sweep(histogram: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Supersteps over the lengths, longest first.

    Rows (length, first rank, last rank + 1, first sequence, pieces a sequence, offset there):
    rank r of the run goes to sequence first + (r - first rank) // pieces, at offset +
    length * ((r - first rank) % pieces). Ranks count from 0. Also the number of sequences."""
    gaps: list[int] = []  # sorted gap sizes in use
    runs: dict[int, list[tuple[int, int]]] = {}  # gap -> [(first sequence, how many)]
    out: list[tuple[int, ...]] = []
    used = 0

    def give(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in runs:
                bisect.insort(gaps, gap)
                runs[gap] = []
            runs[gap].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        at = bisect.bisect_left(gaps, length)
        freed: list[tuple[int, int, int]] = []
        while left and at < len(gaps):  # the successors of this length, smallest gap first
            gap = gaps[at]
            each = gap // length
            rest = []
            for first, n in runs[gap]:
                full = min(n, left // each)
                if full:
                    out.append((length, rank, rank + full * each, first, each, capacity - gap))
                    freed.append((gap - each * length, first, full))
                    rank, left, first, n = rank + full * each, left - full * each, first + full, n - full
                if n and left and left < each:
                    out.append((length, rank, rank + left, first, each, capacity - gap))
                    freed.append((gap - left * length, first, 1))
                    rank, left, first, n = rank + left, 0, first + 1, n - 1
                if n:
                    rest.append((first, n))
            if rest:
                runs[gap] = rest
                at += 1
            else:
                del runs[gap], gaps[at]
        each = capacity // length
        if left:  # no gap fits any more: new sequences
            full, part = divmod(left, each)
            out.append((length, rank, rank + left, used, each, 0))
            freed += [(capacity - each * length, used, full), (capacity - part * length, used + full, 1 if part else 0)]
            used += full + (1 if part else 0)
        for gap, first, n in freed:
            give(gap, first, n)
    return np.array(out, np.int64).reshape(-1, 6), used


def place(pieces: DataFrame, capacity: int, order: list[str], max_broadcast_runs: int = 2_000_000) -> DataFrame:
    """``pieces`` (with a ``length`` of 1..capacity) with ``sequence_id`` and ``offset``.

    The sweep's runs number a small multiple of the distinct lengths; up to
    ``max_broadcast_runs`` (48 bytes each) they are broadcast, beyond it they are joined by
    length and rank range."""
    spark: SparkSession = pieces.sparkSession
    ranked = with_row_number(pieces, "_n", order_by=["length", *order])
    counts = {int(r[0]): int(r[1]) for r in pieces.groupBy("length").count().collect()}  # <= capacity rows
    plan, _ = sweep(counts, capacity)
    before, below = {}, 0
    for length in sorted(counts):
        before[length] = below
        below += counts[length]
    if len(plan) > max_broadcast_runs:
        return _place_by_join(spark, ranked, plan, before)
    key = np.array([before[int(x)] for x in plan[:, 0]], np.int64) + plan[:, 1] if len(plan) else np.zeros(0, np.int64)
    by_start = np.argsort(key, kind="stable")
    shared = spark.sparkContext.broadcast((key[by_start], plan[by_start]))
    names = [f.name for f in pieces.schema.fields]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields) + ", sequence_id bigint, offset bigint"

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, rows = shared.value
        for batch in batches:
            n = batch.column(len(names)).to_numpy(zero_copy_only=False).astype(np.int64) - 1
            k = np.searchsorted(start, n, side="right") - 1
            run, within = rows[k], n - start[k]
            sequence, slot = run[:, 3] + within // run[:, 4], within % run[:, 4]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(names)], pa.array(sequence), pa.array(run[:, 5] + slot * run[:, 0])],
                names=[*names, "sequence_id", "offset"])

    return ranked.select(*[f"`{n}`" for n in names], "_n").mapInArrow(assign, ddl)


def _place_by_join(spark: SparkSession, ranked: DataFrame, plan: np.ndarray, before: dict[int, int]) -> DataFrame:
    """The same assignment with the runs as a table: runs and pieces meet by length and by
    slices of the rank."""
    slice_of = 4096
    first = spark.createDataFrame([(k, v) for k, v in before.items()], "length bigint, _before bigint")
    runs = spark.createDataFrame([tuple(map(int, r)) for r in plan], "length bigint, _a bigint, _b bigint, _first bigint, _each bigint, _at bigint")
    runs = runs.withColumn("_slice", F.explode(F.expr(f"sequence(_a div {slice_of}, (_b - 1) div {slice_of})")))
    numbered = ranked.join(F.broadcast(first), "length").withColumn("_r", F.col("_n") - 1 - F.col("_before"))  # <= capacity rows
    met = numbered.withColumn("_slice", F.expr(f"_r div {slice_of}")).join(runs, ["length", "_slice"])
    met = met.where("_r >= _a and _r < _b")
    kept = [c for c in ranked.columns if c != "_n"]
    return met.select(*kept, F.expr("_first + (_r - _a) div _each").alias("sequence_id"),
                      F.expr("_at + length * pmod(_r - _a, _each)").alias("offset"))


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 4096,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Every piece of ``docs`` with its place: sequence number and offset in it."""
    with C.text_rows(docs.sparkSession):
        pieces = C.stored(tokenized_pieces(docs, tokenizer_path, end_id, capacity, id_col, text_col, with_ids), "pieces")
    return place(pieces, capacity, [id_col, "piece", "ids_crc32"])


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed pieces (with ids) joined in order of their offsets. A
    group holds at most ``capacity`` ids."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return parts.select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"))
