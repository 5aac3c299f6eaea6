"""Byte-level BPE encoding and decoding by a global distinct-word shuffle.

Encoding. Texts are cut into pre-tokens with positions, block by block. A block sends its
*distinct* pre-tokens, split by a hash into buckets, to the tasks that own the buckets; there
every distinct pre-token of the corpus is merged once, however many blocks hold it. The ids
travel back to the blocks, where each text is put together again by position. What is
shuffled is the vocabulary of each block and one packed code per position, never a row per
pre-token, so a word that makes up a third of the corpus weighs one entry per block.

Decoding joins the token-byte table: as many rows as the vocabulary has entries (a bound that
does not depend on the data), held by each task.

Cases: a null text is empty; an empty text has no ids and decodes to no bytes; repeated rows
and repeated ids give one result row each; an empty table gives an empty result; other
columns are not read. A text is one cell, so the longest one bounds a block's memory.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common as C

#: Unicode White_Space, which Python's \s exceeds by \x1c-\x1f.
_WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A run without white space with the one space before it, or white space. No match of the
#: pre-token pattern crosses the ends of these pieces.
_PIECES = re.compile(rf" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")


@lru_cache(maxsize=4)
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def _encoding(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=_ranks(path), special_tokens={})


@lru_cache(maxsize=4)
def _matcher(pattern: str):
    import regex

    return regex.compile(pattern.replace(r"[^\s", rf"[^{_WS}").replace(r"\s", f"[{_WS}]")
                         .replace(r"(?!\S)", rf"(?![^{_WS}])"))


class _Crossing(Exception):
    """A run of white space reaches over a split at a space."""


class _Lexicon(dict):
    """Codes of the pre-tokens, in order of their first occurrence (``codes``).

    A text splits at its spaces into parts, each keeping the space before it; as a key, a part
    stands without that space. This cuts no pre-token unless other white space touches the
    space: such a text, and the part before the first space, go by ``_PIECES``."""

    def __init__(self, pattern: str):
        super().__init__()
        self.find = _matcher(pattern).findall
        self.codes: dict[str, int] = {}
        self.pieces: dict[str, bytes] = {}

    def _code(self, word: str) -> bytes:
        return self.codes.setdefault(word, len(self.codes)).to_bytes(4, "little")

    def __missing__(self, part: str) -> bytes:
        if not part or part[0].isspace() or part[-1].isspace():
            raise _Crossing
        if part.isalpha():
            got = self._code(" " + part)
        elif part[-1] in ".,;:!?" and part[:-1].isalpha():
            got = self._code(" " + part[:-1]) + self._code(part[-1])
        else:
            got = b"".join(map(self._code, self.find(" " + part)))
        self[part] = got
        return got

    def _piece(self, piece: str) -> bytes:
        got = self.pieces.get(piece)
        if got is None:
            got = self.pieces[piece] = b"".join(map(self._code, self.find(piece)))
        return got

    def packed(self, text: str) -> bytes:
        """The text's codes, 32-bit little-endian, by position."""
        first, *parts = text.split(" ")
        if not first[-1:].isspace():
            try:
                return self._piece(first) + b"".join(map(self.__getitem__, parts))
            except _Crossing:
                pass
        return b"".join(map(self._piece, _PIECES.findall(text)))


def _buckets(words: list[bytes], n: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % n


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           block_chars: int = C.BLOCK_CHARS, buckets: int | None = None) -> DataFrame:
    """(id_col, ids array<int>) for every row of ``docs``, as the rank file's tokenizer
    encodes its text without special tokens, each match of ``pattern`` merged on its own."""
    spark = docs.sparkSession
    n = buckets or C.partitions(spark)
    id_type = C.type_of(docs, id_col)
    src = C.plain_scan(C.picked(docs, id_col, text_col), "bpe-input")
    out_schema = f"`{id_col}` {id_type}, ids array<int>"
    seq_type = f"block bigint, bucket int, docs array<{id_type}>, ranks binary, body binary"
    seq_arrow = C.arrow_schema(spark.createDataFrame([], seq_type).schema)
    out_arrow = C.arrow_schema(spark.createDataFrame([], out_schema).schema)

    def vocabularies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, texts in C.blocks(batches, block_chars):
            lex = _Lexicon(pattern)
            for t in texts:
                lex.packed(t)
            words = [w.encode() for w in lex.codes]
            of = _buckets(words, n)
            order = np.argsort(of, kind="stable")
            cuts = np.searchsorted(of[order], np.arange(n + 1))
            rows = []
            for b in range(n):
                mine = order[cuts[b]:cuts[b + 1]]
                if len(mine):
                    rows.append((block, b, None, C.pack_ints(np.diff(mine, prepend=0)),
                                 C.pack_words([words[i] for i in mine.tolist()])))
            yield C.batch_of(seq_arrow, rows)

    def merge_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merge = _encoding(ranks_path, pattern)._core_bpe.encode_single_piece
        known: dict[bytes, tuple[int, ...]] = {}  # this task's share of the distinct words
        for batch in batches:
            for row in batch.to_pylist():
                got = []
                for w in C.unpack_words(row["body"]):
                    ids = known.get(w)
                    if ids is None:
                        ids = known[w] = tuple(merge(w))
                    got.append(ids)
                counts = C.pack_ints([len(x) for x in got])
                flat = C.pack_ints([i for x in got for i in x])
                body = len(counts).to_bytes(4, "little") + counts + flat
                yield C.batch_of(seq_arrow, [(row["block"], row["bucket"], None, row["ranks"], body)])

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, texts in C.blocks(batches, block_chars):
            lex = _Lexicon(pattern)
            packed = [lex.packed(t) for t in texts]
            lengths = C.pack_ints([len(p) // 4 for p in packed])
            codes = C.pack_ints(np.frombuffer(b"".join(packed), "<u4"))
            yield C.batch_of(seq_arrow, [(block, -1, ids, lengths, codes)])

    def reassemble(got):
        rows = got.to_pylist()
        seq = next(r for r in rows if r["bucket"] < 0)
        starts, counts, flat, base = [], [], [], 0
        ranks = []
        for r in rows:
            if r["bucket"] < 0:
                continue
            k = int.from_bytes(r["body"][:4], "little")
            cnt, ids = C.unpack_ints(r["body"][4:4 + k]).astype(np.int64), C.unpack_ints(r["body"][4 + k:])
            ranks.append(np.cumsum(C.unpack_ints(r["ranks"]), dtype=np.int64))
            starts.append(base + np.cumsum(cnt) - cnt)
            counts.append(cnt)
            flat.append(ids)
            base += len(ids)
        codes, lengths = C.unpack_ints(seq["body"]), C.unpack_ints(seq["ranks"]).astype(np.int64)
        size = sum(map(len, ranks))
        if len(codes) and int(codes.max()) >= size:
            raise RuntimeError("a block's words are incomplete: the input changed between two passes")
        at, cnt = np.zeros(size, np.int64), np.zeros(size, np.int64)
        if ranks:
            at[np.concatenate(ranks)], cnt[np.concatenate(ranks)] = np.concatenate(starts), np.concatenate(counts)
        every = np.concatenate(flat) if flat else np.zeros(0, "<u4")
        each = cnt[codes]
        ids = every[C.spread(at[codes], each)].astype(np.int32)
        ends = np.concatenate([[0], np.cumsum(each)])[np.concatenate([[0], np.cumsum(lengths)])]
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
        return pa.Table.from_arrays([pa.array(seq["docs"], out_arrow.field(0).type), lists.cast(out_arrow.field(1).type)], schema=out_arrow)

    words = src.mapInArrow(vocabularies, seq_type)
    coded = words.repartition(n, "bucket").mapInArrow(merge_words, seq_type)
    both = src.mapInArrow(sequences, seq_type).unionByName(coded)
    return both.groupBy("block").applyInArrow(reassemble, out_schema)


@lru_cache(maxsize=4)
def _token_bytes(ranks_path: str) -> list[bytes]:
    ranks = _ranks(ranks_path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        table[i] = token
    return table


def _joined(lists: pa.Array, table: list[bytes], between: bytes = b"") -> Iterator[bytes | None]:
    """Each id list through the table; None for a null list."""
    for ids in lists:
        ids = ids.values
        if ids is None:
            yield None
            continue
        a = ids.to_numpy(zero_copy_only=False)
        if len(a) and (ids.null_count or a.min() < 0 or a.max() >= len(table)):
            raise ValueError("an id is not in the token-byte table")
        yield between.join(map(table.__getitem__, a.tolist()))


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of its id arrays in ``out_col`` (null for a null array).

    An id outside the vocabulary, or a null id, is an error: there are no bytes for it."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in encoded.schema.fields)}, `{out_col}` binary"
    at = encoded.columns.index(ids_col)

    def join_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = pa.array(_joined(batch.column(at), _token_bytes(ranks_path)), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, out_col])

    return encoded.mapInArrow(join_bytes, schema)


def digests(encoded: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """For every row the count of its ids, the hash of their decimal list and the hash of the
    bytes they decode to, without passing the ids or bytes on. The columns before the ids stay."""
    kept = encoded.columns[:encoded.columns.index(ids_col)]
    schema = ", ".join(f"`{c}` {C.type_of(encoded, c)}" for c in kept) + ", n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _token_bytes(ranks_path)
        decimals = [b"%d" % i for i in range(len(table))]
        for batch in batches:
            lists = batch.column(len(kept))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], lists.value_lengths().cast(pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in _joined(lists, decimals, b",")], pa.string()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in _joined(lists, table)], pa.string())],
                names=[*kept, "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.select(*kept, ids_col).mapInArrow(hashed, schema)


def bpe_round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    return digests(encode(docs, ranks_path, pattern), ranks_path)
