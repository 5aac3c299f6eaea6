"""Exact substring dedup: byte windows that also start in a document with a smaller id.

The repeated windows are the equal groups of a radix sort of all suffixes that stops at
``length`` bytes and goes by the most significant digit first; a group left with one member
is finished and drops out. The first digit is chosen by content, so that neighbouring windows
share it and travel together: a window's *anchor*, the 16-byte gram of least hash in it.
Equal windows have equal anchors.

1. Anchor pass. Every block of documents sends the distinct anchors of its windows (48-bit
   fingerprints, delta-packed) to the tasks that own their buckets, with the number of distinct
   strings that it has under each. Anchors of one document only are done; the block learns
   which of its anchors come back elsewhere, and which of those are *hot*: more than
   ``hot_strings`` strings in all blocks.
2. Window passes. Runs of neighbouring windows with one repeated anchor travel as one byte
   string (run + length - 1 bytes), each distinct string of a block once, with its least
   document id. The bucket's task drops strings alone under their anchor, and orders the
   windows of the others by eight-byte digits, dropping groups of one after each pass. Equal
   groups give each window the least document id that it starts in.
   Windows under a hot anchor (a common phrase with ever other neighbours) are dealt by all
   their further digits instead: each distinct one of a block goes to the bucket of its whole
   content, so they spread over all buckets.
3. The answers go back to the blocks, where covered bytes are cut from the texts.

A passage that a third of all documents share is one string per block, not per document.
A block's rows are bounded by ``block_chars`` and the longest text; a bucket's by the number
of buckets, since no anchor brings more than ``hot_strings`` strings into one. Blocks x buckets pieces are moved, like the map x reduce pieces of any shuffle:
raise ``block_chars`` along with the input.

Cases: a null or empty text has no bytes and loses none; texts under ``length`` bytes lose
none; rows with one id never remove each other's bytes (neither id is smaller), whether they
are repeated rows or not; a null id counts as larger than all others; an empty table gives an
empty result; other columns are not read unless carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

_MUL = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_LAST = np.iinfo(np.int64).max
_TYPE = "block bigint, bucket int, kind int, a binary, b binary"
_ANCHORS, _REPEATED, _STRINGS, _ANSWERS, _TEXT = range(5)


def _pack_longs(values) -> bytes:
    a = np.ascontiguousarray(values, dtype="<u8")
    return C.squeeze(a.view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpack_longs(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(C.unsqueeze(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


def _eights(b: np.ndarray) -> np.ndarray:
    """Big-endian eight-byte words at every position (len - 7 of them)."""
    x = b.astype(np.uint64)
    for shift, step in ((8, 1), (16, 2), (32, 4)):
        x = x[:-step] << np.uint64(shift) | x[step:]
    return x


def _several(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def _parts(blob: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(blob):
        n = int.from_bytes(blob[at:at + 4], "little")
        out.append(blob[at + 4:at + 4 + n])
        at += 4 + n
    return out


def _anchors(b: np.ndarray, length: int) -> np.ndarray:
    """The least gram hash of every window (len - length + 1 of them)."""
    gram = 16 if length >= 32 else 8
    if len(b) < length:
        return np.zeros(0, np.uint64)
    x = _eights(b)
    g = x * _MUL[0]
    if gram == 16:
        g = g[:-8]
        g ^= g >> np.uint64(31)
        x *= _MUL[1]
        g += x[8:]
    del x
    g ^= g >> np.uint64(29)
    g *= _MUL[2]
    g ^= g >> np.uint64(32)
    wide, have = length - gram + 1, 1
    while have * 2 <= wide:
        g = np.minimum(g[:-have], g[have:])
        have *= 2
    if wide > have:
        g = np.minimum(g[:have - wide], g[wide - have:])
    return g


class _Runs:
    """Runs of neighbouring windows of one anchor in a block's texts, and its anchors by
    (bucket, fingerprint)."""

    def __init__(self, texts: list[bytes], length: int, buckets: int):
        sizes = np.array([len(t) for t in texts], np.int64)
        starts = np.cumsum(sizes) - sizes
        self.buffer = b"".join(texts)
        windows = np.maximum(0, sizes - length + 1)
        least = _anchors(np.frombuffer(self.buffer, np.uint8), length)
        n = len(least)
        edge = np.zeros(n + 1, np.int8)  # +1 where a document's windows begin, -1 where they end
        some = windows > 0
        edge[starts[some]] += 1
        edge[(starts + windows)[some]] -= 1
        new = np.ones(n, bool)
        new[1:] = least[1:] != least[:-1]
        new |= edge[:n] != 0
        first = np.flatnonzero(new)
        run = np.diff(first, append=n)
        inside = np.cumsum(edge[:n], dtype=np.int8)[first] > 0
        self.start, self.windows = first[inside], run[inside]
        self.doc = np.searchsorted(starts, self.start, side="right") - 1
        self.sizes, self.starts, self.length = sizes, starts, length
        finger, self.anchor = np.unique((least[self.start] * _MUL[0]) >> np.uint64(16), return_inverse=True)
        bucket = (finger % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        self.finger, self.bucket = finger[order], bucket[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.anchor = place[self.anchor]
        self.cuts = np.searchsorted(self.bucket, np.arange(buckets + 1))

    def in_two_documents(self) -> np.ndarray:
        order = np.argsort(self.anchor, kind="stable")
        first = np.searchsorted(self.anchor[order], np.arange(len(self.finger)))
        last = np.append(first[1:], len(order)) - 1
        return self.doc[order[first]] != self.doc[order[last]]

    def strings_per_anchor(self) -> np.ndarray:
        """Distinct strings under each anchor (counted where it stands four times or more)."""
        out = np.ones(len(self.finger), np.int64)
        often = np.flatnonzero(np.bincount(self.anchor, minlength=len(out))[self.anchor] >= 4)
        seen: dict[int, set[bytes]] = {}
        begin = self.start[often]
        for k, a, b in zip(self.anchor[often].tolist(), begin.tolist(), (begin + self.windows[often] + self.length - 1).tolist()):
            seen.setdefault(k, set()).add(self.buffer[a:b])
        for k, s in seen.items():
            out[k] = len(s)
        return out

    def strings(self, repeated: list[dict]) -> tuple[dict[int, list[bytes]], _Sent]:
        """Distinct strings by bucket, and the runs of repeated anchors that they come from."""
        back, hot = np.zeros(len(self.finger), bool), np.zeros(len(self.finger), bool)
        for row in repeated:
            mine = self.cuts[row["bucket"]] + np.cumsum(C.unpack_ints(row["a"]), dtype=np.int64)
            back[mine] = True
            hot[mine[C.unpack_ints(row["b"])]] = True
        known = len(self.anchor) > 0
        cold = np.flatnonzero((back & ~hot)[self.anchor]) if known else np.zeros(0, np.int64)
        start, windows, doc, bucket = self.start[cold], self.windows[cold], self.doc[cold], self.bucket[self.anchor[cold]]
        split = np.flatnonzero(hot[self.anchor]) if known else cold[:0]
        if len(split):  # window by window, by their whole content
            single = C.spread(self.start[split], self.windows[split])
            words = _eights(np.frombuffer(self.buffer, np.uint8))
            h = np.zeros(len(single), np.uint64)
            for digit in [*range(0, self.length - 8, 8), self.length - 8]:
                h = (h ^ words[single + digit]) * _MUL[0]
                h ^= h >> np.uint64(29)
            start, windows = np.concatenate([start, single]), np.concatenate([windows, np.ones(len(single), np.int64)])
            doc = np.concatenate([doc, np.repeat(self.doc[split], self.windows[split])])
            bucket = np.concatenate([bucket, (h % np.uint64(len(self.cuts) - 1)).astype(np.int64)])
        seen: dict[int, dict[bytes, int]] = {}
        place = np.empty(len(start), np.int64)
        for i, (k, a, b) in enumerate(zip(bucket.tolist(), start.tolist(), (start + windows + self.length - 1).tolist())):
            own = seen.setdefault(k, {})
            place[i] = own.setdefault(self.buffer[a:b], len(own))
        return {k: list(v) for k, v in seen.items()}, _Sent(start, windows, doc, bucket, place)


class _Sent(NamedTuple):
    """Runs of windows whose strings were sent: where they start in the block, how many windows
    and which document they are, and the bucket and place of their string."""

    start: np.ndarray
    windows: np.ndarray
    doc: np.ndarray
    bucket: np.ndarray
    place: np.ndarray


def _least_documents(strings: list[bytes], least: np.ndarray, length: int) -> list[tuple[np.ndarray, np.ndarray] | None]:
    """Per distinct string the runs (window count, least document) of its windows, or None
    where its own least document holds for all of them."""
    out: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(strings)
    sizes = np.array([len(s) for s in strings], np.int64)
    starts = np.cumsum(sizes) - sizes
    buffer = np.frombuffer(b"".join(strings), np.uint8)
    _, group, count = np.unique(_anchors(buffer, length)[starts], return_inverse=True, return_counts=True)
    shared = np.flatnonzero(count[group] > 1)
    if not len(shared):
        return out
    windows = sizes[shared] - length + 1
    at = C.spread(starts[shared], windows)
    answer = np.repeat(least[shared], windows)
    words = _eights(buffer)
    alive, gid = np.arange(len(at)), np.repeat(group[shared], windows)
    for digit in [*range(0, length - 8, 8), length - 8]:
        key = words[at[alive] + digit]
        order = np.lexsort([key, gid])
        alive, key, gid = alive[order], key[order], gid[order]
        new = np.ones(len(alive), bool)
        new[1:] = (key[1:] != key[:-1]) | (gid[1:] != gid[:-1])
        gid = np.cumsum(new) - 1
        kept = np.bincount(gid)[gid] > 1
        alive, gid = alive[kept], gid[kept]
        if not len(alive):
            return out
    first = np.flatnonzero(np.append(True, gid[1:] != gid[:-1]))
    lowest = np.minimum.reduceat(answer[alive], first)
    answer[alive] = np.repeat(lowest, np.diff(first, append=len(alive)))
    ends = np.cumsum(windows)
    for s, a, b in zip(shared.tolist(), (ends - windows).tolist(), ends.tolist()):
        part = answer[a:b]
        if (part != least[s]).any():
            cut = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            out[s] = np.diff(cut, append=b - a), part[cut]
    return out


def remove_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   carry: tuple[str, ...] = (), as_text: bool = False, block_chars: int = C.BLOCK_CHARS, buckets: int | None = None,
                   hot_strings: int = 8192) -> DataFrame:
    """(id_col, carried columns, n_bytes, n_removed, n_spans, kept binary) per row of ``docs``:
    its text's bytes without those covered by a ``length``-byte string that also starts in a
    row of smaller id. ``as_text``: ``kept`` is a string instead; what a cut leaves of a
    character goes too."""
    if length < 8:
        raise ValueError("length is at least 8 bytes")
    spark = docs.sparkSession
    n = buckets or 4 * C.partitions(spark)
    chosen = C.picked(docs, id_col, text_col, *carry)
    fields = ["c0"] + [f"c{i + 2}" for i in range(len(carry))]
    row = chosen.select(F.struct(*[F.col(f).cast("bigint").alias(f) if f == "c0" else F.col(f) for f in fields]).alias("row"), F.col("c1").cast("string"))
    row_type = row.schema["row"].dataType.simpleString()
    src = C.plain_scan(row, "dedup-input")
    full_type = f"{_TYPE}, rows array<{row_type}>"
    full = C.arrow_schema(spark.createDataFrame([], full_type).schema)
    types = [C.type_of(docs, c) for c in carry]
    out_type = ", ".join([f"`{id_col}` bigint", *[f"`{c}` {t}" for c, t in zip(carry, types)],
                          f"n_bytes bigint, n_removed bigint, n_spans bigint, kept {'string' if as_text else 'binary'}"])
    out_arrow = C.arrow_schema(spark.createDataFrame([], out_type).schema)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, texts in C.blocks(batches, block_chars):
            r = _Runs([t.encode() for t in texts], length, n)
            two, strings_ = r.in_two_documents(), r.strings_per_anchor()
            rows = []
            for k in np.flatnonzero(np.diff(r.cuts)).tolist():
                a, b = r.cuts[k], r.cuts[k + 1]
                rows.append((block, k, _ANCHORS, _pack_longs(np.diff(r.finger[a:b], prepend=np.uint64(0))),
                             _several(C.pack_ints(np.flatnonzero(two[a:b])), C.pack_ints(strings_[a:b])), None))
            yield C.batch_of(full, rows)

    def repeated(got):
        rows = got.to_pylist()
        fingers = [np.cumsum(_unpack_longs(r["a"]), dtype=np.uint64) for r in rows]
        value, count = np.unique(np.concatenate(fingers), return_counts=True)
        back, total = count > 1, np.zeros(len(value), np.int64)
        for f, r in zip(fingers, rows):
            two, strings_ = _parts(r["b"])
            back[np.searchsorted(value, f[C.unpack_ints(two)])] = True
            total[np.searchsorted(value, f)] += C.unpack_ints(strings_).astype(np.int64)
        out = []
        for f, r in zip(fingers, rows):
            at = np.searchsorted(value, f)
            mine = np.flatnonzero(back[at])
            if len(mine):
                hot = np.flatnonzero(total[at[mine]] > hot_strings)
                out.append((r["block"], r["bucket"], _REPEATED, C.pack_ints(np.diff(mine, prepend=0)), C.pack_ints(hot), None))
        return pa.Table.from_batches([C.batch_of(full, out)])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows, got in C.blocks(batches, block_chars):
            parts = [t.encode() for t in got]
            yield C.batch_of(full, [(block, -1, _TEXT, C.squeeze(b"".join(parts)), C.pack_ints([len(p) for p in parts]), rows)])

    def opened(rows: list[dict]) -> tuple[dict, _Runs, np.ndarray]:
        one = next((r for r in rows if r["kind"] == _TEXT), None)
        if one is None:
            raise RuntimeError("a block has no texts: the input changed between two passes")
        sizes, body = C.unpack_ints(one["b"]).astype(np.int64), C.unsqueeze(one["a"])
        ends = np.cumsum(sizes)
        parts = [body[e - s:e] for s, e in zip(sizes.tolist(), ends.tolist())]
        ids = np.array([_LAST if r["c0"] is None else r["c0"] for r in one["rows"]], np.int64)
        return one, _Runs(parts, length, n), ids

    def strings(got):
        rows = got.to_pylist()
        one, r, ids = opened(rows)
        found, sent = r.strings([x for x in rows if x["kind"] == _REPEATED])
        out = []
        order = np.argsort(sent.bucket, kind="stable")
        cuts = np.searchsorted(sent.bucket[order], sorted(found))
        for k, a, b in zip(sorted(found), cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
            mine = order[a:b]
            least = np.full(len(found[k]), _LAST)
            np.minimum.at(least, sent.place[mine], ids[sent.doc[mine]])
            out.append((one["block"], k, _STRINGS, C.pack_words(found[k]), _pack_longs(least), None))
        return pa.Table.from_batches([C.batch_of(full, out)])

    def answers(got):
        known: dict[bytes, int] = {}
        each, lows = [], []
        rows = got.to_pylist()
        for r in rows:
            each.append(np.array([known.setdefault(s, len(known)) for s in C.unpack_words(r["a"])], np.int64))
            lows.append(_unpack_longs(r["b"]).astype(np.int64))
        least = np.full(len(known), _LAST)
        np.minimum.at(least, np.concatenate(each), np.concatenate(lows))
        several = _least_documents(list(known), least, length)
        out = []
        for r, mine in zip(rows, each):
            runs, sizes, docs_ = [], [], []
            for s in mine.tolist():
                if several[s] is None:
                    runs.append(0)
                    docs_.append(least[s:s + 1])
                else:
                    runs.append(len(several[s][0]))
                    sizes.append(several[s][0])
                    docs_.append(several[s][1])
            head, tail = C.pack_ints(runs), C.pack_ints(np.concatenate(sizes) if sizes else [])
            out.append((r["block"], r["bucket"], _ANSWERS, len(head).to_bytes(4, "little") + head + tail, _pack_longs(np.concatenate(docs_)), None))
        return pa.Table.from_batches([C.batch_of(full, out)])

    def cut(got):
        rows = got.to_pylist()
        one, r, ids = opened(rows)
        _, sent = r.strings([x for x in rows if x["kind"] == _REPEATED])
        cover = np.zeros(len(r.buffer) + 1, np.int32)
        order = np.argsort(sent.bucket, kind="stable")
        by_bucket = {x["bucket"]: x for x in rows if x["kind"] == _ANSWERS}
        keys, first = np.unique(sent.bucket[order], return_index=True)
        for k, a, b in zip(keys.tolist(), first.tolist(), [*first[1:].tolist(), len(order)]):
            mine = order[a:b]
            x = by_bucket[k]
            size = int.from_bytes(x["a"][:4], "little")
            parts, lengths = C.unpack_ints(x["a"][4:4 + size]).astype(np.int64), C.unpack_ints(x["a"][4 + size:]).astype(np.int64)
            lows = _unpack_longs(x["b"]).astype(np.int64)
            count = np.maximum(parts, 1)
            at, at_size = np.cumsum(count) - count, np.cumsum(parts) - parts
            begin, s = sent.start[mine], sent.place[mine]
            own = ids[sent.doc[mine]]
            whole = (parts[s] == 0) & (lows[at[s]] < own)
            np.add.at(cover, begin[whole], 1)
            np.add.at(cover, (begin + sent.windows[mine])[whole] + length - 1, -1)
            for i in np.flatnonzero(parts[s] > 0).tolist():
                p = begin[i]
                j, m = s[i], parts[s[i]]
                for w, low in zip(lengths[at_size[j]:at_size[j] + m].tolist(), lows[at[j]:at[j] + m].tolist()):
                    if low < own[i]:
                        cover[p] += 1
                        cover[p + w + length - 1] -= 1
                    p += w
        gone = np.cumsum(cover[:-1], dtype=np.int32) > 0
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        inner = r.starts[(r.sizes > 0)]
        begins[inner] = gone[inner]
        total = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])[np.append(r.starts, len(flags))])
        removed, spans = total(gone), total(begins)
        kept = np.frombuffer(r.buffer, np.uint8)[~gone].tobytes()
        left = r.sizes - removed
        ends = np.cumsum(left)
        texts_ = [kept[e - k:e] for k, e in zip(left.tolist(), ends.tolist())]
        if as_text:
            texts_ = [t.decode("utf-8", "ignore") for t in texts_]
        columns = [[x[f] for x in one["rows"]] for f in fields] + [r.sizes, removed, spans, texts_]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out_arrow)], schema=out_arrow)

    with C.text_rows(spark):
        back = C.stored(src.mapInArrow(anchors, full_type).groupBy("bucket").applyInArrow(repeated, full_type), "dedup-repeated")
    text_rows = src.mapInArrow(texts, full_type)
    found = text_rows.unionByName(back).groupBy("block").applyInArrow(strings, full_type)
    lows = found.groupBy("bucket").applyInArrow(answers, full_type)
    return text_rows.unionByName(back).unionByName(lows).groupBy("block").applyInArrow(cut, out_type)


def repeat_digests(docs: DataFrame, length: int = 50) -> DataFrame:
    out = remove_repeats(docs, length)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
