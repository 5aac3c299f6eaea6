"""Periodic runs of words: maximal stretches that repeat with a smallest period, and the text
with each run collapsed to its first period.

Per text, phase one of Baier's suffix sorter groups the positions of a word sequence by their
longest Lyndon prefix: groups are taken from the highest down, and a position whose next
lower neighbours on the left end in the group grows by as many copies of the group's word.
Its result is the Lyndon array (the length of the longest Lyndon word that starts at each
position) together with the equality of those words. It runs under an order of the words and
under the reverse order; a run's Lyndon root starts a chain of equal longest Lyndon words in
one of the two. A chain's two ends are extended by longest common extensions (galloping
comparisons) to the run.

A run of at least ``times`` periods holds each of its words ``times`` times, so words that
occur less often in a stretch cannot be in one: they cut the text into shorter stretches
before the grouping, again and again until no stretch changes. That loses no run and no end
of one, and leaves little of ordinary prose. What is left takes linear time.

Each text is judged on its own, in the task that scans it; nothing is shuffled.

Cases: a null or wordless text has no words, no runs and an empty collapsed text; repeated
rows and rows without an id are judged like others; very long texts are taken whole; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common as C

_RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_YIELD_BYTES = 4 << 20


def lyndon_groups(codes: list[int], top: int) -> tuple[list[int], list[int]]:
    """(group of each position, length of each group's word): the longest Lyndon word that
    starts at a position, the end counting as smaller than all of the codes 0 .. top - 1."""
    n = len(codes)
    members: list[list[int]] = [[] for _ in range(top)]
    for i, c in enumerate(codes):
        members[c].append(i)
    group, length = list(codes), [1] * top
    above, below = [*range(1, top), -1], list(range(-1, top - 1))
    left, right = list(range(-1, n)), list(range(1, n + 2))  # positions whose group is still to come
    g = top - 1
    while g >= 0:
        hits: dict[int, int] = {}
        for i in members[g]:
            if group[i] != g:
                continue  # it has grown into a higher group
            p, q = left[i], right[i]
            left[q] = p
            if p >= 0:
                right[p] = q
                hits[p] = hits.get(p, 0) + 1
        grown: dict[tuple[int, int], list[int]] = {}
        for p, k in hits.items():
            grown.setdefault((group[p], k), []).append(p)
        for old, k in sorted(grown, reverse=True):  # of one group: more copies, higher up
            new, up = len(length), above[old]
            moved = grown[old, k]
            members.append(moved)
            length.append(length[old] + k * length[g])
            above.append(up)
            below.append(old)
            above[old] = new
            if up >= 0:
                below[up] = new
            for p in moved:
                group[p] = new
        g = below[g]
    return group, length


def _agree(buf: bytes, a: int, b: int, limit: int) -> int:
    """How many words from positions a and b on are equal, at most ``limit``."""
    got, step = 0, 8
    while got < limit:
        k = min(step, limit - got)
        if buf[4 * (a + got):4 * (a + got + k)] == buf[4 * (b + got):4 * (b + got + k)]:
            got += k
            step *= 2
        elif k == 1:
            break
        else:
            step = max(1, k // 2)
            limit = got + k
    return got


def _agree_back(buf: bytes, a: int, b: int, limit: int) -> int:
    """How many words before positions a and b are equal, at most ``limit``."""
    got, step = 0, 8
    while got < limit:
        k = min(step, limit - got)
        if buf[4 * (a - got - k):4 * (a - got)] == buf[4 * (b - got - k):4 * (b - got)]:
            got += k
            step *= 2
        elif k == 1:
            break
        else:
            step = max(1, k // 2)
            limit = got + k
    return got


def runs_of(codes: np.ndarray, least: int, times: int) -> set[tuple[int, int, int]]:
    """(start, length, period) of the runs of at least ``least`` words and ``times`` periods
    (two or more)."""
    n = len(codes)
    values, ranks = np.unique(codes, return_inverse=True)
    top = len(values)
    buf = array("I", ranks.tolist()).tobytes()
    out = set()
    for order in (ranks, top - 1 - ranks):
        got, lengths = lyndon_groups(order.tolist(), top)
        group = np.array(got)
        period = np.array(lengths)[group]
        at = np.arange(n)
        chained = at + period * max(1, times - 1) <= n
        for k in range(1, times - 1):  # a run holds times - 1 whole roots
            ahead = np.where(chained, at + k * period, 0)
            chained &= group[ahead] == group
        before = np.where(at >= period, at - period, 0)
        chained &= ~((at >= period) & (group[before] == group))
        for i in np.flatnonzero(chained).tolist():
            p = int(period[i])
            end = i + p + _agree(buf, i, i + p, n - i - p)
            start = i - _agree_back(buf, i, i + p, i)
            if end - start >= max(least, times * p):
                out.add((start, end - start, p))
    return out


def find_runs(words: list[bytes], least: int = 6, times: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of a word sequence's runs, by start and period."""
    counts = Counter(words)
    code = {w: k for k, w in enumerate((w for w, c in counts.items() if c >= times), 1)}
    if not code:
        return []
    seq = np.fromiter((code.get(w, 0) for w in words), np.int64, len(words))
    at = np.flatnonzero(seq)
    seq = seq[at]
    while len(at):
        piece = np.cumsum(np.diff(at, prepend=at[0]) != 1)
        long = np.bincount(piece)[piece] >= max(least, times)
        _, word, count = np.unique(piece * (len(code) + 1) + seq, return_inverse=True, return_counts=True)
        keep = long & (count[word] >= times)
        if keep.all():
            break
        at, seq = at[keep], seq[keep]
    found = []
    cuts = [*np.flatnonzero(np.diff(at, prepend=-2) != 1).tolist(), len(at)]
    for a, b in zip(cuts, cuts[1:]):
        first = int(at[a])
        found += [(first + s, m, p) for s, m, p in runs_of(seq[a:b], least, times)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by a space, without what any run repeats."""
    if runs:
        edge = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            edge[start + period] += 1
            edge[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, least: int = 6, times: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_words, runs, collapsed) per row of ``docs``: words are the stretches between
    ASCII white space, numbered from 0."""
    if times < 2:
        raise ValueError("a run has at least two periods")
    schema = f"`{id_col}` bigint, n_words bigint, runs {_RUNS}, collapsed string"
    arrow = C.arrow_schema(docs.sparkSession.createDataFrame([], schema).schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (t.as_py() or "").encode().split()
                runs = find_runs(words, least, times)
                text = collapse(words, runs)
                out.append((i, len(words), [dict(zip(("start", "length", "period"), r)) for r in runs], text.decode()))
                size += len(text) + 64 * len(runs) + 32
                if size >= _YIELD_BYTES:
                    yield C.batch_of(arrow, out)
                    out, size = [], 0
        yield C.batch_of(arrow, out)

    return C.picked(docs, id_col, text_col).mapInArrow(scan, schema)
