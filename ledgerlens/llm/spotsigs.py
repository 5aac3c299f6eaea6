"""SpotSigs fingerprints: chains of content words that follow common-word anchors.

Words are lower-cased (A-Z) and cut at ASCII white space and punctuation. A word is *common* if
at least a ``share`` of all documents holds it; document counts are taken over the whole table,
and at most (mean distinct words a document) / share words pass, which the tasks then carry as
64-bit hashes. Each common word is a spot; so is, where none of the ``drought`` words before it
is common, a word whose length in bytes is a multiple of four (texts in a language that few
documents share still get spots). A spot's signature is its word with the next ``chain`` words
that are not common, cut short by the end of the text. A text with words but no signature has
its whole word sequence as one; a text without words has none.

A fingerprint is the set of a text's signatures, each as 32 bits of its digest, in ascending
order as hexadecimal digits: equal texts have equal fingerprints. Two fingerprints are alike by
the Jaccard measure, pruned: sets are partitioned by their length, at powers of 1 / least, so
that sets two partitions apart are less than ``least`` alike and are not compared; within
reach, the bound of the two lengths comes first; what is under ``least`` counts as 0.

``compare_with_edits`` sets each document beside an edited copy and beside the next document.
Documents are put in order by ranges of ids, one shuffle of the texts; in a range's task, rows
pass one by one in ascending order, and only the texts of the present and the previous id are
held. Range bounds come from a quantile sketch. What a range's first rows need from lower
ranges travels as a *guest* row: at most two ids a range, one text each. An id that holds many
rows spans several bounds, and its rows are dealt over their ranges.

Cases: a null text counts as empty; two empty fingerprints are alike (1), an empty and another
are not (0). Documents are ordered by distinct ids: the next document of every row of an id is
that of the next smaller id, with the least of its texts if they differ; a single id is its own
next. A row without an id has no place in the order: nothing replaces the end of its text, and
``near_next`` is null. Very long texts are taken whole; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import math
import string
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

_WORDS = bytes.maketrans((string.ascii_uppercase + string.punctuation).encode(), (string.ascii_lowercase + " " * len(string.punctuation)).encode())
_FLUSH = 1 << 17
_YIELD_CHARS = 4 << 20


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_WORDS).split()


def common_words(docs: DataFrame, share: float = 0.02, id_col: str = "doc_id", text_col: str = "text") -> set[int]:
    """64-bit hashes of the words that at least a ``share`` of the rows hold."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        rows = 0

        def flush() -> pa.RecordBatch:
            names = np.fromiter(map(xxhash.xxh3_64_intdigest, held), np.uint64, len(held)).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(names), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for t in batch.column(0):
                rows += 1
                held.update(set(words_of(t.as_py() or "")))
                if len(held) > _FLUSH:
                    yield flush()
                    held.clear()
        yield flush()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([rows], pa.int64())], names=["word", "n"])

    counted = C.picked(docs, text_col).mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counted = C.stored(counted, "document-counts")
    total = counted.where("word is null").agg(F.sum("n")).first()[0] or 0
    often = counted.where(F.col("word").isNotNull() & (F.col("n") >= share * total))
    return {r[0] & (2 ** 64 - 1) for r in often.select("word").collect()}  # at most (mean distinct words) / share


class Spots:
    """Signature sets of texts, given the common words."""

    def __init__(self, common: set[int], chain: int = 2, drought: int = 16):
        self.common, self.chain, self.drought = common, chain, drought
        self.seen: dict[bytes, bool] = {}
        self.known: dict[bytes, bytes] = {}

    def signatures(self, text: str) -> set[bytes]:
        words = words_of(text)
        flags = list(map(self.seen.get, words))
        if None in flags:
            if len(self.seen) > _FLUSH:
                self.seen.clear()
            for w in set(words).difference(self.seen):
                self.seen[w] = xxhash.xxh3_64_intdigest(w) in self.common
            flags = list(map(self.seen.get, words))
        stand_in = self._stand_ins(words, flags)
        chains, tail, link = set(), (), b""
        for i in range(len(words) - 1, -1, -1):
            if flags[i]:
                if link:
                    chains.add(words[i] + link)
            else:
                if link and i in stand_in:
                    chains.add(words[i] + link)
                tail = (words[i], *tail[:self.chain - 1])
                link = b" " + b" ".join(tail)
        if words and not chains:
            chains.add(b" ".join(words))
        if len(self.known) > _FLUSH:
            self.known.clear()
        for c in chains.difference(self.known):  # an edited text shares most chains with its original
            self.known[c] = md5(c).digest()[:4]
        return set(map(self.known.__getitem__, chains))

    def _stand_ins(self, words: list[bytes], flags: list[bool]) -> set[int]:
        out, last = set(), -1
        for e in [*(i for i, common in enumerate(flags) if common), len(words)]:
            if e - last > self.drought:
                out.update(i for i in range(last + 1 + self.drought, e) if len(words[i]) % 4 == 0)
            last = e
        return out


def fingerprint(signatures: set[bytes]) -> str:
    return b"".join(sorted(signatures)).hex()


def likeness(a: set[bytes], b: set[bytes], least: float = 0.05) -> float:
    """Jaccard measure, 0 where it is under ``least``."""
    if not a or not b:
        return float(len(a) == len(b))
    part = lambda s: math.floor(math.log(len(s), 1 / least))
    if abs(part(a) - part(b)) > 1:
        return 0.0
    few, many = (a, b) if len(a) <= len(b) else (b, a)
    if len(few) < least * len(many):
        return 0.0
    both = len(few & many)
    got = both / (len(a) + len(b) - both)
    return got if got >= least else 0.0


def fingerprints(docs: DataFrame, common: set[int], chain: int = 2, drought: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_signatures, fingerprint) per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spots = Spots(shared.value, chain, drought)
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                sets = [spots.signatures(t.as_py() or "") for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(map(len, sets), pa.int64()), pa.array(map(fingerprint, sets), pa.string())],
                                                 names=[id_col, "n_signatures", "fingerprint"])

    return C.picked(docs, id_col, text_col).mapInArrow(scan, f"`{id_col}` bigint, n_signatures bigint, fingerprint string")


def _bounds(ids: DataFrame, parts: int) -> list[int]:
    """Ids that cut the table into ranges of about equal numbers of rows; an id with many rows
    may stand several times."""
    if parts < 2:
        return []
    at = [k / parts for k in range(1, parts)]
    return list(ids.agg(F.percentile_approx("c0", at, 100 * parts)).first()[0] or [])


def _predecessors(ids: DataFrame, cuts: list[int]) -> tuple[list[int | None], int | None]:
    """The greatest id below each of the sorted distinct ``cuts``, and the greatest of all."""
    def most(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, int] = {}
        for batch in batches:
            for i in pc.unique(batch.column(0)).to_pylist():
                k = bisect_left(cuts, i)
                if k < len(cuts) and cuts[k] == i:
                    best.setdefault(~k, i)  # the cut itself
                elif best.get(k, i) <= i:
                    best[k] = i
        yield pa.RecordBatch.from_arrays([pa.array(best.keys(), pa.int64()), pa.array(best.values(), pa.int64())], names=["k", "id"])

    found = {r[0]: r[1] for r in ids.mapInArrow(most, "k bigint, id bigint").groupBy("k").agg(F.max("id")).collect()}  # at most two a cut
    below, got = [], None
    for k, cut in enumerate(cuts):
        got = found.get(k, got)
        below.append(got)
        got = cut if ~k in found else got
    return below, found.get(len(cuts), got)


def compare_with_edits(docs: DataFrame, share: float = 0.02, chain: int = 2, drought: int = 16, least: float = 0.05, id_col: str = "doc_id",
                       text_col: str = "text", parts: int | None = None) -> DataFrame:
    """(id_col, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next) per row:
    the edited text has its last third replaced by as much of the start of the next document,
    in descending order of ids."""
    spark = docs.sparkSession
    parts = parts or C.partitions(spark)
    common = spark.sparkContext.broadcast(common_words(docs, share, id_col, text_col))
    picked = C.picked(docs, id_col, text_col).select(F.col("c0").cast("bigint").alias("c0"), F.coalesce(F.col("c1").cast("string"), F.lit("")).alias("c1"))
    ids = picked.select("c0").where("c0 is not null")
    bounds = _bounds(ids, parts)
    cuts = sorted(set(bounds))
    below, top = _predecessors(ids, cuts)

    # guests: range k (ids from bounds[k - 1] on) may need that bound's document or the one before
    wanted = []
    for k in range(parts):
        if k == 0 or not bounds:
            wanted.append((k, top, True))  # after the last comes the first
            continue
        low = bounds[k - 1]
        before = below[bisect_left(cuts, low)]
        wanted += [(k, low, False), (k, top if before is None else before, before is None)]
    wanted = [w for w in wanted if w[1] is not None]
    spread = F.broadcast(spark.createDataFrame(wanted, "part int, c0 bigint, wraps boolean"))  # at most two rows a range
    asked = sorted({w[1] for w in wanted})
    guests = picked.where(F.col("c0").isin(asked)).groupBy("c0").agg(F.min("c1").alias("c1")).join(spread, "c0")
    guests = guests.select("part", F.when(~F.col("wraps"), F.col("c0")).alias("at"), F.lit(False).alias("own"), "c1")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = []
            for n, i in enumerate(batch.column(0).to_pylist()):
                low, high = (0, parts - 1) if i is None else (bisect_left(bounds, i), bisect_right(bounds, i))
                # an id on several bounds may lie in any range between them
                place.append(low if low == high else low + xxhash.xxh3_64_intdigest(batch.column(1)[n].as_buffer() or b"", n) % (high - low + 1))
            yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), batch.column(0), pa.array(np.ones(len(place), bool)), batch.column(1)],
                                             names=["part", "at", "own", "c1"])

    rows = picked.mapInArrow(deal, "part int, at bigint, own boolean, c1 string").unionByName(guests)
    rows = rows.repartitionById(parts, "part").sortWithinPartitions("part", F.col("at").asc_nulls_first(), "own", "c1")
    schema = f"`{id_col}` bigint, n_chars bigint, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    arrow = C.arrow_schema(spark.createDataFrame([], schema).schema)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spots = Spots(common.value, chain, drought)
        nobody: tuple = (None, "", set())
        present = previous = nobody  # (range, id), its least text and that text's signatures
        out, size = [], 0
        for batch in batches:
            for part, at, own, t in zip(*(batch.column(c) for c in range(4))):
                part, at, own, text = part.as_py(), at.as_py(), own.as_py(), t.as_py()
                signs = spots.signatures(text)
                lone = own and at is None
                if not lone and present[0] != (part, at):
                    previous = present if present[0] is not None and present[0][0] == part else nobody
                    present = ((part, at), text, signs)
                if not own:
                    continue
                n = len(text)
                edited = text[:n - n // 3] + ("" if lone else previous[1][:n // 3])
                changed = spots.signatures(edited)
                out.append((at, n, edited, fingerprint(signs), fingerprint(changed), likeness(signs, changed, least),
                            None if lone else likeness(signs, previous[2], least)))
                size += n + 8 * (len(signs) + len(changed))
                if size >= _YIELD_CHARS:
                    yield C.batch_of(arrow, out)
                    out, size = [], 0
        yield C.batch_of(arrow, out)

    return rows.mapInArrow(walk, schema)
