"""How filters of a corpus interact: what each removes in every order, alone and in vain.

Every filter gives a sorted posting list of the ids that fail it, per part of the corpus and
per range of ids. Within a range, lists are merged by galloping (the shorter list looks its
ids up in what is left of the longer): the union of the filters applied so far, the
difference of the next filter's list and that union, and its meeting with the lists of good
and of toxic ids. Sums of the lists' sizes over the ranges give every figure of a part; the
orders of the filters are put together from the sets of filters that precede one another.

A range spans ``width`` ids whatever the parts are, so a part or source that holds a third of
all rows is dealt over all ranges. Rows that agree in part, id and verdicts are counted before
they are shuffled and stand in the lists once, with their number, so a repeated id is one entry.
Rows without an id are entries of their own range, told apart by their verdicts.

``REPEATS`` is the filter of rows whose text a smaller id has, by 128 bits of a digest: least
ids per digest are aggregated map-side; the few digests that more than a ``hot`` share of the
rows have (at most 1 / hot) are broadcast, the others are joined. Texts are read once; what is
written and shuffled of a row is its part, id, verdicts and digest.

Cases: a null part counts as the empty string; a null verdict as not failing; documents without
a label are neither good nor toxic, and several labels of an id count together; a null id has no
label, is no smaller than another and has none smaller; an empty table gives no parts; other
columns are not read.
"""

from __future__ import annotations

import math
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

WORD_GAP = r"[\x20\x09-\x0D]+"
_GOOD, _TOXIC = 0, 1


def words(text: Column) -> Column:
    """The stretches between ASCII white space."""
    return F.filter(F.split(text, WORD_GAP), lambda w: w != "")


def digest(text: Column) -> Column:
    """128 bits that name a text (null and empty are the same)."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)), 1, 16)


def with_repeats(rows: DataFrame, hot: float = 0.001) -> DataFrame:
    """Stored ``rows`` (with columns ``id`` and ``digest``) and a boolean column ``repeats``: a
    row of smaller id has the digest."""
    seen = rows.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count(F.lit(1)).alias("n"))
    seen = C.stored(seen.where("least < most"), "repeated-texts")  # a text of one id repeats nothing
    often = F.col("n") > hot * rows.count()
    heavy = F.broadcast(seen.where(often).select("digest", "least"))  # at most 1 / hot rows
    light = seen.where(~often).select("digest", "least")
    out = rows.join(heavy, "digest", "left")
    done = out.where("least is not null")
    rest = out.where("least is null").drop("least").join(light, "digest", "left")
    return done.unionByName(rest).withColumn("repeats", F.coalesce(F.col("least") < F.col("id"), F.lit(False))).drop("least")


# ---- posting lists: sorted ids with the number of rows of each ---------------------


def _found(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which entries of ``a`` are in ``b`` (both sorted): the shorter list gallops through the
    longer, each search starting where the last one ended."""
    if not len(a) or not len(b):
        return np.zeros(len(a), bool)
    if len(a) <= len(b):
        at = np.searchsorted(b, a)
        return b[np.minimum(at, len(b) - 1)] == a
    edge = np.zeros(len(a) + 1, np.int64)  # an id may stand in ``a`` several times
    np.add.at(edge, np.searchsorted(a, b), 1)
    np.add.at(edge, np.searchsorted(a, b, side="right"), -1)
    return np.cumsum(edge[:-1]) > 0


def union(lists: list[np.ndarray]) -> np.ndarray:
    """k-way union of sorted lists, the longest taking in the others, shortest first."""
    out = np.zeros(0, np.int64)
    for one in sorted(lists, key=len):
        new = one[~_found(one, out)]
        out = np.insert(out, np.searchsorted(out, new), new)
    return out


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a[~_found(a, b)]


REPEATS = "repeats"


def audit(docs: DataFrame, filters: dict[str, Column | str], part: Column, labels: DataFrame | None = None, id_col: str = "doc_id",
          text_col: str = "text", width: int = 1 << 16) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley) per part, order of the filters and step. ``filters`` says for each name which rows
    of ``docs`` fail: a boolean column, or ``REPEATS`` for rows whose text a smaller id has;
    ``labels`` has ``id_col``, ``quality`` and ``toxic``."""
    names, spark, k = list(filters), docs.sparkSession, len(filters)
    C.importable(spark)

    def bits(verdicts: list[tuple[int, Column]]) -> Column:
        return sum((F.when(F.coalesce(v, F.lit(False)), F.lit(1 << i)).otherwise(F.lit(0)) for i, v in verdicts), F.lit(0)).cast("int")

    plain = [(i, v) for i, v in enumerate(filters.values()) if not isinstance(v, str)]
    wide = [(i, F.col("repeats")) for i, v in enumerate(filters.values()) if isinstance(v, str)]
    own = [F.coalesce(part.cast("string"), F.lit("")).alias("part"), F.col(id_col).cast("bigint").alias("id"), bits(plain).alias("mask")]
    if wide:
        rows = with_repeats(C.stored(docs.select(*own, digest(F.col(text_col)).alias("digest")), "filter-verdicts"))
        rows = rows.withColumn("mask", F.col("mask") + bits(wide))
    else:
        rows = docs.select(*own)

    lone, span = F.col("id").isNull().alias("lone"), F.floor(F.col("id") / width).cast("bigint").alias("span")
    entries = rows.groupBy("part", "id", "mask").agg(F.count(F.lit(1)).alias("n"))
    entries = entries.select(lone, span, F.lit(True).alias("failing"), "part", "id", "mask", "n")
    if labels is not None:
        marked = labels.select(F.col(id_col).cast("bigint").alias("id"), bits([(_GOOD, F.col("quality") == 1), (_TOXIC, F.col("toxic") == 1)]).alias("mask"))
        marked = marked.where("id is not null and mask > 0").groupBy("id").agg(F.expr("bit_or(mask)").alias("mask"))
        entries = entries.unionByName(marked.select(lone, span, F.lit(False).alias("failing"), F.lit("").alias("part"), "id", "mask", F.lit(1).cast("bigint").alias("n")))
    sums = ("removed", "redundant", "good", "toxic", "kept")
    cell = "part string, filter int, before int, " + ", ".join(f"{c} bigint" for c in sums)
    arrow = C.arrow_schema(spark.createDataFrame([], cell).schema)

    def merge(got: pa.Table) -> pa.Table:
        failing = got.column("failing").to_numpy()
        ids = got.column("id").combine_chunks().fill_null(0).to_numpy()  # all null, or none
        masks, n = got.column("mask").to_numpy(), got.column("n").to_numpy()
        good, toxic = (np.sort(ids[~failing & (masks >> bit & 1 > 0)]) for bit in (_GOOD, _TOXIC))
        parts = got.column("part").combine_chunks().dictionary_encode()
        code, out = parts.indices.to_numpy(), []
        order = np.lexsort([masks, ids, code])
        order = order[failing[order]]
        cuts = np.flatnonzero(np.diff(code[order], prepend=-1)).tolist()
        for a, b in zip(cuts, [*cuts[1:], len(order)]):
            mine = order[a:b]
            number, name = n[mine], parts.dictionary[int(code[mine[0]])].as_py()
            # posting lists hold places in the part's order of ids, so that rows of one id keep apart
            at = np.arange(len(mine))
            lists = [at[masks[mine] >> f & 1 > 0] for f in range(k)]
            is_good, is_toxic = (at[_found(ids[mine], marks)] for marks in (good, toxic))
            size = lambda places: int(number[places].sum())
            for before in range(1 << k):
                gone = union([lists[f] for f in range(k) if before >> f & 1])
                left = int(number.sum()) - size(gone)
                for f in range(k):
                    if before >> f & 1:
                        continue
                    lost = difference(lists[f], gone)
                    out.append((name, f, before, size(lost), size(lists[f]) - size(lost), size(lost[_found(lost, is_good)]),
                                size(lost[_found(lost, is_toxic)]), left - size(lost)))
        return pa.Table.from_batches([C.batch_of(arrow, out)])

    cells = entries.groupBy("lone", "span").applyInArrow(merge, cell)
    cells = C.stored(cells.groupBy("part", "filter", "before").agg(*[F.sum(c).alias(c) for c in sums]), "filter-cells")

    steps, alone = [], []
    for line in permutations(range(k)):
        gone = 0
        for step, f in enumerate(line, 1):
            steps.append(("".join(names[x] for x in line), step, f, gone))
            gone |= 1 << f
    for f in range(k):
        for before in range(1 << k):
            if not before >> f & 1:
                m = before.bit_count()  # so many filters stand before f in m! (k - 1 - m)! orders
                alone.append((f, before, math.factorial(m) * math.factorial(k - 1 - m), m == k - 1))
    orders = F.broadcast(spark.createDataFrame(steps, "filter_order string, step int, filter int, before int"))  # k * k! rows
    ways = F.broadcast(spark.createDataFrame(alone, "filter int, before int, ways bigint, last boolean"))  # k * 2^(k-1) rows
    own = cells.join(ways, ["filter", "before"]).groupBy("part", "filter").agg(
        F.sum(F.when(F.col("last"), F.col("removed")).otherwise(0)).alias("unique_fails"), F.sum(F.col("removed") * F.col("ways")).alias("shapley"))
    return cells.join(own, ["part", "filter"]).join(orders, ["filter", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley")
