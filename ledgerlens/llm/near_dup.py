"""Near-duplicate documents by SetSketch registers on word shingles.

A document's sketch has ``registers`` values floor(1 - log_b(min h_i(x))), truncated to 16
bits, with h_i exponential over its shingles: mergeable by maximum, and two sketches agree in
a register about as often as their sets' similarity. Registers in bands of ``rows`` values
make bucket keys; documents that share a bucket are candidates. A candidate's similarity is
estimated from how many registers are above, below and equal, jointly with the two known set
sizes, by maximum likelihood; whatever lies within ``slack`` of the threshold is confirmed on
the full sets.

Equal sets are one node from the start. Links are then found in rounds, none of which lists
the pairs of a group:

1. every member of a bucket is compared with the bucket's least member only; its likeliest
   such link is confirmed, and all whose estimate reaches the threshold;
2. buckets of more than ``tile`` members that still hold several components are compared with
   other members as hubs, drawn anew each round, and the likeliest link of every two
   components is confirmed, until no link is found. A round makes one row per member; a dense
   group is one component after a few;
3. what is still mixed is compared in full: buckets of up to ``tile`` members each in one
   task; of larger ones, members are packed into blocks of about ``tile`` (those of the largest
   component apart from the others), and block meets block unless both are of that component.
   A block is one row, so a bucket of k members makes about (k / tile)^2 rows at worst, and
   k / tile if few members stand apart. Members carry their short sets (up to 512 shingles)
   along, so that only pairs that reach the threshold are offered. First every two components offer their likeliest link;
   then what is still apart offers all its likely links that no earlier round refused.

Full sets are read for the pairs to confirm only, from the documents that the pairs name. Texts,
sketches and sets move in Arrow batches of bounded rows.

A pair is looked at in one bucket only, that of its first agreeing band. At 0.75, 48 bands of
4 miss a pair with probability 1e-8. The likelihood over 192 registers deviates by 0.03, so a
slack of 0.15 is five deviations; in the tiles 512 more registers (their low bytes, compared
for equality) bring that to 0.016, and five of those to 0.08.

Cases: a null or wordless text has an empty set, is its own component and kept; a row without
an id links with nothing, has no component and is kept; repeated rows share a component, and
each is kept if its id is the component's; rows of one id with different texts are judged by
their texts; very long texts are taken whole; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .components import components

_BASE, _RATE, _TOP = 1.001, 20.0, 65535
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)
#: The bitmap over ids that tells which documents' full sets are needed: 4 MB.
_BITS = 1 << 25
_FINE = 512
#: Sets up to this size are compared in full inside blocks. Rounds with drawn hubs at most; pairs of full sets in an Arrow batch; bytes that a scan holds back.
_EXACT, _ROUNDS, _BATCH, _HELD = 512, 2, 256, 4 << 20


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles of ``size`` words (A-Z lowered,
    split at ASCII white space); fewer words make one shingle, none an empty set."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(h) < size:
        return _finish(np.array([xxhash.xxh3_64_intdigest(h.tobytes(), len(h))], np.uint64))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        out = _finish(out + h[i:len(h) - size + 1 + i] * _MIX[i % 5])
    return np.unique(out)


def _params(registers: int, seed: int = 20) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 31, registers, np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, registers, np.uint64).astype(np.uint32)


def sketch(shingles: np.ndarray, params: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    a, b = params
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 1024):
        least = np.minimum(least, (x[i:i + 1024, None] * a + b).min(axis=0))
    h = -np.log1p(-(least.astype(np.float64) + 0.5) / 4294967296.0) / _RATE
    return np.clip(np.floor(1 - np.log(h) / np.log(_BASE)), 0, _TOP).astype("<u2")


def estimate(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, grid: int = 101) -> np.ndarray:
    """Likeliest Jaccard similarity of sketch rows x and y of sets of nx and ny elements."""
    above, below = (x > y).sum(axis=1), (x < y).sum(axis=1)
    u = nx / (nx + ny)
    v = 1 - u
    most = np.minimum(u / v, v / u)
    share = lambda p: -np.log1p(-np.clip(p, 0, 1) * (_BASE - 1) / _BASE) / np.log(_BASE)
    best, at = np.full(len(x), -np.inf), np.zeros(len(x))
    for step in np.linspace(0, 1, grid):
        j = most * step
        up, down = share(u - v * j), share(v - u * j)
        like = above * np.log(np.maximum(up, 1e-9)) + below * np.log(np.maximum(down, 1e-9)) \
            + (x.shape[1] - above - below) * np.log(np.maximum(1 - up - down, 1e-9))
        better = like > best
        best[better], at[better] = like[better], j[better]
    return at


def _registers(column: pa.Array, m: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, m)


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int, registers: int) -> DataFrame:
    """(doc_id, n, node, registers): per row its set's size, a 64-bit name of the set itself
    (0 for the empty set), and the sketch."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        params = _params(registers)
        for batch in batches:
            n, node, reg = [], [], []
            for t in batch.column(1):
                s = shingle_set(t.as_py(), size)
                n.append(len(s))
                node.append(_node(s))
                reg.append(sketch(s, params).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(reg, pa.binary())],
                                             names=["doc_id", "n", "node", "registers"])

    return C.picked(docs, id_col, text_col).mapInArrow(scan, "doc_id bigint, n bigint, node bigint, registers binary")


def _node(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) if len(s) else 0


def near_duplicates(docs: DataFrame, size: int = 5, threshold: tuple[int, int] = (75, 100), id_col: str = "doc_id",
                    text_col: str = "text", bands: int = 48, rows: int = 4, slack: float = 0.15, tile: int = 512) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``."""
    if bands > 64:
        raise ValueError("at most 64 bands")
    with C.text_rows(docs.sparkSession):
        return _near_duplicates(docs, size, threshold, id_col, text_col, bands, rows, slack, tile)


def _near_duplicates(docs: DataFrame, size: int, threshold: tuple[int, int], id_col: str, text_col: str, bands: int, rows: int,
                     slack: float, tile: int) -> DataFrame:
    m = bands * rows
    num, den = threshold
    least = num / den - slack
    spark = docs.sparkSession
    rows_ = C.stored(sketches(docs, id_col, text_col, size, m), "sketches")
    linked = rows_.where("doc_id is not null and n > 0")
    nodes = C.stored(linked.groupBy("node").agg(F.min("doc_id").alias("doc"), F.any_value("n").alias("n"), F.any_value("registers").alias("registers")), "nodes")

    def band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = np.random.default_rng(5).integers(0, 1 << 63, bands, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            reg = _registers(batch.column(1), m).reshape(-1, bands, rows)
            key = np.broadcast_to(salt, reg.shape[:2]).copy()
            for i in range(rows):
                key = _finish(key + reg[:, :, i] * _MIX[i % 5])
            key = key & ~np.uint64(63) | np.arange(bands, dtype=np.uint64)  # the band is the key's low bits
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(batch.column(0).to_numpy(), bands))], names=["key", "node"])

    keys = nodes.select("node", "registers").mapInArrow(band_keys, "key bigint, node bigint")
    hubs = keys.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("members")).where("members > 1")
    members = C.stored(keys.join(hubs, "key"), "bucket-members")
    star = members.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    slim = nodes.select("node", "n", "registers")
    left = slim.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("registers").alias("ra"))
    right = slim.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("registers").alias("rb"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, na, nb = (batch.column(c).to_numpy() for c in ("a", "b", "na", "nb"))
            est = estimate(_registers(batch.column("ra"), m), _registers(batch.column("rb"), m), na, nb)
            near = est >= least
            yield pa.RecordBatch.from_arrays([pa.array(a[near]), pa.array(b[near]), pa.array(est[near])], names=["a", "b", "likely"])

    def estimated(pairs: DataFrame) -> DataFrame:
        """(a, b, likely) of the pairs whose sketches do not rule them out."""
        met = pairs.join(left, "a").join(right, "b").where(f"na * {den} >= nb * {num} and nb * {den} >= na * {num}")
        return C.stored(met.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(judge, "a bigint, b bigint, likely double"), "likely")

    likely = estimated(star)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                same.append(both * den >= (len(p) + len(q) - both) * num)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(same, pa.bool_())], names=["a", "b", "same"])

    def confirmed(pairs: DataFrame) -> DataFrame:
        """(a, b, same) of the pairs, judged on the full sets."""
        pairs = pairs.select("a", "b")
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        sets = _of_nodes(docs, id_col, text_col, size, nodes.join(ends, "node").select("node", "doc"), lambda x: x.tobytes())
        met = pairs.join(sets.select(F.col("node").alias("a"), F.col("body").alias("sa")), "a")
        met = met.join(sets.select(F.col("node").alias("b"), F.col("body").alias("sb")), "b")
        with C.arrow_rows(spark, _BATCH):
            return C.stored(met.select("a", "b", "sa", "sb").mapInArrow(compare, "a bigint, b bigint, same boolean"), "confirmed")

    best = likely.groupBy("a").agg(F.max_by("b", "likely").alias("b"))
    judged = confirmed(C.stored(best.unionByName(likely.where(f"likely >= {num / den}").select("a", "b")).distinct(), "first-pairs"))
    labels = components(judged.where("same"))

    def labelled(pairs: DataFrame, column: str) -> DataFrame:
        own = labels.select(F.col("node").alias(column), F.col("label").alias(f"l{column}"))
        return pairs.join(own, column, "left").withColumn(f"l{column}", F.coalesce(f"l{column}", column))

    def apart(pairs: DataFrame) -> DataFrame:
        """(a, b, likely, la, lb) of the pairs between two components that were not judged."""
        pairs = pairs.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("likely").alias("likely"))
        done = judged.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        return C.stored(labelled(labelled(pairs.join(done, ["a", "b"], "left_anti"), "a"), "b").where("la <> lb"), "open-links")

    def likeliest(pairs: DataFrame) -> DataFrame:
        """One link for every two components."""
        best = pairs.groupBy(F.least("la", "lb").alias("x"), F.greatest("la", "lb").alias("y")).agg(F.max_by(F.struct("a", "b", "la", "lb"), "likely").alias("p"))
        return C.stored(best.select("p.*"), "likeliest")

    def learn(pairs: DataFrame) -> bool:
        """Confirm pairs (a, b, la, lb) and join the components that they link; whether any do."""
        nonlocal judged, labels
        new = confirmed(pairs)
        judged = judged.unionByName(new)  # stored tables, a few of them
        linked = C.stored(new.where("same").join(pairs, ["a", "b"]).select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct(), "linked")
        if not linked.limit(1).count():
            return False
        to = components(linked)
        moved = labels.join(to.select(F.col("node").alias("label"), F.col("label").alias("now")), "label", "left")
        moved = moved.select("node", F.coalesce("now", "label").alias("label"))
        labels = C.stored(moved.unionByName(to.join(labels, "node", "left_anti")), "labels")  # the rest were alone so far
        return True

    def mixed(of: str) -> DataFrame:
        """(key, node, lnode, k, hub, lhub, major) of the members of buckets with several
        components: a hub drawn at random and the component that most members are of."""
        held = labelled(members.where(of).select("key", "node", F.col("members").alias("k")), "node")
        draw = F.xxhash64("node", F.lit(drawn))
        each = held.groupBy("key", "lnode").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct(draw.alias("d"), "node")).alias("first"))
        kinds = each.groupBy("key").agg(F.max(F.struct("m", "lnode")).alias("most"), F.min(F.struct("first", "lnode")).alias("hub"), F.count(F.lit(1)).alias("kinds"))
        several = kinds.where("kinds > 1").select("key", F.col("hub.first.node").alias("hub"), F.col("hub.lnode").alias("lhub"), F.col("most.lnode").alias("major"), F.col("most.m").alias("m"))
        return held.join(several, "key")

    for drawn in range(_ROUNDS):
        star = mixed(f"members > {tile}").where("lnode <> lhub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
        star = C.stored(star, "hub-pairs")
        if not star.limit(1).count() or not learn(likeliest(apart(estimated(star)))):
            break

    def in_full() -> DataFrame:
        """Likely links between components inside the buckets that still hold several."""
        held = C.stored(mixed("members > 2"), "mixed-buckets")
        wanted = held.select("node").distinct().join(nodes.select("node", "doc"), "node")
        params = _params(_FINE, 21)
        fine = _of_nodes(docs, id_col, text_col, size, wanted, lambda x: sketch(x, params).astype(np.uint8).tobytes() + _short(x))
        full = held.join(slim, "node").join(fine.select("node", F.col("body").alias("fine")), "node")
        found = "a bigint, b bigint, likely double"
        small = full.where(f"k <= {tile}").select("key", "node", "lnode", "n", "registers", "fine")

        def each_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for got in _buckets(batches):
                yield from _links(_Block.of(got), None, bands, rows, slack, num, den).to_batches()

        pairs = small.repartition("key").sortWithinPartitions("key").mapInArrow(each_bucket, found)
        side = F.when(F.col("lnode") == F.col("major"), 0).otherwise(1)
        parts = F.ceil(F.when(side == 0, F.col("m")).otherwise(F.col("k") - F.col("m")) / F.lit(tile))
        large = full.where(f"k > {tile}").select("key", side.alias("side"), F.pmod(F.xxhash64("node"), parts).alias("part"), "node", "lnode", "n", "registers", "fine",
                                                 F.ceil(F.col("m") / tile).alias("majors"), F.ceil((F.col("k") - F.col("m")) / tile).alias("others"))
        block = "key bigint, side int, part bigint, majors bigint, others bigint, node binary, lnode binary, n binary, registers binary, fine binary"
        blocks = C.stored(large.groupBy("key", "side", "part").applyInArrow(_Block.pack, block), "blocks")
        # blocks of other components meet all blocks, those of the largest one the others only
        meets = F.expr("""concat(transform(sequence(0L, others - 1), j -> struct(1 AS side, j AS part)),
                                 if(side = 1, transform(sequence(0L, majors - 1), j -> struct(0 AS side, j AS part)), array()))""")
        own = F.struct("side", "part")
        dealt = blocks.withColumn("other", F.explode(meets)).withColumn("i", F.least(own, "other")).withColumn("j", F.greatest(own, "other"))
        dealt = dealt.select("key", "i.side", "i.part", F.col("j.side").alias("side2"), F.col("j.part").alias("part2"), "node", "lnode", "n", "registers", "fine")
        met = dealt.groupBy("key", "side", "part", "side2", "part2").applyInArrow(
            lambda got: _links(*_Block.unpack(got), bands, rows, slack, num, den), found)
        return pairs.unionByName(met).unionByName(likely.where("a <> b"))

    drawn = _ROUNDS
    left_over = C.stored(in_full(), "links-in-full")
    for best in (True, False):
        open_ = apart(left_over)
        if not open_.limit(1).count():
            break
        learn(likeliest(open_) if best else open_)

    named = linked.select("node", "doc_id").groupBy("node").agg(F.min("doc_id").alias("doc"))
    named = named.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    lowest = named.groupBy("label").agg(F.min("doc").alias("component_id"))
    of = named.join(lowest, "label").select("node", "component_id")
    alone = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = rows_.drop("registers").join(of, "node", "left").withColumn("component_id", F.when(F.col("doc_id").isNotNull(), alone))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                      (F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))).alias("kept"))


class _Block:
    """Members of one bucket: names, components, set sizes, registers and further registers."""

    FIELDS = ("node", "lnode", "n", "registers", "fine")

    def __init__(self, key: int, node, lnode, n, registers: bytes, fine: bytes):
        self.key, self.node, self.label, self.n = key, node, lnode, n
        self.reg = np.frombuffer(registers, "<u2").reshape(len(node), -1)
        sizes = _FINE + 4 * np.where(n <= _EXACT, n, 0)
        ends = np.cumsum(sizes)
        bodies = [fine[e - k:e] for k, e in zip(sizes.tolist(), ends.tolist())]
        self.fine = np.frombuffer(b"".join(x[:_FINE] for x in bodies), np.uint8).reshape(len(node), _FINE)
        self.short = [np.frombuffer(x, "<u4", offset=_FINE) if len(x) > _FINE else None for x in bodies]

    @classmethod
    def of(cls, got: pa.Table) -> _Block:
        body = [b"".join(got.column(c).to_pylist()) for c in ("registers", "fine")]
        return cls(got.column("key")[0].as_py(), *(got.column(c).to_numpy() for c in ("node", "lnode", "n")), *body)

    @staticmethod
    def pack(got: pa.Table) -> pa.Table:
        """The rows of one block as one row."""
        head = got.select(["key", "side", "part", "majors", "others"]).slice(0, 1)
        for c in ("node", "lnode", "n"):
            head = head.append_column(c, pa.array([got.column(c).to_numpy().astype("<i8").tobytes()], pa.binary()))
        for c in ("registers", "fine"):
            head = head.append_column(c, pa.array([b"".join(got.column(c).to_pylist())], pa.binary()))
        return head

    @classmethod
    def unpack(cls, got: pa.Table) -> tuple[_Block, _Block | None]:
        """The two blocks that meet; one, if a block meets itself."""
        out = []
        for r in got.select(["key", *cls.FIELDS]).to_pylist():
            out.append(cls(r["key"], *(np.frombuffer(r[c], "<i8") for c in ("node", "lnode", "n")), r["registers"], r["fine"]))
        return out[0], out[1] if len(out) > 1 else None


def _short(shingles: np.ndarray) -> bytes:
    """Sets of up to ``_EXACT`` shingles by 32 bits each, sorted; nothing for larger ones."""
    return np.sort((shingles >> np.uint64(32)).astype("<u4")).tobytes() if len(shingles) <= _EXACT else b""


def _alike(p: np.ndarray, q: np.ndarray, num: int, den: int) -> bool:
    """Whether two short sets can reach the threshold; shingles that agree in 32 bits by chance
    may let a pair through, one such in a set may hide one shingle."""
    at = np.minimum(np.searchsorted(q, p), len(q) - 1)
    both = int((q[at] == p).sum()) + 1
    return both * den >= (len(p) + len(q) - both) * num


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The buckets of rows that come sorted by key, each at most as large as it is."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        cuts = np.flatnonzero(np.diff(key)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)]):
            part = batch.slice(a, b - a)
            if held and held[0].column("key")[0] != part.column("key")[0]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _links(a: _Block, b: _Block | None, bands: int, rows: int, slack: float, num: int, den: int) -> pa.Table:
    """Likely links across components between two blocks, or inside one."""
    m, least, band = bands * rows, num / den - slack, a.key & 63
    close = num / den - 5 * np.sqrt(num / den * (1 - num / den) / (m + _FINE))
    c = a if b is None else b
    out = []
    for x in range(len(a.node)):
        y = np.flatnonzero((c.label != a.label[x]) & (c.n * den >= a.n[x] * num) & (a.n[x] * den >= c.n * num))
        if b is None:
            y = y[c.node[y] > a.node[x]]
        for k in range(0, len(y), 4096):
            z = y[k:k + 4096]
            same = c.reg[z] == a.reg[x]
            first = same.reshape(len(z), bands, rows).all(axis=2).argmax(axis=1) == band
            low = ((c.fine[z] == a.fine[x]).sum(axis=1) * 256 - _FINE) / 255  # less the chance hits of a byte
            z = z[first & (same.sum(axis=1) + low >= close * (m + _FINE))]
            if len(z) and a.short[x] is not None:  # short sets are compared as they are, by 32 bits a shingle
                z = z[[c.short[j] is None or _alike(a.short[x], c.short[j], num, den) for j in z.tolist()]]
            if len(z):
                like = estimate(np.broadcast_to(a.reg[x], (len(z), m)), c.reg[z], np.full(len(z), a.n[x]), c.n[z])
                for j, v in zip(z[like >= least].tolist(), like[like >= least].tolist()):
                    out.append((min(a.node[x], c.node[j]), max(a.node[x], c.node[j]), v))
    cols = list(zip(*out)) if out else [(), (), ()]
    return pa.table({"a": pa.array(cols[0], pa.int64()), "b": pa.array(cols[1], pa.int64()), "likely": pa.array(cols[2], pa.float64())})


def _of_nodes(docs: DataFrame, id_col: str, text_col: str, size: int, needed: DataFrame, make) -> DataFrame:
    """(node, body): ``make`` of the full set of each of the nodes in ``needed`` (node, doc). A
    bitmap over document ids tells the scan which texts to look at; rows that hit it by chance,
    or hold another text under the id, fall out in the join."""
    needed = C.stored(needed, "needed")
    place = F.col("doc").bitwiseAND(_BITS - 1)
    mask = F.expr("bit_or(shiftleft(1L, cast(place & 63 AS int)))")
    got = needed.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(mask.alias("mask")).toArrow()  # at most _BITS / 64 rows
    table = np.zeros(_BITS // 64, np.uint64)
    table[got.column("word").to_numpy()] = got.column("mask").to_numpy().view(np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            at = ids.astype(np.int64) & (_BITS - 1)
            hit = (words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool) & ~batch.column(0).is_null().to_numpy(zero_copy_only=False)
            out, held = [], 0
            for k in np.flatnonzero(hit).tolist():
                s = shingle_set(batch.column(1)[k].as_py(), size)
                if len(s):
                    out.append((_node(s), int(ids[k]), make(s)))
                    held += len(out[-1][2])
                if held > _HELD:
                    yield _hits(out)
                    out, held = [], 0
            yield _hits(out)

    hits = C.picked(docs, id_col, text_col).mapInArrow(scan, "node bigint, doc bigint, body binary")
    return C.stored(hits.join(needed, ["node", "doc"]).groupBy("node").agg(F.any_value("body").alias("body")), "bodies")


def _hits(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    node, doc, body = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(doc, pa.int64()), pa.array(body, pa.binary())], names=["node", "doc", "body"])
