"""URL filters by a cascade of Bloom filters.

Listed keys (rules by host and path prefix, and a list of hosts) are held against the keys
that the corpus's URLs can match: its complete key universe. Level 1 encodes the listed keys,
level 2 the universe's keys that level 1 lets through wrongly, level 3 the listed keys that
level 2 lets through, and so on until nothing is let through wrongly. A key's first level that
refuses it tells: exact membership for every key of the universe, from a few bits a listed
key, with no join over the pages. Level 1 is sized so that it lets through about as many keys
as are listed, whatever the universe: 1.44 * log2(universe / list) bits a listed key; each
further level lets one in ``_ODDS`` through. So a cascade follows the list, and grows with the
corpus by its logarithm only. Cascades of up to ``max_filter_bytes``, checked level by level
before a level is fetched, are broadcast; larger lists are joined by distinct key.

The longest rule that fits decides; where none fits, a URL is blocked if its host or a domain
above it is on the host list.

Cases: a null URL, or one without ``://``, has an empty host and path, fits no rule and is
allowed; repeated rows give one result each; very long URLs are taken whole (only prefixes as
long as some rule's path, and suffixes of as many labels as some listed host, are keys); an
empty table or list is fine; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Of the keys tested against a further level, one in so many is let through.
_ODDS = 8.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host after the first ``://`` (A-Z lowered), then the path up to ``?`` or ``#``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit("")), F.coalesce(path, F.lit(""))


def key_of(host: str, path: str) -> str:
    return f"{host}\0{path}"


class Bloom:
    def __init__(self, words: np.ndarray, hashes: int):
        self.words, self.hashes = words, hashes

    @staticmethod
    def shape(keys: int, odds: float) -> tuple[int, int]:
        """64-bit words and hashes for a filter that lets one in ``odds`` other keys through."""
        hashes = max(1, round(math.log2(odds)))
        return -(-math.ceil(keys * hashes / math.log(2)) // 64), hashes

    @staticmethod
    def places(keys: list[str], bits: int, level: int, hashes: int) -> np.ndarray:
        h = np.array([xxhash.xxh3_64_intdigest(k, level) for k in keys], np.uint64)
        step = (h >> np.uint64(32)) | np.uint64(1)
        return (((h & np.uint64(0xFFFFFFFF))[:, None] + np.arange(hashes, dtype=np.uint64) * step[:, None]) % np.uint64(bits)).astype(np.int64)

    def holds(self, keys: list[str], level: int) -> np.ndarray:
        if not keys or not len(self.words):
            return np.zeros(len(keys), bool)
        at = self.places(keys, 64 * len(self.words), level, self.hashes)
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).all(axis=1)


class Cascade:
    """Exact membership for the universe that it was built over."""

    def __init__(self, levels: list[Bloom]):
        self.levels = levels

    def holds(self, keys: list[str]) -> np.ndarray:
        member = np.zeros(len(keys), bool)
        left = np.arange(len(keys))
        for n, level in enumerate(self.levels):
            passed = level.holds([keys[i] for i in left.tolist()], n)
            member[left[~passed]] = n % 2 == 1
            left = left[passed]
        member[left] = len(self.levels) % 2 == 1
        return member

    @property
    def bytes(self) -> int:
        return sum(x.words.nbytes for x in self.levels)


def _filter_of(keys: DataFrame, count: int, level: int, odds: float) -> Bloom:
    words, hashes = Bloom.shape(count, odds)
    if not count:
        return Bloom(np.zeros(0, np.uint64), hashes)

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(words, np.uint64)
        for batch in batches:
            at = Bloom.places(batch.column(0).to_pylist(), 64 * words, level, hashes).ravel()
            np.bitwise_or.at(own, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        some = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(own[some].view(np.int64))], names=["word", "mask"])

    got = keys.mapInArrow(marks, "word bigint, mask bigint").groupBy("word").agg(F.expr("bit_or(mask)").alias("mask")).toArrow()
    table = np.zeros(words, np.uint64)  # as large as the filter, which was checked
    table[got.column("word").to_numpy()] = got.column("mask").to_numpy().view(np.uint64)
    return Bloom(table, hashes)


def _let_through(keys: DataFrame, bloom: Bloom, level: int) -> DataFrame:
    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(bloom.holds(batch.column(0).to_pylist(), level)))

    return keys.mapInArrow(test, "key string")


def build_cascade(universe: DataFrame, listed: DataFrame, max_bytes: int = 64 << 20) -> Cascade | None:
    """Over distinct keys (column ``key``): the listed ones against all of the universe. None if
    the levels would take more than ``max_bytes``."""
    C.importable(universe.sparkSession)
    inside = C.stored(listed.select("key").distinct(), "cascade-listed")
    outside = universe.select("key").join(inside, "key", "left_anti")
    levels: list[Bloom] = []
    encoded, tested, count, others = inside, outside, inside.count(), outside.count()
    odds = max(_ODDS, others / max(1, count))
    while True:
        if sum(x.words.nbytes for x in levels) + 8 * Bloom.shape(count, odds)[0] > max_bytes:
            return None
        levels.append(_filter_of(encoded, count, len(levels), odds))
        wrong = C.stored(_let_through(tested, levels[-1], len(levels) - 1), "cascade-wrong")
        through = wrong.count()
        if not through:
            return Cascade(levels)
        encoded, tested, count, odds = wrong, encoded, through, _ODDS


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], listed_hosts: DataFrame, id_col: str = "page_id",
               url_col: str = "url", max_filter_bytes: int = 64 << 20) -> DataFrame:
    """(id_col, host, path, rule, verdict). ``rules``: (host, path prefix, allow or block);
    ``listed_hosts``: column ``host``."""
    spark = pages.sparkSession
    id_type = C.type_of(pages, id_col)
    src = C.picked(pages, id_col, url_col)
    host, path = host_and_path(F.col("c1"))
    split = src.select("c0", host.alias("host"), path.alias("path"))
    lengths = sorted({len(p) for _, p, _ in rules})
    hosts = listed_hosts.select("host").where("host is not null and host <> ''").distinct()
    labels = hosts.select(F.size(F.split("host", r"\.")).alias("n")).distinct()
    rule_labels = sorted({h.count(".") + 1 for h, _, _ in rules})
    list_labels = sorted(r[0] for r in labels.collect())  # label counts: at most 127 in a host name

    def suffixes(name: str, counts: list[int]) -> list[str]:
        parts = name.split(".")
        return [".".join(parts[-n:]) for n in counts if n <= len(parts)] if name else []

    def rule_keys(name: str, at: str) -> list[str]:
        return [key_of(s, at[:n]) for s in suffixes(name, rule_labels) for n in lengths if n <= len(at)]

    def host_keys(name: str) -> list[str]:
        return [key_of(s, "") for s in suffixes(name, list_labels)]

    def universe(kind: str):
        def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[str] = set()
            for batch in batches:
                for h, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    seen.update(rule_keys(h, p) if kind == "rules" else host_keys(h))
                if len(seen) > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(list(seen))], names=["key"])
                    seen = set()
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string())], names=["key"])

        return C.stored(split.select("host", "path").mapInArrow(keys, "key string").distinct(), f"universe-{kind}")

    by_rule, by_host = universe("rules"), universe("hosts")
    cascades = {}
    for verdict in ("allow", "block"):
        mine = [(key_of(h, p),) for h, p, v in rules if v == verdict]
        cascades[verdict] = build_cascade(by_rule, spark.createDataFrame(mine, "key string"))
    listed = hosts.select(F.concat("host", F.lit("\0")).alias("key"))
    cascades["listed"] = build_cascade(by_host, listed, max_filter_bytes)
    joined = cascades["listed"] is None
    shared = spark.sparkContext.broadcast(cascades)
    out_type = f"c0 {id_type}, host string, path string, rule string, verdict string"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = shared.value
        for batch in batches:
            names, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            tried = [rule_keys(h, p) for h, p in zip(names, paths)]
            flat = [k for keys in tried for k in keys]
            allow, block = tests["allow"].holds(flat), tests["block"].holds(flat)
            hosts_of = [host_keys(h) for h in names]
            bad = tests["listed"].holds([k for keys in hosts_of for k in keys]) if not joined else None
            rule, verdict, i, j = [], [], 0, 0
            for keys, own in zip(tried, hosts_of):
                fits = [(len(k), k.index("\0"), n) for n, k in enumerate(keys, i) if allow[n] or block[n]]
                on_list = not joined and bool(bad[j:j + len(own)].any())
                if fits:
                    n = max(fits)[2]
                    rule.append(flat[n].replace("\0", ""))
                    verdict.append("allow" if allow[n] else "block")
                else:
                    rule.append(None)
                    verdict.append("block" if on_list else "allow")
                i, j = i + len(keys), j + len(own)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                                             names=["c0", "host", "path", "rule", "verdict"])

    out = split.mapInArrow(judge, out_type)
    if joined:  # the list is too large for a filter: its keys are joined, once per distinct host
        on = split.select("host").distinct().withColumn("part", F.split("host", r"\."))
        on = on.withColumn("key", F.explode(F.transform(F.sequence(F.lit(1), F.size("part")), lambda n: F.concat(F.array_join(F.slice("part", -n, n), "."), F.lit("\0")))))
        on = on.join(listed, "key", "left_semi").select("host").distinct().withColumn("on", F.lit(True))
        out = out.join(on, "host", "left").withColumn("verdict", F.when(F.col("rule").isNull() & F.col("on"), "block").otherwise(F.col("verdict")))
    return out.select(F.col("c0").alias(id_col), "host", "path", "rule", "verdict")


def hosts_with_words(pages: DataFrame, words: tuple[str, ...], url_col: str = "url") -> DataFrame:
    """A host list: the hosts of which a label holds one of ``words`` between hyphens or dots."""
    host, _ = host_and_path(F.col(f"`{url_col}`"))
    return pages.select(host.alias("host")).where(F.col("host").rlike(rf"(^|[.-])({'|'.join(words)})([.-]|$)")).distinct()
