"""Language identification by Bayesian fusion of evidence.

Four kinds of evidence are combined per row, each as a probability:

- the text: byte trigrams under one multinomial model per language, and a uniform model for
  "none of these". Every language that a row is labelled with has a model, however many they
  are; a label counts as its part before ``-`` or ``_``, in lower case, like a declaration.
  The models are fitted on at most about ``per_language`` labelled rows each and kept as the
  trigrams that occur, so they grow with the languages' own trigrams;
- the declared language (a page's ``lang`` attribute, a document's column): how often rows of
  each language declare what, counted over all rows;
- the address suffix (top-level domain) and the host (a page's host, a document's source):
  priors smoothed down the hierarchy all rows -> suffix -> host by ``weight`` pseudo-rows of
  the level above, from grouped sums of the text posteriors of all rows. A row's own share is
  taken out of its host's sum, so it does not confirm itself.

Trigrams overlap, so their log-likelihood counts by ``temper``. A row is rejected if it has
no letter, or if "none of these" comes out likeliest although it starts ``doubt`` nats behind:
a short or odd text is kept, only clear evidence rejects.

Cases: null and empty texts are rejected, with language ``und``; null declarations, hosts and
suffixes say nothing; repeated rows are judged alike; very long texts are taken whole; with no
labelled row every text is ``und``; an empty table gives an empty result; other columns are
not read unless carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

_SIZE = 1 << 16
#: Languages that a fitting task counts, and (trigram, language) pairs or (row, language)
#: numbers that a scoring task holds, at a time.
_AT_ONCE, _PAIRS = 64, 1 << 20


def grams(text: str) -> np.ndarray:
    """Hashed byte trigrams of the lower-cased text between two spaces."""
    b = np.frombuffer(f" {text.lower()} ".encode(), np.uint8).astype(np.uint32)
    return (((b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)) * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def language_of(label: Column) -> Column:
    """A label or declaration without its region or script: ``en`` of ``EN``, ``en-US``, ``en_GB``."""
    return F.lower(F.split(label, "[-_]")[0])


class Model:
    """Languages, and the log-probabilities of trigrams under each of them and under "none":
    ``base`` for a trigram that a language was not seen with, ``gain`` over it (by trigram,
    from ``start[g]`` to ``start[g + 1]``) for the languages ``lang`` that it was seen with."""

    def __init__(self, names: list[str], gram: np.ndarray, lang: np.ndarray, n: np.ndarray):
        order = np.lexsort([lang, gram])
        gram, lang, n = gram[order], lang[order], n[order].astype(np.float64)
        self.names, self.lang, self.gain = names, lang.astype(np.int32), np.log((n + 0.5) / 0.5)
        self.start = np.searchsorted(gram, np.arange(_SIZE + 1))
        seen = np.bincount(lang, weights=n, minlength=len(names))
        self.base = np.append(np.log(0.5 / (seen + 0.5 * _SIZE)), -np.log(_SIZE))

    def log_likelihood(self, g: np.ndarray) -> np.ndarray:
        """Of the trigrams under every language and under "none"."""
        k = len(self.base)
        out, step = self.base * len(g), max(1, _PAIRS // k)
        for a in range(0, len(g), step):
            part = g[a:a + step]
            at = C.spread(self.start[part], self.start[part + 1] - self.start[part])
            out += np.bincount(self.lang[at], weights=self.gain[at], minlength=k)
        return out


def fit(labelled: DataFrame, text_col: str, label_col: str, id_col: str, per_language: int = 2000) -> Model:
    """One model per language among the labels."""
    rows = C.picked(labelled, text_col, label_col, id_col)
    rows = rows.withColumn("c1", language_of(F.col("c1").cast("string"))).where("c0 is not null and c1 is not null and c1 <> ''")
    sizes = rows.groupBy("c1").agg(F.count(F.lit(1)).alias("size")).toArrow()  # one row per language
    names = sorted(sizes.column("c1").to_pylist())
    if not names:
        nothing = np.zeros(0, np.int64)
        return Model([], nothing, nothing, nothing)
    size = dict(zip(sizes.column("c1").to_pylist(), sizes.column("size").to_pylist()))
    # from Arrow: rows from Python objects would start Python workers of another kind beside those of the other steps
    shares = rows.sparkSession.createDataFrame(pa.table({"c1": names, "lang": range(len(names)), "share": [min(1.0, per_language / size[n]) for n in names]}))
    chosen = rows.join(F.broadcast(shares), "c1").where(F.pmod(F.xxhash64("c2", "c0"), F.lit(1 << 20)) < F.col("share") * (1 << 20)).select("c0", "lang")

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}

        def counted() -> pa.RecordBatch:
            g = {i: np.flatnonzero(c) for i, c in own.items()}
            parts = [np.concatenate([np.zeros(0, np.int64), *x]) for x in ([np.full(len(x), i) for i, x in g.items()], g.values(), [own[i][x] for i, x in g.items()])]
            own.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in parts], names=["lang", "gram", "n"])

        for batch in batches:
            for t, i in zip(batch.column(0), batch.column(1).to_pylist()):
                if i not in own and len(own) == _AT_ONCE:
                    yield counted()
                own[i] = own.get(i, 0) + np.bincount(grams(t.as_py()), minlength=_SIZE)
        yield counted()

    with C.text_rows(rows.sparkSession):
        got = chosen.mapInArrow(count_grams, "lang bigint, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    return Model(names, *[got.column(c).to_numpy() for c in ("gram", "lang", "n")])


def identify(rows: DataFrame, model: Model, text: str | Column, declared: str | Column | None = None,
             host: str | Column | None = None, suffix: str | Column | None = None, carry: dict[str, Column] | None = None,
             temper: float = 0.3, weight: float = 20.0, doubt: float = 20.0) -> DataFrame:
    """The carried columns (name -> expression) with language, probability, text_language and
    accepted, per row."""
    spark = rows.sparkSession
    C.importable(spark)
    names = model.names
    k = len(names) + 1
    as_col = lambda c: F.lit(None).cast("string") if c is None else (F.col(f"`{c}`") if isinstance(c, str) else c).cast("string")
    carry = carry or {}
    src = rows.select(as_col(text).alias("text"), language_of(as_col(declared)).alias("declared"), as_col(host).alias("host"),
                      as_col(suffix).alias("suffix"), F.struct(*[c.alias(n) for n, c in carry.items()], F.lit(0).alias("_")).alias("row"))
    shared = spark.sparkContext.broadcast(model)
    row_type = src.schema["row"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, step = shared.value, max(1, _PAIRS // k)
        for whole in batches:
            for a in range(0, whole.num_rows, step):
                batch = whole.slice(a, step)
                like, lettered = np.zeros((batch.num_rows, k)), []
                for r, t in enumerate(batch.column(0)):
                    t = t.as_py() or ""
                    lettered.append(any(map(str.isalpha, t)))
                    if t:
                        total = fitted.log_likelihood(grams(t)) * temper
                        total[-1] -= doubt
                        like[r] = total - total.max()
                lists = pa.ListArray.from_arrays(np.arange(0, like.size + 1, k, dtype=np.int32), like.ravel())
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], lists, pa.array(lettered, pa.bool_())],
                                                 names=["declared", "host", "suffix", "row", "like", "lettered"])

    seen = src.mapInArrow(score, f"declared string, host string, suffix string, row {row_type}, like array<double>, lettered boolean")
    weights = F.transform("like", lambda x: F.exp(x))
    total = F.aggregate("w", F.lit(0.0), lambda a, x: a + x)
    seen = seen.withColumn("w", weights).withColumn("p", F.transform("w", lambda x: x / total)).drop("w")
    with C.text_rows(spark):
        seen = C.stored(seen, "language-evidence")
    p = [F.col("p")[i] for i in range(k)]
    sums = [F.sum(F.when(F.col("lettered"), x).otherwise(0.0)).alias(f"s{i}") for i, x in enumerate(p)]
    total_row = seen.agg(*sums).first()
    base = np.array([float(x or 0.0) for x in total_row]) + 1.0
    prior = base / base.sum()

    def packed(df: DataFrame, key: str, name: str) -> DataFrame:
        return df.select(key, F.array(*[f"s{i}" for i in range(k)]).alias(name))

    def below(counts: Column, above: Column, own: Column | None = None) -> Column:
        """Smoothed shares: (counts - own + weight * above) / their sum."""
        left = counts if own is None else F.zip_with(counts, own, lambda c, o: F.greatest(c - o, F.lit(0.0)))
        mixed = F.zip_with(left, above, lambda c, a: c + a * weight)
        size = F.aggregate(mixed, F.lit(0.0), lambda a, x: a + x)
        return F.transform(mixed, lambda x: x / size)

    every = F.array(*[F.lit(float(x)) for x in prior])
    nothing = F.array(*[F.lit(0.0)] * k)
    # declarations: P(declared | language) from posterior counts, one pseudo-row of the marginal
    said = packed(seen.where("declared is not null").groupBy("declared").agg(*sums), "declared", "of_declared")
    all_said = seen.where("declared is not null").agg(*sums).first()
    said_total = F.array(*[F.lit(float(x or 0.0) + 1.0) for x in all_said])
    said_rows = float(sum(float(x or 0.0) for x in all_said)) or 1.0
    by_suffix = packed(seen.where("suffix is not null").groupBy("suffix").agg(*sums), "suffix", "of_suffix")
    by_host = packed(seen.where("host is not null").groupBy("host").agg(*sums), "host", "of_host")
    fused = seen.join(said, "declared", "left").join(by_suffix, "suffix", "left").join(by_host, "host", "left")
    own = F.when(F.col("lettered"), F.col("p")).otherwise(nothing)
    fused = fused.withColumn("at_suffix", F.when(F.col("of_suffix").isNull(), every).otherwise(below(F.col("of_suffix"), every, own)))
    fused = fused.withColumn("at_host", F.when(F.col("of_host").isNull(), F.col("at_suffix")).otherwise(below(F.col("of_host"), F.col("at_suffix"), own)))
    size = F.aggregate("of_declared", F.lit(0.0), lambda a, x: a + x)
    marginal = size / F.lit(said_rows)
    told = F.zip_with("of_declared", said_total, lambda c, t: (c + marginal) / t)
    fused = fused.withColumn("told", F.when(F.col("of_declared").isNull(), F.transform(every, lambda x: F.lit(1.0))).otherwise(told))
    log = F.zip_with(F.zip_with("like", F.transform("at_host", lambda x: F.ln(x + 1e-300)), lambda a, b: a + b),
                     F.transform("told", lambda x: F.ln(x + 1e-300)), lambda a, b: a + b)
    fused = fused.withColumn("log", log).withColumn("top", F.array_max("log"))
    labels = F.array(*[F.lit(x) for x in [*names, "und"]])
    best = F.array_position("log", F.col("top"))
    mass = F.aggregate(F.transform("log", lambda x: F.exp(x - F.col("top"))), F.lit(0.0), lambda a, x: a + x)
    alone = F.array_position("p", F.array_max("p"))
    accepted = F.col("lettered") & (best < k)
    return fused.select(*[F.col(f"row.`{n}`").alias(n) for n in carry],
                        F.when(accepted, F.element_at(labels, best.cast("int"))).otherwise(F.lit("und")).alias("language"),
                        (1 / mass).alias("probability"),
                        F.when(F.col("lettered"), F.element_at(labels, alone.cast("int"))).otherwise(F.lit("und")).alias("text_language"), accepted.alias("accepted"))


def identify_documents(docs: DataFrame, carry: dict[str, Column], per_language: int = 2000) -> DataFrame:
    """Documents: the ``lang`` column is the declared language, the source is the host."""
    model = fit(docs, "text", "lang", "doc_id", per_language)
    return identify(docs, model, "text", declared="lang", host="source", carry=carry)


def identify_pages(pages: DataFrame, labelled: DataFrame, per_language: int = 2000) -> DataFrame:
    """Pages: text without markup, the ``lang`` attribute, the host and its last label."""
    from .url_filter import host_and_path

    model = fit(labelled, "text", "lang", "doc_id", per_language)
    host, _ = host_and_path(F.col("url"))
    bare = F.regexp_replace(F.col("html"), r"(?is)<(script|style|title)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    bare = F.regexp_replace(bare, r"&#?\w+;?", " ")
    lang = F.regexp_extract("html", r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1)
    return identify(pages, model, bare, declared=F.when(lang != "", lang), host=F.when(host != "", host),
                    suffix=F.when(host != "", F.element_at(F.split(host, r"\."), -1)),
                    carry={"page_id": F.col("page_id"), "url": F.col("url")})
