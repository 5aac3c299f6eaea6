"""The training-data operators against brute force, and on awkward tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from html import escape

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from harness import compare, duck
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm import (ann, bpe, chat, common, components, dom, exact_substring, html_extract, language_id, near_dup, oracles,
                            packing, queries, topk, url_filter)

SF = "/root/testdata/sf0.001"
RANKS, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")
#: Null, empty, blank, odd white space, repeated, repeated id, no id, long, other scripts.
TEXTS = [(900, None), (901, ""), (902, " \t\n"), (903, " lead x\n  y \n z\n \nq  w   e "), (904, "a\tb don't 12ab, x.y  "),
         (905, "it's  a\n\n test\x1c x　y 's"), (905, "it's  a\n\n test\x1c x　y 's"), (906, "one two three"), (907, "One  TWO three"),
         (908, "long " * 9000), (None, "long " * 9000), (909, "中文 и русский ᵃⅣ² 😀 éé"), (909, "another text under one id, with enough words in it")]


@pytest.fixture(scope="module")
def documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame(TEXTS, "doc_id long, text string")
    # extra columns with the names that the operators use inside
    clash = {c: F.lit(c) for c in ("c0", "c1", "block", "bucket", "node", "label", "ids", "row", "key", "piece", "n", "s")}
    return docs.unionByName(more).withColumns(clash).repartition(5).cache()


def plain(df, *columns):
    fix = lambda v: -1 if v is None else v
    return sorted(tuple(map(fix, r)) for r in df.select(*columns).collect())


def texts_of(documents):
    return [(r[0], r[1] or "") for r in documents.select("doc_id", "text").collect()]


def same(got, want):
    assert got == sorted(tuple(-1 if v is None else v for v in r) for r in want)


def test_bpe_equals_the_library(spark, documents):
    enc = bpe._encoding(RANKS, P.PATTERN)
    want = []
    for i, t in texts_of(documents):
        ids = enc.encode_ordinary(t)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    same(plain(bpe.bpe_round_trip(documents, RANKS, P.PATTERN), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"), want)
    back = bpe.decode(bpe.encode(documents, RANKS, P.PATTERN, block_chars=5000), RANKS)
    same(plain(back.select("doc_id", F.col("decoded").cast("string")), "doc_id", "decoded"), texts_of(documents))


def test_pretoken_cuts_on_random_text():
    enc, rnd = bpe._encoding(RANKS, P.PATTERN), random.Random(3)
    parts = [" ", " ", " ", "\n", "\t", "a", "B", "é", "1", "²", "'s", "'", "!", "?", "\xa0", "\x1c", "　", "中", "́", "Ⅳ", "😀", "'ll"]
    for _ in range(4000):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        lex = bpe._Lexicon(P.PATTERN)
        codes, words = lex.packed(t), []
        words = list(lex.codes)
        ids = [i for k in range(0, len(codes), 4) for i in enc._core_bpe.encode_single_piece(words[int.from_bytes(codes[k:k + 4], "little")].encode())]
        assert ids == enc.encode_ordinary(t), repr(t)


def best_fit_decreasing(pieces, cap):
    gaps = []
    for p in sorted(pieces, reverse=True):
        fit = min((g for g in gaps if g >= p), default=None)
        if fit is not None:
            gaps.remove(fit)
        gaps.append((cap if fit is None else fit) - p)
    return len(gaps)


def pieces(rows, cap):
    """(doc, piece, start, length, crc32) by a freshly loaded tokenizer. Its text says that strings
    like those of special tokens are plain text in this vocabulary (``encode_special_tokens``)."""
    tok = Tokenizer.from_file(WORDS)
    tok.encode_special_tokens = True
    out = []
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), cap):
            part = np.array(ids[k:k + cap], "<u4").tobytes()
            out.append((i, k // cap, k, len(part) // 4, zlib.crc32(part)))
    return out


def gapless(rows, cap):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for got in bins.values():
        at = 0
        for o, n in sorted(got):
            assert o == at
            at += n
        assert at <= cap
    return bins


def test_packing_is_gapless_and_tight(spark, documents):
    special = [(950, "end of text <|endoftext|> next"), (951, "<|startoftext|><|endoftext|>")]
    documents = documents.select("doc_id", "text", "c0").unionByName(spark.createDataFrame(special, "doc_id long, text string"), allowMissingColumns=True)
    want = pieces(texts_of(documents), 512)
    packed = packing.pack(documents, WORDS, capacity=512, with_ids=True).cache()
    same(plain(packed, "doc_id", "piece", "start", "length", "ids_crc32"), want)
    bins = gapless(packed.collect(), 512)
    assert len(bins) == best_fit_decreasing([w[3] for w in want], 512) <= 1.02 * sum(w[3] for w in want) / 512
    assert all(len(r[0]) <= 512 for r in packing.sequences(packed).select("ids").collect())
    by_join = packing.place(packed.drop("sequence_id", "offset"), 512, ["doc_id", "piece", "ids_crc32"], max_broadcast_runs=0)
    assert plain(by_join, "length", "sequence_id", "offset") == plain(packed, "length", "sequence_id", "offset")


def test_sweep_is_best_fit_decreasing():
    rnd = random.Random(1)
    for _ in range(60):
        cap = rnd.randint(3, 60)
        pieces = [rnd.randint(1, cap) for _ in range(rnd.randint(1, 80))]
        assert packing.sweep(Counter(pieces), cap)[1] == best_fit_decreasing(pieces, cap)


def without_repeats(rows, length=50):
    """(id, bytes, bytes removed, runs removed, bytes left) per (id, text), window by window."""
    rows = [(2 ** 63 - 1 if i is None else i, t.encode()) for i, t in rows]
    low = {}
    for i, b in rows:
        for p in range(len(b) - length + 1):
            low[b[p:p + length]] = min(low.get(b[p:p + length], i), i)
    out = []
    for i, b in rows:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if low[b[p:p + length]] < i:
                gone[p:p + length] = b"\1" * length
        out.append((None if i == 2 ** 63 - 1 else i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), bytes(c for c, g in zip(b, gone) if not g)))
    return out


def test_substring_dedup_by_brute_force(spark, documents):
    per = "ab" * 300
    more = spark.createDataFrame([(None, per), (-5, per[:200]), (7, per + "x" * 200), (912, "é" * 30), (913, "zz" + "é" * 30), (913, "zz" + "é" * 30)], "doc_id long, text string")
    docs = documents.select("doc_id", "text", "c0").unionByName(more, allowMissingColumns=True)
    want = [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in without_repeats(texts_of(docs))]
    for hot in (8192, 0):  # 0: every repeated window is dealt by its whole content
        out = exact_substring.remove_repeats(docs, 50, carry=("c0",), block_chars=20_000, hot_strings=hot).withColumn("h", F.sha2("kept", 256))
        assert out.columns[:2] == ["doc_id", "c0"]
        same(plain(out, "doc_id", "n_bytes", "n_removed", "n_spans", "h"), want)


def test_a_phrase_among_ever_other_words_is_dealt_over_the_buckets(spark):
    rnd = random.Random(8)
    rows = [(i, f"{rnd.random()} {rnd.random()} {rnd.random()} as a matter of course and fact {rnd.random()} {rnd.random()} {rnd.random()}") for i in range(900)]
    rows += [(1000 + i, rows[i][1][10:90]) for i in range(0, 900, 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in without_repeats(rows)]
    out = exact_substring.remove_repeats(docs, 50, block_chars=30_000, hot_strings=50).withColumn("h", F.sha2("kept", 256))
    same(plain(out, "doc_id", "n_bytes", "n_removed", "n_spans", "h"), want)
    r = exact_substring._Runs([t.encode() for _, t in rows], 50, 64)
    often = r.strings_per_anchor()
    assert often.max() > 100  # a gram of the phrase is the anchor of ever other strings
    hot = np.flatnonzero(often > 50)
    asked = [{"bucket": int(r.bucket[k]), "a": exact_substring.C.pack_ints([k - r.cuts[r.bucket[k]]]), "b": exact_substring.C.pack_ints([0])} for k in hot]
    _, sent = r.strings(asked)
    share = np.bincount(sent.bucket, minlength=64)
    assert share.min() > 0 and share.max() < 2 * share.mean()


def shingles(t):
    w = t.encode().lower().split()
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def brute_components(rows):
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    post = defaultdict(list)
    for i, s in enumerate(sets):
        if rows[i][0] is not None:
            near = Counter(j for x in s for j in post[x])
            for j, k in near.items():
                if 100 * k >= 75 * (len(s) + len(sets[j]) - k):
                    parent[find(i)] = find(j)
            for x in s:
                post[x].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(sets[i]), None if d is None else least[find(i)], d is None or d == least[find(i)]) for i, (d, _) in enumerate(rows)]


def test_near_duplicates_by_brute_force(spark, documents):
    rnd = random.Random(5)  # a group of copies with a word in ten changed: links of all strengths
    base = [f"w{rnd.randint(0, 400)}" for _ in range(150)]
    near = [(2000 + i, " ".join(w if rnd.random() > 0.03 else f"x{rnd.random()}" for w in base)) for i in range(120)]
    docs = documents.select("doc_id", "text", "node").unionByName(spark.createDataFrame(near, "doc_id long, text string"), allowMissingColumns=True)
    out = near_dup.near_duplicates(docs, tile=16)
    same(plain(out, "doc_id", "n_shingles", "component_id", "kept"), brute_components(texts_of(docs)))


def test_texts_move_in_small_batches(spark, documents, tmp_path, monkeypatch):
    """Near-duplicates, language ID and packing hold at most TEXT_ROWS rows of texts at a time
    in Spark's reader and in Python; the session's own sizes are back after them."""
    names = ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch")
    before, seen, store = [spark.conf.get(n) for n in names], {}, common.materialize
    monkeypatch.setattr(common, "materialize", lambda df, name: seen.setdefault(name, [int(spark.conf.get(n)) for n in names]) and store(df, name))
    at = str(tmp_path / "docs")
    documents.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source")).coalesce(1).write.parquet(at)
    docs = spark.read.parquet(at)
    near_dup.near_duplicates(docs)
    packing.pack(docs, WORDS)
    language_id.identify_documents(docs, {"id": F.col("doc_id")})
    assert {"sketches", "nodes", "bodies", "pieces", "language-evidence"} <= set(seen)
    assert all(max(seen[n]) <= common.TEXT_ROWS for n in seen), seen
    assert [spark.conf.get(n) for n in names] == before
    long = str(tmp_path / "long")
    spark.range(3 * common.TEXT_ROWS).coalesce(1).write.parquet(long)
    with common.text_rows(spark):
        rows = spark.read.parquet(long).mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"id": [b.num_rows]}) for b in batches), "id bigint").collect()
    assert sum(r.id for r in rows) == 3 * common.TEXT_ROWS and max(r.id for r in rows) <= common.TEXT_ROWS
    with pytest.raises(ValueError), common.text_rows(spark):
        raise ValueError
    assert [spark.conf.get(n) for n in names] == before


def test_workers_keep_no_words_after_packing(spark, documents):
    packing.pack(documents, WORDS)

    def held(batches):
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"id": [packing._words.cache_info().currsize]})

    assert {r.id for r in spark.range(0, 64, 1, 16).mapInArrow(held, "id bigint").collect()} == {0}


def test_sketch_estimates_are_near_and_mergeable():
    rnd, params = np.random.default_rng(2), near_dup._params(192)
    for j in (0.2, 0.5, 0.75, 0.9):
        both = rnd.integers(0, 1 << 63, int(600 * j), np.uint64)
        only = rnd.integers(0, 1 << 63, 600 - len(both), np.uint64)
        a, b = np.concatenate([both, only[::2]]), np.concatenate([both, only[1::2]])
        x, y = near_dup.sketch(a, params), near_dup.sketch(b, params)
        assert abs(near_dup.estimate(x[None], y[None], np.array([len(a)]), np.array([len(b)]))[0] - j) < 0.13
        assert (np.maximum(x, y) == near_dup.sketch(np.concatenate([a, b]), params)).all()


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)] + [(300, 300)]
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(80)} | {300: 300}


VECTORS = [(0, [1.0, 0.0]), (100, [0.5, 0.5]), (3, [0.5, 0.5]), (2, [0.5, 0.5]), (5, [0.0, 0.0]), (200, None), (300, [float("nan"), 1.0]), (7, [None, 1.0]),
           (8, [float("inf"), 0.0]), (None, [1.0, 1.0]), (9, [1.0]), (11, [0.5, 0.5]), (11, [-1.0, 0.25]), (100, [0.5, 0.5]), (400, [])]


def test_exact_top_k_by_brute_force(spark):
    real = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    rnd = random.Random(6)
    huge = [(0, [3e6, 0.0]), (1, [1.0, 0.0]), (100, [1.0, 2.0]), (2, [-2.0 ** 21, 1.5]), (200, [1e-9, 2.0 ** 40]), (3, [0.0, 2.0])]
    wide = [(i, [rnd.choice([-1, 1]) * 2.0 ** rnd.randint(0, 20) + rnd.random() for _ in range(3)]) for i in range(250)]
    for rows, k in ((VECTORS, 3), (VECTORS, 50), (real, 10), (huge, 4), (wide, 7)):
        ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
        want = []
        for q in sorted({i for i, _ in ok if i % 100 == 0}):
            own = min(v for i, v in ok if i == q)
            best = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in ok if i != q)[:k]
            want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("c0", F.lit(1)).repartition(3)
        same(plain(topk.exact_top_k(df, "id % 100 = 0", k=k, bins=64, row_block=64, query_block=2), "query_id", "rank", "vec_id", "score"), want)


def test_top_k_scores_fit_64_bits_or_raise(spark):
    edge = [(0, [2.0 ** 21.0]), (1, [2.0 ** 20.999]), (2, [-(2.0 ** 21.4)])]  # up to 2^62.4
    df = spark.createDataFrame(edge, "vec_id long, embedding array<double>")
    want = sorted(((math.floor(1024 * edge[0][1][0]) * math.floor(1024 * v[0]), i) for i, v in edge[1:]), reverse=True)
    assert [(r.score, r.vec_id) for r in topk.exact_top_k(df, "id % 100 = 0").orderBy("rank").collect()] == want
    for far in (2.0 ** 22, 1e30, 1e308):
        with pytest.raises(Exception, match="does not fit"):
            topk.exact_top_k(df.union(spark.createDataFrame([(3, [far])], df.schema)), "id % 100 = 0").collect()


def test_forest_recall_and_exact_scores(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = {r[0]: np.asarray(r[1], float) for r in df.select("vec_id", "embedding").collect()}
    got = defaultdict(list)
    for q, _, i, s in sorted(map(tuple, ann.forest_search(df, "id % 20 = 0").collect())):
        assert abs(s - rows[q] @ rows[i]) < 1e-12 and i != q
        got[q].append((-s, i))
    hit = 0
    for q, found in got.items():
        assert found == sorted(found) and len(found) == 20
        best = sorted((-(rows[q] @ v), i) for i, v in rows.items() if i != q)[:20]
        hit += len({i for _, i in best} & {i for _, i in found})
    assert hit / (20 * len(got)) >= 0.9
    small = [VECTORS, [(0, [1.0, 0.0]), (1, [-1.0, 0.0])], [(i, [math.cos(i), math.sin(i)]) for i in range(5)], [(0, [1.0])],
             [(i % 7 * 20, [math.cos(i), math.sin(3 * i), 0.1]) for i in range(40)]]
    for rows, k in [(r, k) for r in small for k in (1, 3, 20)]:  # a full offer: all candidates, if fewer than k; k of them at least
        ok = [(i, list(v) + [0.0] * (3 - len(v))) for i, v in rows if i is not None and v and any(v) and all(x is not None and math.isfinite(x) for x in v)]
        got = defaultdict(list)
        for q, _, i, s in sorted(map(tuple, ann.forest_search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "id % 20 = 0", k=k).collect())):
            got[q].append((i, round(s, 9)))
        for q in {i for i, _ in ok if i % 20 == 0}:
            own = min((v for i, v in rows if i == q and v and any(v)))
            own = own + [0.0] * (3 - len(own))
            others = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in ok if i != q)
            assert len(got[q]) == min(k, len(others))
            if k >= len(others):
                assert Counter(got[q]) == Counter((i, round(-s, 9)) for s, i in others)


def test_url_rules_and_cascade(spark):
    urls = [(1, "http://A.com/x"), (2, "https://example.com/en/1"), (3, "http://www.example.com/en/?q"), (4, "http://m.example.com/en/"), (5, "http://b.net/es/1#t"),
            (6, "http://b.net/en/"), (7, None), (8, "nothing"), (9, "http://com"), (10, "http://acom/x"), (11, "http://cheap-pills.net/en/"), (12, "http://w.cheap-pills.net/"),
            (6, "http://b.net/en/"), (None, "x://h.org?a/b"), (13, "http://h.org/" + "p" * 50_000)]
    df = spark.createDataFrame(urls, "page_id long, url string").withColumn("host", F.lit("clash"))
    out = url_filter.judge_urls(df, queries.URL_RULES, url_filter.hosts_with_words(df, queries.LISTED_WORDS))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    assert out.count() == len(urls)
    assert got[1] == ("a.com", "/x", "com/", "allow") and got[2][2:] == ("example.com/en/", "block")
    assert got[3] == ("www.example.com", "/en/", "www.example.com/en/", "allow") and got[4][2:] == ("example.com/en/", "block")
    assert got[5][2:] == ("net/es/", "block") and got[6][2:] == (None, "allow") and got[7] == ("", "", None, "allow") == got[8]
    assert got[9] == ("com", "", None, "allow") and got[10][2] is None and got[11][2:] == (None, "block") == got[12][2:]
    assert got[None] == ("h.org", "", None, "allow") and len(got[13][1]) == 50_001
    joined = url_filter.judge_urls(df, queries.URL_RULES, url_filter.hosts_with_words(df, queries.LISTED_WORDS), max_filter_bytes=0)
    assert plain(joined, "page_id", "host", "verdict") == plain(out, "page_id", "host", "verdict")
    keys = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"))
    cascade = url_filter.build_cascade(keys, keys.where("substr(key, 2) % 3 = 0"))
    assert cascade.holds([f"k{i}" for i in range(4000)]).tolist() == [i % 3 == 0 for i in range(4000)]
    few = keys.where("substr(key, 2) < 40")
    sizes = {}
    for n in (400, 40_000):  # a hundred times the universe: the filter grows by its logarithm, not by the keys let through
        every = spark.range(n).select(F.concat(F.lit("k"), "id").alias("key"))
        cascade = build = url_filter.build_cascade(every, few)
        sizes[n] = build.bytes
        assert cascade.holds([f"k{i}" for i in range(n)]).tolist() == [i < 40 for i in range(n)]
    assert sizes[40_000] <= 4 * sizes[400] and url_filter.build_cascade(every, few, max_bytes=16) is None


def test_quotation_linking(spark):
    rows = [(1, 0, "u", "Hello there\nHow are you?\n\nSecond para"), (1, 1, "a", "Fine thanks"), (1, 2, "u", "> How are  YOU?\nstill asking"),
            (1, 3, "a", ">> how are you?\n> still asking\nok"), (1, 4, "u", None), (1, 5, "a", "> nothing like it\n"), (None, 1, "a", "> Fine thanks"),
            (1, None, "u", "x"), (2, 0, "u", "Fine thanks"), (2, 1, None, ">Fine thanks"), (2, 1, None, ">Fine thanks"), (3, 0, "u", "say " * 20_000)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").withColumn("key", F.lit("clash"))
    out = chat.format_conversations(df)
    got = {(r.conv_id, r.turn): r for r in out.collect()}
    assert out.count() == len(rows)
    assert [(got[1, t].reply_to, got[1, t].thread, got[1, t].depth) for t in range(6)] == [(None, 0, 0), (None, 1, 0), (0, 0, 1), (2, 0, 2), (None, 4, 0), (None, 5, 0)]
    assert (got[1, 3].n_quotes, got[1, 3].n_linked, got[1, 3].text) == (2, 2, "ok")
    assert [r.turn for r in out.where("conv_id = 1").orderBy("position").collect()] == [None, 0, 2, 3, 1, 4, 5]
    assert got[2, 1].reply_to == 0 and got[2, 1].text == "" and got[None, 1].reply_to is None
    assert plain(out.where("conv_id = 2"), "position") == [(0,), (1,), (2,)]


def test_language_fusion(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(900, None, "en", "s"), (901, "", "fr", None), (902, "12 !!", None, "src0"), (903, "der die und schverkeit " * 3000, "de", "src0"), (903, "the and of", None, None)],
                                "doc_id long, text string, lang string, source string")
    every = docs.unionByName(odd, allowMissingColumns=True).withColumn("like", F.lit("clash"))
    got = [r for r in language_id.identify_documents(every, {"doc_id": F.col("doc_id"), "lang": F.col("lang")}).collect()]
    assert len(got) == every.count()
    clean = [r for r in got if r.doc_id < 900]
    assert all(r.accepted for r in clean) and sum(r.language == r.lang for r in clean) >= 0.98 * len(clean)  # the labels are the declared languages
    assert {r.language for r in got if r.doc_id in (900, 901, 902)} == {"und"} and all(not r.accepted for r in got if r.doc_id in (900, 901, 902))
    held = docs.where("doc_id % 5 = 0")
    model = language_id.fit(docs.where("doc_id % 5 <> 0"), "text", "lang", "doc_id")
    told = language_id.identify(held, model, "text", carry={"lang": F.col("lang")}).collect()  # text alone, unseen
    assert sum(r.text_language == r.lang for r in told) >= 0.97 * len(told)
    pages = language_id.identify_pages(spark.read.parquet(f"{SF}/pages.parquet"), docs).collect()
    assert sum(r.language == r.url.split("/")[3] for r in pages) >= 0.97 * len(pages)


def test_every_labelled_language_has_a_model(spark):
    rnd, rows = random.Random(4), []
    for i in range(90):  # each in letters of its own, under three spellings of its label
        letters = [chr(0x4E00 + 40 * i + j) for j in range(40)]
        code = f"q{chr(97 + i // 26)}{chr(97 + i % 26)}"
        for n in range(3 if i >= 80 else 6):  # the last ones are the rarest
            text = " ".join("".join(rnd.choices(letters, k=rnd.randint(2, 6))) for _ in range(80))
            rows.append((len(rows), text, [code, f"{code.upper()}-US", f"{code}_GB"][n % 3], None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    assert language_id.fit(docs, "text", "lang", "doc_id").names == sorted({r[2][:3].lower() for r in rows})
    got = language_id.identify_documents(docs, {"lang": F.col("lang")}).collect()
    assert len(got) == len(rows) and all(r.accepted and r.language == r.lang[:3].lower() == r.text_language for r in got)


def article(html):
    inner = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    from html import unescape
    return "\n".join(t for t in (" ".join(unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:h1|p)>", inner)) if t)


def test_html_extraction(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    trees = html_extract.train(pages)
    out = {r.page_id: r for r in html_extract.extract(pages, trees).collect()}
    for i, html in pages.select("page_id", "html").collect():
        assert out[i].text == article(html) and out[i].n_chars == len(out[i].text)
    right = total = 0  # layouts that were not among the examples
    for k, (html,) in enumerate(pages.select("html").limit(80).collect()):
        main, other = html_extract._by_tag(html)
        rnd = random.Random(k + 999)
        nodes, runs = dom.parse(html_extract.layout(rnd, main[:6], [" ".join(t.split()[:9]) for t in other + main], main[:4]))
        kept, label = dom.decode(nodes, trees.probability(dom.features(nodes))), html_extract._labels(nodes)
        inside = {}  # nothing is kept below a node that was dropped inside a kept one
        for i, n in enumerate(nodes):
            up = inside.get(id(n.parent), 0)
            assert not (up == 2 and kept[i])
            inside[id(n)] = 2 if up == 2 else 1 if kept[i] else 2 if up == 1 else 0
        right += sum(bool(kept[i]) == (label[i] == 1) for i, _ in runs)
        total += len(runs)
    assert right / total >= 0.97
    odd = spark.createDataFrame([(1, None, None), (2, "u", ""), (2, "u", ""), (3, "u", "<p>a<p>b &amp; c<br>d<script>x</p>"), (4, "u", "<article><p>" + "word " * 50_000)], "page_id long, url string, html string")
    got = html_extract.extract(odd.withColumn("text", F.lit("clash")), trees).collect()
    assert len(got) == 5 and all(r.text == "" for r in got if r.page_id in (1, 2))
    assert [t for _, t in dom.parse("<div>x<p>a<p>b &amp; c<br>d<script>x</p></script>e</div>f <b>g")[1]] == ["x", "a", "b & c de", "f g"]


def test_html_without_semantic_tags(spark):
    docs = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    rows, want = [], {}
    for i, text in enumerate(docs):
        words = text.split()[:300]
        paragraphs = [" ".join(words[a:a + 50]) for a in range(0, len(words), 50)]
        menu = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in words[:6])
        body = "".join(f"<p>{escape(p)}</p>" for p in paragraphs)
        rows.append((i, "u", f'<html><body><div class="menu"><ul>{menu}</ul></div><div class="content">{body}</div><div class="footer">&copy; {words[0]}</div></body></html>'))
        want[i] = "\n".join(paragraphs)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(pages).collect()}
    assert sum(got[i] == want[i] for i in want) >= 0.95 * len(want)
    menu_only = "<nav><a href='/a'>Home and some other words</a></nav><div><p>Words of the page</p></div>"
    assert html_extract._fill(menu_only)[0] == ["Words of the page"] and not html_extract._fill("<nav>Home</nav>")[0]


def test_html_options_and_text_under_the_page(spark):
    search = "<form><input list=x><datalist id=x><option value=a>one<option value=b><b>two</b><optgroup><option>three</datalist></form>"
    assert [t for _, t in dom.parse(f"<body>{search}<article><p>Kept text</p></article>")[1]] == ["Kept text"]
    assert [t for _, t in dom.parse("a <select><option>b<option>c</select>d <option>e</option>f")[1]] == ["a d f"]
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    trees = html_extract.train(pages)
    assert html_extract.main_text("Plain <b>words</b>", trees) == "Plain words"
    texts = [article(html).split("\n") for (html,) in pages.select("html").limit(60).collect()]
    right = total = 0
    for i, paragraphs in enumerate(texts):
        long = [p for p in paragraphs if len(p) > 60][:6]
        if long:
            inner = "<br>".join(f"{escape(p)}" for p in long)
            for html in (inner, f"<!DOCTYPE html><title>t</title><nav><a href='/'>Home</a> <a href='/b'>News</a></nav>{inner}<footer>&copy; 2020</footer>",
                         f"<html><body><h1>{escape(long[0][:30])}</h1>{inner}</body></html>"):
                got = html_extract.main_text(html, trees)
                right, total = right + (" ".join(long) in got.replace("\n", " ") and "News" not in got), total + 1
    assert total > 100 and right >= 0.95 * total


def test_html_keeps_fallback_formulas_and_unknown_elements():
    def blocks(html):
        return [t for _, t in dom.parse(html)[1]]

    assert blocks("<article><p>a</p><iframe src=x><p>b text</p></article>c") == ["a", "b text", "c"]
    for tag in ("noscript", "svg", "math", "object", "video"):
        assert blocks(f"<article><p>a</p><{tag}><p>b text</p></article>c") == ["a", "b text", "c"]
    assert blocks("<div><p>a</p><textarea>typed</div><p>b</p>") == ["a", "b"] == blocks("<div><p>a</p><textarea>typed</textarea></div><p>b</p>")
    assert blocks("<title>head<p>b</p>") == ["b"] and blocks("<div>a<script>x = 1</div>b") == ["a", "b"] and blocks("a<style>p {}") == ["a"]
    assert blocks("<p>area <math><mi>x</mi></math> is big</p>") == ["area x is big"]
    assert blocks("<p>one <nobr>two</nobr> <picture><img></picture>three <x-note>four</x-note> five</p>") == ["one two three four five"]
    assert blocks("<x-card><h2>a</h2><p>b</p></x-card>c") == ["a", "b", "c"]
    nodes, _ = dom.parse('<x-card class="sidebar"><p>b</p></x-card><p>c</p>')
    assert [x.tag for x in nodes] == ["#page", "x-card", "p", "p"] and nodes[3].parent is nodes[0]
    assert blocks("<p>if a<b then c</p><p>1 < 2 <3</p>") == ["if a<b then c", "1 < 2 <3"]


def test_pages_to_learn_from_do_not_depend_on_the_table_around_them(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html")
    many = pages.unionByName(pages).unionByName(spark.createDataFrame([(1, None), (2, "")], pages.schema))
    one, two = (html_extract.train(p, sample=20) for p in (pages, many))  # repeated pages count once; a bound or none chooses the same
    assert all((a == b).all() for a, b in zip(one.trees, two.trees))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    vecs = spark.createDataFrame([], "vec_id long, embedding array<float>")
    chats = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    for out in (bpe.bpe_round_trip(docs, RANKS, P.PATTERN), packing.pack(docs, WORDS), exact_substring.repeat_digests(docs), near_dup.near_duplicates(docs),
                language_id.identify_documents(docs, {"doc_id": F.col("doc_id")}), language_id.identify_pages(pages, docs), html_extract.extract(pages),
                url_filter.judge_urls(pages, queries.URL_RULES, url_filter.hosts_with_words(pages, ("x",))), topk.exact_top_k(vecs, "id % 100 = 0"),
                ann.forest_search(vecs, "id % 20 = 0"), chat.format_conversations(chats)):
        assert out.count() == 0


@pytest.mark.parametrize("key", sorted(oracles.ORACLES))
def test_query_equals_its_sql(spark, key):
    ok, said = compare(queries.QUERIES[key](spark, SF), duck(SF), oracles.ORACLES[key])
    assert ok, said


def test_pipeline_stages(spark, documents):
    import corpus_pipeline as cp

    docs = documents.select("doc_id", "text").withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("bigint"), "node": F.lit(1)})
    at = documents.sparkSession.conf.get("spark.checkpoint.dir") + f"/pipeline-{random.random()}"
    kept = []
    for n, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, SF)
        assert n == len(cp.STAGES) - 1 or out.columns == cp.COLUMNS
        out.write.parquet(f"{at}/{name}")
        before, docs = docs, spark.read.parquet(f"{at}/{name}")
        kept.append((before.select("doc_id", "text").collect(), docs.collect()))
    assert [n for n, _ in cp.STAGES] == ["language_id", "near_dedup", "substring_dedup", "best_fit_packing"]
    judged, got = kept[0]
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r.doc_id, r.text) for r in judged if any(map(str.isalpha, r.text or "")))
    before, got = kept[1]
    keep = {(r[0], t) for r, (_, t) in zip(brute_components([(r.doc_id, r.text) for r in before]), [(r.doc_id, r.text) for r in before]) if r[3]}
    assert {(r.doc_id, r.text) for r in got} == keep and len(got) == len(keep)
    before, got = kept[2]
    left = [(i, b.decode("utf-8", "ignore")) for i, n, _, _, b in without_repeats([(r.doc_id, r.text or "") for r in before]) if b or not n]
    assert Counter((r.doc_id, r.text) for r in got) == Counter(left) and all(len(r.text) == r.n_chars for r in got)
    before, got = kept[3]
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == Counter(pieces([(r.doc_id, r.text) for r in before], 4096))
    gapless(got, 4096)
    assert len({r.sequence_id for r in got}) == best_fit_decreasing([r.length for r in got], 4096)
