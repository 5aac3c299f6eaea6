"""Filter audit, periodic runs and spot signatures against brute force, and on awkward tables."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import filter_audit, periodic_runs, queries, spotsigs

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"
#: Null, empty, blank, odd white space, repeated, repeated id with another text, no id, long, other scripts.
TEXTS = [(900, None, None), (901, "", "a"), (902, " \t\n", "a"), (903, " lead x\n  y \n z\n \nq  w   e ", None), (904, "A\tB don't 12ab, X.y#  ", "b"),
         (905, "it's  a\x1c test\x1c x　y 's", "b"), (905, "it's  a\x1c test\x1c x　y 's", "b"), (906, "one two three", "c"), (907, "One  TWO three", ""),
         (908, "long way " * 9000, "a"), (None, "long way " * 9000, "a"), (None, None, None), (909, "中文 и русский ᵃⅣ² 😀 éé", "c"),
         (909, "another text under one id, with enough words in it", "c"), (-4, "one two three", "c"), (910, "one two three", "c"),
         (911, "a b a b a b a b a b c c c c c c c", "c"), (912, "x " + "p q r " * 5 + "p q s", "d")]


@pytest.fixture(scope="module")
def documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").limit(150)
    clash = {c: F.lit(c) for c in ("c0", "c1", "part", "id", "mask", "digest", "words", "runs", "n", "at", "own", "w", "a", "p", "g", "span")}
    return docs.unionByName(spark.createDataFrame(TEXTS, "doc_id long, text string, source string")).withColumns(clash).repartition(5).cache()


def split(text):
    for c in SPACE:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def test_filter_audit_by_brute_force(spark, documents):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (905, 1, 1), (906, 1, None), (906, None, 1), (None, 1, 1), (908, 1, 0), (77777, 1, 1)] + [(i, i % 2, i % 3 == 0) for i in range(20, 120)],
                                   "doc_id long, quality int, toxic int") if False else \
        spark.createDataFrame([(1, 1, 0), (2, 0, 1), (905, 1, 1), (906, 1, None), (906, None, 1), (None, 1, 1), (908, 1, 0), (77777, 1, 1)] + [(i, i % 2, int(i % 3 == 0)) for i in range(20, 120)],
                              "doc_id long, quality int, toxic int")
    marks = [tuple(r) for r in labels.collect()]
    good, toxic = {i for i, q, _ in marks if q == 1 and i is not None}, {i for i, _, t in marks if t == 1 and i is not None}
    rows = [(r.doc_id, r.text or "", r.source or "") for r in documents.collect()]
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t] = min(least.get(t, i), i)
    fails = []
    for i, t, _ in rows:
        w = split(t)
        fails.append({"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
                      "D": any(c in "#$%&*|" for c in t), "E": i is not None and least[t] < i})
    want = {}
    for part in {p for _, _, p in rows}:
        own = [(i, f) for (i, _, p), f in zip(rows, fails) if p == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                lost = [x for x in left if x[1][name]]
                left = [x for x in left if not x[1][name]]
                shapley[name] += len(lost)
                want[part, "".join(order), step] = [len(left), len(lost), sum(f[name] for _, f in own) - len(lost), sum(f[name] and sum(f.values()) == 1 for _, f in own),
                                                    sum(i in good for i, _ in lost), sum(i in toxic for i, _ in lost), name]
        for key in want:
            if key[0] == part:
                want[key][6] = shapley[want[key][6]]
    docs = documents.withColumn("split", filter_audit.words(F.coalesce("text", F.lit(""))))
    text = F.coalesce("text", F.lit(""))
    filters = {"A": F.size("split") < 200, "B": 100 * F.size(F.array_distinct("split")) < 50 * F.size("split"),
               "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]", "")) > 2 * F.length(text), "D": F.col("text").rlike("[#$%&*|]"), "E": filter_audit.REPEATS}
    for width in (1 << 16, 7):
        out = filter_audit.audit(docs, filters, F.col("source"), labels, width=width).collect()
        assert {tuple(r[:3]): list(r[3:]) for r in out} == want and len(out) == len(want)
    plain = filter_audit.audit(docs, {"A": filters["A"], "D": filters["D"]}, F.lit(None)).collect()  # one part, no labels
    assert len(plain) == 4 and {r.part for r in plain} == {""} and all(r.kept + r.removed <= len(rows) and r.good_lost == 0 for r in plain)


def test_posting_lists():
    import numpy as np

    rnd = random.Random(4)
    for _ in range(300):
        sets = [sorted(rnd.sample(range(40), rnd.randint(0, 40))) for _ in range(4)]
        lists = [np.array(s, np.int64) for s in sets]
        assert filter_audit.union(lists).tolist() == sorted(set().union(*sets))
        assert filter_audit.difference(lists[0], lists[1]).tolist() == sorted(set(sets[0]) - set(sets[1]))
        repeated = np.sort(np.concatenate([lists[0], lists[0]]))
        assert filter_audit._found(repeated, lists[1]).tolist() == [x in sets[1] for x in repeated]


def lyndon(s):
    return [max(j - i for j in range(i + 1, len(s) + 1) if all(s[i:j] < s[k:j] for k in range(i + 1, j))) for i in range(len(s))]


def test_lyndon_arrays_by_definition():
    rnd = random.Random(1)
    for _ in range(800):
        s = [rnd.randint(0, 2) for _ in range(rnd.randint(1, 13))]
        for order in (s, [2 - c for c in s]):
            group, length = periodic_runs.lyndon_groups(order, 3)
            want = lyndon(order)
            assert [length[g] for g in group] == want
            words = [tuple(s[i:i + n]) for i, n in enumerate(want)]
            assert all((group[i] == group[j]) == (words[i] == words[j]) for i in range(len(s)) for j in range(len(s)))


def brute_runs(w, least, times):
    out, n = [], len(w)
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q) and not any(all(w[k] == w[k + r] for k in range(i, j + q - r)) for r in range(1, q)):
                out.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    rnd = random.Random(2)
    for _ in range(2500):
        n, k = rnd.randint(0, 60), rnd.choice([1, 2, 2, 3, 6])
        w = [b"abcdefgh"[c:c + 1] for c in (rnd.randrange(k) for _ in range(n))]
        if n and rnd.random() < 0.6:
            a, p = rnd.randrange(n), rnd.randint(1, 8)
            root = w[a:a + p]
            w[a:] = [root[i % len(root)] for i in range(n - a)]
        for least, times in ((6, 4), (2, 2), (3, 3)):
            assert periodic_runs.find_runs(w, least, times) == brute_runs(w, least, times)
    long = [b"a", b"b"] * 50_000
    assert periodic_runs.find_runs([b"x", *long, b"x"]) == [(1, 100_000, 2)]


def test_planted_runs_query_by_brute_force(spark, documents, tmp_path):
    folder = str(tmp_path)
    documents.write.parquet(f"{folder}/documents.parquet")
    want = []
    for i, t in documents.select("doc_id", "text").collect():
        w = split(t or "")
        n, h = len(w), -1 if i is None else zlib.crc32(str(i).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        if n > 5000:  # the long text: all of it is one run
            runs = [(0, n, 2)]
        else:
            runs = brute_runs(w, 6, 4)
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((i, len(runs), *(best or (None,) * 3), None if best is None else 1000 * best[1] // best[2],
                     sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    got = queries.op12_periodic_runs(spark, folder)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 6 + ["string"] * 2
    assert Counter(map(tuple, got.collect())) == Counter(want)
    out = periodic_runs.periodic_runs(documents.where("doc_id = 912")).first()
    assert [tuple(r) for r in out.runs] == [(1, 17, 3)] and out.collapsed == "x p q r s" and out.n_words == 19


def spots(text, common):
    for c in SPACE + "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~":
        text = text.replace(c, " ")
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in text.split(" ") if w]
    out = set()
    for i, w in enumerate(words):
        if w in common or (i >= 16 and not any(x in common for x in words[i - 16:i]) and len(w.encode()) % 4 == 0):
            chain = [x for x in words[i + 1:] if x not in common][:2]
            if chain:
                out.add(hashlib.md5(" ".join([w, *chain]).encode()).hexdigest()[:8])
    if words and not out:
        out.add(hashlib.md5(" ".join(words).encode()).hexdigest()[:8])
    return words, out


def jaccard(a, b):
    if not a or not b:
        return float(len(a) == len(b))
    got = len(a & b) / len(a | b)
    return got if got >= 0.05 else 0.0


def brute_spots(rows, share=0.02):
    counts = Counter(w for _, t in rows for w in set(spots(t, ())[0]))
    common = {w for w, n in counts.items() if n >= share * len(rows)}
    first = {}
    for i, t in rows:
        if i is not None:
            first[i] = min(first.get(i, t), t, key=str.encode)
    down = sorted(first, reverse=True)
    after = {i: first[down[(k + 1) % len(down)]] for k, i in enumerate(down)}
    want = []
    for i, t in rows:
        n, nxt = len(t), "" if i is None else after[i]
        edited = t[:n - n // 3] + nxt[:n // 3]
        a, b, c = spots(t, common)[1], spots(edited, common)[1], spots(nxt, common)[1]
        want.append((i, n, edited, "".join(sorted(a)), "".join(sorted(b)), jaccard(a, b), None if i is None else jaccard(a, c)))
    return want


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_spot_signatures_by_brute_force(spark, documents, parts):
    rows = [(r.doc_id, r.text or "") for r in documents.where("doc_id is null or doc_id <> 908").collect()]
    out = spotsigs.compare_with_edits(documents.where("doc_id is null or doc_id <> 908"), parts=parts)
    assert Counter(map(tuple, out.collect())) == Counter(brute_spots(rows))


def test_spot_signatures_of_an_id_with_most_rows(spark):
    rows = [(5, f"the text number {i % 3} of a common id and its words") for i in range(60)] + [(4, "the one before it, and more"), (9, "the last of them and words"), (5, "a least text")]
    for some in (rows, rows[:60], rows[-1:]):
        df = spark.createDataFrame(some, "doc_id long, text string").repartition(4)
        out = spotsigs.compare_with_edits(df, parts=8)
        assert Counter(map(tuple, out.collect())) == Counter(brute_spots(some))


def test_spot_likeness():
    sets = [set(range(n)) for n in (0, 1, 2, 19, 20, 21, 39, 41, 399, 401, 8000)]
    for a in sets:
        for b in sets:
            assert spotsigs.likeness(a, b) == jaccard(a, b)
    prose = [f"w{i}" if i % 3 else "the" for i in range(600)]
    s = spotsigs.Spots({__import__("xxhash").xxh3_64_intdigest(b"the")})
    a, b = s.signatures(" ".join(prose)), s.signatures(" ".join(prose[:300] + ["changed"] + prose[301:]))
    assert 0.95 < spotsigs.likeness(a, b) < 1 and spotsigs.fingerprint(a) == spotsigs.fingerprint(s.signatures("  ".join(prose).upper()))


def test_fingerprints_agree_with_the_comparison(spark, documents):
    common = spotsigs.common_words(documents)
    one = {(r.doc_id, r.fingerprint) for r in spotsigs.fingerprints(documents, common).collect()}
    assert one == {(r.doc_id, r.fingerprint) for r in spotsigs.compare_with_edits(documents).collect()}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    filters = {"A": F.length("text") < 5, "E": filter_audit.REPEATS}
    for out in (filter_audit.audit(docs, filters, F.col("source"), labels), periodic_runs.periodic_runs(docs), spotsigs.compare_with_edits(docs),
                spotsigs.fingerprints(docs, set())):
        assert out.count() == 0
    some = spark.createDataFrame([(1, "abc", "s")], docs.schema)
    assert filter_audit.audit(some, filters, F.col("source"), labels).count() == 4
