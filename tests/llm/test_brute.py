"""Quotation linking and language evidence against plain Python over whole rows."""

import random
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from ledgerlens.llm import chat, language_id

SF = "/root/testdata/sf0.001"
SPACE = r"[ \t\n\x0b\f\r]"


def normal(text):
    return re.sub(SPACE + "+", " ", text).strip(" ").lower()


def own_text(text):
    lines = [x for x in (text or "").split("\n") if not re.match(r"[ \t]*>", x)]
    return re.sub(rf"\A{SPACE}+|{SPACE}+\Z", "", "\n".join(lines))


def passages(text):
    """(level, line, 0 passage or 1 line, body) of the quoted parts."""
    out, run, last = [], [], 0
    for n, line in enumerate([*text.split("\n"), None]):
        marks = re.match(r"[ \t]*(?:>[ \t]?)+", line).group() if line is not None and re.match(r"[ \t]*>", line) else ""
        level = marks.count(">")
        if run and (level != last or line is None):
            out.append((last, run[0][0], 0, "\n".join(b for _, b in run)))
            out += [(last, k, 1, b) for k, b in run]
            run = []
        if level:
            run.append((n, line[len(marks):]))
        last = level
    return [p for p in out if normal(p[3])]


def brute_threads(rows):
    said = defaultdict(dict)
    for conv, turn, _, text in rows:
        if conv is not None and turn is not None:
            own = own_text(text)
            for unit in {own, *re.split(rf"\n{SPACE}*\n", own), *own.split("\n")}:
                if normal(unit):
                    said[conv][normal(unit)] = min(said[conv].get(normal(unit), turn), turn)
    reply, counts = {}, defaultdict(lambda: (0, 0))
    for conv, turn, text in {(c, t, x) for c, t, _, x in rows if c is not None and t is not None and x is not None}:
        for level, line, part, body in passages(text):
            at = said[conv].get(normal(body))
            at = at if at is not None and at < turn else None
            if part == 0:
                n, m = counts[conv, turn]
                counts[conv, turn] = (n + 1, m + (at is not None))
            if at is not None:
                reply.setdefault((conv, turn), []).append((level, part, line, at))
    reply = {k: min(v)[3] for k, v in reply.items()}
    out = []
    for conv, turn, role, text in rows:
        thread, depth = turn, 0
        while (conv, thread) in reply and conv is not None:
            thread, depth = reply[conv, thread], depth + 1
        n, m = counts[conv, turn] if conv is not None and turn is not None else (0, 0)
        out.append((conv, thread, turn, role, own_text(text), reply.get((conv, turn)) if conv is not None else None, depth, n, m))
    nulls_first = lambda r: tuple((x is not None, x if x is not None else 0) for x in r)
    out.sort(key=lambda r: (*nulls_first(r[:4]), r[4].encode()))
    at, last, done = 0, object(), []
    for conv, thread, turn, role, text, to, depth, n, m in out:
        at = at + 1 if conv == last else 0
        last = conv
        done.append((conv, at, turn, role, to, thread, depth, n, m, text))
    return done


def test_quotation_linking_by_brute_force(spark):
    rnd = random.Random(12)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    for conv in range(10_000, 10_030):
        told = []
        for turn in range(rnd.randint(1, 14)):
            lines = []
            for _ in range(rnd.randint(0, 3)):
                if told and rnd.random() < 0.7:  # quote a message, or some line of it, one level deeper
                    old = rnd.choice(told).split("\n")
                    old = old if rnd.random() < 0.6 else [rnd.choice(old)]
                    lines += [rnd.choice(["> ", ">", " >  "]) + (x.upper() if rnd.random() < 0.2 else x.replace(" ", "  ") if rnd.random() < 0.2 else x) for x in old]
                if rnd.random() < 0.7:
                    lines += [" ".join(rnd.choice("yes no maybe so well now then".split()) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(1, 2))]
                if rnd.random() < 0.3:
                    lines.append("")
            told.append("\n".join(lines))
            rows.append((conv, turn, rnd.choice(["user", "assistant", None]), told[-1]))
            if rnd.random() < 0.1:
                rows.append(rows[-1])
    rows += [(None, 1, "u", "> yes"), (10_001, None, "u", "> no"), (10_002, 3, "u", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = [(r.conv_id, r.position, r.turn, r.role, r.reply_to, r.thread, r.depth, r.n_quotes, r.n_linked, r.text) for r in chat.format_conversations(df).collect()]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(got, key=key) == sorted(brute_threads(rows), key=key)
    assert sum(r[4] is not None for r in got) > 60 and max(r[6] for r in got) >= 3


def test_fusion_of_evidence_by_its_formula(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = spark.createDataFrame([(900, None, "en", "src1"), (901, "", "fr", None), (902, "12 !!", None, "src0"), (903, "le", None, None), (904, "the", "de", "new host")], docs.schema)
    docs = docs.unionByName(odd).withColumn("end", F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("e"), (F.col("doc_id") % 4).cast("string"))))
    model = language_id.fit(docs, "text", "lang", "doc_id")
    out = language_id.identify(docs, model, "text", declared="lang", host="source", suffix="end", carry={"doc_id": F.col("doc_id")})
    rows = docs.collect()
    k = len(model.names) + 1
    like, lettered = np.zeros((len(rows), k)), np.array([any(map(str.isalpha, r.text or "")) for r in rows])
    for n, r in enumerate(rows):
        if r.text:
            like[n] = 0.3 * model.log_likelihood(language_id.grams(r.text))
            like[n, -1] -= 20
            like[n] -= like[n].max()
    p = np.exp(like)
    p /= p.sum(axis=1, keepdims=True)
    p_own = p * lettered[:, None]

    def sums(name):
        by = defaultdict(lambda: np.zeros(k))
        for n, r in enumerate(rows):
            if r[name] is not None:
                by[r[name]] += p_own[n]
        return by

    prior = p_own.sum(axis=0) + 1
    prior /= prior.sum()
    said, ends, hosts = sums("lang"), sums("end"), sums("source")
    said_total = sum(said.values())
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows)
    for n, r in enumerate(rows):
        above = prior
        for name, by in (("end", ends), ("source", hosts)):
            if r[name] is not None:
                mixed = np.maximum(by[r[name]] - p_own[n], 0) + 20 * above
                above = mixed / mixed.sum()
        told = np.ones(k) if r.lang is None else (said[r.lang] + said[r.lang].sum() / said_total.sum()) / (said_total + 1)
        log = like[n] + np.log(above + 1e-300) + np.log(told + 1e-300)
        best = int(log.argmax())
        accepted = bool(lettered[n]) and best < k - 1
        mine = got[r.doc_id]
        assert (mine.accepted, mine.language) == (accepted, model.names[best] if accepted else "und"), r.doc_id
        assert abs(mine.probability - 1 / np.exp(log - log.max()).sum()) < 1e-9
