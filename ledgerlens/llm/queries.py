"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, bpe, chat, exact_substring, filter_audit, html_extract, language_id, near_dup, packing, periodic_runs, spotsigs,
               topk, url_filter)
from .common import table


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_round_trip(table(spark, sf_dir, "documents"),
                              public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), "id % 100 = 0", k=10, scale=1024)


def op3_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(table(spark, sf_dir, "conversations"))


#: (host, path prefix, verdict)
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]
#: Hosts with one of these words in a label are on the query's host list.
LISTED_WORDS = ("adult", "ads", "bets", "casino", "pills", "track")


def op4_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge_urls(pages, URL_RULES, url_filter.hosts_with_words(pages, LISTED_WORDS))


def op5_setsketch_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_substring.repeat_digests(table(spark, sf_dir, "documents"), length=50)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify_documents(docs, {"doc_id": F.col("doc_id")})


def page_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator over pages, which have all four kinds of evidence."""
    return language_id.identify_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op10_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.forest_search(table(spark, sf_dir, "embeddings"), "id % 20 = 0", k=20)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("words", filter_audit.words(F.col("text")))
    capitals = F.length(F.regexp_replace("text", "[^A-Z]", ""))
    filters = {
        "A": F.size("words") < 200,
        "B": 100 * F.size(F.array_distinct("words")) < 50 * F.size("words"),
        "C": 100 * capitals > 2 * F.length("text"),
        "D": F.col("text").rlike("[#$%&*|]"),
        "E": filter_audit.REPEATS,
    }
    return filter_audit.audit(docs, filters, F.col("source"), table(spark, sf_dir, "labels"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the tail of every tenth document (by the hash of its id) made periodic."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, filter_audit.words(F.col("text")))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("w"))
    rows = rows.withColumn("n", F.when(F.size("w") > 0, F.size("w")).cast("bigint")).withColumn("a", F.col("g") % F.col("n"))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    altered = F.expr("array_join(transform(w, (x, i) -> if(i < a, x, w[cast(a + (i - a) % p as int)])), ' ')")
    return rows.select("doc_id", F.when(F.col("n").isNotNull(), altered).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    best = F.expr("""array_sort(runs, (x, y) -> case
        when x.length * y.period <> y.length * x.period then if(x.length * y.period > y.length * x.period, -1, 1)
        when x.start <> y.start then if(x.start < y.start, -1, 1)
        else if(x.period < y.period, -1, if(x.period > y.period, 1, 0)) end)""")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    found = found.withColumn("best", F.when(F.size("runs") > 0, F.element_at(best, 1)))
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
                        F.col("best.period").alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare_with_edits(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_exact_top_k": op2_exact_top_k,
    "op3_quotation_linking": op3_quotation_linking,
    "op4_bloom_cascade": op4_bloom_cascade,
    "op5_setsketch_near_dup": op5_setsketch_near_dup,
    "op6_html_main_text": op6_html_main_text,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_language_id": op9_language_id,
    "page_language_id": page_language_id,
    "op10_hash_prefix_forest": op10_hash_prefix_forest,
    "op11_filter_audit": op11_filter_audit,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_spot_signatures": op13_spot_signatures,
}
