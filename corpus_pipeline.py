"""The corpus pipeline: language ID, near-dedup, substring dedup and packing over ``documents``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's docs. All but the last
return the columns of ``documents``. Other columns of the input are not passed on.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import exact_substring, language_id, near_dup, packing
from ledgerlens.llm.common import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Rejected documents (two longs each) are broadcast up to this many, and joined beyond.
MAX_BROADCAST = 500_000


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the corpus's languages; those without a letter, or in none of the
    languages, go. A null text goes."""
    key = {"id": F.col("doc_id"), "name": F.xxhash64("text")}  # the texts themselves stay where they are
    judged = language_id.identify_documents(docs, key)
    gone = stored(judged.where(~F.col("accepted")).select("id", "name").distinct(), "rejected")
    few = gone.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST
    same = key["id"].eqNullSafe(F.col("id")) & (key["name"] == F.col("name"))
    return docs.join(F.broadcast(gone) if few else gone, same, "left_anti").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of smallest id; of rows that repeat
    an id and a text, one. Rows without an id stay: nothing can name them."""
    docs = docs.select(*COLUMNS)
    kept = near_dup.near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return named.select(*COLUMNS).unionByName(docs.where("doc_id is null"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings that a document of smaller id has; documents of which
    nothing is left go."""
    out = exact_substring.remove_repeats(docs, 50, carry=("lang", "source"), as_text=True)
    out = out.where("n_bytes = 0 or n_removed < n_bytes").withColumnRenamed("kept", "text")
    return out.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token piece with its sequence and offset."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", pack),
]

#: Fitted models and tokenizers cannot be said in SQL; tests hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
