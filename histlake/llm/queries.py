"""Corpus operators as queries over the driver tables; digests only, by fixed contracts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histlake.llm import bpe, decontaminate, html_wrapper, language, oracle, pii, quality, simhash, substring, suffix_repeats, token_alignment, toxicity, url_reputation, vector_codes
from histlake.llm.common import crc_mod


URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document; labels are learnt from four of five rows."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").where(crc_mod(F.col("doc_id"), 5) != 0)
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs, model).select(
        "doc_id",
        (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op3_html_wrapper(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html_wrapper.extract(table(spark, folder, "pages"))


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words and items of the benchmark in every document, and the verdict."""
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op5_url_reputation(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page's url."""
    found = url_reputation.judge(table(spark, folder, "pages"), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document: base counts and digest, and all spans."""
    return pii.digests(table(spark, folder, "documents"))


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document, those in passages that occur earlier, and the digest of the rest."""
    found = substring.remove(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of every document, whether it fails the base rules, and the verdict."""
    found = quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts and digests of ids and of decoded bytes, for every document."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learnt from two of three rows."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    prototypes = language.fit(docs.where(~held_out))
    found = language.predict(docs, prototypes)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of two tokenizers' tokens of every document, and how usual its links are."""
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.digests(table(spark, folder, "documents"), a, b)


def op12_suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of every document, those in strings that occur earlier, and the digest of the rest."""
    found = suffix_repeats.remove(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Product code of every usable vector, its error and that of its label."""
    found, books = vector_codes.compress(table(spark, folder, "embeddings"))
    return found.select("vec_id", "code", "error", "label_error", F.lit(vector_codes.books_sha256(books)).alias("codebooks_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_simhash, op3_html_wrapper, op4_decontamination, op5_url_reputation, op6_pii, op7_substring_dedup, op8_quality_rules, op9_byte_bpe, op10_language_id, op11_token_alignment, op12_suffix_repeats, op13_vector_codes)}


def oracle_sql() -> dict[str, str]:
    return {op5_url_reputation.__name__: oracle.URL_REPUTATION}
