"""The registered queries of the corpus operators: each applies one to its whole table."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.columns import text_of
from tidewater.llm.hard_negatives import hard_negatives
from tidewater.llm.leaks import leaks
from tidewater.llm.licenses import find_licenses
from tidewater.llm.near_dedup import near_duplicates
from tidewater.llm.ngram_join import ngram_join
from tidewater.llm.quality_model import score_quality, train
from tidewater.llm.quality_rules import SHAPE_RULES, failed_rule, order_rules, word_statistics
from tidewater.llm.secrets_scan import described, find_secrets
from tidewater.llm.shared import table
from tidewater.llm.substrings import remove_repeats
from tidewater.llm.token_alignment import align_tokens
from tidewater.llm.tokens import count_tokens, encode_texts
from tidewater.llm.url_filter import judge_urls, word_counts

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def workers_find_library(spark: SparkSession) -> None:
    """Python workers started by ``spark`` import the library from where the driver has it."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [ROOT, env.get("PYTHONPATH")]))


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers_find_library(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


@_query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts decide base_failed; the cascade of the other rules runs on the rows that it lets pass."""
    docs = table(spark, sf_dir, "documents")
    rules = [m.rule for m in order_rules(docs, SHAPE_RULES)]
    out = docs.withColumn("s", word_statistics(text_of())).select("doc_id", "text", "s.*")
    out = out.withColumn("base_failed", F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words"))
    kept = F.when(F.col("base_failed"), False).otherwise(failed_rule(text_of(), rules).isNull())
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))


@_query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_texts(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@_query
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85, words=5)


@_query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(table(spark, sf_dir, "documents"))


@_query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=80, words=5)


# fixed values: the rules of the registered query
URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


@_query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return judge_urls(pages, URL_RULES, word_counts(pages, "html")).select("page_id", "host", "path", "rule", "verdict")


@_query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return out.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(described(F.col("base")), 256).alias("base_sha256"),
        described(F.col("spans")).alias("spans"),
    )


@_query
def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, train(docs, table(spark, sf_dir, "labels")))


@_query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"), size=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@_query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return count_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, limit=512)


@_query
def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"), percent=90, words=3)


@_query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path
    return align_tokens(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), public_tokenizers.PATTERN, path("piece_bpe_32k.model"))


@_query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("vector"))
    return hard_negatives(rows, F.col("id") % 50 == 0)
