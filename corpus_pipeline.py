"""A training-data pipeline over the corpus operators.

``STAGES`` are (name, function) in order. A function takes (spark, docs,
sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet to the
shared checkpoint folder and gives it to the next stage, so a lost executor
costs no more than a stage's own work. All stages but the last return the
columns of ``docs``, whatever these are.

1. quality rules: documents that a rule rejects go.
2. near dedup: of each group of near copies the row of the smallest doc_id stays.
3. decontamination: documents that hold a benchmark item go.
4. secret scan: secrets in the texts are replaced by a mark.
5. byte bpe: the texts are encoded, and decoded again as a check.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.columns import text_of
from tidewater.llm.leaks import leaks
from tidewater.llm.near_dedup import near_duplicates
from tidewater.llm.quality_rules import DEFAULT_RULES, failed_rule, order_rules
from tidewater.llm.queries import workers_find_library
from tidewater.llm.secrets_scan import find_secrets, redacted
from tidewater.llm.shared import staged, table, within
from tidewater.llm.tokens import encode_texts


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that no rule rejects; a null or empty text is rejected."""
    order = [m.rule for m in order_rules(docs, DEFAULT_RULES)]
    return docs.where(failed_rule(text_of(), order).isNull())


#: A list of row keys is broadcast up to this many rows (16 MB of numbers), else joined by a shuffle.
BROADCAST_ROWS = 2_000_000
ROW = "_pipeline_row"


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` plus ROW, a key of each row, so that what is decided of a row does not hang on doc_id.

    The key is the row's place in the Parquet files, the same in every scan;
    rows that come from elsewhere are written once with a key.
    """
    try:
        place = docs.metadataColumn("_metadata")
        return docs.withColumn(ROW, F.xxhash64(place["file_path"], place["row_index"]))
    except AnalysisException:
        return staged(docs.withColumn(ROW, F.monotonically_increasing_id()))


def _without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    return docs.join(within(rows, BROADCAST_ROWS), ROW, "left_anti").drop(ROW)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of the smallest doc_id, of equal or null ones any. Rows that repeat a doc_id with other texts stay."""
    keyed = _keyed(docs)
    judged = staged(near_duplicates(keyed.select(F.col(ROW).alias("doc_id"), "text")).select(F.col("doc_id").alias(ROW), "component_id"))
    many = staged(judged.groupBy("component_id").count().where("count > 1").select("component_id"))
    copies = judged.join(within(many, BROADCAST_ROWS), "component_id").join(keyed.select(ROW, "doc_id"), ROW)
    copies = staged(copies.select("component_id", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", ROW).alias("row")))
    first = staged(copies.groupBy("component_id").agg(F.min("row").alias("first")))
    dropped = copies.join(within(first, BROADCAST_ROWS), "component_id").where(F.col(f"row.{ROW}") != F.col(f"first.{ROW}"))
    return _without(keyed, staged(dropped.select(F.col(f"row.{ROW}").alias(ROW))))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no benchmark item."""
    keyed = _keyed(docs)
    found = leaks(keyed.select(F.col(ROW).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return _without(keyed, staged(found.select(F.col("doc_id").alias(ROW)).distinct()))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with secrets in the texts replaced; a text without secrets, also a null one, is unchanged."""
    columns = docs.columns
    out = find_secrets(docs.select("doc_id", "text", F.struct(*columns).alias("_row")))
    text = F.when(F.size("spans") > 0, redacted(text_of(), F.col("spans"))).otherwise(F.col("text"))
    return out.select(*(text.alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in columns))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256, ids."""
    return encode_texts(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, arrays=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("secret_scan", secret_scan),
    ("byte_bpe", byte_bpe),
]

#: SQL can express neither the secret scan's tests nor the encoding; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the table documents."""
    workers_find_library(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
