"""From raw documents to token ids, in five stages. Each works on all rows that the one before it kept.

Every stage is written as Parquet to the shared folder and read again, which cuts the lineage. A stage takes
``(spark, docs, sf_dir)``; all but the last return the columns of ``documents``. NULL and empty texts have no words and fall
to the quality rules. Of repeated rows and ties one stays, that with the smallest id. An empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spinmart.llm.bpe import encode_texts
from spinmart.llm.decontamination import drop_leaks
from spinmart.llm.jaccard_join import keep_one
from spinmart.llm.line_dedup import drop_common_lines
from spinmart.llm.quality_rules import keep_good
from spinmart.operators.staging import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Bytes of rows that a Python worker gets at a time. Whole documents pass every stage, several workers an executor.
BATCH_BYTES = 2 << 20


def chosen(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The columns of ``documents``; others that a table may have are left behind whatever their names."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return docs.select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules."""
    return keep_good(chosen(spark, docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines that ten or more of them share."""
    return drop_common_lines(chosen(spark, docs)).withColumn(
        "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies."""
    return keep_one(chosen(spark, docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_leaks(chosen(spark, docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, little-endian 32-bit, of all documents that are left, and a digest of the text they decode to."""
    return encode_texts(chosen(spark, docs), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                        carry=("doc_id", "lang", "source"), decoded=True).select(
        "doc_id", "lang", "source", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("bpe", bpe),
]

# SQL has no byte-pair encoding; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_SQL = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
