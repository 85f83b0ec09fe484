"""The corpus pipeline: civil, deduplicated, decontaminated and tokenised documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of
`documents`; a changed text brings its n_chars along. Rows pass from stage to stage as Parquet in the
shared folder, so a lost executor never costs more than tasks of the stage at hand.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.llm import byte_bpe, decontaminate, line_dedup, simhash, toxicity
from gridtide.llm.common import table, whole
from gridtide.sources.scratch import delete, fresh_dir

VOCABULARY = "byte_bpe_50k.tiktoken"
TOKENS = ("ids", "n_tokens", "ids_sha256", "decoded_sha256")


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of those present, does not reject."""
    return toxicity.keep_civil(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a document of smaller id holds as well."""
    kept = line_dedup.dedupe_lines(docs)
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")
    return kept.withColumn("n_chars", n_chars).select(*docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id."""
    return simhash.keep_one(docs)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, and digests of the ids and of the bytes they decode to."""
    vocabulary = byte_bpe.Vocabulary(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    plain = docs.drop(*TOKENS)
    coded = plain.withColumn("__coded", byte_bpe.encode_decode(whole(F.col("text")), vocabulary))
    return coded.select(
        *plain.columns, F.col("__coded.ids").alias("ids"), F.size("__coded.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("__coded.ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("__coded.bytes", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", civil),
    ("line_dedup", distinct_lines),
    ("simhash_near_dedup", distinct_documents),
    ("decontamination", clean_of_benchmarks),
    ("byte_bpe", tokenised),
]

# The first stage learns its model from the rows, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to `documents`, one after the other."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = fresh_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
