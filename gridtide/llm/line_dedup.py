"""Line deduplication across documents, in DataFrame functions only.

Every line is keyed by its stripped text with A-Z lower-cased. Keys are hashed to 128 bits, distinct
documents are counted per hash, and a key that enough documents share loses its lines everywhere
but in the document with the smallest id. The remaining lines are put together by position.

Shuffles: one of (hash, id) pairs, distinct before it is counted, so that a line in every document
meets as one row per task; one join of line positions with the shared hashes, both sides plain
exchanges, so that a hot hash is split; one of the texts by row. No text moves by line.

Defined cases. Null or empty text is one empty line. Rows with one id are one document: they never
drop each other's lines, whatever their texts. A row with a null id keeps all lines and counts for no
document. Repeated rows all stay. Columns named like a result are replaced, others pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import BLANKS, ascii_lower, durable, text_key, whole, without

RESULTS = ("n_lines", "n_dropped")


def split_lines(text: Column) -> Column:
    return F.split(whole(text), "\n", -1)


def keyed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row per line with a key long enough: __id, __text, __pos (from 0), __hash."""
    lines = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("__id"),
        text_key(F.col(text_col)).alias("__text"),
        F.posexplode(split_lines(ascii_lower(whole(F.col(text_col))))).alias("__pos", "__line"),
    )
    key = F.btrim(F.col("__line"), F.lit(BLANKS))
    return lines.withColumn("__line", key).where(F.length("__line") >= min_chars).select(
        "__id", "__text", "__pos", F.unhex(F.md5("__line")).alias("__hash")
    )


def shared_keys(lines: DataFrame, min_docs: int) -> DataFrame:
    """Hashes found in at least `min_docs` documents, with the smallest id: __hash, __first."""
    held = lines.select("__hash", "__id").distinct().groupBy("__hash").agg(
        F.count(F.lit(1)).alias("__docs"), F.min("__id").alias("__first")
    )
    return held.where(F.col("__docs") >= min_docs).select("__hash", "__first")


def dedupe_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, min_docs: int = 2
) -> DataFrame:
    """`docs` with shared lines dropped from the text, plus n_lines (before) and n_dropped.

    Rows that lose nothing keep their text as it was, null included.
    """
    lines = keyed_lines(docs, id_col, text_col, min_chars)
    shared = durable(shared_keys(lines, min_docs), "shared-lines")
    dropped = (
        lines.join(shared, "__hash")
        .where(F.col("__id") != F.col("__first"))
        .groupBy("__id", "__text")
        .agg(F.collect_set("__pos").alias("__drop"))
    )
    marked = without(docs, RESULTS).withColumn("__text", text_key(F.col(text_col)))
    joined = marked.join(
        dropped.withColumnRenamed("__text", "__of"),
        (F.col(id_col) == F.col("__id")) & (F.col("__text") == F.col("__of")),
        "left",
    )
    parts = split_lines(F.col(text_col))
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("__drop"))
    text = F.when(F.col("__drop").isNull(), F.col(text_col)).otherwise(
        F.array_join(F.transform(kept, lambda n: F.get(F.col("__parts"), n)), "\n")
    )
    return (
        joined.withColumn("__parts", parts)
        .withColumn("n_lines", F.size("__parts").cast("long"))
        .withColumn("n_dropped", F.coalesce(F.size("__drop"), F.lit(0)).cast("long"))
        .withColumn(text_col, text)
        .select(*marked.columns[:-1], *RESULTS)
    )
