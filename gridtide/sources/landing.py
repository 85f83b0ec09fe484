"""Landed export payloads: shape triage, explosion to records, and windowed scans."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.functions import clock


class PayloadError(RuntimeError):
    """A landed payload is not an array of records."""


def scan_window(
    rows: DataFrame, key: str, start: datetime, end: datetime, ordered: bool = True
) -> DataFrame:
    """Rows with ``start <= key < end``, bounds in UTC cut to whole seconds.

    The bounds are literals of the key's own type, so the filter reaches the
    scan. Only a reader who wants the order pays for the sort.
    """
    dtype = clock.type_of(rows, key)
    lower, upper = (clock.literal(bound.replace(microsecond=0), dtype) for bound in (start, end))
    kept = rows.where(f"{key} >= {lower} AND {key} < {upper}")
    return kept.orderBy(key) if ordered else kept


# -- payload shape ------------------------------------------------------------------


_STRICT = "map('allowSingleQuotes', 'false')"


def _closes_with(payload: str, bracket: str) -> str:
    """The parser stops at the closing bracket, so what follows it is checked here."""
    return f"endswith(trim(TRAILING ' \\t\\r\\n' FROM {payload}), '{bracket}')"


def triage(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Adds ``elements`` (record texts, null on error) and ``problem`` (null when fine).

    An object is the upstream's way to report an error; its message is passed on.
    """
    elements = f"""CASE WHEN {_closes_with(payload, ']')}
        THEN from_json({payload}, 'array<string>', {_STRICT}) END AS elements"""
    members = f"""CASE WHEN elements IS NULL AND {_closes_with(payload, '}')}
        THEN from_json({payload}, 'map<string,string>', {_STRICT}) END AS _members"""
    scalar = f"schema_of_variant(try_parse_json({payload}))"
    problem = f"""CASE WHEN elements IS NOT NULL THEN NULL
        WHEN _members IS NOT NULL THEN concat('API error: ', coalesce(
            nullif(_members['message'], ''), nullif(_members['error_code'], ''), 'unknown error'))
        WHEN NOT {payload} RLIKE r'^\\s*[\\[{{]' AND {scalar} IS NOT NULL
            THEN concat('unexpected payload shape: ', lower({scalar}))
        ELSE 'invalid JSON' END AS problem"""
    rows = payloads.selectExpr("*", elements).selectExpr("*", members)
    return rows.selectExpr("*", problem).drop("_members")


def explode_records(triaged: DataFrame, origin: str = "origin") -> DataFrame:
    """One row per array element: ``seq`` = (origin, position) keeps the arrival order.

    A broken payload becomes a single row that carries its ``problem``, so that
    payloads are parsed once and no batch vanishes silently.
    """
    spread = triaged.selectExpr(
        f"{origin} AS _origin",
        "problem",
        "posexplode(coalesce(elements, array(CAST(NULL AS string)))) AS (_pos, record)",
    )
    return spread.selectExpr(
        "named_struct('origin', _origin, 'pos', CAST(_pos AS bigint)) AS seq",
        "coalesce(record, 'null') AS record",
        "problem",
    )


def payloads(files: DataFrame) -> DataFrame:
    """Files read as whole texts, as ``(origin, payload)``."""
    return files.select(F.col("_metadata.file_path").alias("origin"), F.col("value").alias("payload"))


def read_export_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Landed export files, one JSON array each, as ``(origin, payload)``.

    A file is parsed by one task, so parallelism comes from many files; land
    JSON lines for large backfills.
    """
    return payloads(spark.read.text(path, wholetext=True))


def first_problem(rows: DataFrame) -> str | None:
    """The first broken payload's message, if any: a top-1, never a full collect."""
    row = rows.where(F.col("problem").isNotNull()).orderBy("seq").select("problem").limit(1).first()
    return None if row is None else row["problem"]


def export_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of landed export files, broken payloads included as ``problem`` rows."""
    return explode_records(triage(read_export_files(spark, path)))


def line_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of landed JSON lines: splittable, so one huge file still spreads.

    Lines are ordered by file, then by the byte block they were read in, then by
    position inside the block, which is their order in the file.
    """
    return records_of_lines(spark.read.text(path))


def records_of_lines(lines: DataFrame) -> DataFrame:
    """Records of lines as the text reader gives them."""
    placed = lines.select(
        F.col("_metadata.file_path").alias("origin"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("record"),
    )
    seq = F.struct("origin", "block", "pos")
    return placed.where(F.trim("record") != "").select(seq.alias("seq"), "record")
