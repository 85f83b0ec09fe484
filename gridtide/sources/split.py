"""Records of JSON-array files, each file read by as many tasks as it has byte ranges.

A text scan cut at ``}`` gives fragments by byte range. Whether a fragment begins inside a string, and how deep, depends on
all text before it, so each fragment, and then each range, says what it makes of either state; one row a range and
file is enough to carry the states through the file (a prefix pass), and every range then knows its own. A record ends with a
fragment that returns to the array's level; the fragments between two ends are one record, wherever ranges were cut.

A file is judged as a whole, as :func:`gridtide.sources.landing.triage` does: a broken one gives a single row with its ``problem``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from gridtide.sources import landing, scratch

_OPEN, _CLOSE = "{[", "}]"
_BLANK = "' \\t\\r\\n'"


def _count(text: str, *signs: str) -> str:
    """How often the signs occur in a text."""
    return "(" + " + ".join(f"octet_length({text}) - octet_length(replace({text}, '{sign}', ''))" for sign in signs) + ")"


def _level(text: str) -> str:
    """Brackets opened less brackets closed."""
    return f"CAST({_count(text, *_OPEN)} - {_count(text, *_CLOSE)} AS bigint)"


def scan(reader: DataFrameReader | DataStreamReader, path: str | list[str]) -> DataFrame:
    """What a text scan cut at ``}`` gives of landed files, batch or stream: origin, block (first byte of the range), size of
    the file, value."""
    return reader.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("origin"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"), "value",
    )


def fragments(scanned: DataFrame) -> DataFrame:
    """A scan's rows with ``at`` (order in the range), ``bytes``, ``head`` (first sign) and what the fragment does to the state:
    ``parity`` of its quotes, and its change of level if it begins outside (``out``) or inside (``inn``) a string."""
    plain = scanned.selectExpr(
        "*", "monotonically_increasing_id() AS at",
        r"if(contains(value, char(92)), regexp_replace(value, r'(?s)\\.', ''), value) AS _plain",
    )
    # Regular expressions run only for fragments with several brackets; of a single one, the quotes before it tell enough.
    quoted = r"""regexp_replace({}, r'(?s)"[^"]*("|$)', '')"""
    rest = r"""regexp_replace(_plain, r'(?s)^[^"]*("|$)', '')"""
    first = "_plain"
    for sign in (*_OPEN, "]"):
        first = f"substring_index({first}, '{sign}', 1)"
    counted = plain.selectExpr("*", f"{_count('_plain', *_OPEN, ']')} AS _brackets")
    bare = counted.selectExpr(
        "*", f"CASE WHEN _brackets = 1 THEN {first} END AS _first",
        f"CASE WHEN _brackets > 1 THEN {quoted.format('_plain')} END AS _out",
        f"CASE WHEN _brackets > 1 THEN {quoted.format(rest)} END AS _inn",
    )
    told = bare.selectExpr(
        "*", f"{_count('_first', chr(34))} % 2 AS _inside", "if(contains(_plain, ']'), -1L, 1L) AS _step"
    )
    level = "CASE _brackets WHEN 0 THEN 0L WHEN 1 THEN if(_inside = {}, _step, 0L) ELSE {} END"
    return told.selectExpr(
        "origin", "block", "at", "value", "size", "octet_length(value) + 1 AS bytes",
        f"substring(trim(LEADING {_BLANK} FROM value), 1, 1) AS head", f"{_count('_plain', chr(34))} % 2 AS parity",
        f"{level.format(0, _level('_out'))} AS out", f"{level.format(1, _level('_inn'))} AS inn",
    )


def placed(parts: DataFrame) -> DataFrame:
    """Fragments with the number of the record they belong to: origin, block, at, text, record, is_array, closed."""
    in_range = Window.partitionBy("origin", "block").orderBy("at")
    before = in_range.rowsBetween(Window.unboundedPreceding, -1)
    # Relative to a range that begins outside a string; the other case is the opposite throughout.
    rows = parts.withColumn("turn", F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2)
    change = "if((turn + {0}) % 2 = 0, out, inn) - if((turn + {0} + parity) % 2 = 0, 1, 0)"
    rows = rows.selectExpr("*", f"{change.format(0)} AS if_out", f"{change.format(1)} AS if_inn")
    ranges = rows.groupBy("origin", "block").agg(
        F.expr("sum(parity) % 2 AS parity"), F.sum("if_out").alias("if_out"), F.sum("if_inn").alias("if_inn"),
        F.max("at").alias("last_at"), F.max("size").alias("size"),
        F.sum("bytes").alias("bytes"), F.min_by("head", "at").alias("head"),
    )
    # One row a range: a file of a terabyte has some thousands.
    over = Window.partitionBy("origin").orderBy("block")
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("begins", F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2)
    ranges = ranges.withColumn("moves", F.expr("if(begins = 0, if_out, if_inn)"))
    ranges = ranges.withColumn("level", F.coalesce(F.sum("moves").over(earlier), F.lit(0)))
    whole = Window.partitionBy("origin")
    ranges = ranges.select(
        "origin", "block", "begins", "level",
        (F.min_by("head", "block").over(whole) == "[").alias("is_array"),
        # The last fragment has no sign after it, unless all bytes are accounted for with one. Of a compressed file the bytes
        # tell nothing: what is no array had the sign if that closes it.
        F.when(
            (F.col("block") == F.max("block").over(whole)) & (F.sum("bytes").over(whole) != F.col("size"))
            & ~((F.min_by("head", "block").over(whole) != "[") & (F.sum("bytes").over(whole) != F.col("size") + 1)
                & (F.sum("moves").over(whole) == 0)),
            F.col("last_at"),
        ).alias("file_end"),
    )
    rows = rows.join(ranges, ["origin", "block"])
    rows = rows.withColumn("_change", F.expr("if(begins = 0, if_out, if_inn)"))
    rows = rows.withColumn("after", F.col("level") + F.sum("_change").over(in_range))
    rows = rows.selectExpr(
        "origin", "block", "at", "is_array", "coalesce(at = file_end, false) AS final",
        "(turn + begins + parity) % 2 = 0 AS outside", "after", "value",
    )
    rows = rows.selectExpr(
        "origin", "block", "at", "is_array", "if(final, value, concat(value, '}')) AS text",
        "is_array AND outside AND NOT final AND after = 1 AS ends",
    )
    return rows


def _numbered(rows: DataFrame) -> DataFrame:
    """``record``: how many records ended before the fragment, by the same two steps."""
    before = Window.partitionBy("origin", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("origin").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("origin", "block").agg(F.count_if("ends").alias("ended"))
    counts = counts.select("origin", "block", F.coalesce(F.sum("ended").over(earlier), F.lit(0)).alias("ended"))
    own = F.coalesce(F.sum(F.col("ends").cast("bigint")).over(before), F.lit(0))
    return rows.withColumn("own", own).join(counts, ["origin", "block"]).withColumn("record", F.col("ended") + F.col("own"))


def split_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of landed JSON arrays; see :func:`records_of`."""
    return records_of(spark, scan(spark.read, path), scratch.fresh_dir(spark, "fragments"))


def records_of(spark: SparkSession, scanned: DataFrame, folder: str) -> DataFrame:
    """Records of scanned JSON arrays: ``seq`` = (origin, pos, sub), ``record`` and ``problem``, as
    :func:`gridtide.sources.landing.export_records` gives them. ``sub`` tells values apart that no ``}`` parts.

    ``folder`` holds the fragments for a while, and then the parsed records, which must stay until they have been read.
    """
    # Written once, so the order inside ranges is settled and the scan is not repeated by the steps below.
    parts, cut = fragments(scanned), f"{folder}/fragments"
    parts.write.mode("overwrite").parquet(cut)
    parsed, held = _parsed(_numbered(placed(spark.read.schema(parts.schema).parquet(cut)))), f"{folder}/records"
    # Written too: whether a file is sound is known only when all of it is parsed, and parsing is what costs most.
    parsed.write.mode("overwrite").parquet(held)
    scratch.delete(spark, cut)
    read = spark.read.schema(parsed.schema).parquet(held)
    # A sound array has text after its last record: the bracket that closes it.
    judged = read.groupBy("origin").agg(
        F.expr("bool_or(elements IS NULL) OR bool_and(ended) AS broken"), F.max("problem").alias("problem")
    )
    broken = judged.where("broken").selectExpr("origin", "coalesce(problem, 'invalid JSON') AS problem")
    # Broken files only are sent to every task; a join by file would put each file's records into one.
    sound = read.join(F.broadcast(broken.select("origin")), "origin", "left_anti").select(
        "origin", "record", F.posexplode("elements").alias("sub", "text")
    )
    none = F.lit(None).cast("string")
    found = sound.select(
        "origin", F.col("record").alias("pos"), "sub", F.coalesce("text", F.lit("null")).alias("record"), none.alias("problem")
    )
    refused = broken.select(
        "origin", F.lit(0).cast("bigint").alias("pos"), F.lit(0).alias("sub"), F.lit("null").alias("record"), "problem"
    )
    return found.unionByName(refused).select(F.struct("origin", "pos", "sub").alias("seq"), "record", "problem")


def _parsed(rows: DataFrame) -> DataFrame:
    """origin, record, ended, elements (the values in a record's text; null when broken), problem of a file that is no array."""
    pieces = F.array_sort(F.collect_list(F.struct("block", "at", "text")))
    chunks = rows.groupBy("origin", "record", "is_array").agg(
        F.array_join(F.transform(pieces, lambda p: p["text"]), "").alias("text"), F.max("ends").alias("ended")
    )
    # What a record's text may look like: [ or , before it, and ] after the last.
    shape = r"""CASE
        WHEN ended THEN regexp_extract(text, if(record = 0, r'(?s)^\s*\[(.*)$', r'(?s)^\s*,(.*)$'), 1)
        WHEN record > 0 AND text RLIKE r'(?s)^\s*\]\s*$' THEN ' '
        ELSE regexp_extract(text, if(record = 0, r'(?s)^\s*\[(.*)\]\s*$', r'(?s)^\s*,(.*\S.*)\]\s*$'), 1) END"""
    empty = r"record = 0 AND NOT ended AND text RLIKE r'(?s)^\s*\[\s*\]\s*$'"
    bodies = chunks.selectExpr(
        "origin", "record", "is_array", "ended", "CASE WHEN NOT is_array THEN text END AS payload",
        f"CASE WHEN is_array THEN if({empty}, ' ', {shape}) END AS body",
    )
    others = landing.triage(bodies).drop("elements")
    return others.selectExpr(
        "origin", "record", "ended",
        f"CASE WHEN body <> '' THEN from_json(concat('[', body, ']'), 'array<string>', {landing._STRICT}) END AS elements",
        "CASE WHEN NOT is_array THEN problem END AS problem",
    )
