"""Benchmark decontamination, in DataFrame functions only.

Benchmark items are cut into windows of consecutive normalised words (13; a shorter item is one
window). The windows form a hash set that every task holds. Training texts are scanned window by
window on the row itself: a window is looked up only if its first and last words begin and end some
benchmark window, and the lookup compares the window's whole text, so a hit is verified as it is
found. Nothing of a text is shuffled; only hits leave the row, to be matched with their items.

The set travels with the plan and is checked against `SET_LIMIT`. A larger benchmark takes the
other way: the same word test is made on the row with the benchmark's first and last words (as long as these are no more than
`SET_LIMIT`), the windows that pass leave it, and meet the benchmark in an ordinary join on their text, which Spark broadcasts
or shuffles by size.

Defined cases. Null or wordless text has no words and no hits; a null item id is left out of the items,
yet its windows hit. Items that share a window all count. Rows that agree in id and text are one document
in `contamination`; `decontaminate` keeps every row. An empty benchmark hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import ascii_lower, durable, text_key, whole

WINDOW = 13
SET_LIMIT = 100_000  # windows that may travel with the plan as a set
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of the text with A-Z lower-cased: runs of digits, letters a-z and all beyond ASCII."""
    return F.array_remove(F.split(ascii_lower(whole(text)), SEPARATORS, -1), "")


def benchmark_windows(benchmark: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct windows of the benchmark: item (string), gram, size, head, tail."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w"))
    size = F.least(F.size("w"), F.lit(width))
    starts = F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)
    grams = (
        items.withColumn("size", size)
        .where(F.col("size") > 0)
        .select("item", "size", "w", F.explode(starts).alias("at"))
        .select("item", "size", F.slice("w", F.col("at"), F.col("size")).alias("w"))
    )
    return grams.select(
        "item", "size", F.array_join("w", " ").alias("gram"), F.element_at("w", 1).alias("head"),
        F.element_at("w", -1).alias("tail"),
    ).distinct()


def _members(rows, column: str) -> str:
    """A literal set; normalised words hold no quote, blank or backslash, windows only single blanks."""
    values = {v for row in rows for v in (row[column] if isinstance(row[column], list) else [row[column]])}
    return ", ".join(f"'{value}'" for value in sorted(values))


def _hits(size: int, rows, grams_too: bool) -> str:
    """SQL of the windows of one size that may hit (or do, with `grams_too`): array<struct<at, size, gram>>. Without rows,
    any may."""
    gram = f"array_join(slice(w, i + 1, {size}), ' ')"
    found = f" AND {gram} IN ({_members(rows, 'gram')})" if grams_too else ""
    borders = f"w[i] IN ({_members(rows, 'head')}) AND w[i + {size - 1}] IN ({_members(rows, 'tail')})" if rows else "true"
    return (
        f"transform(filter(sequence(0, size(w) - {size}), i -> {borders}{found}), "
        f"i -> named_struct('at', i, 'size', {size}, 'gram', {gram}))"
    )


# Words under at least one hit: windows in order of their start, each adding what lies past the last end.
COVERED = """
aggregate(array_sort(transform(hits, h -> struct(h.at AS at, h.at + h.size AS stop))),
  named_struct('n', 0L, 'last', 0),
  (a, h) -> named_struct('n', a.n + greatest(h.stop - greatest(h.at, a.last), 0),
                         'last', greatest(a.last, h.stop)),
  a -> a.n)"""
SPANS = "array_sort(transform(hits, h -> struct(h.at AS at, h.size AS size)))"


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", width: int = WINDOW, one_in: int = 20,
    set_limit: int = SET_LIMIT,
) -> DataFrame:
    """One row per document (id and text): id_col, __text, n_words, n_hit, spans, items (sorted), contaminated.

    spans: the hits as (at, size), counted in words from 0. contaminated: some word is hit, and at least
    one word in `one_in` is.
    """
    grams = durable(benchmark_windows(benchmark, width, item_col, item_text_col), "windows")
    total, heads, tails = grams.agg(*[F.count_distinct(c) for c in ("gram", "head", "tail")]).first()
    inline, tested = total <= set_limit, max(heads, tails) <= set_limit
    # What comes to the driver, and travels with the plan, is at most `set_limit` windows, first words and last words.
    known = []
    if inline:
        known = grams.select("size", "head", "tail", "gram").distinct().collect()
    elif tested:
        borders = grams.groupBy("size").agg(F.collect_set("head").alias("head"), F.collect_set("tail").alias("tail"))
        known = borders.collect()
    sizes = [r["size"] for r in grams.select("size").distinct().collect()]
    scan = docs.select(F.col(id_col), text_key(F.col(text_col)).alias("__text"), words(F.col(text_col)).alias("w"))
    scan = scan.withColumn("n_words", F.size("w").cast("long"))
    empty = "cast(array() AS array<struct<at: int, size: int, gram: string>>)"
    # Rows without a hit meet no owner; by keys of their own, which no window begins with, they are dealt evenly.
    dealt = F.coalesce("gram", F.concat(F.lit(" "), F.col("__text").cast("string")))
    if inline:
        found = [
            f"CASE WHEN size(w) >= {n} THEN {_hits(n, [r for r in known if r['size'] == n], True)} ELSE {empty} END"
            for n in sorted(sizes)
        ]
        hits = F.expr(f"concat({', '.join(found)})" if found else empty)
        scan = scan.withColumn("hits", hits)
        counted = scan.select(
            id_col, "__text", "n_words", F.expr(COVERED).alias("n_hit"), F.expr(SPANS).alias("spans"),
            F.explode_outer(F.expr("array_distinct(hits.gram)")).alias("gram"),
        )
        counted = counted.withColumn("gram", dealt)
        owners = grams.groupBy("gram").agg(F.collect_set("item").alias("of"))
        named = counted.join(owners, "gram", "left")
        result = named.groupBy(id_col, "__text", "n_words", "n_hit", "spans").agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("of")))).alias("items")
        )
    else:
        found = [
            f"CASE WHEN size(w) >= {n} THEN {_hits(n, [r for r in known if r['size'] == n], False)} ELSE {empty} END"
            for n in sorted(sizes)
        ]
        windows = scan.select(id_col, "__text", "n_words", F.inline_outer(F.expr(f"concat({', '.join(found)})")))
        windows = windows.withColumn("gram", dealt)
        owners = grams.groupBy("gram").agg(F.collect_set("item").alias("of"))
        named = windows.join(owners, "gram", "left")
        result = (
            named.groupBy(id_col, "__text", "n_words")
            .agg(
                F.array_sort(F.collect_set(F.when(F.col("of").isNotNull(), F.struct("at", "size")))).alias("hits"),
                F.array_sort(F.array_distinct(F.flatten(F.collect_set("of")))).alias("items"),
            )
            .withColumn("n_hit", F.expr(COVERED))
            .withColumnRenamed("hits", "spans")
        )
    enough = F.col("n_hit") * one_in >= F.col("n_words")
    return result.withColumn("contaminated", (F.col("n_hit") > 0) & enough)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options):
    """The rows of `docs` whose document is not contaminated, columns unchanged."""
    # Judged in full before the filter, which the planner would else copy into every use of the large set.
    found = durable(contamination(docs, benchmark, id_col, text_col, **options), "judged").where("contaminated")
    bad = found.select(F.col(id_col).alias("__id"), F.col("__text").alias("__of"))
    same = docs[id_col].eqNullSafe(F.col("__id")) & (text_key(docs[text_col]) == F.col("__of"))
    return docs.join(bad, same, "left_anti")


# In a text as it stands, a word with the separators after it: what a span is cut by.
PIECE = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+[^0-9A-Za-z\x{80}-\x{10FFFF}]*"


def cut_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options):
    """`docs` with every hit word, and the separators after it, cut out of the text."""
    found = durable(contamination(docs, benchmark, id_col, text_col, **options), "judged").where("n_hit > 0")
    cut = F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["size"] - 1)))
    spans = found.select(F.col(id_col).alias("__id"), F.col("__text").alias("__of"), cut.alias("__cut"))
    same = docs[id_col].eqNullSafe(F.col("__id")) & (text_key(docs[text_col]) == F.col("__of"))
    pieces = F.regexp_extract_all(F.col(text_col), F.lit(PIECE), F.lit(0))
    kept = F.array_except(F.sequence(F.lit(0), F.size("__pieces") - 1), F.col("__cut"))
    head = F.regexp_extract(F.col(text_col), r"^[^0-9A-Za-z\x{80}-\x{10FFFF}]*", 0)
    left = F.concat(head, F.array_join(F.transform(kept, lambda n: F.get(F.col("__pieces"), n)), ""))
    return (
        docs.join(spans, same, "left")
        .withColumn("__pieces", pieces)
        .withColumn(text_col, F.when(F.col("__cut").isNull(), F.col(text_col)).otherwise(left))
        .select(*docs.columns)
    )
