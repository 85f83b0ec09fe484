"""The registered queries of the text operators over the benchmark tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.llm import byte_bpe, context_mixing, decontaminate, html_extract, language_id, license_scan, line_dedup, merkle
from gridtide.llm import simhash, source_audit, toxicity, vector_codes, warc
from gridtide.llm.common import table, whole
from gridtide.sources.scratch import fresh_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def registered(name: str):
    def add(query):
        QUERIES[name] = query
        return query

    return add


@registered("op1_decontaminate")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


WORDS = f"regexp_extract_all({ASCII_LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLE["op1_decontaminate"] = f"""
WITH items AS (SELECT item_id, {WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
cut AS (
  SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS p
  FROM items WHERE len(w) > 0
),
grams AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS gram FROM cut),
sizes AS (SELECT DISTINCT n FROM grams),
docs AS (SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE {WORDS} END AS w FROM documents),
spots AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM docs, sizes WHERE len(w) >= n),
windows AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS gram FROM spots),
hits AS (SELECT doc_id, item_id, n, p FROM windows JOIN grams USING (n, gram)),
covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, n, p FROM hits)) GROUP BY doc_id
),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)"""


@registered("op2_line_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedupe_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(whole(F.col("text")), 256).alias("kept_sha256"))


ORACLE["op2_line_dedup"] = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM split),
keyed AS (
  SELECT *, {ASCII_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key
  FROM lines
),
shared AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
),
judged AS (SELECT keyed.*, coalesce(doc_id <> first, false) AS gone FROM keyed LEFT JOIN shared USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


@registered("op5_simhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("__print")).alias("fingerprint"), "component_id")


@registered("op7_byte_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = byte_bpe.Vocabulary(
        spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    coded = table(spark, sf_dir, "documents").select(
        "doc_id", byte_bpe.encode_decode(whole(F.col("text")), vocabulary).alias("coded")
    )
    return coded.select(
        "doc_id", F.size("coded.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("coded.ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("coded.bytes", 256).alias("decoded_sha256"),
    )


@registered("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.with_toxicity(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
        F.col("toxic").cast("int").alias("predicted"),
    )


@registered("op4_merkle_fingerprint")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merkle.with_successors(table(spark, sf_dir, "documents"))
    rows = merkle.with_fingerprint(rows, "text", "fingerprint")
    rows = merkle.with_fingerprint(rows, "edited", "edited_fingerprint")
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint",
        merkle.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        merkle.likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"), "next_doc_id",
    )


BY_CONTENT = f"""CASE WHEN length(y) > {merkle.LONG} THEN list_filter(string_split(array_to_string(list_transform(
  regexp_extract_all(y, '{merkle.PIECE}'), lambda t: CASE WHEN left(md5(t), 1) < '2' THEN t || chr(1) ELSE t END), ''), chr(1)),
  lambda z: z <> '') ELSE [y] END"""


def merkle_sql(source: str) -> str:
    """Rows of (doc_id, text) to rows of (doc_id, print), in steps that read like the tree."""
    border = "CASE WHEN n = 1 THEN '' WHEN left(p[n - 1], 1) < '4' THEN '|' ELSE ';' END"
    return f"""
    SELECT doc_id, concat_ws('/', md5(ss), ss, ps, cs) AS print FROM (
      SELECT *, list_aggregate(list_transform(string_split(ps, '|'), lambda s: left(md5(s), 16)), 'string_agg', '|') AS ss
      FROM (
        SELECT doc_id,
          array_to_string(list_transform(p, lambda h, n: {border} || h), '') AS ps,
          array_to_string(list_transform(c, lambda l, n: {border} ||
            array_to_string(list_transform(l, lambda x: left(x, 8)), ',')), '') AS cs
        FROM (
          SELECT doc_id, c, list_transform(c, lambda l: left(md5(array_to_string(l, ',')), 16)) AS p FROM (
            SELECT doc_id, list_transform(string_split(rtrim(replace(text, chr(10), chr(10) || chr(2)), chr(2)), chr(2)),
              lambda q: list_transform(flatten(list_transform(string_split(replace(
                rtrim(regexp_replace(regexp_replace(q, '([.,;:!?][^\\p{{L}}\\p{{N}}\\s]{{0,3}}[ \\t])', '\\1' || chr(1), 'g'),
                  '([{merkle.MARKS}])', '\\1' || chr(1), 'g'), chr(1)), chr(1) || chr(10), chr(10)),
                chr(1)),
                lambda y: {BY_CONTENT})),
                lambda x: md5(x))) AS c
            FROM {source}))))"""


def likeness_sql(a: str, b: str) -> str:
    def leaves(x: str) -> str:
        return f"list_distinct(regexp_split_to_array(split_part({x}, '/', 4), '[,;|]'))"

    total = f"(len({leaves(a)}) + len({leaves(b)}))"
    return f"""CASE WHEN split_part({a}, '/', 1) = split_part({b}, '/', 1) THEN 1.0::DOUBLE
      ELSE least(len(list_intersect({leaves(a)}, {leaves(b)})) * 2.0::DOUBLE / {total},
                 1 - 1.0::DOUBLE / ({total} + 1)) END"""


ORACLE["op4_merkle_fingerprint"] = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
paired AS (
  SELECT doc_id, text, coalesce(lead(text) OVER w, first(text) OVER (ORDER BY doc_id)) AS after,
    coalesce(lead(doc_id) OVER w, first(doc_id) OVER (ORDER BY doc_id)) AS next_id
  FROM docs WINDOW w AS (ORDER BY doc_id)
),
edits AS (
  SELECT doc_id, next_id, text, left(text, length(text) - length(text) // 4) || left(after, length(text) // 4) AS edited
  FROM paired
),
own AS ({merkle_sql("docs")}),
changed AS ({merkle_sql("(SELECT doc_id, edited AS text FROM edits)")})
SELECT edits.doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256, own.print AS fingerprint,
  changed.print AS edited_fingerprint, {likeness_sql("own.print", "changed.print")} AS near_edited,
  {likeness_sql("own.print", "follower.print")} AS near_next,
  next_id AS next_doc_id
FROM edits JOIN own USING (doc_id) JOIN changed USING (doc_id) JOIN own AS follower ON follower.doc_id = next_id"""


@registered("op3_html_extract")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_extract.with_main_text(table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@registered("op6_warc")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_dir(spark, "warc")
    archives = warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder, archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE["op6_warc"] = """
WITH paid AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
kept AS (SELECT html, max(page_id) AS page FROM paid WHERE strlen(html) >= 1000 GROUP BY html)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN page <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page <> page_id THEN page END AS refers_to
FROM paid LEFT JOIN kept USING (html)"""


@registered("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = language_id.fit(docs)
    found = language_id.with_language(docs.select("doc_id", "text"), network)
    return found.select(
        "doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


@registered("op9_license_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.with_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.size("licenses").cast("long").alias("n_passages"),
        F.array_join(F.array_sort(F.array_distinct("licenses.license")), ",").alias("licenses"),
        F.coalesce(F.array_max("licenses.dice"), F.lit(0.0)).alias("best_dice"),
    )


@registered("op11_vector_codes")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def nearest_sql(book: str) -> str:
    """Every part with the index (e) of its nearest entry in a book and the squared distance (d)."""
    gap = "list_sum(list_transform(list_zip(parts.v, book.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    return f"""SELECT vec_id, label, p, v, min(struct_pack(d, e)).e AS e, min(struct_pack(d, e)).d AS d
      FROM (SELECT parts.*, e, {gap} AS d FROM parts JOIN {book} AS book USING (p)) GROUP BY vec_id, label, p, v"""


def next_book_sql(book: str) -> str:
    """The book with each entry that is some part's nearest replaced by the floored mean of those parts."""
    return f"""SELECT {book}.p, {book}.e, coalesce(mean.v, {book}.v) AS v FROM {book} LEFT JOIN (
        SELECT p, e, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
          SELECT p, e, i, sum(v[i]) AS total, count(*) AS n
          FROM (SELECT p, e, v, unnest(range(1, len(v) + 1)) AS i FROM ({nearest_sql(book)})) GROUP BY p, e, i
        ) GROUP BY p, e
      ) AS mean USING (p, e)"""


ORACLE["op11_vector_codes"] = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS MATERIALIZED (
  SELECT vec_id, label, p, v[p * len(v) // 16 + 1:(p + 1) * len(v) // 16] AS v
  FROM (SELECT *, unnest(range(16)) AS p FROM kept)
),
book0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM parts
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64)
),
book1 AS MATERIALIZED ({next_book_sql("book0")}),
book2 AS MATERIALIZED ({next_book_sql("book1")}),
coded AS MATERIALIZED (
  SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM ({nearest_sql("book2")}) GROUP BY vec_id, label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM book2) AS codebooks_sha256
FROM coded"""


@registered("op12_context_mixing")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.score(table(spark, sf_dir, "documents"))


@registered("op13_source_audit")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(table(spark, sf_dir, "documents"))


TERMS = f"regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
SHARE = "CAST(1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER whole + count(*) OVER whole) AS HUGEINT)"
DIVERGENCE = "((a.p - b.p) * (a.p - b.p) // b.p)"
ORACLE["op13_source_audit"] = f"""
WITH docs AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, {TERMS} AS w FROM documents),
terms AS MATERIALIZED (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM docs) GROUP BY lang, term HAVING count(*) >= 3
),
met AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(w) AS term FROM docs) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
counted AS MATERIALIZED (
  SELECT lang, source, term, coalesce(n, 0) AS n
  FROM groups JOIN terms USING (lang) LEFT JOIN met USING (lang, source, term)
),
of_source AS MATERIALIZED (
  SELECT lang, source, term, n, {SHARE} AS p FROM counted WINDOW whole AS (PARTITION BY lang, source)
),
of_lang AS (
  SELECT lang, term, {SHARE} AS p FROM (SELECT lang, term, sum(n) AS n FROM counted GROUP BY lang, term)
  WINDOW whole AS (PARTITION BY lang)
),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum({DIVERGENCE}) AS value
  FROM of_source AS a JOIN of_source AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
pairs AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0) AS value
  FROM groups AS g JOIN groups AS h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN apart ON apart.lang = g.lang AND apart.source = g.source AND apart.item = h.source
),
marked AS (
  SELECT a.lang, a.source, 'term' AS part, a.term AS item, {DIVERGENCE} AS value
  FROM of_source AS a JOIN of_lang AS b USING (lang, term) WHERE a.n > 0 AND a.p > b.p
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM marked)
QUALIFY part = 'pair' OR rank <= 200"""
