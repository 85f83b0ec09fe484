"""Registered queries: against their SQL, or against the contracts in plain Python."""

from __future__ import annotations

import hashlib
import os
import re

import brute
import duckdb
import pytest
from html import unescape

import __spark_entry__ as entry
import corpus_pipeline
from gridtide.llm import toxicity
from gridtide.llm.suite import ORACLE, QUERIES
from tools_check import TABLES, compare

pytestmark = pytest.mark.filterwarnings("ignore")


def texts(spark, tables):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, tables, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tables}/{table}.parquet'")
    _, rows, verdict = compare(spark, con, name, tables)
    assert verdict == "ok", verdict
    assert rows > 0


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 11)} == {name.split("_")[0] for name in QUERIES}
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


def test_html(spark, tables):
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in QUERIES["op3_html_extract"](spark, tables).collect()}
    pages = spark.read.parquet(f"{tables}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:  # these pages hold their text in one article of headings and paragraphs
        article = re.search(r"<article>(.*)</article>", page.html, re.S)[1]
        blocks = (re.sub(r"<[^>]*>", " ", part) for part in re.split(r"</?(?:p|h1)>", article))
        text = "\n".join(filter(None, (" ".join(unescape(block).split()) for block in blocks)))
        assert got[page.page_id] == (page.url, text, len(text))


def test_simhash(spark, tables):
    prints = {doc: brute.simhash(text) for doc, text in texts(spark, tables)}
    want = {doc: (f"{prints[doc]:016x}", low) for doc, low in brute.components(prints).items()}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op5_simhash"](spark, tables).collect()}
    assert got == want


def coded(tokenizer, text):
    ids = tokenizer.encode_ordinary(text or "")
    return len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(text or "")


def test_byte_bpe(spark, tables):
    tokenizer = brute.tokenizer()
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op7_byte_bpe"](spark, tables).collect()}
    assert got == {doc: coded(tokenizer, text) for doc, text in texts(spark, tables)}


def larger(tables):
    return os.path.join(os.path.dirname(tables), "sf0.01")


def test_language_on_held_out_rows(spark, tables):
    got = QUERIES["op8_language_id"](spark, larger(tables)).join(
        spark.read.parquet(f"{larger(tables)}/documents.parquet").select("doc_id", "lang"), "doc_id"
    ).collect()
    held = [r for r in got if r.held_out]
    assert 0.15 < len(held) / len(got) < 0.35
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_toxicity_on_held_out_rows(spark, tables):
    got = QUERIES["op10_toxicity"](spark, larger(tables)).join(
        spark.read.parquet(f"{larger(tables)}/labels.parquet"), "doc_id"
    ).collect()
    held = [r for r in got if r.held_out]
    toxic, clean = ([r.score for r in held if r.toxic == y] for y in (1, 0))
    ranked = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert ranked > 0.8  # some hundred training labels
    assert sum(s >= 0.3 for s in clean) / len(clean) < 0.1
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_licenses(spark, tables):
    named = {"Apache-2.0": "Apache License", "MIT": "MIT License", "GPL-3.0": "GNU General", "CC-BY-NC-4.0": "CC BY-NC"}
    got = {r.doc_id: r.licenses for r in QUERIES["op9_license_scan"](spark, tables).collect()}
    for doc, text in texts(spark, tables):
        assert got[doc] == ",".join(sorted(k for k, v in named.items() if v in text)), doc


def test_pipeline(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{tables}/labels.parquet"))
    left = {doc: text for doc, text in texts(spark, tables) if model.score(text or "") < toxicity.THRESHOLD}
    left = {doc: text for doc, (_, _, text) in brute.dedupe_lines(left.items()).items()}
    low = brute.components({doc: brute.simhash(text) for doc, text in left.items()})
    left = {doc: text for doc, text in left.items() if low[doc] == doc}
    items = [tuple(r) for r in spark.read.parquet(f"{tables}/benchmark.parquet").select("item_id", "text").collect()]
    judged = brute.contamination(left.items(), items)
    left = {d: t for d, t in left.items() if not (judged[d][1] and 20 * len(judged[d][1]) >= judged[d][0])}
    got = corpus_pipeline.run(spark, tables)
    assert got.columns[: len(docs.columns)] == docs.columns
    rows = {r.doc_id: r for r in got.collect()}
    assert rows.keys() == left.keys()
    tokenizer = brute.tokenizer()
    for doc, text in left.items():
        r = rows[doc]
        assert r.text == text and r.n_chars == len(text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == coded(tokenizer, text)
        assert r.ids == tokenizer.encode_ordinary(text)
        assert hashlib.sha256(text.encode()).hexdigest() == r.decoded_sha256
