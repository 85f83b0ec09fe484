"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names, for every operator."""

from __future__ import annotations

import random
import time

import brute
import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from gridtide.llm import (
    byte_bpe, components, decontaminate, html_extract, language_id, license_scan, line_dedup, merkle, simhash, toxicity, warc,
)
from gridtide.llm.common import durable
from gridtide.sources.scratch import fresh_dir

from conftest import LINE, PROSE, ROWS


def named(rows):
    return [(i, t) for i, t in rows if i is not None]


# -- decontamination --------------------------------------------------------------------------------

ITEMS = [(10, PROSE), (9, PROSE + " for good"), (7, "two words"), (None, "école 北京"), (8, None), (6, "..."), (10, PROSE)]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, gram string")


@pytest.mark.parametrize("limit", [decontaminate.SET_LIMIT, 0])
def test_contamination_equals_brute_force(docs, items, limit):
    want = brute.contamination(named(ROWS), [(i, t) for i, t in ITEMS if i is not None])
    extra = brute.contamination(named(ROWS), ITEMS)  # a null item hits, without a name
    got = {r.doc_id: r for r in decontaminate.contamination(docs, items, set_limit=limit).collect() if r.doc_id}
    for doc, (n_words, hit, of) in want.items():
        hit = extra[doc][1]
        assert (got[doc].n_words, got[doc].n_hit, got[doc]["items"]) == (n_words, len(hit), of)
        assert got[doc].contaminated == (bool(hit) and 20 * len(hit) >= n_words)


def test_decontaminate_keeps_clean_rows_and_columns(docs, items, no_docs):
    left = decontaminate.decontaminate(docs, items)
    assert left.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 4, 5, 6, 7, 10, 12]
    assert decontaminate.decontaminate(no_docs, items).count() == 0
    assert decontaminate.decontaminate(docs, items.limit(0)).count() == docs.count()


def test_cut_spans(spark, items):
    texts = [(1, f"-- Before. {PROSE.upper()}! After."), (2, "clean"), (3, None)]
    cut = decontaminate.cut_spans(spark.createDataFrame(texts, "doc_id long, text string"), items)
    assert {r.doc_id: r.text for r in cut.collect()} == {1: "-- Before. After.", 2: "clean", 3: None}


# -- line dedup ----------------------------------------------------------------------------------------


def test_line_dedup_equals_brute_force(docs):
    want = brute.dedupe_lines(named(ROWS))
    out = line_dedup.dedupe_lines(docs)
    assert set(out.columns) == {*docs.columns, "n_dropped"}
    rows = out.collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        if r.doc_id is None:
            assert r.n_dropped == 0 and r.text in (None, f"{PROSE}\n{LINE}")
        else:
            assert (r.n_lines, r.n_dropped, r.text or "") == want[r.doc_id]


def test_line_dedup_threshold_and_empty_table(docs, no_docs):
    assert line_dedup.dedupe_lines(no_docs).count() == 0
    assert line_dedup.dedupe_lines(docs, min_docs=100).agg(F.sum("n_dropped")).first()[0] == 0


# -- html ------------------------------------------------------------------------------------------------

PARAGRAPH = "<p>Some prose, with commas, and enough words to count as a paragraph of the article.</p>"
KEPT = "Some prose, with commas, and enough words to count as a paragraph of the article."


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("plain &lt;text&gt;\n here", "plain <text> here"),
    ("<p>a<p>b<div>c</p>d</div><script>if(a<b){'</p>'}</script>e<!-- x --><b>f", "a\nb\nc\nd\nef"),
    (f"<body><div id='header'>Site</div><div class='navbar'><a href=x>One</a></div><div class='content'><h1>T &amp; U</h1>"
     f"{PARAGRAPH}<p>Short.</p><ul><li>one<li>two</ul></div><div class='sidebar'>{PARAGRAPH * 3}</div>"
     f"<div id='comments'>{PARAGRAPH * 9}</div><div class='cookie-notice'>We use cookies, all of them</div>",
     f"T & U\n{KEPT}\nShort.\none\ntwo"),
    (f"<main><section><h2>A</h2>{PARAGRAPH}</section><section><h2>B</h2><p>tiny</p></section><form>{PARAGRAPH}</form></main>"
     f"<aside>{PARAGRAPH * 4}</aside><footer>{PARAGRAPH * 4}</footer>", f"A\n{KEPT}\nB\ntiny"),
    (f"<h1>Head</h1><div>{PARAGRAPH * 2}</div><div><a href=1>link one</a></div>", f"Head\n{KEPT}\n{KEPT}"),
    ("<article>" + "<div>" * 3000 + "deep" + "</article>", "deep"), ("<p>cut off <b", "cut off"),
])
def test_html_cases(html, text):
    assert html_extract.main_text(html or "") == text


LONG = "This paragraph is long enough to be prose, as articles have it, and nobody would take it for a menu or an advert, " * 2


@pytest.mark.parametrize("name", [
    "id='content' class='has-sidebar'", "class='site-content no-sidebar'", "class='post comments-open'", "class='layout-with-nav'",
    "class='sidebar'", "id='comments'", "class='main-nav'",
])
def test_html_names_do_not_lose_the_article(name):
    page = f"<body><nav>Menu</nav><div {name}><h1>T</h1>{PARAGRAPH * 3}</div><div class='ad'>Buy this, now</div></body>"
    assert html_extract.main_text(page) == "\n".join(["T", KEPT, KEPT, KEPT])


@pytest.mark.parametrize("id_", ["discussion", "navigation", "advertising", "sponsor", "comments"])
@pytest.mark.parametrize("tag", ["section", "div"])
def test_html_ids_from_headings_do_not_lose_sections(tag, id_):
    part = f"<{tag} id='{id_}'><h2>{id_.title()}</h2>{PARAGRAPH}</{tag}>"
    page = f"<article><h1>T</h1>{PARAGRAPH * 4}{part}</article>"
    assert html_extract.main_text(page) == "\n".join(["T", *[KEPT] * 4, id_.title(), KEPT])


def test_html_names_still_leave_noise_out():
    noise = "<div class='main-nav'><a href=1>One, two</a> <a href=2>three</a></div><div class='sidebar'>Hot today</div>"
    noise += f"<div class='comments'><p>{LONG}</p></div><pre><span class='comment'># kept</span> x = 1</pre>"
    assert html_extract.main_text(f"<article><p>{LONG}</p><p>{LONG}</p>{noise}</article>").split("\n") == [
        LONG.strip(), LONG.strip(), "# kept x = 1"
    ]


SECTION = "<div><p>" + "Ordinary words, as sections hold them, fill a paragraph, until it has its length of text. " * 3 + "</p></div>"
SECTION_TEXT = SECTION[8:-10].strip()


@pytest.mark.parametrize("html, text", [
    ("<main><h1>T</h1><article>{P}{P}</article><article>{P}</article></main>", "T\nP\nP\nP"),
    ("<main><h1>T</h1><div><article>{P}{P}</article></div><div><article>{P}</article></div></main>", "T\nP\nP\nP"),
    ("<h1>T</h1><article>{P}{P}</article><div><a href=1>Next story, and another</a></div>", "T\nP\nP"),
    ("<div>{P}{P}{P}</div><pre>x = 1</pre>", "P\nP\nP\nx = 1"), ("<div>{P}{P}</div><blockquote>said</blockquote>", "P\nP\nsaid"),
    ("<div>{P}{P}</div><table><tr><td>1</td><td>2</td></tr></table>", "P\nP\n1\n2"),
    ("<div>{P}{P}</div><ul><li>one<li>two</ul>", "P\nP\none\ntwo"),
    ("<div>" + "{P}" * 20 + "</div>{S}", "P\n" * 20 + "S"),
    ("<div>{P}{P}</div>and <b>loose</b> text<br>between <div>{P}</div>", "P\nP\nand loose text between\nP"),
    ("<div>{P}</div><a href=1>Somewhere else</a><div>short</div><p>x</p><div>end</div>", "P\nshort\nx"),
    ("Loose text before it, long enough to be prose.<div>{P}{P}</div>", "Loose text before it, long enough to be prose.\nP\nP"),
])
def test_html_siblings_by_their_own_text(html, text):
    page = html.replace("{P}", PARAGRAPH).replace("{S}", SECTION)
    want = [{"P": KEPT, "S": SECTION_TEXT}.get(line, line) for line in text.split("\n")]
    assert html_extract.main_text(f"<body><div>{page}</div></body>").split("\n") == want


@pytest.mark.parametrize("html, text", [
    (f"{PARAGRAPH}<p>if a < b then a long tail, to the end", f"{KEPT}\nif a < b then a long tail, to the end"),
    ("plain text, where 1 < 2 and x <3", "plain text, where 1 < 2 and x <3"), ("a < b, then <b", "a < b, then"),
    ("a <= b &lt; c</p", "a <= b < c"), ("ends with <", "ends with <"), ("<p>1 << 2 <!-- cut", "1 << 2"),
    ("x < " * 20_000, " ".join(["x <"] * 20_000)),
])
def test_html_text_after_a_sign_that_is_no_tag(html, text):
    assert html_extract.main_text(html) == text


def test_html_column(spark):
    pages = spark.createDataFrame([(1, None, "x"), (2, PARAGRAPH * 500, "y")], "page_id long, html string, text string")
    got = {r.page_id: r.text for r in html_extract.with_main_text(pages).collect()}
    assert got == {1: "", 2: "\n".join([KEPT] * 500)}
    assert html_extract.with_main_text(pages.limit(0)).count() == 0


def own(n):
    return f"Sentence number {n} of the article, which is long enough, has commas, and goes on for a while to count. " * 2


def remark(n):
    return f"Reader remark {n}, which is also long, has commas, and goes on for quite a while so that it counts a lot. " * 2


def remarks(count, wrap="<li><p>{}</p></li>"):
    return "".join(wrap.format(remark(n)) for n in range(count))


# Pages whose main text is the sentences 1 and 2 (or 1), and that have other prose.
LAYOUTS = {
    "discussion beside an article": (1, f'<article><h1>T</h1><p>{own(1)}</p></article><section class="user-discussion"><ul>{remarks(5)}</ul></section>'),
    "discussion beside a post": (2, f'<div class="post"><p>{own(1)}</p><p>{own(2)}</p></div><section class="user-discussion"><ul>{remarks(5)}</ul></section>'),
    "comment inside an article": (1, f'<article><h1>T</h1><p>{own(1)}</p><div class="comment">{remarks(3, "<p>{}</p>")}</div></article>'),
    "notice beside an article": (1, f'<div class="site-notice"><p>{remark(1)}</p></div><article><h1>T</h1><p>{own(1)}</p></article>'),
    "notice beside a story": (2, f'<div class="site-notice"><p>{remark(1)}</p></div><div class="story"><p>{own(1)}</p><p>{own(2)}</p></div>'),
    "box beside main": (1, f'<main><h1>T</h1><p>{own(1)}</p></main><div class="xyz"><p>{remark(1)}</p><p>{remark(2)}</p></div>'),
    "comments of a post": (2, f'<div class="entry"><p>{own(1)}</p><p>{own(2)}</p></div><div class="post-comments">{remarks(5, "<div class=comment-body><p>{}</p></div>")}</div>'),
    "articles in main": (2, f'<main><h1>T</h1><article><p>{own(1)}</p></article><article><p>{own(2)}</p></article></main>'),
    "a page with a sidebar": (2, f'<div id="content" class="has-sidebar"><p>{own(1)}</p><p>{own(2)}</p></div><div class="sidebar"><p>{remark(1)[:90]}</p></div>'),
    "open comments": (2, f'<div class="post comments-open"><p>{own(1)}</p><p>{own(2)}</p></div>'),
    "a section about a discussion": (2, f'<article><h1>T</h1><p>{own(1)}</p><section id="discussion"><h2>Discussion</h2><p>{own(2)}</p></section></article>'),
    "unnamed text, named comments": (2, f'<div><p>{own(1)}</p><p>{own(2)}</p></div><div id="comments"><ol>{remarks(6)}</ol></div>'),
    "thread of replies": (1, f'<article><p>{own(1)}</p></article><div class="thread"><h3>3 Replies</h3>{remarks(4, "<div class=reply><p>{}</p></div>")}</div>'),
    "consent box": (2, f'<div class="wrap"><div class="left"><p>{own(1)}</p><p>{own(2)}</p></div><div class="consent-box"><p>{remark(1)}</p></div></div>'),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_html_layouts_keep_the_article_and_nothing_else(name):
    count, body = LAYOUTS[name]
    for page in (f"<html><body>{body}</body></html>", f'<body><nav>{remark(9)}</nav><div id="page">{body}</div><footer>{remark(8)}</footer></body>'):
        text = html_extract.main_text(page)
        assert "remark" not in text, name
        assert [n for n in (1, 2) if f"Sentence number {n} " in text] == list(range(1, count + 1)), name


# -- fingerprints ----------------------------------------------------------------------------------------


def test_successors_wrap_round_and_follow_ids(docs, no_docs):
    rows = merkle.with_successors(docs).collect()
    assert len(rows) == len({(i, t or "") for i, t in ROWS})
    order = sorted({i for i, _ in named(ROWS)})
    by_id = {i: t or "" for i, t in ROWS}
    for r in rows:
        if r.doc_id is not None and r.doc_id != order[-1]:
            after = by_id[order[order.index(r.doc_id) + 1]]
            n = len(r.text) // 4
            assert r.edited == r.text[: len(r.text) - n] + after[:n]
    assert merkle.with_successors(no_docs).count() == 0
    alone = docs.where("doc_id = 1")
    r = merkle.with_successors(alone).first()
    assert r.edited == r.text[: len(r.text) - len(r.text) // 4] + r.text[: len(r.text) // 4]


def test_equal_texts_have_equal_trees_and_edits_are_located(spark):
    a = "".join(f"Paragraph {n}, with a clause, and another one.\n" for n in range(40))
    b = a.replace("Paragraph 17,", "Paragraph x,")
    rows = spark.createDataFrame([(a, a, b, "")], "a string, same string, b string, none string")
    for name in rows.columns:
        rows = merkle.with_fingerprint(rows, name, f"{name}_print")
    one = rows.select(
        (F.col("a_print") == F.col("same_print")).alias("equal"),
        merkle.likeness(F.col("a_print"), F.col("same_print")).alias("same"),
        merkle.likeness(F.col("a_print"), F.col("b_print")).alias("near"),
        merkle.likeness(F.col("a_print"), F.col("none_print")).alias("far"),
        merkle.edited_paragraphs(F.col("b_print"), F.col("a_print")).alias("places"),
    ).first()
    assert one.equal and one.same == 1.0 and 0.9 < one.near < 1 and one.far == 0
    assert one.places == [17]


def test_likeness_of_texts_without_marks_or_blanks(spark):
    """Three quarters of a text unchanged show, also in one clause of words, of signs, or with full-width marks."""
    rng = random.Random(8)
    signs = [chr(0x4E00 + 7 * n) for n in range(400)]
    words = " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(400))
    texts = [words, "".join(rng.choices(signs, k=600)), "".join(rng.choices([*signs[:40], "。", "，"], k=600)), words.replace(" ", "\x01 ")]
    rows = [(n, text, text[: -(len(text) // 4)] + text[-(len(text) // 4) :][::-1]) for n, text in enumerate(texts)]
    frame = spark.createDataFrame(rows, "n int, a string, b string")
    frame = merkle.with_fingerprint(merkle.with_fingerprint(frame, "a", "of_a"), "b", "of_b")
    near = [r[0] for r in frame.orderBy("n").select(merkle.likeness(F.col("of_a"), F.col("of_b"))).collect()]
    assert all(0.6 < x < 0.9 for x in near[:3])
    assert near[3] == 0  # holds the sign that marks cuts, so it stays one clause


# -- near-duplicates --------------------------------------------------------------------------------------


def test_components_of_rows(docs, no_docs):
    prints = {i: brute.simhash(t) for i, t in named(ROWS)}
    low = brute.components(prints)
    out = simhash.with_components(docs)
    assert set(out.columns) == set(docs.columns)
    rows = out.collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert r.fingerprint == f"{brute.simhash(r.text):016x}"
        if r.doc_id is not None:
            assert r.component_id == low[r.doc_id]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {i for i in low if low[i] == i}
    assert all(low[r.doc_id] == r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert simhash.keep_one(no_docs).count() == 0


@pytest.mark.parametrize("block", [simhash.BLOCK, 8])
def test_links_of_dense_groups(spark, block):
    """Fingerprints around a few centres: full cells, spreads, blocks; components as by brute force."""
    rng = random.Random(block)
    prints = {0, (1 << 64) - 1}
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(150):
            prints.add(centre ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(4))}))
    prints |= {rng.getrandbits(64) for _ in range(300)}
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    links = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "p long"), "p", block=block)
    links = durable(links, "links")
    assert all(((r.a ^ r.b) % 2**64).bit_count() <= 3 for r in links.collect())
    found = {r.node: r.component for r in components.components(links, "a", "b").collect()}
    want = brute.components({p: p % 2**64 for p in signed})
    assert {p: found.get(p, p) for p in signed} == want


def test_components_of_a_long_chain(spark):
    chain = spark.range(400).selectExpr("id AS a", "id + 1 AS b")
    found = components.components(chain.union(spark.createDataFrame([(5, 5)], "a long, b long")), "a", "b").collect()
    assert {r.node for r in found} == set(range(401)) and {r.component for r in found} == {0}
    assert components.components(chain.limit(0), "a", "b").count() == 0


# -- archives ------------------------------------------------------------------------------------------------


def test_archives_round_trip(spark):
    long = "<p>" + "long enough to be worth a reference " * 200
    rows = [(1, "http://a/1", long), (2, "http://a/ 2\r\nX: y", long), (3, None, None), (4, "", "short"), (5, "u", "short"),
            (None, "n", long), (6, "http://b", "é" * 100_000), (7, "v", long + "!"), (7, "v", long + "!")]
    rows += [(n, f"http://c/{n}", f"<html>{n}" + "common words of every page " * 40) for n in range(10, 80)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record_type string")
    folder = fresh_dir(spark, "warc-test")
    written = warc.write(pages.repartition(2), folder, archive_bytes=60_000)
    assert written.count() > 2
    warc.write(pages, folder)  # what is not reported is not read
    got = warc.read(spark, folder, written).collect()
    assert len(got) == len(rows)
    payload = {r.page_id: bytes(r.payload) for r in got if r.payload is not None}
    for page_id, _, html in rows:
        mine = [r for r in got if r.page_id == page_id]
        for r in mine:
            assert r.payload_bytes == len((html or "").encode())
            assert payload[r.refers_to if r.record_type == "revisit" else page_id] == (html or "").encode()
    kinds = {r.page_id: (r.record_type, r.refers_to) for r in got}
    assert kinds[1] == ("revisit", 2) and kinds[2] == ("response", None) and kinds[None] == ("revisit", 2)
    assert kinds[4] == kinds[5] == kinds[7] == ("response", None)
    assert {r.page_id: r.url for r in got}[2] == "http://a/%202%0D%0AX:%20y"


def test_archive_has_its_dictionary_in_front():
    records = [warc.record(n, f"http://x/{n}", b"<html>common words " * 60 + str(n).encode(), None) for n in range(200)]
    content = warc.archive(records)
    assert content[:4] == (0x184D2A5D).to_bytes(4, "little")
    assert len(list(warc.parse(content))) == 200
    single = warc.archive(records[:1])
    assert single[:4] != content[:4] and len(list(warc.parse(single))) == 1


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = fresh_dir(spark, "warc-none")
    written = warc.write(pages, folder)
    assert written.count() == 0 and warc.read(spark, folder, written).count() == 0


# -- byte-level BPE -------------------------------------------------------------------------------------------


def test_random_texts_encode_as_tiktoken_does():
    plain = brute.tokenizer()
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        codec = byte_bpe.ByteBpe(byte_bpe.read_ranks(file.read()), public_tokenizers.PATTERN)
    rng = random.Random(3)
    texts = ["".join(rng.choice("aab  cdé😀\n\t1234'st恐龍ing the  ###$$") for _ in range(rng.randrange(60))) for _ in range(3000)]
    for text in [*texts, "a" * 3000, " " * 3000, "<|endoftext|>", "é" * 500]:
        ids = codec.encode(text)
        assert ids == plain.encode_ordinary(text)
        assert codec.decode(ids).decode() == text


def test_columns_round_trip(spark, docs):
    vocabulary = byte_bpe.Vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = docs.withColumn("ids", byte_bpe.encode(F.col("text"), vocabulary))
    rows = coded.withColumn("back", byte_bpe.decode(F.col("ids"), vocabulary)).collect()
    assert all((r.ids is None) == (r.text is None) for r in rows)
    assert all(r.text is None or bytes(r.back).decode() == r.text for r in rows)


# -- language ---------------------------------------------------------------------------------------------------


def test_language_cases(spark, docs, no_docs):
    network = language_id.fit(docs)
    out = language_id.with_language(docs, network)
    assert set(out.columns) == {*docs.columns, "lang_score"}
    for r in out.collect():
        assert (r.lang_pred, r.lang_score) == ("und", 0.0) if not (r.text or "").strip() else r.lang_pred == "en"
    assert {r.lang_pred for r in language_id.with_language(docs, language_id.fit(no_docs)).collect()} == {"und"}
    assert language_id.with_language(no_docs, network).count() == 0


def test_every_window_counts():
    text = language_id.normalised("Ab1 " * 200)
    rows = language_id.windows(text)
    assert rows.shape == (3, language_id.WINDOW) and rows.tobytes().rstrip(b"\0") == text


# -- licences ----------------------------------------------------------------------------------------------------


def slow_scan(text, threshold=license_scan.THRESHOLD):
    """Every passage against every template, without bounds."""
    lines = [license_scan.line_words(line) for line in text.split("\n")]
    found = []
    for t in license_scan.known_templates():
        ends = [n for n, w in enumerate(lines) if any(p in t.counts for p in license_scan.bigrams(w))]
        for a in ends:
            for b in [n for n in ends if n >= a]:
                pairs = list(license_scan.bigrams([w for line in lines[a : b + 1] for w in line]))
                common = sum(min(n, pairs.count(p)) for p, n in t.counts.items())
                dice = 2 * common / (len(pairs) + t.size)
                if dice >= threshold:
                    found.append((dice, len(pairs), t.license, a, b))
    taken = []
    for dice, _, license_, a, b in sorted(found, key=lambda p: (-p[0], -p[1], *p[2:])):
        if all(b < x or a > y for _, x, y, _ in taken):
            taken.append((license_, a, b, dice))
    return sorted(taken, key=lambda p: p[1])


def test_license_scan_equals_brute_force():
    from gridtide.llm.license_templates import templates

    rng = random.Random(5)
    known = templates()
    for license_, text in rng.sample(known, 12) + known[-8:]:
        words = text.split(" ")
        for _ in range(len(words) // 25):
            words[rng.randrange(len(words))] = "changed"
        doc = f"Some prose of the work.\nCopyright (c) 2020 Someone\n{' '.join(words)}\nAnd the end, of the work."
        got = license_scan.scan(doc)
        assert got == slow_scan(doc)
        assert not len(words) // 25 or got or len(words) < 60
        assert license_ in [p[0] for p in license_scan.scan("x\n" + text)]


def slow_passages(words, threshold=license_scan.THRESHOLD):
    """Every range of words against every template, without bounds."""
    found = []
    for t in license_scan.known_templates():
        for a in range(len(words)):
            left, common = dict(t.counts), 0
            for b in range(a + 1, len(words)):
                pair = words[b - 1], words[b]
                if left.get(pair, 0):
                    left[pair] -= 1
                    common += 1
                dice = 2 * common / (b - a + t.size)
                if dice >= threshold:
                    found.append((-dice, a - b, t.license, a, b))
    taken = []
    for passage in sorted(found):
        if all(passage[4] < a or passage[3] > b for *_, a, b in taken):
            taken.append(passage)
    return sorted(taken, key=lambda p: p[3])


@pytest.mark.parametrize("text, want", [
    ("Copyright 2020 Foo. Licensed under the Apache License, Version 2.0.", [("Apache-2.0", 0, 0)]),
    ("Copyright (c) 2020 Foo Bar, all rights reserved. Released under the MIT License.", [("MIT", 0, 0)]),
    ("Released under the\nMIT\nLicense.", [("MIT", 0, 2)]),
    ("A long line of prose, " * 9 + "which is released under the MIT License. " + "And more of it, " * 9, [("MIT", 0, 0)]),
    ("Released under the MIT License. Docs are licensed under CC BY-NC 4.0.", [("MIT", 0, 0), ("CC-BY-NC-4.0", 0, 0)]),
    ("It is licensed under the GNU General Public License, version\n3.", [("GPL-3.0", 0, 1)]),
    ("x\nThe code was\nreleased under the MIT\n\nLicense. The text is licensed under\nCC BY 4.0 as well", [("MIT", 2, 2), ("CC-BY-4.0", 4, 5)]),
    ("as it is licensed under the GNU General Public License, version\n3. Mind the rest of that file, please", [("GPL-3.0", 0, 1)]),
])
def test_license_notices_inside_and_across_lines(text, want):
    assert [p[:3] for p in license_scan.scan(text)] == want


@pytest.mark.parametrize("text, want", [
    ("MIT License", "MIT"), ("It is free under the terms of the MIT license, as is.", "MIT"), ("This code is MIT licensed.", "MIT"),
    ("// SPDX-License-Identifier: MIT", "MIT"), ("# SPDX-License-Identifier: GPL-2.0-only\nx = 1", "GPL-2.0"),
    ("SPDX-License-Identifier: LGPL-2.1-or-later", "LGPL-2.1"), ("Licensed under the GPL v3", "GPL-3.0"),
])
def test_license_tags_and_short_notices(text, want):
    assert [p[0] for p in license_scan.scan(text)] == [want]


def test_license_near_copies_take_time_in_proportion():
    """A megabyte of copies of a long licence, each with too many words replaced to count, and one that counts."""
    whole = dict(license_scan.full_texts())["GPL-3.0"]

    def spoilt(share, seed):
        rng = random.Random(seed)
        return " ".join(word if rng.random() > share else f"xq{rng.randrange(10**6)}" for word in whole.split(" "))

    assert [p[0] for p in license_scan.scan(spoilt(0.05, 1))] == ["GPL-3.0"]
    started = time.monotonic()
    found = license_scan.scan("\n".join([*(spoilt(0.15, n) for n in range(15)), spoilt(0.08, 99), *(spoilt(0.2, n) for n in range(14))]))
    # Besides the whole copy at most headers, some of which are spared by chance.
    assert {p[0] for p in found} == {"GPL-3.0"} and [p[2] - p[1] > 300 for p in found].count(True) == 1
    assert time.monotonic() - started < 60


def test_license_on_one_line_after_its_copyright():
    from gridtide.llm.license_templates import TEXTS

    for license_, text in TEXTS:
        line = " ".join(text.split())
        for doc in (f"Copyright (c) 2020 Foo Bar {line}", f"Copyright (c) 2020, Foo, Inc. All rights reserved. {line} And more prose."):
            assert [(p[0], p[1], p[2]) for p in license_scan.scan(doc)] == [(license_, 0, 0)]


def test_license_scan_equals_every_range_of_words():
    rng = random.Random(7)
    notices = [text for _, text in license_scan.templates() if len(text) < 90]
    for _ in range(12):
        words = " ".join([*rng.sample(notices, 2), "and some prose"]).split()
        for _ in range(3):
            words[rng.randrange(len(words))] = rng.choice(["License", "under", "the", "other"])
        words = license_scan.line_words(" ".join(words))
        scan = license_scan.Scan(words, license_scan._hopeful(words, license_scan.THRESHOLD), license_scan.THRESHOLD)
        want = slow_passages(words)
        assert scan.words([(0, len(words))]) == scan.words(scan.parts) == want
        # No line holds one notice: the same words across lines, and inside one.
        assert [p[0] for p in license_scan.scan(f"{'other words ' * 9}{' '.join(words)} {'more words ' * 9}")] == [p[2] for p in want]


def test_license_headers_and_full_texts_have_their_own_names():
    from gridtide.llm.license_templates import full_texts, headers, SHORT_TEXTS, TEXTS

    for license_, text in [*headers(), *SHORT_TEXTS, *TEXTS, *full_texts()]:
        words = text.split(" ")
        for n in range(30, len(words), 60):
            if not any(word[:1].isdigit() or word == "version" for word in words[n - 1 : n + 2]):
                words[n] = "changed"
        changed = " ".join(words)
        for doc in (text, f"Some prose before.\n{changed}\nSome prose after.", " ".join(changed.split())):
            got = license_scan.scan(doc)
            assert license_ in [p[0] for p in got], (license_, got)
        assert [p[0] for p in license_scan.scan(text)] == [license_]


@pytest.mark.parametrize("license_, name, version, subject", [
    ("AGPL-3.0", "GNU Affero General Public License", "either version 3", "program"),
    ("LGPL-2.1", "GNU Lesser General Public License", "either version 2.1", "library"),
    ("LGPL-3.0", "GNU Lesser General Public License", "either version 3", "library"),
    ("GPL-2.0", "GNU General Public License", "either version 2", "program"),
    ("GPL-3.0", "GNU General Public License", "either version 3", "program"),
])
def test_license_headers_of_one_family(license_, name, version, subject):
    text = (
        f"# Foo is free software; you can redistribute it and/or modify\n# it under the terms of the {name}\n# as published by the "
        f"Free Software Foundation; {version} of the\n# License, or (at your option) any later version.\n#\n# Foo is distributed in "
        f"the hope that it will be useful,\n# but WITHOUT ANY WARRANTY; without even the implied warranty of\n# MERCHANTABILITY or "
        f"FITNESS FOR A PARTICULAR PURPOSE. See the\n# {name} for more details.\n#\n# You should have received a copy of the {name}\n"
        f"# along with this {subject}. If not, see <https://www.gnu.org/licenses/>."
    )
    assert [p[0] for p in license_scan.scan(text)] == [license_]


def test_license_columns(docs, no_docs):
    out = license_scan.with_licenses(docs)
    assert set(out.columns) == set(docs.columns)
    assert all(r.licenses == [] for r in out.collect())
    assert license_scan.with_licenses(no_docs).count() == 0


# -- toxicity ----------------------------------------------------------------------------------------------------


def test_swapping_groups_hardly_moves_the_score(spark):
    """Toxic rows happen to name one group; the counterfactual term keeps the others from paying for it."""
    rng = random.Random(11)
    filler = [f"word{n}" for n in range(300)]
    rows = []
    for n in range(800):
        toxic = n % 4 == 0
        body = rng.sample(filler, 12) + (["idiots"] if toxic and rng.random() < 0.6 else [])
        group = "muslims" if rng.random() < (0.8 if toxic else 0.05) else "christians" if n % 3 == 0 else "people"
        rows.append((n, " ".join([*body, group]), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = docs.select("doc_id", "toxic")

    def gap(model):
        raw = [sum(w for f, w in model.weights.items() if f in toxicity.features(g)) for g in ("muslims", "christians")]
        return abs(raw[0] - raw[1])

    fair, plain = toxicity.fit(docs, labels), toxicity.fit(docs, labels, counterfactual=0.0)
    assert gap(fair) < gap(plain) / 3
    assert fair.score("you idiots") > 0.3 > fair.score("muslims met here")


def test_toxicity_cases(spark, docs, no_docs):
    labels = spark.createDataFrame([(1, 0), (12, 1), (None, 1), (99, 1), (2, None), (12, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    out = toxicity.with_toxicity(docs, model)
    assert set(out.columns) == {*docs.columns, "toxic"}
    rows = out.collect()
    assert len(rows) == len(ROWS) and all(0 <= r.toxicity <= 1 for r in rows)
    assert len({r.toxicity for r in rows if not (r.text or "").strip()}) == 1
    assert toxicity.fit(docs, labels.limit(0)).weights == {}
    assert toxicity.fit(no_docs, labels).weights == {}
    assert toxicity.keep_civil(no_docs, model).count() == 0


def test_toxicity_learns_from_the_labels_of_present_documents(spark):
    labels = spark.range(6000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS toxic")
    docs = spark.range(200).selectExpr("id AS doc_id", "IF(id % 2 = 1, 'you idiots', 'good people') AS text")
    model = toxicity.fit(docs, labels, per_class=40)
    assert model.score("idiots") > 0.5 > model.score("good")


def test_repeated_rows_of_an_id_teach_once(spark, monkeypatch):
    labels = spark.range(200).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS toxic")
    words = "IF(id % 2 = 1, 'you idiots', 'good people')"
    docs = spark.range(200).selectExpr("id AS doc_id", f"{words} AS text", "IF(id % 2 = 0, 'en', 'de') AS lang")
    more = spark.range(4000).selectExpr("1L AS doc_id", "'you idiots' AS text", "'de' AS lang")
    assert toxicity.fit(docs.union(more), labels) == toxicity.fit(docs, labels)

    monkeypatch.setattr(language_id, "train_on", lambda rows, answers: answers)
    assert language_id.fit(docs.union(more), per_language=20) == language_id.fit(docs, per_language=20)
    assert language_id.fit(docs.union(more), per_language=20).count("de") >= 20


# -- pipeline ----------------------------------------------------------------------------------------------------


def test_stages_on_odd_and_no_rows(spark, tables, docs, no_docs):
    for rows in (docs, no_docs):
        left = rows
        for _, stage in corpus_pipeline.STAGES:
            left = durable(stage(spark, left, tables), "stage")
            assert set(rows.columns) <= set(left.columns)
        assert left.count() <= rows.count()
