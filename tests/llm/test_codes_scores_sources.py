"""Vector codes, context mixing and the source audit: brute force, and the defined cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from gridtide.llm import context_mixing, source_audit, transducer, vector_codes
from gridtide.llm.suite import ORACLE, QUERIES

# -- vector codes ------------------------------------------------------------------------------------


@pytest.mark.parametrize("width", [1, 3, 4, 5, 48])
@pytest.mark.parametrize("scale", [3, 1 << 20, 1 << 40])
def test_nearest_entry_is_exact_and_lowest(width, scale):
    rng = np.random.default_rng(width)
    parts = rng.integers(-scale, scale, (700, width))
    entries = np.concatenate([parts[:20], parts[5:9]])  # repeated entries tie
    index, distance = vector_codes.nearest(parts, entries)
    exact = [[sum((int(x) - int(y)) ** 2 for x, y in zip(p, e)) for e in entries] for p in parts[:80]]
    assert index[:80].tolist() == [row.index(min(row)) for row in exact]
    assert [int(d) for d in distance[:80]] == [min(row) for row in exact]


def test_transform_keeps_distances_times_its_width():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-99, 99, (2, 50, 6))
    gap = vector_codes.transformed(a) - vector_codes.transformed(b)
    assert (gap**2).sum(1).tolist() == (8 * ((a - b) ** 2).sum(1)).tolist()
    signs = vector_codes.transformed(np.eye(8, dtype=int)).T
    assert [(np.diff(row) != 0).sum() for row in signs] == list(range(8))


def brute_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // parts))
    ints = [[math.floor(256 * x) for x in v] + [0] * (width * parts - len(v)) for _, v, _ in kept]
    first = {}
    for (i, v, _), whole in zip(kept, ints):
        if i is not None and (i not in first or v < first[i][0]):
            first[i] = (v, whole)
    start = [first[i][1] for i in sorted(first)[:entries]] or [[0] * (width * parts)]
    cut = lambda whole, n: whole[n * width : (n + 1) * width]
    books = [[list(cut(w, n)) for w in start] for n in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda p, book: min((far(p, e), n) for n, e in enumerate(book))
    for _ in range(rounds):
        for n in range(parts):
            groups = defaultdict(list)
            for w in ints:
                groups[near(cut(w, n), books[n])[1]].append(cut(w, n))
            for e, members in groups.items():
                books[n][e] = [sum(column) // len(members) for column in zip(*members)]
    codes = []
    for (i, _, label), w in zip(kept, ints):
        found = [near(cut(w, n), books[n]) for n in range(parts)]
        codes.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
    totals = Counter()
    for _, _, error, label in codes:
        totals[label] += error
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted(((i, code, error, totals[label], digest) for i, code, error, label in codes), key=repr)


def coded(spark, rows, **options):
    frame = spark.createDataFrame([(*row, "x", 1, "y") for row in rows], "vec_id long, embedding array<float>, label int, code string, error long, part string")
    out = vector_codes.compress(frame.repartition(3), **options)
    assert out.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in out.collect()), key=repr)


def test_codes_of_odd_rows_equal_brute_force(spark):
    rng = random.Random(3)
    vector = lambda size=32: [float(np.float32(rng.uniform(-1, 1))) for _ in range(size)]
    same = vector()
    rows = [(n, vector(), n % 3) for n in range(40)] + [(n, same, None) for n in range(40, 60)]
    rows += [(None, vector(), 1), (7, vector(), 0), (7, same, 0), (7, same, 0), (60, vector(20), 2), (61, [], None)]
    rows += [(62, None, 1), (63, [None, *vector(31)], 1), (64, [float("nan"), *vector(31)], 1), (65, [float("inf"), *vector(31)], 2)]
    assert coded(spark, rows, entries=16) == brute_codes(rows, entries=16)


def test_codes_of_few_or_huge_values(spark):
    assert coded(spark, [(1, None, 1)]) == [] and coded(spark, []) == []
    rows = [(1, [1e30, -1e30] * 8, 1), (2, [float(np.float32(0.1))] * 16, 1), (3, [0.0] * 16, None)]
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]
    want = brute_codes(rows)
    assert coded(spark, rows) == [(i, code, e if e < 2**63 else None, t if t < 2**63 else None, d) for i, code, e, t, d in want]


# -- context mixing -------------------------------------------------------------------------------


def texts(rows):
    return [((t or "").encode().translate(context_mixing.LOWER)) for _, t in rows]


def trained(rows):
    return [zlib.crc32(str(i).encode()) % 5 != 1 if i is not None else True for i, _ in rows]


def brute_base(rows):
    counts = Counter()
    for text, train in zip(texts(rows), trained(rows)):
        if train:
            counts.update([*re.findall(rb"[^\x20\x09-\x0D]+", text), None])
    total, distinct = sum(counts.values()), len(counts)
    found = []
    for (i, _), text, train in zip(rows, texts(rows), trained(rows)):
        tokens = [*re.findall(rb"[^\x20\x09-\x0D]+", text), None]
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in tokens)
        found.append((i, not train, len(tokens), sum(counts[t] > 0 for t in tokens), total, round(base, 6)))
    return sorted(found, key=repr)


def scored(spark, rows, **options):
    frame = spark.createDataFrame([(*row, "x", 1, "t") for row in rows], "doc_id long, text string, score string, n long, token string")
    return context_mixing.score(frame.repartition(3), **options).collect()


MIXED = [
    (1, "The cat sat on the mat.\tThe cat!"), (2, "the  cat\nsat"), (3, None), (4, ""), (5, " \n"), (6, "École 北京 🙂 école"),
    (7, "x" * 100_000), (8, "word " * 30_000), (9, "a\x0bb\x0cc\x1cd e"), (None, "no id"), (None, None), (2, "the  cat\nsat"), (10, "a" * 70),
]


@pytest.mark.parametrize("head", [0, 3, 1 << 16])
def test_base_scores_equal_brute_force(spark, head, monkeypatch):
    rows = scored(spark, MIXED, head=head)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows), key=repr)
    assert got == brute_base(MIXED)
    assert all(r.score <= 0 and r.bits_per_byte >= 0 for r in rows)
    # Equal texts score alike, wherever they lie.
    assert len({r.score for r in rows if r.doc_id == 2}) == 1


def test_without_training_rows(spark):
    held = [n for n in range(50) if zlib.crc32(str(n).encode()) % 5 == 1][:3]
    rows = scored(spark, [(n, f"only {n}") for n in held])
    assert [(r.n_known, r.train_tokens, r.base_score) for r in rows] == [(0, 0, 0.0)] * 3 and all(r.score < 0 for r in rows)
    assert scored(spark, []) == []


def test_decisions_of_the_next_symbol_sum_to_one():
    """A probability over texts: those of all symbols that may come next add up to 1."""
    counts = np.zeros((256, context_mixing.SYMBOLS), np.int64)
    for a, b in zip(b"abracadabra", b"bracadabra"):
        counts[a, b] += 1
    code = context_mixing.Code(counts)
    rng = np.random.default_rng(5)
    tables = [rng.integers(-40, 40, context_mixing.CELLS << context_mixing.ROW_BITS).astype(np.int8) for _ in range(context_mixing.PREDICTORS)]
    mixer = context_mixing.Mixer(code, tables)
    total = math.exp(mixer.scores(iter([b""]))[0])
    part = np.concatenate([np.zeros(context_mixing.BACK, np.uint8), np.zeros(1, np.uint8)])
    for symbol in range(256):
        part[-1] = symbol
        fresh = [np.zeros(s) for s in ((context_mixing.LANES, context_mixing.REFINED),) * 2]
        weights = np.full((context_mixing.PREDICTORS, context_mixing.LANES, mixer.GATES), context_mixing.START / context_mixing.ODDS, np.float32)
        total += math.exp(-mixer._chunk([(part, False)], [0], weights, np.zeros(weights.shape), *fresh)[0])
    assert abs(total - 1) < 1e-3


def test_scores_do_not_depend_on_the_company():
    counts = np.ones((256, context_mixing.SYMBOLS), np.int64)
    code = context_mixing.Code(counts)
    tables = [np.zeros(context_mixing.CELLS << context_mixing.ROW_BITS, np.int8) for _ in range(context_mixing.PREDICTORS)]
    rng = random.Random(2)
    docs = [bytes(rng.choice(b"abc \n") for _ in range(rng.choice([0, 1, 1023, 1024, 1025, 5000]))) for _ in range(150)]
    alone = [context_mixing.Mixer(code, tables).scores(iter([d]))[0] for d in docs[:20]]
    assert context_mixing.Mixer(code, tables).scores(iter(docs))[:20] == alone


def test_mixing_learns(spark, tables):
    rows = QUERIES["op12_context_mixing"](spark, tables).collect()
    train, held = ([r for r in rows if r.held_out is h and r.n_tokens > 20] for h in (False, True))
    size = {r.doc_id: len((r.text or "").encode()) for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    for part, most in ((train, 2.4), (held, 3.0)):
        assert sum(-r.score for r in part) * math.log2(10) / sum(size[r.doc_id] for r in part) < most


# -- source audit -------------------------------------------------------------------------------------


def test_transducer_gives_ordinals_and_is_minimal():
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(7))).encode() for _ in range(90)} | {"é".encode(), b""})
    built = transducer.Transducer(transducer.build(words))
    asked = [*words, b"abz", b"bbbbbbbbb", "è".encode()]
    text = np.frombuffer(b" ".join(asked) + b" ", np.uint8)
    sizes = np.array([len(w) for w in asked])
    tokens, ordinals = built.ordinals(text, np.cumsum(sizes + 1) - sizes - 1, sizes)
    assert dict(zip(tokens.tolist(), ordinals.tolist())) == {n: n for n in range(len(words))}
    rest = {w[:n]: frozenset(v[n:] for v in words if v[:n] == w[:n]) for w in words for n in range(len(w) + 1)}
    assert built.states == len(set(rest.values()))
    with pytest.raises(ValueError):
        transducer.build([b"b", b"a"])


AUDITED = [
    ("The cat and the dog", "en", "a"), ("the cat, THE dog", "en", "b"), ("cat dog the bird", "en", "b"), ("bird Bird bird the", "en", "c"),
    ("bird", "en", None), (None, "en", "empty"), ("", "fr", "x"), ("un un un", "fr", "y"), ("École école é", None, "z"), ("École É é", None, "z"),
    ("École é2é", None, None), ("a1b a b ab", "mixed-ſ", "s"), ("a b a", "mixed-ſ", "t"), ("a b", "mixed-ſ", "t"), ("the cat and the dog", "en", "a"),
    ("x " * 3_000 + "the", "en", "long"), ("y" * 5_000 + " the", "en", "long"),
]


@pytest.mark.parametrize("options", [{}, {"block": 2, "cells": 3, "pass_bytes": 1}])
def test_audit_equals_sql(spark, options, monkeypatch):
    rows = [(n, *row) for n, row in enumerate(AUDITED)]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, lang string, source string, term string, ordinal string")
    out = source_audit.audit(frame.repartition(3), **options)
    got = sorted(map(tuple, out.select("lang", "source", "part", "item", "value", "rank").collect()))
    con = duckdb.connect()
    con.register("given", pa.table({c: [r[n] for r in rows] for n, c in enumerate(("doc_id", "text", "lang", "source"))}))
    con.execute("CREATE TABLE documents AS SELECT * FROM given")
    want = con.execute(f"SELECT lang, source, part, item, value, rank FROM ({ORACLE['op13_source_audit']})").fetchall()
    assert got == sorted(want)


def test_audit_of_pieces_and_nothing(spark, monkeypatch):
    frame = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert source_audit.audit(frame).count() == 0
    # A text cut to many pieces is still one document.
    long = " ".join(f"w{chr(97 + n % 26)}{chr(97 + n // 26 % 26)}" for n in range(4000)).encode()
    monkeypatch.setattr(source_audit, "PIECE", 100)
    pieces = list(source_audit._pieces(iter([(5, long), (6, b"a"), (6, b"")])))
    assert b" ".join(p for _, _, p in pieces).split() == long.translate(source_audit.TERMS).split() + [b"a"]
    assert {n for numbers, _, _ in pieces for n in numbers.tolist()} == {5, 6}


def test_shares_are_exact_beyond_64_bits():
    counts = np.array([0, 5, 10**10, 3 * 10**12], np.int64)
    assert source_audit.shares(counts, 7 * 10**12).tolist() == [1 + (int(c) + 1) * 10**9 // (7 * 10**12) for c in counts]
