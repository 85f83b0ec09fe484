"""The contracts once more, in plain Python on small tables."""

from __future__ import annotations

import hashlib
import re

import public_tokenizers
import tiktoken
import xxhash

from gridtide.llm.byte_bpe import read_ranks

BLANK = " \t\n\x0b\x0c\r"
UPPER = {c: c + 32 for c in range(65, 91)}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def contamination(docs, items):
    """docs and items: (id, text). {doc: (n_words, hit positions, item ids)}."""
    grams = {}
    for item, text in items:
        w = words(text)
        for at in range(max(len(w) - 12, 1) if w else 0):
            grams.setdefault(tuple(w[at : at + 13]), set()).add(str(item))
    found = {}
    for doc, text in docs:
        w, hit, of = words(text), set(), set()
        for gram, owners in grams.items():
            for at in range(len(w) - len(gram) + 1):
                if tuple(w[at : at + len(gram)]) == gram:
                    hit.update(range(at, at + len(gram)))
                    of |= owners
        found[doc] = len(w), hit, sorted(of)
    return found


def dedupe_lines(docs):
    """{doc: (lines, dropped, text left)}."""
    def key(line):
        return line.strip(BLANK).translate(UPPER)

    holders = {}
    for doc, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(doc)
    found = {}
    for doc, text in docs:
        lines = (text or "").split("\n")
        left = [x for x in lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == doc]
        found[doc] = len(lines), len(lines) - len(left), "\n".join(left)
    return found


def simhash(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[n : n + 3]) for n in range(max(1, len(w) - 2))]
    ones = [0] * 64
    for shingle in shingles:
        digest = xxhash.xxh64_intdigest(shingle, 42)
        for bit in range(64):
            ones[bit] += digest >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * ones[bit] > len(shingles))


def components(prints, bits=3):
    """prints: {doc: fingerprint}. {doc: smallest doc reachable}."""
    docs, parent = sorted(prints), {doc: doc for doc in prints}

    def top(doc):
        while parent[doc] != doc:
            doc = parent[doc]
        return doc

    for n, a in enumerate(docs):
        for b in docs[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                low, high = sorted((top(a), top(b)))
                parent[high] = low
    return {doc: top(doc) for doc in docs}


def tokenizer():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = read_ranks(file.read())
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
