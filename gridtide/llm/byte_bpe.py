"""Byte-level BPE encoding and decoding with the ranks of a public vocabulary.

A text is cut by the vocabulary's pattern. The bytes of a piece are read as Latin-1, one character a byte, so
that the trie of an Aho-Corasick automaton over strings finds the longest token at a place. The encoding
is built from the left with the longest token that goes, and then the shorter ones that begin it: two adjacent tokens go together if merging their joint bytes
ends in just these two, which is worked out once per pair, from what stands at their border as they
grow, and remembered. Where no token goes on, the
last one is taken back and the place it ended is closed for good. A chain of tokens that go together pairwise
is the encoding that the merges give, and no place is tried twice, so the work is linear in the piece.

The vocabulary reaches the tasks as a broadcast of its file (50,000 tokens, under 1 MB; refused beyond
`LARGEST_FILE`). Encoded pieces are remembered per worker in two generations of
`PIECES_HELD`, pairs up to `PAIRS_HELD`, after which their memory starts afresh: results never depend on it.

Defined cases. Null text has null ids in `encode`, and counts as empty in the query. Null ids decode to
null; an id that the vocabulary lacks is an error. Text that is not UTF-8 is read with replacement
characters.
"""

from __future__ import annotations

import base64
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from gridtide.llm.common import ship

LARGEST_FILE = 64 << 20
PIECES_HELD = 300_000  # in each of two generations
PAIRS_HELD = 400_000
NEVER = 1 << 60
LONG_PIECE = 64  # code points; longer pieces are not remembered
NEAR = 7  # bytes ahead whose longest token is remembered
NOTHING: dict[int, bool] = {}


class Remembered(dict):
    """Encoded pieces, worked out when first asked for. The pieces of two generations are held: a full one becomes the elder,
    and what is still asked for moves to the next."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.elder = encode, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        known = self.elder.get(piece)
        if known is None:
            known = self.encode(piece)
        if len(piece) <= LONG_PIECE:
            if len(self) >= PIECES_HELD:
                self.elder = dict(self)
                self.clear()
            self[piece] = known
        return known


class ByteBpe:
    """The vocabulary in one worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.whole = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        top = max(ranks.values(), default=-1) + 1
        self.sizes = [0] * top  # by rank, as the next
        for rank, token in self.tokens.items():
            self.sizes[rank] = len(token)
        self.reach = max(self.sizes, default=0)
        self.finder = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for token in self.whole:
            self.finder.add_word(token)
        # For every path of the trie, the longest token on it; and for every token the next shorter one on its path.
        self.longest: dict[str, int] = {}
        self.shorter: list[int | None] = [None] * top
        self.near: dict[str, int | None] = {}
        for token in sorted(self.whole, key=len):
            rank, below = self.whole[token], None
            for size in range(len(token) - 1, 0, -1):
                if (below := self.whole.get(token[:size])) is not None:
                    break
            self.shorter[rank] = below
        for token in self.whole:
            for size in range(len(token), 0, -1):
                path = token[:size]
                if path in self.longest:
                    break
                held = size
                while held and path[:held] not in self.whole:
                    held -= 1
                if held:
                    self.longest[path] = self.whole[path[:held]]
        self.pieces = Remembered(self.piece)
        self.pairs: dict[int, dict[int, bool]] = {}
        self.pairs_held = 0
        self.edges: dict[tuple[int, int], list[tuple[bytes, int]] | None] = {}

    def halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge makes this one, found by carrying out the merges below its rank."""
        parts = [token[n : n + 1] for n in range(len(token))]
        limit = self.ranks[token]
        while len(parts) > 2:
            rank, at = min((self.ranks.get(a + b, limit), n) for n, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= limit:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts[0], parts[1]

    def edge(self, rank: int, side: int) -> list[tuple[bytes, int]] | None:
        """What stands at an end of a token while it grows (side 0: its start, 1: its end): from the single
        byte to the token, each with the rank of the merge that takes it up."""
        known = self.edges.get((rank, side), 0)
        if known == 0:
            token, known, taken_up = self.tokens[rank], [], NEVER
            while True:
                known.append((token, taken_up))
                if len(token) == 1:
                    known.reverse()
                    break
                taken_up = self.ranks[token]
                parts = self.halves(token)
                if parts is None:  # no merge makes this token
                    known = None
                    break
                token = parts[side]
            self.edges[rank, side] = known
        return known

    def go_together(self, left: int, right: int) -> bool:
        """Whether no merge joins the two while they grow: of merges of one rank the leftmost comes first."""
        ends, starts = self.edge(left, 1), self.edge(right, 0)
        known = ends is not None and starts is not None
        a = b = 0
        while known:
            (end, end_up), (start, start_up) = ends[a], starts[b]
            across = self.ranks.get(end + start, NEVER)
            if across < end_up and across <= start_up:
                known = False
            elif end_up == start_up == NEVER:
                break
            elif end_up <= start_up:
                a += 1
            else:
                b += 1
        if self.pairs_held >= PAIRS_HELD:
            self.pairs.clear()
            self.pairs_held = 0
        self.pairs.setdefault(left, {})[right] = known
        self.pairs_held += 1
        return known

    def begins(self, ahead: str) -> int | None:
        """The longest token that begins these `NEAR` bytes (or fewer, at the end of a piece); None if it may be longer."""
        size = self.finder.longest_prefix(ahead)
        rank = None if size == NEAR else self.longest[ahead[:size]]
        if len(self.near) >= PAIRS_HELD:
            self.near.clear()
        self.near[ahead] = rank
        return rank

    def piece(self, piece: str) -> tuple[int, ...]:
        """Ids of one match of the pattern."""
        text = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1")
        if (rank := self.whole.get(text)) is not None:
            return (rank,)
        sizes, shorter, near, pairs = self.sizes, self.shorter, self.near, self.pairs
        end = len(text)
        closed = bytearray(end + 1)
        taken: list[int] = []
        at, beside, rank = 0, None, -1
        while at < end:
            if rank == -1:
                ahead = text[at : at + NEAR]
                if ahead in near:
                    rank = near[ahead]
                else:
                    rank = self.begins(ahead)
                if rank is None:
                    ahead = text[at : at + self.reach]
                    rank = self.longest[ahead[: self.finder.longest_prefix(ahead)]]
            while rank is not None:
                stop = at + sizes[rank]
                if not closed[stop]:
                    if beside is None:
                        break
                    fits = beside.get(rank)
                    if fits is None:
                        fits = self.go_together(taken[-1], rank)
                    if fits:
                        break
                rank = shorter[rank]
            if rank is None:
                closed[at] = 1
                rank = taken.pop()
                at -= sizes[rank]
                rank = shorter[rank]
                beside = pairs.get(taken[-1], NOTHING) if taken else None
            else:
                taken.append(rank)
                at = stop
                beside = pairs.get(rank, NOTHING)
                rank = -1
        return tuple(taken)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.pattern.findall(text))))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def read_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if token}


_loaded: dict[int, ByteBpe] = {}


class Vocabulary:
    """The vocabulary file at `path` (on the driver), sent to the tasks."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        with open(path, "rb") as file:
            content = file.read(LARGEST_FILE + 1)
        if len(content) > LARGEST_FILE:
            raise ValueError(f"vocabulary file exceeds {LARGEST_FILE} bytes")
        ship(spark)
        self.content, self.pattern = spark.sparkContext.broadcast(content), pattern

    def codec(self) -> ByteBpe:
        key = hash((self.content.value, self.pattern))
        if key not in _loaded:
            _loaded.clear()
            _loaded[key] = ByteBpe(read_ranks(self.content.value), self.pattern)
        return _loaded[key]


def encode(text: Column, vocabulary: Vocabulary) -> Column:
    """Token ids of the text: array<int>."""

    @F.arrow_udf("array<int>")
    def encoded(column: pa.Array) -> pa.Array:
        codec = vocabulary.codec()
        ids = []
        for value in column.cast(pa.binary()):
            held = value.as_buffer()
            ids.append(None if held is None else _ids(codec, held.to_pybytes()))
        return _lists(ids)

    return encoded(text.cast("string"))


def decode(ids: Column, vocabulary: Vocabulary) -> Column:
    """The bytes that the ids stand for."""

    @F.arrow_udf("binary")
    def decoded(column: pa.Array) -> pa.Array:
        codec = vocabulary.codec()
        return pa.array([None if value is None else codec.decode(value) for value in _values(column)], pa.binary())

    return decoded(ids)


def encode_decode(text: Column, vocabulary: Vocabulary) -> Column:
    """Both at once, for a round trip that leaves the worker once: struct<ids: array<int>, bytes: binary>."""

    @F.arrow_udf("struct<ids: array<int>, bytes: binary>")
    def both(column: pa.Array) -> pa.Array:
        codec = vocabulary.codec()
        ids, back = [], []
        for value in column.cast(pa.binary()):
            held = value.as_buffer()
            ids.append(None if held is None else _ids(codec, held.to_pybytes()))
            back.append(None if held is None else codec.decode(ids[-1].tolist()))
        return pa.StructArray.from_arrays([_lists(ids), pa.array(back, pa.binary())], ["ids", "bytes"])

    return both(text.cast("string"))


def _ids(codec: ByteBpe, text: bytes) -> np.ndarray:
    return np.array(codec.encode(text.decode("utf-8", "replace")), np.int32)


def _lists(rows: list[np.ndarray | None]) -> pa.Array:
    """Arrow lists from arrays of ids, without a Python object per id."""
    stops = np.cumsum([0] + [0 if row is None else len(row) for row in rows])
    offsets = pa.array([None if n < len(rows) and rows[n] is None else int(stop) for n, stop in enumerate(stops)], pa.int32())
    flat = np.concatenate([row for row in rows if row is not None] or [np.zeros(0, np.int32)])
    return pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))


def _values(column: pa.Array):
    for value in column:
        yield value.as_py()
