"""Minimal acyclic transducers: sorted words to their ordinals, many tokens of a text at a time.

`build` takes distinct words in ascending order of their bytes and merges equal states as soon as no later word can change them, so the
automaton is minimal when the last word is in. An edge carries how many words come before those behind it:
the sum along a word's path is its place in the list. `Transducer.ordinals` moves all tokens of a buffer by one byte at a
time, those without an edge dropping out, through a table of edges hashed by state and byte.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np

ODD = np.uint64(0x9E3779B97F4A7C15)
FREE = np.int64(-1)


def build(words: Iterable[bytes]) -> bytes:
    """The transducer of distinct, ascending words, packed."""
    register: dict[tuple, int] = {}
    sizes: list[int] = []  # words accepted from a state on
    states, labels, targets, outputs = [], [], [], []
    # The path of the last word: its open states, each with (final, edges to settled states).
    path: list[list] = [[False, []]]
    last = b""

    def settle(depth: int) -> None:
        while len(path) - 1 > depth:
            final, edges = path.pop()
            path[-1][1].append((last[len(path) - 1], number(final, edges)))

    def number(final: bool, edges: list) -> int:
        key = (final, *edges)
        known = register.get(key)
        if known is None:
            known = register[key] = len(sizes)
            before = int(final)
            for label, target in edges:
                states.append(known), labels.append(label), targets.append(target), outputs.append(before)
                before += sizes[target]
            sizes.append(before)
        return known

    for word in words:
        if word <= last and (last or path[0][0]):
            raise ValueError("words must be distinct and ascending")
        shared = 0
        for a, b in zip(word, last):
            if a != b:
                break
            shared += 1
        settle(shared)
        path += [[False, []] for _ in range(len(word) - shared)]
        path[-1][0] = True
        last = word
    settle(0)
    start = number(*path[0])
    finals = np.zeros(len(sizes), np.uint8)
    for key, n in register.items():
        finals[n] = key[0]
    head = np.array([start, len(sizes), len(states)], np.int64).tobytes()
    parts = [np.array(x, np.int32) for x in (states, targets, outputs)] + [np.array(labels, np.uint8), finals]
    return zlib.compress(head + b"".join(part.tobytes() for part in parts), 1)


class Transducer:
    """A packed transducer made ready for streaming."""

    def __init__(self, packed: bytes):
        raw = zlib.decompress(packed)
        self.start, states, edges = (int(x) for x in np.frombuffer(raw, np.int64, 3))
        place = 24
        columns = []
        for _ in range(3):
            columns.append(np.frombuffer(raw, np.int32, edges, place))
            place += 4 * edges
        labels = np.frombuffer(raw, np.uint8, edges, place)
        self.final = np.frombuffer(raw, np.uint8, states, place + edges).astype(bool)
        self.edges, self.states = edges, states
        bits = max(4, (3 * edges // 2).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, FREE)
        self.moves = np.zeros(1 << bits, np.int64)  # target in the upper, output in the lower 32 bits
        self._insert(columns[0].astype(np.int64) * 256 + labels, columns[1].astype(np.int64) << 32 | columns[2])

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * ODD) >> self.shift).astype(np.int64)

    def _insert(self, keys: np.ndarray, moves: np.ndarray) -> None:
        slots = self._slots(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slots] == FREE)
            self.keys[slots[free]] = keys[free]  # of several for one slot the last stays
            placed = self.keys[slots] == keys
            self.moves[slots[placed]] = moves[placed]
            keys, moves, slots = keys[~placed], moves[~placed], (slots[~placed] + 1) & self.mask

    def ordinals(self, text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens (by index) that are words of the list, and their ordinals."""
        token = np.arange(len(starts))
        state, total = np.full(len(starts), self.start, np.int64), np.zeros(len(starts), np.int64)
        found, places, step = [], [], 0
        while len(token):
            ended = sizes.take(token) == step
            if ended.any():
                here = np.flatnonzero(ended)
                here = here[self.final[state[here]]]
                found.append(token[here]), places.append(total[here])
                on = np.flatnonzero(~ended)
                token, state, total = token[on], state[on], total[on]
            keys = state * 256 + text.take(starts.take(token) + step)
            slots = self._slots(keys)
            held = self.keys.take(slots)
            astray = np.flatnonzero((held != keys) & (held != FREE))
            while len(astray):
                slots[astray] = (slots[astray] + 1) & self.mask
                held[astray] = self.keys[slots[astray]]
                astray = astray[(held[astray] != keys[astray]) & (held[astray] != FREE)]
            on = np.flatnonzero(held != FREE)
            move = self.moves.take(slots.take(on))
            token, state, total = token[on], move >> 32, total[on] + (move & 0xFFFFFFFF)
            step += 1
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found), np.concatenate(places)
