"""Licence passages in texts, by the Dice coefficient over word bigrams.

The words (letters and digits, lower case, versions in one piece) of a passage, and those of a template, make multisets
of bigrams; Dice is twice their common part over the sum of their sizes. Copyright clauses (sign, years and holder) are
left out on both sides, the rest of their line is not. For a passage to reach the threshold t against a template of n
bigrams it must have between n t / (2 - t) and n (2 - t) / t of them, and as many as the lower bound in common. The text's
own bigrams are counted against that bound first, which rules out nearly every template for nearly every text, and the
bigrams within reach of each start after that. The best passage found so far is the threshold for the next.

Passages are runs of whole lines first. Of those over the threshold, the best are kept that do not overlap: by Dice, then
size, then licence, then place. A run gives way to a range of words at its place that has a higher Dice with
another licence and no fewer bigrams in common: a line break had cut that notice. Then ranges of words are passages, by the
same order, in all words that the kept runs' own best ranges leave, so notices inside longer lines, across them and several
on one line are found.

Defined cases. Null or empty text has no passages. Lines are cut at \\n and numbered from 0; a passage of
words has the lines of its first and last one. One scan is one Arrow UDF over whole texts; the templates are a small fixed table.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import ship, whole, without
from gridtide.llm.license_templates import full_texts, templates

THRESHOLD = 0.8
WORD = re.compile(r"[^\W_]+(?:\.\d+)*")
COPYRIGHT_HINT = re.compile(r"copyright|\(c\)|©|all rights reserved", re.IGNORECASE)
# A clause is the sign, with years or at the start of a line, and a holder of at most ten words up to the end of the
# line, of the sentence or to a word that begins a notice. A holder that has no such end stays.
CLAUSE = re.compile(
    r"""(?:(?:copyright\b\s*)?(?:\(c\)|©)|copyright\b)\s*(?:(?:\(c\)|©)\s*)?(?=(?:19|20)\d\d\b)YEARS HOLDER
    |^\W*(?:copyright\b(?:\s*(?:\(c\)|©))|©)\s*HOLDER
    |^\W*copyright\s+(?!(?:holder|owner|notice|law|license|licence|statement|interest|and|or|in|of|is|to|act)s?\b)HOLDER
    |^\W*all\s+rights\s+reserved\W*$""".replace("YEARS", r"(?:(?:19|20)\d\d|\d\d\b|present\b|[\s,–-])+").replace(
        "HOLDER",
        r"""(?:\s*(?:(?!(?:licen[sc]ed|released|distributed|published|permission|permitted|redistribution|everyone|this|the\s+above
        |under|use|all\s+rights|spdx|see)\b)[^\s]+?(?:\s+|(?=[.;](?:\s|$))|$)){0,10}?
        (?:\s*(?:(?=(?:licen[sc]ed|released|distributed|published|permission|permitted|redistribution|everyone|this|the\s+above
        |under|use|spdx|see)\b)|[.;]?\s*all\s+rights\s+reserved\b\.?|[.;](?=\s|$)|$)))?""",
    ),
    re.IGNORECASE | re.VERBOSE,
)
PASSAGE = "array<struct<license: string, first_line: int, last_line: int, dice: double>>"


def line_words(line: str) -> list[str]:
    if COPYRIGHT_HINT.search(line):
        line = CLAUSE.sub(" ", line)
    return WORD.findall(line.lower())


def bigrams(words: list[str]):
    return zip(words, words[1:])


@dataclass
class Template:
    license: str
    counts: Counter
    size: int


def _known(texts: list[tuple[str, str]]) -> tuple[Template, ...]:
    found = []
    for license_, text in texts:
        counts = Counter(bigrams([word for line in text.split("\n") for word in line_words(line)]))
        found.append(Template(license_, counts, sum(counts.values())))
    return tuple(found)


@cache
def known_templates() -> tuple[Template, ...]:
    return _known(templates())


@cache
def all_templates() -> tuple[Template, ...]:
    return known_templates() + _known(full_texts())


@cache
def known_bigrams() -> frozenset:
    return frozenset(pair for template in all_templates() for pair in template.counts)


def bounds(size: int, threshold: float) -> tuple[float, float]:
    """Least and most bigrams of a passage that can reach the threshold against a template of this size."""
    return size * threshold / (2 - threshold), size * (2 - threshold) / threshold


def _need(size: int, threshold: float) -> tuple[int, float]:
    """Least bigrams in common, and most bigrams, of a passage that reaches the threshold."""
    least, most = bounds(size, threshold)
    return max(math.ceil(least - 1e-9), 1), most + 1e-9


class Places:
    """Where a template's bigrams stand among those of a text, and what each one adds to a passage.

    A bigram counts for a passage if, from the passage's first word on, it has not stood there more often than in the
    template: if the occurrence that lies as many occurrences back lies before the passage (`gate`)."""

    def __init__(self, template: Template, pairs: list[tuple]):
        self.template = template
        before: dict[tuple, list[int]] = {}
        at, gate = [], []
        for n, pair in enumerate(pairs):
            times = template.counts.get(pair)
            if times:
                seen = before.setdefault(pair, [])
                at.append(n), gate.append(seen[-times] if len(seen) >= times else -1)
                seen.append(n)
        self.at, self.gate = np.array(at, np.int64), np.array(gate, np.int64)

    def inside(self, start: int, stop: int) -> Places:
        part = object.__new__(Places)
        low, high = np.searchsorted(self.at, (start, stop))
        part.template, part.at, part.gate = self.template, self.at[low:high], self.gate[low:high]
        return part


def _best(places: Places, starts: np.ndarray, ends: np.ndarray, threshold: float):
    """The best passage over the threshold as (-Dice, -size, license, first word, last word), or None.

    It begins at one of `starts` and ends at one of `ends`. All ends of a start are weighed at once. By how much the
    best of them misses the threshold tells how many starts cannot reach it: moving the start by a word takes a word from the
    passage and adds nothing in common."""
    size, at = places.template.size, places.at
    need, most = _need(size, threshold)
    ahead = max(64, size // 4)
    low = np.searchsorted(at, starts)
    whole = low + need <= len(at)
    hopeful = np.flatnonzero(whole)
    hopeful = hopeful[at[low[hopeful] + need - 1] - starts[hopeful] < most]
    found, after = None, -1
    for n in hopeful.tolist():
        first, begin = int(starts[n]), int(low[n])
        if first < after or begin + need > len(at) or at[begin + need - 1] - first >= most:
            continue
        reach = first + int(most) + ahead
        a, b = np.searchsorted(ends, first, "right"), np.searchsorted(ends, reach, "right")
        if a == b:
            continue
        stops = ends[a:b]
        finish = np.searchsorted(at, reach)
        counts = np.concatenate([[0], np.cumsum(places.gate[begin:finish] < first)])
        common = counts[np.searchsorted(at[begin:finish], stops)]
        dice = 2 * common / (stops - first + size)
        top = float(dice.max())
        if top >= threshold:
            last = int(stops[np.flatnonzero(dice == top)[-1]])
            passage = (-top, first - last, places.template.license, first, last)
            if found is None or passage < found:
                found, threshold = passage, top
                need, most = _need(size, threshold)
                if top == 1:
                    return found  # the first whole copy: nothing comes before it
        else:
            missed = threshold * (stops - first + size) - 2 * common
            after = first + min(int(missed.min() / threshold - 1e-6), ahead)
    return found


def _parts(places: list[Places], threshold: float) -> list[tuple[int, int]]:
    """Stretches of words that hold every passage, as first word and the one after the last."""
    spans: list[tuple[int, int]] = []
    for held in places:
        need, most = _need(held.template.size, threshold)
        if len(held.at) >= need:
            first = held.at[: len(held.at) - need + 1]
            near = first[held.at[need - 1 :] - first < most]
            spans += [(a, a + int(most) + 1) for a in near.tolist()]
    parts: list[tuple[int, int]] = []
    for first, stop in sorted(spans):
        if parts and first < parts[-1][1]:
            parts[-1] = parts[-1][0], max(stop, parts[-1][1])
        else:
            parts.append((first, stop))
    return parts


def _hopeful(words: list[str], threshold: float) -> list[Template]:
    """The templates that a passage of these words could reach."""
    known = known_bigrams()
    seen = [pair for pair in bigrams(words) if pair in known]
    if not seen:
        return []
    times = Counter(seen)
    hopeful = []
    for template in all_templates():
        need = _need(template.size, threshold)[0]
        if len(seen) < need:
            continue
        few, many = sorted((times, template.counts), key=len)
        if sum(min(n, many[pair]) for pair, n in few.items() if pair in many) >= need:
            hopeful.append(template)
    return hopeful


class Scan:
    """The search in one text."""

    def __init__(self, words: list[str], hopeful: list[Template], threshold: float):
        self.threshold, self.stop = threshold, len(words)
        pairs = list(bigrams(words))
        self.places = [Places(template, pairs) for template in hopeful]
        self.parts = _parts(self.places, threshold)

    def best_words(self, places: Places, start: int, stop: int, threshold: float):
        inside = places.inside(start, stop - 1)
        return _best(inside, inside.at, inside.at + 1, threshold)

    def best(self, search, threshold: float):
        """The best of all templates, with its places, by `search(places, threshold)`."""
        found = None
        for places in self.places:
            passage = search(places, threshold)
            if passage and (found is None or passage < found[0]):
                found, threshold = (passage, places), -passage[0]
        return found

    def words(self, parts: list[tuple[int, int]]) -> list[tuple]:
        """Ranges of words, in page order."""
        taken = []
        while parts:
            start, stop = parts.pop()
            found = self.best(lambda places, least: self.best_words(places, start, stop, least), self.threshold)
            if found:
                taken.append(found[0])
                parts += [(start, found[0][3]), (found[0][4] + 1, stop)]
        return sorted(taken, key=lambda p: p[3])

    def runs(self, starts: list[int], ends: list[int]) -> list[tuple]:
        """Runs of whole lines, as (passage, places) in page order. The lines begin and end with these words."""
        stretches: list[tuple[int, int]] = []  # of lines
        for start, stop in self.parts:
            first, last = bisect_right(starts, start) - 1, bisect_right(starts, stop - 1) - 1
            if stretches and first <= stretches[-1][1]:
                stretches[-1] = stretches[-1][0], max(last, stretches[-1][1])
            else:
                stretches.append((first, last))
        taken = []
        while stretches:
            first, last = stretches.pop()
            if first > last:
                continue
            begin, finish = (np.array(x[first : last + 1], np.int64) for x in (starts, ends))

            def search(places, least):
                return _best(places.inside(int(begin[0]), int(finish[-1])), begin, finish, least)

            found = self.best(search, self.threshold)
            if found:
                taken.append(found)
                stretches.append((first, bisect_left(starts, found[0][3]) - 1))
                stretches.append((bisect_left(ends, found[0][4]) + 1, last))
        return sorted(taken, key=lambda f: f[0][3])

    def rival(self, run: tuple, places: Places, core: tuple, low: int, high: int):
        """The best range of words between `low` and `high` over the run's core that tells of another licence, or None."""
        common = -run[0] * (places.template.size - run[1]) / 2
        found = None
        for other in self.places:
            size = other.template.size
            if other.template.license != run[2]:
                reach = int(_need(size, self.threshold)[1]) + 1
                start, stop = max(low, core[3] - reach), min(high, core[4] + reach + 1)
                passage = self.best_words(other, start, stop, max(-run[0], self.threshold))
                if (
                    passage and passage[0] < run[0] and passage[3] <= core[4] and passage[4] >= core[3]
                    and -passage[0] * (size - passage[1]) / 2 >= common - 1e-9 and (found is None or passage < found)
                ):
                    found = passage
        return found

    def passages(self, starts: list[int], ends: list[int]) -> list[tuple]:
        runs = self.runs(starts, ends)
        cores = [self.best_words(places, run[3], run[4] + 1, self.threshold) for run, places in runs]
        kept, parts, start = [], [], 0
        for n, (run, places) in enumerate(runs):
            high = cores[n + 1][3] if n + 1 < len(runs) else self.stop
            other = self.rival(run, places, cores[n], start, high)
            kept.append(other or run)
            core = other or cores[n]
            parts.append((start, core[3]))
            start = core[4] + 1
        parts.append((start, self.stop))
        # What is left of the stretches that can hold passages.
        left = [(max(a, b), min(c, d)) for a, c in parts for b, d in self.parts if max(a, b) < min(c, d)]
        return sorted(kept + self.words(left), key=lambda p: (p[3], p[4]))


def scan(text: str, threshold: float = THRESHOLD) -> list[tuple[str, int, int, float]]:
    """Passages of the text: (license, first line, last line, Dice), in page order."""
    # The cheap test is on the bigrams of the whole text, which are at least those of its passages.
    lines = None
    if COPYRIGHT_HINT.search(text):
        lines = [line_words(line) for line in text.split("\n")]
        words = [word for line in lines for word in line]
    else:
        words = WORD.findall(text.lower())
    hopeful = _hopeful(words, threshold)
    if not hopeful:
        return []
    lines = lines or [line_words(line) for line in text.split("\n")]
    line_of = [n for n, line in enumerate(lines) for _ in line]
    starts = [n for n, line in enumerate(line_of) if not n or line != line_of[n - 1]]
    ends = [n - 1 for n in starts[1:]] + [len(words) - 1]
    found = Scan(words, hopeful, threshold).passages(starts, ends)
    return [(license_, line_of[first], line_of[last], -dice) for dice, _, license_, first, last in found]


def licenses(text: Column, threshold: float = THRESHOLD) -> Column:
    """The passages as a column of array<struct<license, first_line, last_line, dice>>."""

    @F.arrow_udf(PASSAGE)
    def scanned(column: pa.Array) -> pa.Array:
        names = ("license", "first_line", "last_line", "dice")
        kind = pa.list_(pa.struct(list(zip(names, (pa.string(), pa.int32(), pa.int32(), pa.float64())))))
        rows = (value.as_buffer().to_pybytes().decode("utf-8", "replace") for value in column.cast(pa.binary()))
        return pa.array([[dict(zip(names, p)) for p in scan(row, threshold)] for row in rows], kind)

    return scanned(whole(text))


def with_licenses(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with the licence passages of each text; a column named licenses is replaced."""
    ship(docs.sparkSession)
    return without(docs, ["licenses"]).withColumn("licenses", licenses(F.col(text_col), threshold))
