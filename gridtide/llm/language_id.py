"""Language identification by a byte convolutional network.

A text, lower-cased, with ASCII signs and digits made blanks and runs of blanks made one, is cut into windows of
`WINDOW` bytes that cover all of it. A window's bytes are embedded, convolved with filters of several
widths, max-pooled over the window and put through a softmax. A text's language is the one with the largest mean
over its windows, weighted by their bytes; that mean is the score.

The network is trained in numpy on the driver, on a bounded sample: `PER_LANGUAGE` labelled rows a language in
the order of a hash of their id, and of each `PER_TEXT` windows spread evenly over the text. Scoring takes
every window of every row, in blocks of `BLOCK` windows: embedding and filters are multiplied out to a
table per filter position, so a convolution is a sum of rows looked up by byte.

Defined cases. Null text and text without a letter is `und` with score 0. Rows with a null id or language teach
nothing; if none is left, every text is `und`. Of more than `MAX_LANGUAGES` languages the most frequent are
learned. A null id is not held out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import durable, ship, whole, without

WINDOW = 256
WIDTHS, FILTERS, EMBEDDING = (2, 3, 4, 5), 8, 8
PER_LANGUAGE, PER_TEXT, MAX_LANGUAGES = 500, 8, 256
STEPS, BATCH, RATE, SEED = 500, 64, 0.01, 7
BLOCK = 256  # windows scored at once
UNKNOWN = "und"
RESULTS = ("lang_pred", "lang_score")
LETTER = re.compile(r"[^\W\d_]")
# Every ASCII byte that is no letter reads as a blank; letters are lower-cased before.
PLAIN = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def normalised(text: str) -> bytes:
    return b" ".join(text.lower().encode("utf-8", "replace").translate(PLAIN).split())


def windows(text: bytes) -> np.ndarray:
    """All windows of the text, the last one padded with zeros."""
    count = max(1, -(-len(text) // WINDOW))
    return np.frombuffer(text.ljust(count * WINDOW, b"\0"), np.uint8).reshape(count, WINDOW)


def _softmax(raw: np.ndarray) -> np.ndarray:
    raised = np.exp(raw - raw.max(1, keepdims=True))
    return raised / raised.sum(1, keepdims=True)


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # (256, EMBEDDING)
    filters: list[np.ndarray]  # for each width (width, EMBEDDING, FILTERS)
    offsets: list[np.ndarray]  # for each width (FILTERS)
    dense: np.ndarray  # (all filters, languages)
    bias: np.ndarray

    def tables(self) -> list[list[np.ndarray]]:
        return [[np.ascontiguousarray(self.embedding @ tap) for tap in taps] for taps in self.filters]

    def probabilities(self, rows: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        pooled = []
        for taps, offset in zip(tables, self.offsets):
            reach = rows.shape[1] - len(taps) + 1
            total = taps[0].take(rows[:, :reach], axis=0)
            for n, tap in enumerate(taps[1:], 1):
                total += tap.take(rows[:, n : n + reach], axis=0)
            pooled.append(np.maximum(total.max(1) + offset, 0))
        return _softmax(np.concatenate(pooled, 1) @ self.dense + self.bias)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        known = [n for n, text in enumerate(texts) if self.languages and text and LETTER.search(text)]
        sums = np.zeros((len(texts), max(1, len(self.languages))))
        tables = self.tables()
        waiting: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        held = 0

        def settle():
            nonlocal held
            if held:
                rows, owner = np.concatenate(waiting), np.concatenate(owners)
                for at in range(0, len(rows), BLOCK):
                    part = rows[at : at + BLOCK]
                    weight = (part != 0).sum(1, keepdims=True) + 1e-9
                    np.add.at(sums, owner[at : at + BLOCK], weight * self.probabilities(part, tables))
            waiting.clear(), owners.clear()
            held = 0

        for n in known:
            rows = windows(normalised(texts[n]))
            waiting.append(rows), owners.append(np.full(len(rows), n))
            held += len(rows)
            if held >= 4 * BLOCK:
                settle()
        settle()
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        for n in known:
            best = int(sums[n].argmax())
            names[n], scores[n] = self.languages[best], float(min(1.0, sums[n, best] / sums[n].sum()))
        return names, scores


def train(rows: np.ndarray, answers: np.ndarray, languages: list[str], steps: int = STEPS) -> Network:
    """A network from windows (n, WINDOW) and the number of each one's language."""
    rng = np.random.default_rng(SEED)

    def normal(*shape):
        return (rng.standard_normal(shape) / np.sqrt(np.prod(shape[:-1]))).astype(np.float32)

    parts = {"embedding": normal(256, EMBEDDING) * 8, "dense": normal(len(WIDTHS) * FILTERS, len(languages))}
    parts["bias"] = np.zeros(len(languages), np.float32)
    for width in WIDTHS:
        parts[f"filter{width}"] = normal(width, EMBEDDING, FILTERS)
        parts[f"offset{width}"] = np.zeros(FILTERS, np.float32)

    def network() -> Network:
        return Network(
            languages, parts["embedding"], [parts[f"filter{w}"] for w in WIDTHS], [parts[f"offset{w}"] for w in WIDTHS],
            parts["dense"], parts["bias"],
        )

    first, second = ({k: np.zeros_like(v) for k, v in parts.items()} for _ in range(2))
    by_language = [np.flatnonzero(answers == n) for n in range(len(languages))]
    for step in range(1, steps + 1):
        # Languages are drawn evenly, however many windows each has.
        chosen = np.array([rng.choice(by_language[n]) for n in rng.integers(len(languages), size=BATCH)])
        x, y = rows[chosen], answers[chosen]
        pooled, places = [], []
        for width in WIDTHS:
            taps, reach = parts[f"filter{width}"], WINDOW - width + 1
            total = sum((parts["embedding"] @ taps[n]).take(x[:, n : n + reach], axis=0) for n in range(width))
            total += parts[f"offset{width}"]
            places.append(total.argmax(1))
            pooled.append(total.max(1))
        raw = np.concatenate(pooled, 1)
        hidden = np.maximum(raw, 0)
        error = _softmax(hidden @ parts["dense"] + parts["bias"])
        error[np.arange(BATCH), y] -= 1
        error /= BATCH
        slope = {"dense": hidden.T @ error, "bias": error.sum(0), "embedding": np.zeros_like(parts["embedding"])}
        back = (error @ parts["dense"].T) * (raw > 0)
        for n, width in enumerate(WIDTHS):
            part = back[:, n * FILTERS : (n + 1) * FILTERS]  # only the place of each maximum learns
            spot = places[n][:, :, None] + np.arange(width)
            seen = x[np.arange(BATCH)[:, None, None], spot]  # (batch, filter, width)
            taps = parts[f"filter{width}"]
            slope[f"filter{width}"] = np.einsum("bf,bfwe->wef", part, parts["embedding"][seen])
            slope[f"offset{width}"] = part.sum(0)
            np.add.at(slope["embedding"], seen, np.einsum("bf,wef->bfwe", part, taps))
        for name, g in slope.items():
            first[name] += 0.1 * (g - first[name])
            second[name] += 0.001 * (g * g - second[name])
            size = np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8
            parts[name] -= (RATE * (1 - step / steps * 0.9) * first[name] / (1 - 0.9**step) / size).astype(np.float32)
    return network()


def held_out(id_: Column) -> Column:
    """Rows whose language is never learned from: crc32 of the id as text leaves 2 on division by 4."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _decoded(column: pa.Array):
    for value in column.cast(pa.binary()):
        yield value.as_buffer().to_pybytes().decode("utf-8", "replace")


def _sampled(text: Column, per_text: int) -> Column:
    @F.arrow_udf("array<binary>")
    def spread(column: pa.Array) -> pa.Array:
        found = []
        for text in _decoded(column):
            rows = windows(normalised(text)) if LETTER.search(text) else np.zeros((0, WINDOW), np.uint8)
            places = np.unique(np.linspace(0, len(rows) - 1, per_text).astype(int)) if len(rows) else []
            found.append([rows[n].tobytes() for n in places])
        return pa.array(found, pa.list_(pa.binary()))

    return spread(text)


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = PER_LANGUAGE, per_text: int = PER_TEXT,
) -> Network:
    """A network from the labelled rows that are not held out, at most `per_language` a language."""
    ship(docs.sparkSession)
    labelled = docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & ~held_out(F.col(id_col)))
    known = durable(labelled.select(F.col(id_col).alias("__id"), F.col(lang_col).cast("string").alias("__lang")).distinct(), "known")
    frequent = known.groupBy("__lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "__lang")
    languages = sorted(row["__lang"] for row in frequent.limit(MAX_LANGUAGES).collect())
    chosen = None
    for language in languages:
        order = F.xxhash64(F.col("__id").cast("string"))
        part = known.where(F.col("__lang") == language).orderBy(order, "__id").limit(per_language)
        chosen = part if chosen is None else chosen.union(part)
    if chosen is None:
        return train_on([], [])
    # At most `per_language` ids for each of `MAX_LANGUAGES` languages are broadcast.
    ids = durable(chosen, "labelled")
    texts = docs.select(
        F.col(id_col).alias("__id"), F.col(lang_col).cast("string").alias("__lang"),
        whole(F.col(text_col)).alias("__body"),
    )
    held = texts.join(F.broadcast(ids), ["__id", "__lang"]).groupBy("__id", "__lang").agg(F.min("__body").alias("__body"))
    sample = held.select("__id", "__lang", _sampled(F.col("__body"), per_text).alias("rows"))
    rows = sorted((row["__lang"], row["__id"], row["rows"]) for row in sample.collect())
    return train_on([w for _, _, r in rows for w in r], [lang for lang, _, r in rows for _ in r])


def train_on(rows: list[bytes], answers: list[str]) -> Network:
    """A network from windows and their languages; without any, one that knows none."""
    seen = sorted(set(answers))
    if not seen:
        return Network([], np.zeros((256, 1), np.float32), [], [], np.zeros((0, 1), np.float32), np.zeros(1, np.float32))
    number = {language: n for n, language in enumerate(seen)}
    x = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, WINDOW)
    return train(x, np.array([number[language] for language in answers]), seen)


def identified(text: Column, network: Network) -> Column:
    """struct<lang: string, score: double> of the text."""

    @F.arrow_udf("struct<lang: string, score: double>")
    def languages(column: pa.Array) -> pa.Array:
        names, scores = network.predict(list(_decoded(column)))
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return languages(whole(text))


def with_language(docs: DataFrame, network: Network, text_col: str = "text") -> DataFrame:
    """`docs` with lang_pred and lang_score; columns of these names are replaced."""
    ship(docs.sparkSession)
    plain = without(docs, RESULTS)
    found = plain.withColumn("__found", identified(F.col(text_col), network))
    return found.select(
        *plain.columns, F.col("__found.lang").alias(RESULTS[0]), F.col("__found.score").alias(RESULTS[1])
    )
