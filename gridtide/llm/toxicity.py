"""Toxicity by a counterfactually regularised linear classifier.

A document's features are its distinct words, and the first three to eight letters of longer words, hashed to
31 bits. Of a bounded sample of labelled rows, Spark counts each feature by class and keeps the strongest ones;
a logistic model over those is fitted in numpy with an L1 penalty. The counterfactual term: in each sampled
text that names a group of people, every such term is exchanged for the next one of its list, and the
square of the change in the model's raw score is penalised. What a text says about a group may count, which group it
names may not, so neutral mentions of any group score alike.

Scoring is one Arrow UDF over all rows; the model is at most `MAX_FEATURES` weights. The sample is bounded by
`PER_CLASS` ids a class, taken in the order of a hash of the id from the labelled ids that have a document, with class
weights that restore the shares among all of those. Of an id with several rows the smallest text is learned from.

Defined cases. Null, empty or letterless text scores the model's base rate. Labels that are null, or whose
document is missing, teach nothing; an id labelled twice counts as toxic if any label says so. Without both
classes the score is the smoothed share of toxic labels. A null id is not held out.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import durable, ship, whole, without

PER_CLASS = 5000  # sampled labelled rows of either class
MAX_FEATURES = 4000
LEAST_DOCS, LEAST_Z = 3, 3.5  # documents that hold a feature; its log odds in standard errors
L1, COUNTERFACTUAL = 1e-4, 1.0  # weights of the penalties
ROUNDS = 1000
THRESHOLD = 0.3
RESULTS = ("toxicity", "toxic")

# Words that name groups of people, by what kind of group they name; a swap stays in its list.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("she", "he"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant", "sikh"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "protestants", "sikhs"),
    ("black", "white", "asian", "african", "latino", "arab", "hispanic", "european"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer", "heterosexual", "homosexual"),
    ("immigrants", "refugees", "foreigners", "migrants", "citizens", "natives"),
    ("americans", "mexicans", "chinese", "indians", "russians", "germans", "french", "turks", "poles"),
    ("old", "young"), ("disabled", "blind", "deaf", "autistic"),
    ("frauen", "männer"), ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"),
    ("schwarze", "weiße", "asiaten", "afrikaner", "araber"), ("schwule", "lesben", "heterosexuelle"),
    ("einwanderer", "flüchtlinge", "ausländer", "migranten"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("noirs", "blancs", "asiatiques", "africains", "arabes"), ("homosexuels", "lesbiennes", "hétérosexuels"),
    ("immigrés", "réfugiés", "étrangers", "migrants"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
    ("negros", "blancos", "asiáticos", "africanos", "árabes"), ("homosexuales", "lesbianas", "heterosexuales"),
    ("inmigrantes", "refugiados", "extranjeros", "migrantes"),
)
NEXT_TERM = {term: group[(n + 1) % len(group)] for group in IDENTITY_TERMS for n, term in enumerate(group)}
STEMS = range(3, 9)  # letters of a word that count as its beginning
WORD = re.compile(r"[^\W\d_]+")


def _hashed(words: set[str]) -> set[int]:
    digest = xxhash.xxh32_intdigest
    found = {digest(word) >> 1 for word in words}
    stems = {word[:n] for word in words for n in STEMS if len(word) > n}
    found.update([digest(stem + "*") >> 1 for stem in stems])
    return found


def features(text: str) -> set[int]:
    return _hashed(set(WORD.findall(text.lower())))


def swapped_features(text: str) -> set[int] | None:
    """Features of the text with every identity term exchanged; None if it has none."""
    words = set(WORD.findall(text.lower()))
    if not words & NEXT_TERM.keys():
        return None
    return _hashed({NEXT_TERM.get(word, word) for word in words})


def _texts(column: pa.Array):
    for value in column.cast(pa.binary()):
        yield value.as_buffer().to_pybytes().decode("utf-8", "replace")


def _both(text: Column) -> Column:
    @F.arrow_udf("struct<own: array<int>, swapped: array<int>>")
    def both(column: pa.Array) -> pa.Array:
        rows = [(features(text), swapped_features(text)) for text in _texts(column)]
        own = pa.array([sorted(a) for a, _ in rows], pa.list_(pa.int32()))
        swapped = pa.array([None if b is None else sorted(b) for _, b in rows], pa.list_(pa.int32()))
        return pa.StructArray.from_arrays([own, swapped], ["own", "swapped"])

    return both(text)


def held_out(id_: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text leaves 2 on division by 4."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class Model:
    bias: float
    weights: dict[int, float] = field(default_factory=dict)

    def score(self, text: str) -> float:
        weight = self.weights
        raw = self.bias + sum(weight[f] for f in features(text) & weight.keys())
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, raw))))


def _strongest(sample: DataFrame, counts: dict[int, int]) -> list[int]:
    """Features whose share differs most between the classes, in standard errors of the log odds ratio."""
    held = sample.select("y", F.explode("f.own").alias("feature")).groupBy("feature").agg(
        F.sum("y").cast("double").alias("a"), F.sum(1 - F.col("y")).cast("double").alias("c")
    )
    a, c = F.col("a") + 0.5, F.col("c") + 0.5
    b, d = counts[1] - F.col("a") + 0.5, counts[0] - F.col("c") + 0.5
    z = F.abs(F.log(a * d / (b * c))) / F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    best = held.where(F.col("a") + F.col("c") >= LEAST_DOCS).withColumn("z", z).where(F.col("z") >= LEAST_Z)
    return [row[0] for row in best.orderBy(F.desc("z"), "feature").select("feature").limit(MAX_FEATURES).collect()]


def _sparse(rows, place: dict[int, int]):
    at = [np.array([place[f] for f in row if f in place], np.int64) for row in rows]
    return np.repeat(np.arange(len(at)), [len(x) for x in at]), np.concatenate(at or [np.zeros(0, np.int64)])


def _descend(x, pairs, y, weight, n_features: int, penalty: float):
    """Accelerated proximal gradient steps on the logistic loss, the counterfactual term and the L1 penalty."""
    rows, cols = x
    (own, own_cols), (other, other_cols), n_pairs = pairs
    n = len(y)
    # A step for each feature: the curvature is at most the sum, over the rows that hold it, of their lengths.
    held = (np.bincount(rows, minlength=n) + 1) * weight / (4 * n)
    bend = np.bincount(cols, held[rows], n_features)
    if n_pairs:
        both = (np.bincount(own, minlength=n_pairs) + np.bincount(other, minlength=n_pairs)) * 2 * penalty / n_pairs
        bend += np.bincount(own_cols, both[own], n_features) + np.bincount(other_cols, both[other], n_features)
    step, step_b = 1 / np.maximum(bend, 1e-9), 1 / held.sum()
    w, b = np.zeros(n_features), math.log((weight @ y + 0.5) / (weight @ (1 - y) + 0.5))
    ahead_w, ahead_b, momentum = w, b, 1.0
    for _ in range(ROUNDS):
        raw = np.clip(np.bincount(rows, ahead_w[cols], n) + ahead_b, -30, 30)
        error = weight * (1 / (1 + np.exp(-raw)) - y) / n
        slope = np.bincount(cols, error[rows], n_features)
        if n_pairs:
            change = np.bincount(own, ahead_w[own_cols], n_pairs) - np.bincount(other, ahead_w[other_cols], n_pairs)
            change *= 2 * penalty / n_pairs
            slope = slope + np.bincount(own_cols, change[own], n_features)
            slope -= np.bincount(other_cols, change[other], n_features)
        new = ahead_w - step * slope
        new, new_b = np.sign(new) * np.maximum(np.abs(new) - step * L1, 0), ahead_b - step_b * error.sum()
        faster = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        ahead_w = new + (momentum - 1) / faster * (new - w)
        ahead_b = new_b + (momentum - 1) / faster * (new_b - b)
        w, b, momentum = new, new_b, faster
    return w, b


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    per_class: int = PER_CLASS, counterfactual: float = COUNTERFACTUAL,
) -> Model:
    """A model from labelled rows that are not held out, at most `per_class` of either class."""
    ship(docs.sparkSession)
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).alias("__id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("y"))
    )
    texts = docs.select(F.col(id_col).alias("__id"), whole(F.col(text_col)).alias("text"))
    known = durable(known.join(texts.select("__id"), "__id", "left_semi"), "known")
    order = F.xxhash64(F.col("__id").cast("string"))
    chosen = [known.where(F.col("y") == y).orderBy(order, "__id").limit(per_class) for y in (0, 1)]
    ids = durable(chosen[0].union(chosen[1]), "labelled")
    totals = {row["y"]: row["n"] for row in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    # At most twice `per_class` ids are broadcast.
    held = texts.join(F.broadcast(ids), "__id").groupBy("__id", "y").agg(F.min("text").alias("text"))
    sample = durable(held.select("__id", "y", _both(F.col("text")).alias("f")), "sample")
    counts = {0: 0, 1: 0} | {row["y"]: row["n"] for row in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts[0] or not counts[1]:
        return Model(math.log((counts[1] + 0.5) / (counts[0] + 0.5)))
    place = {feature: n for n, feature in enumerate(_strongest(sample, counts))}
    if not place:
        return Model(math.log((counts[1] + 0.5) / (counts[0] + 0.5)))
    chosen_rows = sample.select("__id", "y", _only("f.own", place).alias("own"), _only("f.swapped", place).alias("swapped"))
    # Twice `per_class` rows, of `MAX_FEATURES` numbers at most; in order, so that sums come out the same.
    rows = sorted(chosen_rows.collect(), key=lambda row: row["__id"])
    y = np.array([row["y"] for row in rows], float)
    share = {k: totals[k] / counts[k] for k in (0, 1)}
    weight = np.where(y > 0, share[1], share[0])
    weight *= len(y) / weight.sum()
    swaps = [row for row in rows if row["swapped"] is not None]
    pairs = _sparse([r["own"] for r in swaps], place), _sparse([r["swapped"] for r in swaps], place), len(swaps)
    w, b = _descend(_sparse([r["own"] for r in rows], place), pairs, y, weight, len(place), counterfactual)
    return Model(float(b), {feature: float(w[n]) for feature, n in place.items() if w[n]})


def _only(column: str, place: dict[int, int]) -> Column:
    known = frozenset(place)

    @F.arrow_udf("array<int>")
    def kept(rows: pa.Array) -> pa.Array:
        return pa.array(
            [None if row is None else [f for f in row if f in known] for row in rows.to_pylist()], pa.list_(pa.int32())
        )

    return kept(F.col(column))


def toxicity(text: Column, model: Model) -> Column:
    """The model's score of the text, 0 to 1."""

    @F.arrow_udf("double")
    def scores(column: pa.Array) -> pa.Array:
        return pa.array([model.score(text) for text in _texts(column)], pa.float64())

    return scores(whole(text))


def with_toxicity(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with toxicity (score) and toxic (boolean); columns of these names are replaced."""
    ship(docs.sparkSession)
    scored = without(docs, RESULTS).withColumn(RESULTS[0], toxicity(F.col(text_col), model))
    return scored.withColumn(RESULTS[1], F.col(RESULTS[0]) >= threshold)


def keep_civil(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score under the threshold, columns unchanged."""
    ship(docs.sparkSession)
    return docs.where(toxicity(F.col(text_col), model) < threshold)
