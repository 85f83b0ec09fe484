"""Product codes of vectors, learned and assigned in integers.

A component x becomes the integer floor(256 x). Vectors are cut into `PARTS` equal consecutive parts, each position
with a codebook of its own: it starts as that part of the `ENTRIES` smallest ids, and each of `ROUNDS` rounds replaces
an entry by the floored mean of the parts nearest to it (an unused entry stays).

The nearest entry is found behind an integer Walsh-Hadamard transform of the parts and entries, zero-padded to a
power of two P: it multiplies every squared distance by P and gathers what neighbouring components share in the
coefficients of low sequency. Squared differences are added up in the order of sequency. The full distance to the entry that
leads after the first coefficient bounds the search; entries whose partial sum exceeds the best known distance leave it early, so most
are never compared in full. All of it is integer arithmetic: 32 or 64 bits where the largest possible sum
fits, Python integers beyond. Ties go to the lower index.

A round is one pass: a task adds up counts and sums of at most PARTS x ENTRIES entries and Spark adds up the tasks'.
Codebooks (PARTS x ENTRIES x part width integers) are all that reaches the driver and travels back.

Defined cases. Rows whose vector is null or holds a null or non-finite component are left out. Vectors shorter than
the longest, or whose length is no multiple of PARTS, are filled up with zeros at their end. A null id is coded but starts no entry; of rows
that share an id the least vector starts one. Fewer ids make fewer entries. An error that 64 bits cannot
hold is null. An empty table has no codes and empty codebooks. Null labels form one group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import durable, ship

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
BLOCK = 2048  # parts compared at once
LIMB = 10**30  # sums leave a task as two decimals, so that no magnitude of a float is too large
LONG = 1 << 63


def sequency_order(width: int) -> np.ndarray:
    """Of the transform's natural order, the coefficients by their number of sign changes."""
    signs = np.ones((1, 1), np.int8)
    while len(signs) < width:
        signs = np.block([[signs, signs], [signs, -signs]])
    return np.argsort((np.diff(signs, axis=1) != 0).sum(1), kind="stable")


def transformed(parts: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of each row, zero-padded to a power of two, in order of sequency."""
    rows, width = parts.shape
    padded = 1 << max(0, width - 1).bit_length()
    if padded > width:
        parts = np.concatenate([parts, np.zeros((rows, padded - width), parts.dtype)], 1)
    half = 1
    while half < padded:
        pair = parts.reshape(rows, -1, 2, half)
        parts = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], 2).reshape(rows, padded)
        half *= 2
    return np.ascontiguousarray(parts[:, sequency_order(padded)])


def _reach(values: np.ndarray) -> int:
    return max(abs(int(values.max())), abs(int(values.min()))) if values.size else 0


def _narrow(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in the smallest type that holds every sum of squares."""
    width = 1 << max(0, parts.shape[1] - 1).bit_length()
    largest = width * (width * (_reach(parts) + _reach(entries))) ** 2
    kind = np.int32 if largest < 1 << 31 else np.int64 if largest < LONG else object
    return parts.astype(kind), entries.astype(kind)


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each part's nearest entry and the squared distance to it."""
    parts, entries = _narrow(parts, entries)
    a, b = transformed(parts), transformed(entries)
    scale = a.shape[1]
    index, distance = np.empty(len(a), np.int64), np.empty(len(a), a.dtype)
    for at in range(0, len(a), BLOCK):
        index[at : at + BLOCK], distance[at : at + BLOCK] = _search(a[at : at + BLOCK], b)
    return index, distance // scale


def _search(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = a.shape[1]
    gap = a[:, :1] - b[:, 0]
    sums = gap * gap
    gap = a - b[sums.argmin(1)]
    bound = (gap * gap).sum(1)
    rows, entries = np.nonzero(sums <= bound[:, None])
    sums, done = sums[rows, entries], 1
    while done < width:
        for n in range(done, min(2 * done, width)):
            gap = a[:, n].take(rows) - b[:, n].take(entries)
            sums += gap * gap
        done = min(2 * done, width)
        kept = np.flatnonzero(sums <= bound.take(rows))
        rows, entries, sums = rows.take(kept), entries.take(kept), sums.take(kept)
    # The entry that gave the bound is still there, so every row has one.
    best = np.minimum.reduceat(sums, np.flatnonzero(np.diff(rows, prepend=-1)))
    least = np.flatnonzero(sums == best.take(rows))
    first = least[np.diff(rows[least], prepend=-1) != 0]
    return entries[first], best


def integers(values: np.ndarray) -> np.ndarray:
    """floor(256 x), exactly: a power of two only moves the exponent."""
    with np.errstate(over="ignore"):
        raised = np.floor(values.astype(np.float64) * SCALE)
    if not len(raised) or np.abs(raised).max() < 1 << 62:
        return raised.astype(np.int64)
    return np.array([_floor(x) for x in values.tolist()], object)


def _floor(value: float) -> int:
    top, bottom = value.as_integer_ratio()
    return top * SCALE // bottom


@dataclass
class Codebooks:
    books: list[np.ndarray]  # by part position: (entries, part width)

    @property
    def width(self) -> int:
        return self.books[0].shape[1]

    @cached_property
    def digest(self) -> str:
        listed = ",".join(str(x) for book in self.books for x in book.ravel().tolist())
        return hashlib.sha256(listed.encode()).hexdigest()

    def parts(self, vectors: pa.Array) -> Iterator[np.ndarray]:
        """The integer parts of an Arrow list column, position by position: (rows, part width)."""
        sizes = np.asarray(vectors.value_lengths().to_numpy(zero_copy_only=False), np.int64)
        flat = integers(vectors.flatten().to_numpy(zero_copy_only=False))
        whole = np.zeros((len(sizes), self.width * len(self.books)), flat.dtype)
        inside = np.arange(whole.shape[1]) < sizes[:, None]
        whole[inside] = flat
        for n in range(len(self.books)):
            yield whole[:, n * self.width : (n + 1) * self.width]


def _vectors(rows: DataFrame, vector_col: str) -> DataFrame:
    sound = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col(vector_col).isNotNull() & sound)


def _start(kept: DataFrame, id_col: str, vector_col: str, parts: int, entries: int) -> Codebooks | None:
    """Codebooks of the smallest ids: a task passes on at most `entries` of its own."""
    whole_numbers = kept.schema[id_col].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint")
    id_type, stored = ("bigint", pa.int64()) if whole_numbers else ("string", pa.string())
    kinds = [stored, pa.list_(pa.float64()), pa.int32()]

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        longest = -1
        for batch in batches:
            longest = max([longest, *batch.column(1).value_lengths().to_pylist()])
            ids = batch.column(0).to_numpy(zero_copy_only=False) if not batch.column(0).null_count else None
            if ids is not None and len(held) >= entries:  # most batches hold nothing small enough
                near = np.flatnonzero(ids <= max(held))
            else:
                near = range(batch.num_rows)
            for n in near:
                key = batch.column(0)[int(n)].as_py()
                if key is None:
                    continue
                if key in held or len(held) < entries or key < max(held):
                    vector = batch.column(1)[int(n)].as_py()
                    held[key] = min(held.get(key, vector), vector)
                    if len(held) > entries:
                        del held[max(held)]
        if longest >= 0:
            rows = [(key, vector, longest) for key, vector in held.items()] or [(None, None, longest)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], ["id", "vector", "longest"]
            )

    found = kept.select(F.col(id_col).cast(id_type).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    seen = durable(found.mapInArrow(smallest, f"id {id_type}, vector array<double>, longest int"), "smallest")
    longest = seen.agg(F.max("longest")).first()[0]
    if longest is None:
        return None
    first = seen.where("id IS NOT NULL").groupBy("id").agg(F.min("vector").alias("vector")).orderBy("id").limit(entries)
    vectors = [row["vector"] for row in first.collect()]
    width = max(1, -(-longest // parts))
    empty = Codebooks([np.zeros((max(1, len(vectors)), width), np.int64)] * parts)
    return Codebooks([part.copy() for part in empty.parts(pa.array(vectors or [[]], pa.list_(pa.float64())))])


def _round(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after one round over (vector)."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(book), np.int64) for book in books.books]
        totals = [np.zeros(book.shape, object) for book in books.books]
        for batch in batches:
            for n, part in enumerate(books.parts(batch.column(0))):
                if len(part):
                    index, _ = nearest(part, books.books[n])
                    order = np.argsort(index, kind="stable")
                    starts = np.flatnonzero(np.diff(index[order], prepend=-1))
                    used = index[order][starts]
                    counts[n] += np.bincount(index, minlength=len(counts[n]))
                    totals[n][used] += np.add.reduceat(part[order], starts, axis=0).astype(object)
        rows = []
        for n, (count, total) in enumerate(zip(counts, totals)):
            for entry in np.flatnonzero(count):
                for place, value in enumerate(total[entry]):
                    high, low = divmod(int(value), LIMB)
                    rows.append((n, int(entry), place, int(count[entry]), high, low))
        if rows:
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38), pa.decimal128(38)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)],
                ["part", "entry", "place", "n", "high", "low"],
            )

    shape = "part int, entry int, place int, n bigint, high decimal(38,0), low decimal(38,0)"
    sums = vectors.mapInArrow(tally, shape).groupBy("part", "entry", "place").agg(
        F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")
    )
    after = [book.astype(object) for book in books.books]
    for row in sums.collect():  # one row for each component of the codebooks at most
        after[row["part"]][row["entry"], row["place"]] = (int(row["high"]) * LIMB + int(row["low"])) // row["n"]
    return Codebooks([book.astype(np.int64) if _reach(book) < 1 << 62 else book for book in after])


def learn(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> Codebooks | None:
    """The codebooks of a table of vectors; None when it holds none."""
    if not 1 <= entries <= 256:
        raise ValueError("an index has two hex digits: 1 to 256 entries")
    ship(rows.sparkSession)
    kept = _vectors(rows, vector_col)
    books = _start(kept, id_col, vector_col, parts, entries)
    if books is not None:
        for _ in range(rounds):
            books = _round(kept.select(F.col(vector_col).alias("vector")), books)
    return books


def coded(vector: Column, books: Codebooks) -> Column:
    """struct<code: string, error: bigint> of a sound vector."""

    @F.arrow_udf("struct<code: string, error: bigint>")
    def codes(column: pa.Array) -> pa.Array:
        total: np.ndarray | int = 0
        digits = []
        for n, part in enumerate(books.parts(column)):
            index, distance = nearest(part, books.books[n])
            digits.append(index)
            total = total + distance.astype(np.int64 if distance.dtype == np.int32 else object)
        text = np.stack(digits, 1).astype(np.uint8)
        errors = [int(x) if x < LONG else None for x in total]
        names = [row.tobytes().hex() for row in text]
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(errors, pa.int64())], ["code", "error"])

    return codes(vector)


def compress(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", **options
) -> DataFrame:
    """One row per sound vector: id_col, label_col, code, error, label_error, codebooks_sha256."""
    books = learn(rows, id_col, vector_col, **options)
    kept = _vectors(rows, vector_col).select(
        F.col(id_col).alias("__id"), F.col(label_col).alias("__label"), F.col(vector_col).alias("__vector")
    )
    if books is None:
        books = Codebooks([np.zeros((1, 1), np.int64)] * options.get("parts", PARTS))
        digest = hashlib.sha256(b"").hexdigest()
    else:
        digest = books.digest
    found = kept.select("__id", "__label", coded(F.col("__vector"), books).alias("__coded"))
    found = durable(found.select("__id", "__label", "__coded.code", "__coded.error"), "codes")
    # Added up inside the tasks first, so a label that holds most rows is no large group.
    total = F.sum(F.col("error").cast("decimal(38,0)")).alias("__total")
    totals = found.groupBy(F.col("__label").alias("__of")).agg(total)
    same = F.col("__label").eqNullSafe(F.col("__of"))
    return found.join(totals, same).select(
        F.col("__id").alias(id_col), F.col("__label").alias(label_col), "code", "error",
        F.expr("try_cast(__total AS bigint)").alias("label_error"), F.lit(digest).alias("codebooks_sha256"),
    )
