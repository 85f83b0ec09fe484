"""SimHash near-duplicates: bit-count embedding, grid range join, exact check, components.

A fingerprint has 64 bits. Its embedding counts the set bits of 32 segments of two bits each. Two
fingerprints that differ in k bits have embeddings at most k apart in Manhattan distance, so that distance is
a lower bound. Cut the embedding in two halves of 16 counts: of fingerprints at most 3 bits apart, at
least one half is at most 1 apart. That is a range join on a grid whose cells are the possible halves: a
fingerprint lives in its own cell, and visits each cell one step up in one count. Fingerprints one step
apart meet in the upper one's cell, equal halves in their own, so no step down is needed. What meets in
a cell is verified on all 64 bits.

Only distinct fingerprints enter the grid, so a group of copies of any size is one of them. A cell of
up to `PAIRS_UP_TO` is checked pair by pair, in whole arrays; a fuller one by spreading from
fingerprint to fingerprint, which returns links that connect the same ones without listing every pair.
A cell beyond `BLOCK` is dealt to tasks as pairs of blocks, so no task holds more than two blocks of it.

Defined cases. Null or blank text has fingerprint zero and links like any other. Rows without an id have
a fingerprint and link, but give no component its id: a component of such rows alone has none. Rows that share
an id are one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from gridtide.llm.common import durable, ship, text_key, whole, without
from gridtide.llm.components import components

SEED = 42
SHINGLE = 3
MAX_BITS = 3  # the grid's halves, one step apart, are made for up to 3
BLOCK = 2048
PAIRS_UP_TO = 64
RESULTS = ("fingerprint", "component_id")


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of UTF-8 text as an unsigned integer; zero without words."""
    words = text.lower().split()  # on bytes, both know ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    stop = np.cumsum(size + 1) - 1
    width = min(shingle, len(words))
    first, last = (stop - size)[: len(words) - width + 1].tolist(), stop[width - 1 :].tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(first), 65536):
        spans = zip(first[at : at + 65536], last[at : at + 65536])
        hashes = np.array([digest(joined[a:z], SEED) for a, z in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(first), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed 64-bit integer."""

    @F.arrow_udf(returnType=LongType())
    def fingerprints(column: pa.Array) -> pa.Array:
        found = [simhash(value.as_buffer().to_pybytes(), shingle) for value in column.cast(pa.binary())]
        return pa.array(np.array(found, np.uint64).view(np.int64))

    return fingerprints(whole(text))


def embed(prints: np.ndarray) -> np.ndarray:
    """Set bits of each two-bit segment, in 32 fields of two bits."""
    odd = np.uint64(0x5555555555555555)
    return (prints & odd) + ((prints >> np.uint64(1)) & odd)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each fingerprint: its own cell and those it visits, for either half."""
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        counts = embed(prints)
        cell, home, own = [], [], []
        for half in (0, 1):
            part = ((counts >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            name = part + (half << 32)
            cell.append(name), home.append(np.ones(len(name), bool)), own.append(prints)
            for field in range(16):
                open_ = (part >> (2 * field)) & 3 < 2
                cell.append(name[open_] + (1 << (2 * field)))
                home.append(np.zeros(open_.sum(), bool)), own.append(prints[open_])
        yield pa.record_batch(
            {"cell": np.concatenate(cell), "home": np.concatenate(home), "print": np.concatenate(own).view(np.int64)}
        )


def _close(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= bits


def _spread(prints: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what all links within a full cell connect, at most one per fingerprint."""
    links, left = [], np.unique(prints)
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            one = queue.pop()
            near = _close(left, one, bits)
            found, left = left[near], left[~near]
            links.append((np.full(len(found), one), found))
            queue.extend(found)
    return links


def _links(bits: int):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links among rows sorted by group; the last group of a batch waits for the next."""

        def found(group: np.ndarray, home: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            sizes = np.diff(np.r_[starts, len(group)])
            links = []
            for n in np.flatnonzero(sizes > PAIRS_UP_TO):
                links += _spread(prints[starts[n] : starts[n] + sizes[n]], bits)
            few = np.repeat((sizes > 1) & (sizes <= PAIRS_UP_TO), sizes)
            group, home, prints = group[few], home[few], prints[few]
            for step in range(1, sizes[sizes <= PAIRS_UP_TO].max(initial=1)):
                a, b = slice(None, -step), slice(step, None)
                ok = (group[a] == group[b]) & (home[a] | home[b])
                ok[ok] = _close(prints[a][ok], prints[b][ok], bits)
                links.append((prints[a][ok], prints[b][ok]))
            a, b = (np.concatenate([x[side] for x in links] or [prints[:0]]) for side in (0, 1))
            return pa.record_batch({"a": a.view(np.int64), "b": b.view(np.int64)})

        kept = None
        for batch in batches:
            part = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            part[2] = part[2].view(np.uint64)
            if kept is not None:
                part = [np.concatenate(pair) for pair in zip(kept, part)]
            if not len(part[0]):
                continue
            cut = np.searchsorted(part[0], part[0][-1])
            kept = [c[cut:] for c in part]
            if cut:
                yield found(*[c[:cut] for c in part])
        if kept is not None and len(kept[0]):
            yield found(*kept)

    return check


def near_links(prints: DataFrame, column: str, bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between distinct fingerprints at most `bits` apart; repeats may occur."""
    if not 0 <= bits <= MAX_BITS:
        raise ValueError(f"the grid finds fingerprints up to {MAX_BITS} bits apart")
    ship(prints.sparkSession)
    distinct = durable(prints.select(F.col(column).alias("print")).where("print IS NOT NULL").distinct(), "prints")
    cells = distinct.mapInArrow(_cells, "cell long, home boolean, print long")
    full = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > block)
    full = durable(full.select("cell", F.ceil(F.col("rows") / block).cast("int").alias("blocks")), "full-cells")
    blocks = F.coalesce("blocks", F.lit(1))
    dealt = (
        cells.join(full, "cell", "left").withColumn("mine", F.pmod(F.xxhash64("print"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(
            F.xxhash64("cell", F.least("mine", "other"), F.greatest("mine", "other")).alias("group"), "home", "print"
        )
    )
    return dealt.repartition("group").sortWithinPartitions("group").mapInArrow(_links(bits), "a long, b long")


def near_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, bits: int = MAX_BITS
) -> DataFrame:
    """One row per row of `docs`: id_col, __text (key of its text), __print, component_id."""
    ship(docs.sparkSession)
    prints = durable(
        docs.select(
            F.col(id_col), text_key(F.col(text_col)).alias("__text"),
            fingerprint(F.col(text_col), shingle).alias("__print"),
        ),
        "fingerprints",
    )
    first = prints.groupBy("__print").agg(F.min(id_col).alias("__first"))
    parts = components(near_links(prints, "__print", bits), "a", "b")
    linked = parts.withColumnsRenamed({"node": "__print", "component": "__part"})
    lowest = first.join(linked, "__print").groupBy("__part").agg(F.min("__first").alias("__lowest"))
    named = linked.join(durable(lowest, "lowest"), "__part").select("__print", "__lowest")
    of_print = first.join(named, "__print", "left").select(
        "__print", F.coalesce("__lowest", "__first").alias("component_id")
    )
    of_print = durable(of_print, "components")
    return prints.join(of_print, "__print").select(id_col, "__text", "__print", "component_id")


def with_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`docs` with fingerprint (16 hex digits) and component_id; columns of these names are replaced."""
    found = near_components(docs, id_col, text_col, **options).distinct()
    named = found.select(
        F.col(id_col).alias("__id"), F.col("__text").alias("__of"), hex_digits(F.col("__print")).alias(RESULTS[0]),
        RESULTS[1],
    )
    plain = without(docs, RESULTS)
    same = plain[id_col].eqNullSafe(named["__id"]) & (text_key(plain[text_col]) == named["__of"])
    return plain.join(named, same).select(*plain.columns, *RESULTS)


def hex_digits(print_: Column) -> Column:
    return F.lower(F.lpad(F.hex(print_), 16, "0"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The document with the smallest id of each component, columns unchanged.

    Rows that share that id are one document and all stay. Rows without an id go if their component
    has a document with one; else they all stay, as nothing tells them apart.
    """
    found = near_components(docs, id_col, text_col, **options)
    other = found.where(F.col("component_id").isNotNull() & ~F.col(id_col).eqNullSafe(F.col("component_id")))
    other = other.select(F.col(id_col).alias("__id"), F.col("__text").alias("__of")).distinct()
    same = docs[id_col].eqNullSafe(other["__id"]) & (text_key(docs[text_col]) == other["__of"])
    return docs.join(other, same, "left_anti")
