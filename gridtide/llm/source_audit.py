"""How the sources of a language diverge in the words they use.

Terms are runs of letters and of all beyond ASCII, A-Z lower-cased. A language keeps the terms found in at least
`MIN_DOCS` of its documents. The kept terms are sorted, numbered within their language in the order of their bytes and built into minimal
acyclic transducers of at most `BLOCK` terms each, a task a block. All texts then stream through the transducers of their
language, which give the ordinal of every kept term met; from there on terms are numbers, ties are broken by
ordinal, and only the terms of the result are looked up by name.

With counts smoothed to integer shares p = 1 + floor(UNIT (count + 1) / (N + V)), two sources of a language differ by
the sum over all kept terms of floor((p - q)^2 / q), and a source is marked by the terms that it uses beyond their
share q in the language. Both come from tiles of consecutive ordinals: a tile holds at most
`CELLS` counts (terms x sources of the language), so its matrix fits a task whatever the number of sources, and
gives one partial sum for each pair of sources and at most `TOP` terms for each source. All of it is integer arithmetic, in Python
integers where 64 bits do not hold a product.

Vocabularies larger than `PASS_BYTES` (packed) are broadcast and counted in several passes over the texts of the
languages concerned, so no broadcast exceeds that size by more than one block. What a task remembers while it counts is bounded by
`HELD` entries, and texts are worked on in pieces of about `PIECE` bytes, cut between terms.

Defined cases. Null text, language and source count as ''. Every row is a document, also one that repeats another. A
language that keeps no term has pairs of value 0. An empty table has no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtide.llm import transducer
from gridtide.llm.common import durable, ship, whole

MIN_DOCS, TOP, UNIT = 3, 200, 1_000_000_000
BLOCK, CELLS = 1 << 18, 1 << 16
PASS_BYTES = 64 << 20
HELD, PIECE = 1 << 18, 1 << 19
BLANK = 32
# Every byte that belongs to no term reads as a blank.
TERMS = bytes(BLANK if b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def _bytes(column: pa.Array | pa.ChunkedArray) -> Iterator[bytes]:
    for value in column.cast(pa.binary()):
        yield value.as_buffer().to_pybytes()


def _pieces(texts: Iterator[tuple[int, bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray, bytes]]:
    """Texts, each with a number, gathered and cut to pieces: numbers, their first bytes, bytes. No term is cut."""
    numbers, places, held, size = [], [], [], 0
    for number, text in texts:
        text = text.translate(TERMS)
        at = 0
        while at < len(text):
            stop = len(text)
            if stop - at > PIECE:
                stop = text.rfind(b" ", at, at + PIECE) + 1 or text.find(b" ", at + PIECE) + 1 or stop
            numbers.append(number), places.append(size), held.append(text[at:stop])
            size += stop - at + 1
            at = stop
            if size >= PIECE:
                yield np.array(numbers), np.array(places), b" ".join(held)
                numbers, places, held, size = [], [], [], 0
    if held:
        yield np.array(numbers), np.array(places), b" ".join(held)


def _tokens(piece: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The piece's bytes, and the first bytes and sizes of its terms."""
    text = np.frombuffer(piece, np.uint8)
    inside = np.concatenate([[False], text != BLANK, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return text, edges[::2], edges[1::2] - edges[::2]


def _distinct(numbers: np.ndarray, places: np.ndarray, piece: bytes) -> tuple[np.ndarray, pa.Array]:
    """The distinct (number, term) pairs of a piece."""
    text, starts, sizes = _tokens(piece)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    packed = np.ascontiguousarray(text[text != BLANK])
    terms = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(packed)]
    ).dictionary_encode()
    owner = np.searchsorted(places, starts, "right") - 1
    # A text of several pieces has one number in all of them.
    pairs = np.unique(numbers[owner].astype(np.int64) << 32 | terms.indices.to_numpy(zero_copy_only=False))
    return pairs >> 32, terms.dictionary.take(pa.array(pairs & 0xFFFFFFFF))


def _summed(tables: list[pa.Table], keys: list[str]) -> pa.Table:
    joined = pa.concat_tables(tables).combine_chunks()
    return joined.group_by(keys, use_threads=False).aggregate([("n", "sum")]).rename_columns([*keys, "n"])


def document_counts(docs: DataFrame) -> DataFrame:
    """Of (lang, text): lang, term, n documents."""
    schema = pa.schema([("lang", pa.string()), ("term", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            for lang in range(len(langs.dictionary)):
                of_lang = np.flatnonzero(langs.indices.to_numpy() == lang)
                texts = zip(of_lang.tolist(), _bytes(batch.column(1).take(pa.array(of_lang))))
                carried = (np.zeros(0, np.int64), None)
                for numbers, places, piece in _pieces(texts):
                    owners, terms = _distinct(numbers, places, piece)
                    found = pa.table({"number": owners, "term": terms})
                    # The last text may go on in the next piece: its terms wait for it.
                    last = int(numbers[-1])
                    if carried[1] is not None:
                        found = pa.concat_tables([carried[1], found])
                        found = found.group_by(["number", "term"], use_threads=False).aggregate([])
                    waits = np.asarray(found["number"]) == last
                    carried = (last, found.filter(pa.array(waits)))
                    held.append(_tally(found.filter(pa.array(~waits)), langs.dictionary[lang]))
                    rows += len(held[-1])
                if carried[1] is not None:
                    held.append(_tally(carried[1], langs.dictionary[lang]))
                    rows += len(held[-1])
                if rows >= HELD:
                    held = [_summed(held, ["lang", "term"])]
                    rows = len(held[0])
                    if rows >= HELD // 2:
                        yield from _out(held.pop(), schema)
                        rows = 0
                pa.default_memory_pool().release_unused()
        if held:
            yield from _out(_summed(held, ["lang", "term"]), schema)

    rows = docs.select(whole(F.col("lang")).alias("lang"), whole(F.col("text")).alias("text"))
    return rows.mapInArrow(count, "lang string, term string, n bigint").groupBy("lang", "term").agg(F.sum("n").alias("n"))


def _tally(pairs: pa.Table, lang: pa.Scalar) -> pa.Table:
    """Documents per term, of distinct (number, term) pairs of one language."""
    counted = pairs.group_by(["term"], use_threads=False).aggregate([("term", "count")]).rename_columns(["term", "n"])
    langs = pa.array([lang.as_py()], pa.string()).take(pa.array(np.zeros(len(counted), np.int64)))
    return pa.table({"lang": langs, "term": counted["term"], "n": counted["n"]})


def _out(table: pa.Table, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in table.combine_chunks().to_batches(max_chunksize=1 << 16):
        terms = batch.column(1).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), terms.view(pa.string()), batch.column(2)], schema=schema)


def vocabulary(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term, ordinal (from 0 within the language, in the order of the terms' bytes) of the kept terms."""
    kept = durable(document_counts(docs).where(F.col("n") >= min_docs).select("lang", "term"), "kept")
    part = F.spark_partition_id()
    row = F.monotonically_increasing_id() - F.shiftleft(part.cast("bigint"), 33)
    placed = kept.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    placed = durable(placed.select("lang", "term", part.alias("part"), row.alias("row")), "placed")
    # One row for each language of a range: ranges are as many as shuffle partitions.
    runs = placed.groupBy("lang", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("part")) - F.col("n")
    runs = runs.select(F.col("lang"), F.col("part"), (before - F.col("first")).alias("shift"))
    return placed.join(runs, ["lang", "part"]).select("lang", "term", (F.col("row") + F.col("shift")).alias("ordinal"))


def packed_blocks(terms: DataFrame, block: int = BLOCK) -> DataFrame:
    """lang, block, packed: a transducer for every `block` consecutive terms of a language."""

    def pack(key: tuple, group: pa.Table) -> pa.Table:
        packed = transducer.build(_bytes(group.sort_by("ordinal").column("term")))
        return pa.table({"lang": [key[0].as_py()], "block": [key[1].as_py()], "packed": pa.array([packed], pa.binary())})

    grouped = terms.withColumn("block", F.expr(f"ordinal div {block}")).groupBy("lang", "block")
    return grouped.applyInArrow(pack, "lang string, block bigint, packed binary")


_ready: dict[str, dict[str, list[tuple[int, transducer.Transducer]]]] = {}


def _loaded(packed, mark: str) -> dict[str, list[tuple[int, transducer.Transducer]]]:
    """The broadcast transducers by language, each with its first ordinal; made ready once a worker."""
    if mark not in _ready:
        _ready.clear()
        by_lang: dict[str, list] = {}
        for lang, first, content in packed.value:
            by_lang.setdefault(lang, []).append((first, transducer.Transducer(content)))
        _ready[mark] = by_lang
    return _ready[mark]


class _Held:
    """Counts of keys, added up when they are many."""

    def __init__(self) -> None:
        self.keys, self.counts, self.size = [], [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        self.keys.append(keys), self.counts.append(np.ones(len(keys), np.int64) if counts is None else counts)
        self.size += len(keys)

    def summed(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        starts = np.flatnonzero(np.diff(keys, prepend=-1))
        return keys[starts], np.add.reduceat(counts[order], starts) if len(keys) else counts

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        """What is held, if it is too much even when added up."""
        keys, counts = self.summed()
        self.__init__()
        if len(keys) < HELD // 2:
            self.add(keys, counts)
            return keys[:0], counts[:0]
        return keys, counts


def _stream(docs: DataFrame, packed) -> DataFrame:
    """Of (lang, source, text): lang, source, ordinal, n for the transducers of one pass, not yet added up over tasks."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("ordinal", pa.int64()), ("n", pa.int64())])
    mark = uuid.uuid4().hex

    def rows(names: list[tuple[str, str]], found: dict[int, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for number, (keys, counts) in found.items():
            for at in range(0, len(keys), 1 << 16):
                size = len(keys[at : at + (1 << 16)])
                again = pa.array(np.zeros(size, np.int64))
                lang, source = (pa.array([name], pa.string()).take(again) for name in names[number])
                yield pa.RecordBatch.from_arrays(
                    [lang, source, pa.array(keys[at : at + size]), pa.array(counts[at : at + size])], schema=schema
                )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = _loaded(packed, mark)
        names: dict[tuple[str, str], int] = {}
        held: list[_Held] = []
        for batch in batches:
            of = [names.setdefault(pair, len(names)) for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            held += [_Held() for _ in range(len(names) - len(held))]
            of = np.array(of, np.int64)
            langs = batch.column(0).dictionary_encode()
            for lang, name in enumerate(langs.dictionary.to_pylist()):
                blocks = ready.get(name, [])
                mine = np.flatnonzero(langs.indices.to_numpy() == lang)
                # Texts of a source beside each other: a piece holds few sources, mostly one.
                mine = mine[np.argsort(of[mine], kind="stable")]
                texts = zip(of[mine].tolist(), _bytes(batch.column(2).take(pa.array(mine))))
                for numbers, places, piece in _pieces(texts) if blocks else ():
                    text, starts, sizes = _tokens(piece)
                    owner = numbers[np.searchsorted(places, starts, "right") - 1]
                    for first, words in blocks:
                        tokens, ordinals = words.ordinals(text, starts, sizes)
                        groups = owner[tokens]
                        for number in np.unique(groups).tolist():
                            held[number].add(first + ordinals[groups == number])
            if sum(h.size for h in held) >= HELD:
                yield from rows(list(names), {n: h.taken() for n, h in enumerate(held)})
            pa.default_memory_pool().release_unused()
        yield from rows(list(names), {n: h.summed() for n, h in enumerate(held)})

    return docs.mapInArrow(count, "lang string, source string, ordinal bigint, n bigint")


def recount(docs: DataFrame, terms: DataFrame, block: int = BLOCK, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """lang, source, ordinal, n: how often each source of a language uses a kept term, where it does."""
    spark = docs.sparkSession
    blocks = durable(packed_blocks(terms, block), "blocks")
    sizes = blocks.select("lang", "block", F.octet_length("packed").alias("size")).orderBy("lang", "block").collect()
    rows = docs.select(*[whole(F.col(name)).alias(name) for name in ("lang", "source", "text")])
    counted = spark.createDataFrame([], "lang string, source string, ordinal bigint, n bigint")
    at = 0
    while at < len(sizes):
        group, size = [], 0
        while at < len(sizes) and (not group or size + sizes[at]["size"] <= pass_bytes):
            group.append((sizes[at]["lang"], sizes[at]["block"]))
            size += sizes[at]["size"]
            at += 1
        wanted = spark.createDataFrame(group, "lang string, block bigint")
        chosen = blocks.join(F.broadcast(wanted), ["lang", "block"]).collect()
        packed = spark.sparkContext.broadcast([(r["lang"], r["block"] * block, bytes(r["packed"])) for r in chosen])
        counted = counted.union(_stream(rows, packed))
    return counted.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(UNIT (count + 1) / total), exactly."""
    if counts.size and int(counts.max()) + 1 >= (1 << 63) // UNIT:
        counts = counts.astype(object)
    return (1 + (counts + 1) * UNIT // max(1, total)).astype(np.int64)


def _tile(left: pa.Table, right: pa.Table, top: int) -> pa.Table:
    """Partial sums of pairs, and the best terms of each source, from one tile's counts and its language's sources."""
    sources, lang = right.column("source").to_pylist(), right.column("lang")[0].as_py()
    totals, terms = [row or 0 for row in right.column("total").to_pylist()], right.column("terms")[0].as_py()
    ordinals, column = np.unique(left.column("ordinal").to_numpy(), return_inverse=True)
    number = {name: n for n, name in enumerate(sources)}
    row = np.array([number[name] for name in left.column("source").to_pylist()], np.int64)
    counts = np.zeros((len(sources), len(ordinals)), np.int64)
    counts[row, column] = left.column("n").to_numpy()
    p = np.stack([shares(c, total + terms) for c, total in zip(counts, totals)])
    q = shares(counts.sum(0), sum(totals) + terms)
    found: list[tuple] = []
    for n, name in enumerate(sources):
        gap = p[n] - p
        found += [(lang, name, sources[m], None, v) for m, v in enumerate((gap * gap // p).sum(1).tolist()) if m != n]
        marked = np.flatnonzero((counts[n] > 0) & (p[n] > q))
        gap = p[n, marked] - q[marked]
        value = gap * gap // q[marked]
        best = np.lexsort((marked, -value))[:top]
        found += [(lang, name, None, o, v) for o, v in zip(ordinals[marked[best]].tolist(), value[best].tolist())]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    columns = list(zip(*found)) or [()] * len(kinds)
    names = ["lang", "source", "other", "ordinal", "value"]
    return pa.table([pa.array(column, kind) for column, kind in zip(columns, kinds)], names=names)


def audit(
    docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, block: int = BLOCK, cells: int = CELLS,
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    ship(docs.sparkSession)
    terms = durable(vocabulary(docs, min_docs), "vocabulary")
    counts = durable(recount(docs, terms, block, pass_bytes), "counts")
    groups = docs.select(whole(F.col("lang")).alias("lang"), whole(F.col("source")).alias("source")).distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = durable(groups.join(totals, ["lang", "source"], "left"), "groups")
    kept = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")).join(kept, "lang", "left")
    width = F.greatest(F.lit(1), F.expr(f"{cells} div sources")).alias("width")
    langs = durable(langs.select("lang", F.coalesce("terms", F.lit(0)).cast("bigint").alias("terms"), width), "langs")
    last = F.greatest(F.lit(0), F.expr("(terms - 1) div width"))
    left = counts.join(langs, "lang").select("lang", "source", "ordinal", "n", F.expr("ordinal div width AS tile"))
    right = groups.join(langs, "lang").select(
        "lang", "source", "total", "terms", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("tile")
    )

    def tile(left_rows: pa.Table, right_rows: pa.Table) -> pa.Table:
        return _tile(left_rows, right_rows, top)

    found = left.groupBy("lang", "tile").cogroup(right.groupBy("lang", "tile")).applyInArrow(
        tile, "lang string, source string, other string, ordinal bigint, value bigint"
    )
    found = durable(found, "tiles")
    pairs = found.where("other IS NOT NULL").groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "other")
    pairs = pairs.select(
        "lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value", F.row_number().over(by_value).alias("rank")
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    marked = found.where("ordinal IS NOT NULL").withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)
    marked = marked.join(terms, ["lang", "ordinal"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"
    )
    return pairs.union(marked)
