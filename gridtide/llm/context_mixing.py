"""Language-model scores by online logistic mixing of hashed-context bit predictors.

**Decisions.** A text, A-Z lower-cased, is a sequence of bytes and an end. A prefix code made from the training bytes turns each symbol
into binary decisions, about four a byte of prose. Four decisions in a row share a *row* of a predictor's table: 16 cells, one of which a
symbol ends in.

**Predictors.** One for each number of preceding bytes in `ORDERS`, and one for the word so far. Each hashes these bytes, and what of the
code is known already, to one of 2^`ROW_BITS` rows. The rows hold counts over all training texts: each task adds up its own tables, blocks of them are packed,
shuffled and added up, and each block becomes log odds of one byte a decision. All tables together are `TABLE_BYTES` and are broadcast.

**Mixing.** A decision's log odds are a weighted sum of the predictors'. A gate, how many predictors have met this
context and how deep the decision lies in its row, selects the weights. They start alike for every text and are
learned online: a text is scored in chunks, each with the weights that the chunks before it left. What the mixer says is
refined by corrections for each range of its log odds, which are learned from the same text in the same way. Texts are
scored side by side, but none learns from another, so a score does not depend on how rows are dealt to tasks.

**Base.** A unigram model of tokens with additive smoothing. Counts of all training tokens are a table;
up to `HEAD` of the most frequent tokens (of at most `HEAD_BYTES` bytes each) are broadcast, and the rest of a text's tokens, distinct ones with
their numbers, meet the table in a join.

Defined cases. Null text counts as empty: no words, one end. Rows are texts of their own, also those that repeat others. A
null id is not held out. Without training rows all counts are 0, base scores are 0 and every decision starts even.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import durable, ship, whole

ORDERS = (4, 6)
ROW_BITS, CELLS = 18, 16
BLOCK_ROWS = 1 << 12
PREDICTORS = len(ORDERS) + 1
TABLE_BYTES = PREDICTORS << ROW_BITS + 4
HEAD, HEAD_BYTES = 1 << 16, 64
STEPS = 16  # of a token's count for each doubling
END, SYMBOLS = 256, 257
PRIOR = 0.4  # added to the counts of both sides of a decision
ODDS = 16  # log odds are stored in sixteenths, up to about 8
START, RATE, REFINED = 0.35, 0.03, 24
LANES, CHUNK = 32, 1024
PIECE, HELD = 1 << 18, 1 << 18
BACK = 24  # bytes that a chunk knows of what is before it
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
# The white space of the contract: [\x20\x09-\x0D].
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
# Fixed odd multipliers of the hash.
MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0xD3A2646D], np.uint32)
SPREAD, SALT = np.uint32(0x2C1B3C6D), np.uint32(0x297A2D39)


# Of a choice: its cell, what the bit adds to the log odds' side, and its depth in the row.
CELL_OF = np.array([n % 16 for n in range(32)], np.intp)
SIGN_OF = np.array([1 if n >= 16 else -1 for n in range(32)], np.float32)
DEPTH_OF = np.array([(n % 16 + 1).bit_length() - 1 for n in range(32)], np.int8)


def held_out(id_: Column) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves 1 on division by 5."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 1, F.lit(False))


class Code:
    """The prefix codes of the symbols, one for each byte before, and where each decision is found."""

    def __init__(self, counts: np.ndarray):
        """``counts``: how often each symbol follows each byte, (256, SYMBOLS)."""
        overall = _prefix_code(counts.sum(0).tolist())
        codes = [_prefix_code(row.tolist()) if row.any() else overall for row in counts]
        cut = [[bits[at : at + 4] for at in range(0, len(bits), 4)] for code in codes for bits in code]
        # By byte and symbol: rows visited; by visit: the row's salt, the cell it ends in, decisions; by decision: its cell, and
        # 16 more for a 1.
        self.visits = np.array([len(parts) for parts in cut], np.intp)
        self.first_visit = np.concatenate([[0], np.cumsum(self.visits)[:-1]])
        rows: dict[str, int] = {}
        self.salt = np.array(
            [rows.setdefault("".join(parts[:n]), len(rows)) for parts in cut for n in range(len(parts))], np.uint32
        ) * SALT
        self.ends = np.array([int(part.ljust(4, "0"), 2) for part in chain(*cut)], np.intp)
        self.steps = np.array([len(part) for part in chain(*cut)], np.intp)
        self.first = np.concatenate([[0], np.cumsum(self.steps)[:-1]])
        # Within a row: the decisions on the way to each of its ends.
        inside = [(part[:n], part[n]) for part in chain(*cut) for n in range(len(part))]
        self.choice = np.array([int("1" + known, 2) - 1 + 16 * (bit == "1") for known, bit in inside], np.uint8)

    def visited(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each visit to a row: whose symbol's it is, and its number in the code."""
        return _spread(self.first_visit.take(symbols), self.visits.take(symbols))

    def decided(self, visits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each decision: the visit it belongs to, and its number in the code."""
        return _spread(self.first.take(visits), self.steps.take(visits))


def _prefix_code(counts: list[int]) -> list[str]:
    """Bits of each symbol; those never met have long ones."""
    heap = [(count * len(counts) + 1, n, n) for n, count in enumerate(counts)]
    heapq.heapify(heap)
    made = len(heap)
    while len(heap) > 1:
        (a, _, left), (b, _, right) = heapq.heappop(heap), heapq.heappop(heap)
        heapq.heappush(heap, (a + b, made, (left, right)))
        made += 1
    bits = [""] * len(counts)
    waiting = [(heap[0][2], "")]
    while waiting:
        node, path = waiting.pop()
        if isinstance(node, tuple):
            waiting += [(node[0], path + "0"), (node[1], path + "1")]
        else:
            bits[node] = path
    return bits


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each owner in turn `count` (1 or more) numbers from `first` on: owners, numbers. By sums over steps, which are faster than repeats."""
    stops = np.cumsum(count)
    step = np.ones(int(stops[-1]) if len(stops) else 0, np.intp)
    owner = np.zeros(len(step), np.intp)
    if len(step):
        owner[stops[:-1]] = 1
        step[0] = first[0]
        step[stops[:-1]] = first[1:] - first[:-1] - count[:-1] + 1
    return np.cumsum(owner, out=owner), np.cumsum(step, out=step)


def hashes(text: np.ndarray, begins: np.ndarray) -> list[np.ndarray]:
    """For each predictor, a hash of the bytes before each place: so many of them, or all of the word so far. Parts of the
    array that begin at `begins` know nothing of each other."""
    total, found = np.zeros(len(text), np.uint32), []
    wide = text.astype(np.uint32) + np.uint32(1)
    for back in range(1, max(ORDERS) + 1):
        total[back:] += wide[:-back] * MIX[back - 1]
        if back in ORDERS:
            found.append(total.copy())
    # Sums of bytes times powers of an odd number; the power at the word's first byte is divided out.
    power = _powers(len(text))
    sums = np.zeros(len(text), np.uint32)
    np.cumsum((wide * power)[:-1], out=sums[1:])
    first = np.zeros(len(text), np.intp)
    blank = np.flatnonzero(BLANK[text[:-1]]) + 1
    first[blank] = blank
    first[begins] = begins
    np.maximum.accumulate(first, out=first)
    found.append((sums - sums.take(first)) * _powers(len(text), True).take(first))
    return found


_known_powers: dict[bool, np.ndarray] = {}


def _powers(count: int, inverse: bool = False) -> np.ndarray:
    held = _known_powers.get(inverse)
    if held is None or len(held) < count:
        base = np.uint32(pow(int(MIX[1]), -1, 1 << 32) if inverse else MIX[1])
        held = np.full(2 * count, base, np.uint32)
        held[0] = 1
        held = _known_powers[inverse] = np.multiply.accumulate(held, dtype=np.uint32)
    return held[:count]


def rows_of(hashed: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """The first cell of the rows for contexts and places in the code."""
    mixed = (hashed ^ salt) * SPREAD
    mixed ^= mixed >> np.uint32(15)
    mixed *= MIX[0]
    return (mixed >> np.uint32(32 - ROW_BITS)).astype(np.intp) << 4


def _bytes(column: pa.Array) -> Iterator[bytes]:
    for value in column.cast(pa.binary()):
        yield value.as_buffer().to_pybytes().translate(LOWER)


def _framed(text: bytes) -> np.ndarray:
    """A text with what its first byte looks back at, and a place for its end."""
    return np.frombuffer(b"\0" * BACK + text + b"\0", np.uint8)


# -- what the corpus says ------------------------------------------------------------------------


def _pieces(texts: Iterator[bytes]) -> Iterator[tuple[np.ndarray, bytes]]:
    """Texts gathered and cut between tokens to pieces of about `PIECE` bytes: texts of each part of a piece, bytes."""
    owners, held, size = [], [], 0
    for number, text in enumerate(texts):
        at = 0
        while at < len(text):
            stop = len(text)
            if stop - at > PIECE:
                blank = np.flatnonzero(BLANK[np.frombuffer(text, np.uint8, PIECE, at)])
                stop = at + int(blank[-1]) + 1 if len(blank) else _next_blank(text, at + PIECE)
            owners.append((number, size)), held.append(text[at:stop])
            size += stop - at + 1
            at = stop
            if size >= PIECE:
                yield np.array(owners), b" ".join(held)
                owners, held, size = [], [], 0
    if held:
        yield np.array(owners), b" ".join(held)


def _next_blank(text: bytes, at: int) -> int:
    while at < len(text):
        blank = np.flatnonzero(BLANK[np.frombuffer(text, np.uint8, min(PIECE, len(text) - at), at)])
        if len(blank):
            return at + int(blank[0]) + 1
        at += PIECE
    return len(text)


def _tokens(piece: bytes) -> tuple[np.ndarray, pa.DictionaryArray]:
    """First bytes of a piece's tokens, and the tokens."""
    text = np.frombuffer(piece, np.uint8)
    blank = BLANK[text]
    inside = np.concatenate([[False], ~blank, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    offsets = np.concatenate([[0], np.cumsum(edges[1::2] - edges[::2])]).astype(np.int64)
    packed = np.ascontiguousarray(text[~blank])
    tokens = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(packed)]
    )
    return edges[::2], tokens.dictionary_encode()


def token_counts(docs: DataFrame) -> DataFrame:
    """Of (text): token, symbol, n. Every token's count, with a null symbol, and, with a null token, how often each symbol
    (byte or end) follows each byte, as byte * SYMBOLS + symbol."""
    names = ["token", "n"]
    schema = pa.schema([("token", pa.binary()), ("symbol", pa.int32()), ("n", pa.int64())])

    def out(table: pa.Table) -> Iterator[pa.RecordBatch]:
        for batch in table.combine_chunks().to_batches(max_chunksize=1 << 16):
            none = pa.nulls(batch.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.binary()), none, batch.column(1)], schema=schema)

    def summed(tables: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(tables).group_by("token", use_threads=False).aggregate([("n", "sum")]).rename_columns(names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = np.zeros(256 * SYMBOLS, np.int64)
        held: list[pa.Table] = []
        for batch in batches:
            for parts in _parts(_bytes(batch.column(0))):
                symbols += np.bincount(_joined(parts)[3], minlength=len(symbols))
            for _, piece in _pieces(_bytes(batch.column(0))):
                _, tokens = _tokens(piece)
                n = np.bincount(tokens.indices.to_numpy(zero_copy_only=False), minlength=len(tokens.dictionary))
                held.append(pa.table([tokens.dictionary, pa.array(n, pa.int64())], names=names))
                if sum(map(len, held)) >= HELD:
                    held = [summed(held)]
                    if len(held[0]) >= HELD // 2:
                        yield from out(held.pop())
            pa.default_memory_pool().release_unused()
        if held:
            yield from out(summed(held))
        known = np.flatnonzero(symbols)
        if len(known):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(known), pa.binary()), pa.array(known, pa.int32()), pa.array(symbols[known])], schema=schema
            )

    counted = docs.mapInArrow(count, "token binary, symbol int, n bigint")
    return counted.groupBy("token", "symbol").agg(F.sum("n").alias("n"))


def context_tables(docs: DataFrame, code: Code) -> DataFrame:
    """Of (text): predictor, block, odds (one signed byte a cell) from the counts over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros(CELLS << ROW_BITS, np.int32) for _ in range(PREDICTORS)]
        for batch in batches:
            for parts in _parts(_bytes(batch.column(0))):
                _observe(parts, code, tables)
            pa.default_memory_pool().release_unused()
        pack = zstandard.ZstdCompressor(level=1)
        for predictor, table in enumerate(tables):
            blocks = table.reshape(-1, BLOCK_ROWS * CELLS)
            used = np.flatnonzero(blocks.any(1))
            packed = [pack.compress(blocks[n].tobytes()) for n in used]
            yield pa.RecordBatch.from_arrays(
                [pa.array([predictor] * len(used), pa.int32()), pa.array(used, pa.int32()), pa.array(packed, pa.binary())],
                ["predictor", "block", "counts"],
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # All rows of a block are in one partition, which holds one table for each of its blocks.
        unpack, totals = zstandard.ZstdDecompressor(), {}
        for batch in batches:
            for predictor, block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                counts = np.frombuffer(unpack.decompress(packed.as_buffer()), np.int32)
                key = predictor, block
                if key in totals:
                    totals[key] += counts
                else:
                    totals[key] = counts.astype(np.int64)
        for (predictor, block), counts in totals.items():
            odds = log_odds(counts.reshape(-1, CELLS)).tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([predictor], pa.int32()), pa.array([block], pa.int32()), pa.array([odds], pa.binary())],
                ["predictor", "block", "odds"],
            )

    counted = docs.mapInArrow(count, "predictor int, block int, counts binary")
    return counted.repartition("predictor", "block").mapInArrow(add, "predictor int, block int, odds binary")


def _parts(texts: Iterator[bytes]) -> Iterator[list[tuple[np.ndarray, bool]]]:
    """Framed texts gathered and cut to about `PIECE` bytes; each part with whether it ends its text."""
    waiting, size = [], 0
    for text in texts:
        framed = _framed(text)
        for at in range(0, len(text) + 1, PIECE):
            part = framed[at : at + BACK + PIECE]
            waiting.append((part, at + PIECE > len(text)))
            size += len(part)
            if size >= PIECE:
                yield waiting
                waiting, size = [], 0
    if waiting:
        yield waiting


def _observe(parts: list[tuple[np.ndarray, bool]], code: Code, tables: list[np.ndarray]) -> None:
    text, begins, coded, symbols = _joined(parts)
    owner, visit = code.visited(symbols)
    salt, ends = code.salt.take(visit), code.ends.take(visit)
    for table, hashed in zip(tables, hashes(text, begins)):
        # One of the table's own type: another would be added ten times slower.
        np.add.at(table, rows_of(hashed.take(coded).take(owner), salt) + ends, table.dtype.type(1))


def _joined(parts: list[tuple[np.ndarray, bool]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Parts of framed texts in one array, where each begins, the places of what is to be coded, and byte before * SYMBOLS + symbol."""
    text = np.concatenate([part for part, _ in parts])
    sizes = np.array([len(part) for part, _ in parts])
    stops = np.cumsum(sizes)
    inside = np.ones(len(text), bool)
    inside[((stops - sizes)[:, None] + np.arange(BACK)).ravel()] = False
    coded = np.flatnonzero(inside)
    symbols = text.take(coded).astype(np.intp)
    ended = np.array([last for _, last in parts])
    symbols[(stops - BACK * np.arange(1, len(parts) + 1) - 1)[ended]] = END
    symbols += text.take(coded - 1).astype(np.intp) * SYMBOLS
    return text, stops - sizes, coded, symbols


def log_odds(counts: np.ndarray) -> np.ndarray:
    """Of rows of 16 end cells: the log odds of a 1 in each of a row's 15 decisions, in sixteenths; 0 where nothing was met."""
    odds = np.zeros(counts.shape, np.int8)
    for depth in range(4):
        sides = counts.reshape(len(counts), 2 << depth, CELLS >> depth + 1).sum(2).astype(np.float64)
        raw = np.log((sides[:, 1::2] + PRIOR) / (sides[:, ::2] + PRIOR)) * ODDS
        odds[:, (1 << depth) - 1 : (2 << depth) - 1] = np.clip(np.rint(raw), -127, 127)
    return odds


# -- scoring ---------------------------------------------------------------------------------------


class Mixer:
    """Scores texts against tables of log odds."""

    GATES = (PREDICTORS + 1) * 4

    def __init__(self, code: Code, tables: list[np.ndarray]):
        self.code, self.tables = code, tables

    def scores(self, texts: Iterator[bytes]) -> list[float]:
        """The natural log of each text's probability."""
        found: list[float] = []
        lanes: list[list] = []  # number of the text, its frame, the next place
        free = list(range(LANES))
        weights = np.zeros((PREDICTORS, LANES, self.GATES), np.float32)
        moved = np.zeros(weights.shape)
        shift, seen = np.zeros((LANES, REFINED)), np.zeros((LANES, REFINED))
        more = True
        while more or lanes:
            while more and free:
                text = next(texts, None)
                if text is None:
                    more = False
                    break
                lane = free.pop()
                weights[:, lane], moved[:, lane] = START / ODDS, 0
                shift[lane], seen[lane] = 0, 0
                lanes.append([lane, len(found), _framed(text), 0])
                found.append(0.0)
            if not lanes:
                break
            parts, still = [], []
            for lane, number, framed, at in lanes:
                part = framed[at : at + BACK + CHUNK]
                last = at + BACK + CHUNK >= len(framed)
                parts.append((part, last))
            losses = self._chunk(parts, [lane for lane, *_ in lanes], weights, moved, shift, seen)
            for (lane, number, framed, at), (_, last), loss in zip(lanes, parts, losses):
                found[number] -= loss
                if last:
                    free.append(lane)
                else:
                    still.append([lane, number, framed, at + CHUNK])
            lanes = still
        return found

    def _chunk(self, parts, lanes, weights, moved, shift, seen) -> list[float]:
        """Loss of each part, with what its lane has learned so far; the lanes learn from it afterwards."""
        code = self.code
        text, begins, coded, symbols = _joined(parts)
        owner, visit = code.visited(symbols)
        salt = code.salt.take(visit)
        of_visit, decision = code.decided(visit)
        choice = code.choice.take(decision)
        cell, sign = CELL_OF.take(choice), SIGN_OF.take(choice)
        inputs, gate = [], DEPTH_OF.take(choice)
        for table, hashed in zip(self.tables, hashes(text, begins)):
            spot = rows_of(hashed.take(coded).take(owner), salt).take(of_visit)
            spot += cell
            odds = table.take(spot)
            gate += (odds != 0).view(np.int8) << 2
            inputs.append(odds.astype(np.float32))
        # Decisions are in order of the parts.
        sizes = np.array([len(part) - BACK for part, _ in parts])
        visited = np.searchsorted(owner, np.cumsum(sizes))
        until = np.searchsorted(of_visit, visited)
        counts = np.diff(until, prepend=0)
        place = np.repeat(np.array(lanes) * self.GATES, counts)
        place += gate
        mixed = np.zeros(len(decision), np.float32)
        for x, w in zip(inputs, weights.reshape(PREDICTORS, -1)):
            mixed += w.take(place) * x
        bucket = np.clip((mixed + REFINED / 2).astype(np.intp), 0, REFINED - 1)
        bucket += np.repeat(np.array(lanes) * REFINED, counts)
        refined = mixed + shift.astype(np.float32).ravel().take(bucket)
        raised = np.exp(np.minimum(refined * -sign, 60))
        loss = np.log(1 + raised)
        total = np.add.reduceat(loss, until - counts, dtype=np.float64)
        # How far each decision was missed: what both the mixer and the corrections learn from.
        missed = sign * (raised / (1 + raised))
        size = LANES * REFINED
        error = np.bincount(bucket, missed, size).reshape(shift.shape)
        spread = np.abs(missed)
        seen += np.bincount(bucket, spread * (1 - spread), size).reshape(shift.shape)
        shift += error / (seen + 4)
        for n, x in enumerate(inputs):
            slope = np.bincount(place, missed * x, LANES * self.GATES).reshape(moved[n].shape) / ODDS
            moved[n] += slope * slope
            weights[n] += (RATE / ODDS) * slope / np.sqrt(moved[n] + 1e-6)
        return total.tolist()


# -- the operator --------------------------------------------------------------------------------------

_ready: dict[str, tuple] = {}

SCORED = (
    "id string, held_out boolean, n_bytes bigint, n_tokens bigint, head_known bigint, head_log double, score double, "
    "rest array<struct<token: binary, n: bigint>>"
)


class Model:
    """What the training texts say, sent to the tasks: the code, the tables and the most frequent tokens."""

    def __init__(self, corpus: DataFrame, blocks: DataFrame, code: Code, head: int, head_bytes: int):
        spark = corpus.sparkSession
        short = corpus.where(F.col("token").isNotNull() & (F.octet_length("token") <= head_bytes))
        # By steps of count, as many of the largest as hold no more than `head` tokens: a top-k would send that many from every task.
        step = F.floor(F.log2("n") * STEPS).cast("int")
        held, least = 0, 0
        for row in sorted(short.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
            held, least = held + row["n"], row["step"]
            if held > head:
                least += 1
                break
        frequent = short.where(step >= least).select("token", "n").orderBy("token").collect() if head else []
        tables = [np.zeros(CELLS << ROW_BITS, np.int8) for _ in range(PREDICTORS)]
        for row in blocks.collect():  # TABLE_BYTES at most
            at = row["block"] * BLOCK_ROWS * CELLS
            tables[row["predictor"]][at : at + BLOCK_ROWS * CELLS] = np.frombuffer(row["odds"], np.int8)
        tokens = [bytes(row["token"]) for row in frequent]
        self.mark = uuid.uuid4().hex
        self.sent = spark.sparkContext.broadcast((code, tables, tokens, [row["n"] for row in frequent]))

    def ready(self) -> tuple[Mixer, pa.Array, np.ndarray]:
        if self.mark not in _ready:
            _ready.clear()
            code, tables, tokens, counts = self.sent.value
            logs = np.log10(np.array(counts, np.float64) + 0.5)
            _ready[self.mark] = Mixer(code, tables), pa.array(tokens, pa.large_binary()), logs
        return _ready[self.mark]


def _scored(texts: DataFrame, model: Model) -> DataFrame:
    """Of (id, held_out, text): the mixer's score, and the base score's parts; tokens beyond the head are listed."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, head, logs = model.ready()
        for batch in batches:
            n = batch.num_rows
            natural = mixer.scores(_bytes(batch.column(2)))
            sizes = pc.binary_length(batch.column(2).cast(pa.binary()))
            tokens, known, total = np.ones(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
            rest: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
            for owners, piece in _pieces(_bytes(batch.column(2))):
                starts, found = _tokens(piece)
                if not len(starts):
                    continue
                owner = owners[np.searchsorted(owners[:, 1], starts, "right") - 1, 0]
                tokens += np.bincount(owner, minlength=n)
                place = pc.index_in(found.dictionary, value_set=head).fill_null(-1).to_numpy(zero_copy_only=False)
                index = found.indices.to_numpy(zero_copy_only=False)
                at = place.take(index)
                inside = at >= 0
                known += np.bincount(owner[inside], minlength=n)
                total += np.bincount(owner[inside], logs.take(at[inside]), n) if len(logs) else 0
                pairs, counts = np.unique(owner[~inside] << 32 | index[~inside], return_counts=True)
                rest.append((pairs >> 32, counts, found.dictionary.take(pa.array(pairs & 0xFFFFFFFF))))
            owner = np.concatenate([np.zeros(0, np.int64), *[r[0] for r in rest]])
            order = np.argsort(owner, kind="stable")
            names = pa.concat_arrays([pa.array([], pa.large_binary()), *[r[2] for r in rest]]).take(pa.array(order))
            counts = np.concatenate([np.zeros(0, np.int64), *[r[1] for r in rest]])[order]
            offsets = np.searchsorted(owner[order], np.arange(n + 1)).astype(np.int32)
            listed = pa.StructArray.from_arrays([names.cast(pa.binary()), pa.array(counts, pa.int64())], ["token", "n"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), sizes.cast(pa.int64()), pa.array(tokens), pa.array(known), pa.array(total),
                    pa.array(np.array(natural) / np.log(10)), pa.ListArray.from_arrays(pa.array(offsets), listed),
                ],
                ["id", "held_out", "n_bytes", "n_tokens", "head_known", "head_log", "score", "rest"],
            )
            pa.default_memory_pool().release_unused()

    return texts.mapInArrow(score, SCORED)


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD, head_bytes: int = HEAD_BYTES
) -> DataFrame:
    """One row per row of `docs`: id_col, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    ship(docs.sparkSession)
    texts = docs.select(
        F.col(id_col).cast("string").alias("id"), held_out(F.col(id_col)).alias("held_out"), whole(F.col(text_col)).alias("text")
    )
    training = texts.where(~F.col("held_out")).select("text")
    corpus = durable(token_counts(training), "corpus")
    follows = np.zeros(256 * SYMBOLS, np.int64)
    for row in corpus.where("symbol IS NOT NULL").collect():  # one row for each byte and symbol at most
        follows[row["symbol"]] = row["n"]
    follows = follows.reshape(256, SYMBOLS)
    ends = int(follows[:, END].sum())
    words, distinct = corpus.where("token IS NOT NULL").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    train_tokens, vocabulary = words + ends, distinct + (ends > 0)
    code = Code(follows)
    model = Model(corpus, durable(context_tables(training, code), "tables"), code, head, head_bytes)
    scored = durable(
        _scored(texts, model).withColumn("row", F.monotonically_increasing_id()), "scored"
    )
    rest = scored.select("row", F.inline("rest"))
    counts = corpus.where("token IS NOT NULL").select("token", F.col("n").alias("c"))
    rare = rest.join(counts, "token", "left").groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare_log"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rare_known"),
    )
    floor = float(np.log10(train_tokens + 0.5 * (vocabulary + 1)))
    end_log = float(np.log10(ends + 0.5))
    base = F.col("head_log") + F.coalesce("rare_log", F.lit(0.0)) + F.lit(end_log) - F.col("n_tokens") * F.lit(floor)
    known = F.col("head_known") + F.coalesce("rare_known", F.lit(0)) + F.lit(int(ends > 0))
    return scored.drop("rest").join(rare, "row", "left").select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "held_out", "n_tokens",
        known.cast("bigint").alias("n_known"), F.lit(train_tokens).cast("bigint").alias("train_tokens"),
        base.alias("base_score"), "score",
        (-F.col("score") * F.lit(float(np.log2(10))) / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"),
    )
