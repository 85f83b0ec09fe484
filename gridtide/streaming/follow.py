"""Incremental ingestion as Structured Streaming jobs over landed files."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridtide.operators.contract import GRID, Layout
from gridtide.operators.incremental import Params
from gridtide.operators.marts import MARTS
from gridtide.operators.script import Script
from gridtide.plans.cycle import RunOutcome, load_batch
from gridtide.plans.store import Store
from gridtide.sources import landing, scratch, split
from gridtide.sources.table import KeyedTable

PAGE = 10_000  # paths of refused files that the driver holds at once


def _drain(
    stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Process what has landed, then stop; the checkpoint remembers what was read."""
    query = (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def stream_upsert(
    stream: DataFrame, table: KeyedTable, checkpoint: str, seq: str | None = "seq"
) -> StreamingQuery:
    """Upsert every micro-batch by key. A replayed micro-batch merges to the same rows."""
    table.recover()

    def step(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, seq)

    return _drain(stream, step, checkpoint)


def stream_cycle(
    spark: SparkSession,
    landed: str,
    base: str,
    checkpoint: str,
    params: Params = Params(),
    layout: Layout = GRID,
    files_per_batch: int = 1,
    now: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    on_outcome: Callable[[RunOutcome], None] | None = None,
    scripts: Sequence[Script | tuple] = MARTS,
) -> StreamingQuery:
    """The whole cycle per landed export file (or per ``files_per_batch`` of them), each read by byte ranges.

    A run is known by the stream, whose id is kept beside the checkpoint, and its micro-batch: one
    replayed after a crash goes on under its run id, or is skipped if its run had finished. Broken files are
    refused and the others loaded; a micro-batch that fails the gate is refused whole. Refused files are
    listed by :meth:`Store.refused` and offered again, in runs of their own, each time the stream is
    started. Any other exception ends its run as ``error`` and stops the stream.
    """
    store = Store(spark, base, layout, scripts)
    store.recover()
    stream_id = _stream_id(spark, checkpoint)

    def load(scanned: DataFrame, batch_id: int | None) -> None:
        opened = store.start_run(now(), None, None, stream_id, batch_id)
        cut = f"{store.base}/staging/cut={opened['run_id']}"
        try:
            records = split.records_of(spark, scanned, cut)
            outcome = load_batch(store, records, opened, now(), params, time.monotonic(), by_file=True)
        except Exception as problem:
            store.finish_run(opened, "error", error=str(problem))
            if not isinstance(problem, landing.PayloadError):
                raise
            return
        finally:
            scratch.delete(spark, cut)
        if on_outcome is not None:
            on_outcome(outcome)

    def step(scanned: DataFrame, batch_id: int) -> None:
        mine = (F.col("stream") == stream_id) & (F.col("batch_id") == batch_id) & (F.col("event_seq") > 0)
        if store.events().where(mine).isEmpty():
            load(scanned, batch_id)

    for paths in _grouped(store.refused(), files_per_batch):
        there = [path for path in paths if scratch.exists(spark, path)]
        if there:
            load(split.scan(spark.read, there), None)

    stream = split.scan(spark.readStream.option("maxFilesPerTrigger", files_per_batch), landed)
    return _drain(stream, step, checkpoint)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that owns a checkpoint: the name of the one folder kept beside it."""
    home = f"{checkpoint.rstrip('/')}_stream"
    if not scratch.children(spark, home):
        scratch.make_dir(spark, f"{home}/{uuid.uuid4().hex}")
    return scratch.children(spark, home)[0]


def _grouped(refused: DataFrame, size: int) -> Iterator[list[str]]:
    """Paths of refused files in groups, in order; the driver holds one page of them. Runs add to the list only what
    they were offered, which lies behind."""
    page = max(PAGE // size, 1) * size
    after = F.lit(True)
    while True:
        rows = refused.select("origin").where(after).orderBy("origin").limit(page).collect()
        paths = [row["origin"] for row in rows]
        for at in range(0, len(paths), size):
            yield paths[at : at + size]
        if len(paths) < page:
            return
        after = F.col("origin") > paths[-1]
