"""An append-only log of keyed entries whose files stay few: a folded checkpoint and a short tail.

    path/folded/            the latest entry of each key, as a published dataset; its pointer says through which entry
    path/tail/<n>-<high>/   entries after that, numbered; <high> is the largest mark noted with them so far

An append writes one numbered folder, put in place by a rename. Every ``limit`` appends the checkpoint and the tail are folded
into a new checkpoint: one aggregate, whose pointer then hides the entries it holds. Those are deleted at the next folding, so
a reader that planned before it still finds them. Lookups read the checkpoint and at most ``limit`` newer entries, and
:meth:`high` needs file names only.
"""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gridtide.operators import ledger
from gridtide.sources import scratch
from gridtide.sources.published import Published, Version

LIMIT = 64
KEPT = 2  # checkpoints kept for readers that planned before the newest


class FoldedLog:
    """One writer. Of a key's entries the one with the largest ``seq`` counts; folded entries for which ``done`` holds are dropped."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, key: str, seq: str, done: str | None = None,
        limit: int = LIMIT,
    ) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.key, self.seq, self.done = key, seq, done
        self.limit = limit
        self.folded = Published(spark, f"{self.path}/folded")

    def _tail(self, version: Version) -> list[tuple[int, int, str]]:
        """Number, high mark and folder name of the entries that the checkpoint does not hold, oldest first."""
        through = version.facts.get("through", 0)
        names = scratch.children(self.spark, f"{self.path}/tail")
        placed = sorted((*map(int, name.split("-")), name) for name in names)
        return [entry for entry in placed if entry[0] > through]

    def high(self) -> int:
        """The largest mark ever noted, 0 without one."""
        version = self.folded.version()
        return max([version.facts.get("high", 0), *[high for _, high, _ in self._tail(version)]])

    def read(self) -> DataFrame:
        """The checkpoint's entries and those appended since."""
        version = self.folded.version()
        rows = self.folded.read(self.schema, version)
        tail = [f"{self.path}/tail/{name}" for _, _, name in self._tail(version)]
        if not tail:
            return rows
        return rows.unionByName(self.spark.read.schema(self.schema).parquet(*tail))

    def append(self, rows: DataFrame, high: int = 0) -> None:
        version = self.folded.version()
        tail = self._tail(version)
        if len(tail) >= self.limit:
            self.fold()
            version = self.folded.version()
            tail = self._tail(version)
        number = max([version.facts.get("through", 0), *[n for n, _, _ in tail]]) + 1
        high = max(high, self.high())
        staged = f"{self.path}/staging/{uuid.uuid4().hex}"
        rows.write.parquet(staged)
        scratch.move(self.spark, staged, f"{self.path}/tail/{number:012d}-{high:012d}")

    def fold(self) -> None:
        """Make checkpoint and tail one, and delete the entries that the checkpoint before had taken in."""
        version = self.folded.version()
        tail = self._tail(version)
        if not tail:
            return
        rows = ledger.fold(self.read(), self.key, self.seq, keep=True)
        if self.done is not None:
            rows = rows.where(f"NOT coalesce({self.done}, false)")
        load = self.folded.new_load()
        rows.select(*self.schema.names).write.parquet(self.folded.folder(load))
        facts = {"through": tail[-1][0], "high": max(high for _, high, _ in tail)}
        self.folded.publish(load, facts={**facts, "high": max(facts["high"], version.facts.get("high", 0))})
        for name in scratch.children(self.spark, f"{self.path}/tail"):
            if int(name.split("-")[0]) <= version.facts.get("through", 0):
                scratch.delete(self.spark, f"{self.path}/tail/{name}")
        self.folded.tidy(timedelta(0), keep=KEPT)
