"""A Parquet table kept unique by key and partitioned by the UTC date of its time column."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.functions import clock
from gridtide.operators import merge, synopsis
from gridtide.sources import scratch
from gridtide.sources.published import GRACE, Published, Version

DAY = "utc_date"
SYNOPSIS = "synopsis"
_NUMBERS = ("rows", "observed", "newest_micros")
_COUNTS = ("count_if(_change = 'inserted') AS inserted", "sum(_copies) AS sent")


@dataclass(frozen=True)
class Loaded:
    """What an upsert did."""

    inserted: int
    updated: int
    days: tuple[date, ...]


class KeyedTable:
    """Single writer, any number of readers.

    The partition date must follow from the key (the time column is part of it),
    so a revision lands in the date that already holds the row, and an upsert
    reads and rewrites only the dates its batch touches, whatever the history.
    Loads take effect by one renamed pointer (:mod:`gridtide.sources.published`): readers, also those
    that planned earlier, never meet half a load or a missing file.

    Each load keeps two by-products in its folder: the change of every row (:meth:`changes_since`) and
    a synopsis of its dates (:meth:`synopsis`), for which ``seen`` says when a row counts as observed.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: list[str], time: str, schema: T.StructType, seen: str = "true"
    ) -> None:
        if time not in keys:
            raise ValueError("the time column must be part of the key")
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = keys
        self.time = time
        self.schema = schema
        self.seen = seen
        self.feed = T.StructType([
            T.StructField(merge.CHANGE, T.StringType()), T.StructField(merge.COPIES, T.LongType()),
            T.StructField(merge.BEFORE, schema), *schema.fields,
        ])
        self.published = Published(spark, self.path, T.StructField(DAY, T.DateType()))

    # -- reads --------------------------------------------------------------------------

    def days(self, version: Version | None = None) -> list[date]:
        """The dates the table holds, from its pointer alone."""
        version = self.published.version() if version is None else version
        return [date.fromisoformat(part) for part in sorted(version.parts)]

    def read(self, version: Version | None = None) -> DataFrame:
        """The rows of one version, the current one unless given; loads that follow do not change the frame."""
        return self.published.read(self.schema, version).drop(DAY)

    def read_days(self, wanted: Iterable[date], version: Version | None = None) -> DataFrame:
        """Only the named dates, however many: partition pruning leaves out the other folders' files."""
        return self.published.read(self.schema, version, [day.isoformat() for day in wanted]).drop(DAY)

    def read_since(self, first: date) -> DataFrame:
        version = self.published.version()
        return self.read_days([day for day in self.days(version) if day >= first], version)

    def synopsis(self, version: Version | None = None) -> DataFrame:
        """Rows, observed rows and newest observed key per date and local day, as the loads left them."""
        return self.published.read(synopsis.SCHEMA, version, folder=SYNOPSIS, source="json")

    def changes_since(self, number: int) -> DataFrame | None:
        """Inserted and updated rows of all loads after a version, with what they replaced, in order of ``_load``.

        A key that several loads changed has a row from each. None when a load is no longer kept.
        """
        versions = self.published.since(number)
        if versions is None:
            return None
        frames = [
            self.published.rows_of(version.load, self.feed).drop(DAY).withColumn("_load", F.lit(version.number))
            for version in versions
        ]
        feed = self.spark.createDataFrame([], T.StructType([*self.feed.fields, T.StructField("_load", T.IntegerType())]))
        for frame in frames:
            feed = feed.unionByName(frame)
        return feed.where(f"{merge.CHANGE} <> 'unchanged'")

    # -- upsert ---------------------------------------------------------------------------

    def upsert(
        self, batch: DataFrame, seq: str | None = "seq", staged: bool = False
    ) -> Loaded:
        """Insert or replace by key; the last row by ``seq`` wins inside the batch.

        ``seq=None`` states that the batch holds each key once; ``staged`` that it
        is read from files, so reading it again is cheap. A load that dies before its pointer is written
        changed nothing; one that dies after it is finished by :meth:`recover`.
        """
        stage = f"{self.path}/staging/{uuid.uuid4().hex}"
        if not staged:
            batch.write.parquet(stage)
            batch = self.spark.read.schema(batch.schema).parquet(stage)
        try:
            return self._upsert(batch, seq)
        finally:
            if not staged:
                scratch.delete(self.spark, stage)

    def _upsert(self, batch: DataFrame, seq: str | None) -> Loaded:
        day = f"{clock.utc_day(self.time, clock.type_of(batch, self.time))} AS {DAY}"
        touched = self._touched(batch.selectExpr(day))
        if not touched:
            return Loaded(0, 0, ())
        load = self.published.new_load()
        over = self.published.version()
        typed = [f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in self.schema]
        rows = batch.selectExpr(*typed, *([] if seq is None else [seq]))
        feed = merge.changes(self.read_days(touched, over), rows, self.keys, seq).selectExpr("*", day)
        # Rebalancing gives files of even size: a date holding most rows is split over tasks.
        feed.hint("rebalance", F.col(DAY)).write.partitionBy(DAY).parquet(self.published.folder(load))
        told = synopsis.synopsis(self.published.rows_of(load, self.feed), self.time, DAY, self.seen, *_COUNTS).collect()
        # At most three rows for each date of the batch: bounded by the calendar, so a small file holds them.
        lines = [
            json.dumps({name: row[name] if name in _NUMBERS else row[name].isoformat() for name in (DAY, *synopsis.SCHEMA.names)})
            for row in told
        ]
        scratch.write_text(self.spark, f"{self.published.folder(load, SYNOPSIS)}/part.json", "\n".join(lines))
        inserted, sent = (sum(row[name] for row in told) for name in ("inserted", "sent"))
        self._publish(self.published.draft(load, over=over))
        return Loaded(inserted, sent - inserted, tuple(touched))

    def _touched(self, days: DataFrame) -> list[date]:
        """Distinct dates of a batch: bounded by the calendar, not by the rows."""
        return sorted(row[DAY] for row in days.distinct().collect())

    def _publish(self, number: int) -> None:
        self.published.put_in_force(number)

    def recover(self, grace: timedelta = GRACE) -> int:
        """Finish a load that a lost driver had written whole, and drop what no reader can still need; loads finished."""
        made = self.published.recover()
        self.published.tidy(grace, ("data", SYNOPSIS, "staging"))
        return made
