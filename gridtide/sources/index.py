"""An interval index of landed files: which keys each one holds, asked before any is read.

For feeds whose file names tell no date. The index is a small Parquet log of (origin, size, smallest and largest key); bringing
it up to date reads only files that it does not know, or whose size or time has changed.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.functions import clock, coerce
from gridtide.sources import landing
from gridtide.sources.log import FoldedLog

PAGE = 10_000  # paths that the driver holds at once
ENTRY = T.StructType(
    [
        T.StructField("origin", T.StringType()),
        T.StructField("stamp", T.StringType()),
        T.StructField("low", T.LongType()),
        T.StructField("high", T.LongType()),
        T.StructField("unread", T.BooleanType()),
        T.StructField("entry", T.LongType()),
    ]
)


class LandedIndex:
    """``key`` is the JSON field whose values are indexed, as moments in microseconds."""

    def __init__(self, spark: SparkSession, path: str, landed: str, key: str) -> None:
        self.spark, self.landed, self.key = spark, landed, key
        self.log = FoldedLog(spark, path, ENTRY, "origin", "entry")

    def entries(self) -> DataFrame:
        """The latest entry of each file."""
        last = F.max_by(F.struct(*[n for n in ENTRY.names if n != "origin"]), "entry").alias("_last")
        return self.log.read().groupBy("origin").agg(last).select("origin", "_last.*")

    def _listed(self) -> DataFrame:
        """Landed files with a stamp of their size and time; contents are not read."""
        files = self.spark.read.format("binaryFile").load(self.landed)
        stamp = F.concat_ws("-", "_metadata.file_size", F.unix_micros("_metadata.file_modification_time"))
        return files.select(F.col("_metadata.file_path").alias("origin"), stamp.alias("stamp"))

    def refresh(self) -> int:
        """Take in files that are new or changed; returns how many."""
        taken = 0
        while paths := self._unknown():
            self._take_in(paths)
            taken += len(paths)
        return taken

    def _unknown(self) -> list[str]:
        """One page of the files that are new or changed."""
        known = self.entries().select("origin", "stamp")
        fresh = self._listed().join(known, ["origin", "stamp"], "left_anti")
        return [row["origin"] for row in fresh.select("origin").orderBy("origin").limit(PAGE).collect()]

    def _take_in(self, paths: list[str]) -> None:
        records = landing.explode_records(landing.triage(landing.read_export_files(self.spark, paths)))
        moment = F.expr(clock.micros(coerce.instant(f"get_json_object(record, '$.{self.key}')"), clock.INSTANT))
        spans = records.select(F.col("seq.origin").alias("origin"), moment.alias("m")).groupBy("origin").agg(
            # A file with a record whose key cannot be read, or with a problem, may hold anything.
            F.min("m").alias("low"), F.max("m").alias("high"), F.max(F.col("m").isNull()).alias("unread")
        )
        number = self.log.high() + 1
        listed = self._listed().where(F.col("origin").isin(paths))
        rows = listed.join(spans, "origin", "left").select(
            "origin", "stamp", "low", "high", F.coalesce("unread", F.lit(False)).alias("unread"),
            F.lit(number).cast("bigint").alias("entry"),
        )
        self.log.append(rows, high=number)

    def files(self, start: datetime, end: datetime) -> list[str]:
        """The files that may hold a key in the window: those a reader has to open."""
        low, high = clock.micros_of(start), clock.micros_of(end)
        found = self.entries().where((F.col("unread")) | ((F.col("low") < high) & (F.col("high") >= low)))
        return sorted(row["origin"] for row in found.select("origin").collect())
