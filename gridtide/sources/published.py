"""Versioned folders behind one small pointer file, so that readers never notice a load.

    path/data/load=<id>/<part>=<value>/   what a load wrote; never changed afterwards
    path/versions/<number>                which load holds which part; the largest number is current

A load writes only its own folder. It takes effect when its pointer, first written whole under another name, is renamed to
the next number, which no reader can see half done. A reader resolves the pointer once and then knows
every folder it reads, so a plan made before a load and run after it gives the rows of its own time. Old pointers, and folders that no pointer
names, are dropped once a grace time has passed (:meth:`Published.tidy`). One writer, any number of readers.

A pointer holds one line for each part. Parts are dates, months or a single one: bounded by the calendar, not by rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gridtide.sources import scratch

LOAD = "load"
#: The one part of a dataset that is not partitioned.
WHOLE = "all"
GRACE = timedelta(days=1)
_DRAFT = "_next-"


@dataclass(frozen=True)
class Version:
    """What one pointer says: the load of each part, the load that published it, and small facts noted with it."""

    number: int = 0
    parts: dict[str, str] = field(default_factory=dict)
    load: str = ""
    facts: dict = field(default_factory=dict)


class Published:
    """``part`` is the partition column that loads are replaced by; None for a dataset replaced whole."""

    def __init__(self, spark: SparkSession, path: str, part: T.StructField | None = None) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.part = part

    # -- reads ----------------------------------------------------------------------------------

    def numbers(self) -> list[int]:
        """The versions whose pointers are still there, oldest first."""
        names = scratch.children(self.spark, f"{self.path}/versions")
        return sorted(int(name) for name in names if name.isdigit())

    def version(self, number: int | None = None) -> Version:
        """The current version, or an older one that is not dropped yet (LookupError if it is)."""
        while number is None:
            held = self.numbers()
            if not held:
                return Version()
            try:
                return self.version(held[-1])
            except LookupError:  # dropped since the listing, because there is a newer one
                continue
        text = scratch.read_text(self.spark, self._pointer(number))
        if text is None:
            raise LookupError(f"version {number} of {self.path} is gone")
        return Version(number, **json.loads(text))

    def since(self, number: int) -> list[Version] | None:
        """The versions after ``number``, oldest first; None when one of them is gone."""
        found = []
        for later in range(number + 1, self.version().number + 1):
            try:
                found.append(self.version(later))
            except LookupError:
                return None
        return found

    def read(
        self, schema: T.StructType, version: Version | None = None, wanted: Iterable[str] | None = None,
        folder: str = "data", source: str = "parquet",
    ) -> DataFrame:
        """The rows of a version (the current one), of all parts or of ``wanted`` ones, with their part column. What
        loads keep in another ``folder`` may be of another ``source`` format and hold the part as a plain column.

        Every folder is named in the plan: parts become partition filters, and folders of other loads are not listed.
        """
        version = self.version() if version is None else version
        parts = version.parts if wanted is None else {p: version.parts[p] for p in wanted if p in version.parts}
        fields = [*schema.fields, *([self.part] if self.part else [])]
        if not parts:
            return self.spark.createDataFrame([], T.StructType(fields))
        by_load: dict[str, list[str]] = {}
        for part, load in sorted(parts.items()):
            by_load.setdefault(load, []).append(part)
        root = f"{self.path}/{folder}"
        stored = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType()), *([self.part] if self.part else [])])
        rows = self.spark.read.format(source).schema(stored).option("basePath", root)
        rows = rows.load([f"{root}/{LOAD}={load}" for load in sorted(by_load)])
        if self.part:
            kind = "DATE" if isinstance(self.part.dataType, T.DateType) else ""
            kept = [
                f"({LOAD} = '{load}' AND {self.part.name} IN ({', '.join(f"{kind}{_quoted(n)}" for n in names)}))"
                for load, names in by_load.items()
            ]
            rows = rows.where(" OR ".join(kept))
        return rows.select(*[f.name for f in fields])

    def rows_of(self, load: str, schema: T.StructType, folder: str = "data") -> DataFrame:
        """All rows that one load wrote, whatever became of its parts."""
        fields = [*schema.fields, *([self.part] if self.part else [])]
        return self.spark.read.schema(T.StructType(fields)).parquet(f"{self.path}/{folder}/{LOAD}={load}")

    # -- writes ---------------------------------------------------------------------------------

    def new_load(self) -> str:
        return uuid.uuid4().hex

    def folder(self, load: str, folder: str = "data") -> str:
        """Where a load writes its parts, as folders of the part column."""
        return f"{self.path}/{folder}/{LOAD}={load}"

    def written(self, load: str) -> list[str]:
        """The parts found in a load's folder."""
        if self.part is None:
            return [WHOLE]
        prefix = f"{self.part.name}="
        names = scratch.children(self.spark, self.folder(load))
        return [unquote(name[len(prefix):]) for name in names if name.startswith(prefix)]

    def draft(self, load: str, removed: Sequence[str] = (), facts: dict | None = None, over: Version | None = None) -> int:
        """Write the pointer that follows ``over`` (the current version) whole, but not yet in force; its number."""
        over = self.version() if over is None else over
        parts = {part: held for part, held in over.parts.items() if part not in removed}
        parts |= {part: load for part in self.written(load)}
        number = over.number + 1
        body = {"parts": parts, "load": load, "facts": over.facts if facts is None else facts}
        scratch.write_text(self.spark, self._draft(number), json.dumps(body))
        return number

    def put_in_force(self, number: int) -> Version:
        """Rename the draft: the one moment at which a load takes effect."""
        if scratch.exists(self.spark, self._pointer(number)):
            raise RuntimeError(f"version {number} of {self.path} was published by another writer")
        scratch.move(self.spark, self._draft(number), self._pointer(number))
        return self.version(number)

    def publish(self, load: str, removed: Sequence[str] = (), facts: dict | None = None) -> Version:
        return self.put_in_force(self.draft(load, removed, facts))

    def recover(self) -> int:
        """Put a draft in force that a lost driver had written whole; returns how many versions that made."""
        made = 0
        for name in scratch.children(self.spark, f"{self.path}/versions"):
            if name.startswith(_DRAFT):
                number = int(name[len(_DRAFT):])
                if number == self.version().number + 1 and _whole(scratch.read_text(self.spark, self._draft(number))):
                    self.put_in_force(number)
                    made += 1
                else:
                    scratch.delete(self.spark, self._draft(number))
        return made

    def tidy(
        self, grace: timedelta = GRACE, folders: Sequence[str] = ("data",), keep: int = 1
    ) -> list[str]:
        """Drop pointers that were replaced, and loads that no pointer names, more than ``grace`` ago; the loads dropped.

        The newest ``keep`` versions stay, however old.
        """
        before = datetime.now(timezone.utc) - grace
        numbers = self.numbers()
        # A pointer is out of use since the next one was written.
        for number, following in zip(numbers[:-keep], numbers[1:]):
            if scratch.modified(self.spark, self._pointer(following)) <= before:
                scratch.delete(self.spark, self._pointer(number))
        named: set[str] = set()
        for number in self.numbers():
            held = self.version(number)
            named |= {held.load, *held.parts.values()}
        dropped = set()
        for folder in folders:
            for name in scratch.children(self.spark, f"{self.path}/{folder}"):
                load = name.partition("=")[2] or name
                place = f"{self.path}/{folder}/{name}"
                if load not in named and scratch.modified(self.spark, place) <= before:
                    scratch.delete(self.spark, place)
                    dropped.add(load)
        return sorted(dropped)

    def _pointer(self, number: int) -> str:
        return f"{self.path}/versions/{number:012d}"

    def _draft(self, number: int) -> str:
        return f"{self.path}/versions/{_DRAFT}{number:012d}"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _whole(text: str | None) -> bool:
    try:
        return text is not None and "parts" in json.loads(text)
    except ValueError:
        return False
