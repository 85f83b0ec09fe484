"""Everything one feed keeps under its base folder: raw table, marts and run ledger."""

from __future__ import annotations

import hashlib
import inspect
import json
from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta, timezone
from functools import partial

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.functions import clock, energy
from gridtide.operators import contract, ledger, marts, synopsis
from gridtide.operators.contract import GRID, Layout, observed, table_schema
from gridtide.operators.script import Script, digest, levels, scripts_of
from gridtide.plans.together import together
from gridtide.sources import scratch
from gridtide.sources.log import FoldedLog
from gridtide.sources.published import GRACE, Published, Version
from gridtide.sources.table import DAY, KeyedTable

MONTH = "month"
_BY_MONTH = T.StructField(MONTH, T.StringType())


class MartNotBuilt(LookupError):
    """A mart was read before any cycle built it."""


class MartFailed(RuntimeError):
    """A mart could not be rebuilt; the message names it."""


class Store:
    """``scripts`` are the marts (see :class:`gridtide.operators.script.Script`; plain tuples will do). The daily one is kept by
    month from the change feed; any other is built whole, from the newest dates (see :meth:`tail`) and the marts it names."""

    def __init__(
        self, spark: SparkSession, base: str, layout: Layout = GRID,
        scripts: Sequence[Script | tuple] = marts.MARTS,
    ) -> None:
        self.spark = spark
        self.marts = scripts_of(scripts)
        self.base = base.rstrip("/")
        self.layout = layout
        self.table = KeyedTable(
            spark, f"{self.base}/raw", layout.unique, layout.key, table_schema(layout.fields), observed(layout.consumption)
        )
        self.ledger = FoldedLog(spark, f"{self.base}/ledger", ledger.EVENT, "run_id", "event_seq")
        self.files = FoldedLog(spark, f"{self.base}/refused", ledger.REFUSED, "origin", "run_id", "problem IS NULL")

    def recover(self, grace: timedelta = GRACE) -> None:
        """Finish what a lost driver had written whole, and drop versions that no reader can still need."""
        self.table.recover(grace)
        for script in self.marts:
            held = self._published(script.name)
            held.recover()
            held.tidy(grace)

    # -- raw table -----------------------------------------------------------------------

    def raw(self) -> DataFrame:
        return self.table.read()

    def tail(self) -> DataFrame:
        """The newest dates of the table, enough for every question about "now".

        Holds the newest observed row, all rows of the seven days before it and
        the two newest observed local days in full, exactly as the whole table
        would. The synopsis says from which date on that is, whatever the history.
        """
        version = self.table.published.version()
        days = self.table.days(version)
        newest = synopsis.newest_days(self.table.synopsis(version), DAY).collect()
        if not newest:
            return self.table.read_days(days[-1:], version)
        week = clock.moment_of(newest[0]["newest_micros"]) - timedelta(days=marts.MIX_DAYS)
        first = min(week.date(), *[row["first"] for row in newest])
        return self.table.read_days([day for day in days if day >= first], version)

    def watermark(self) -> DataFrame:
        """One row: the newest observed key, null when nothing is observed; from the synopsis."""
        key = clock.type_of(self.spark.createDataFrame([], self.table.schema), self.layout.key)
        newest = synopsis.newest(self.table.synopsis())
        return newest.selectExpr(f"{clock.from_micros('last_micros', key)} AS watermark")

    def sql(self, query: str, args: list | dict | None = None, **frames: DataFrame) -> DataFrame:
        """Ad-hoc parameterised SQL; ``{raw}``, ``{runs}``, ``{refused}``, every mart by its name without the
        leading number (``{mart_daily}``) and given frames name tables."""
        known = {"raw": self.raw, "runs": self.runs, "refused": self.refused}
        known |= {script.name.partition("_")[2]: partial(self.mart, script.name) for script in self.marts}
        named = {name for name in {*known, *frames} if "{" + name + "}" in query}
        used = {name: frames[name] if name in frames else known[name]() for name in named}
        return self.spark.sql(query, args=args, **used)

    # -- marts ------------------------------------------------------------------------------

    def _published(self, name: str) -> Published:
        return Published(self.spark, f"{self.base}/marts/{name}", _BY_MONTH if self._is_daily(name) else None)

    def _is_daily(self, name: str) -> bool:
        return any(script.name == name and script.build is marts.daily for script in self.marts)

    def mart(self, name: str) -> DataFrame:
        """A stored mart in presentation order."""
        held = self._published(name)
        version = held.version()
        if not version.number:
            raise MartNotBuilt(f"{name} is not built yet: run a cycle first")
        rows = held.read(T.StructType.fromJson(json.loads(version.facts["schema"])), version).drop(MONTH)
        # Of the daily mart its state is stored: the sums that loads add to and take from.
        return marts.in_order(name, marts.daily_of(rows) if self._is_daily(name) else rows)

    def definition(self) -> str:
        """A digest of what the stored daily state follows from besides the rows."""
        sources = [inspect.getsource(module) for module in (marts, energy, clock, contract)]
        return hashlib.sha256("\0".join([*sources, repr(self.layout)]).encode()).hexdigest()

    def dirty(self) -> list[date]:
        """Dates that loads have changed since the daily mart was last brought up to date."""
        now = self.table.published.version()
        daily = [script.name for script in self.marts if script.build is marts.daily]
        through = self._published(daily[0]).version().facts.get("through", 0) if daily else now.number
        if through == now.number:
            return []
        try:
            then = self.table.published.version(through) if through else Version()
        except LookupError:
            then = Version()
        return [date.fromisoformat(day) for day in sorted(now.parts) if then.parts.get(day) != now.parts[day]]

    def build_marts(self, tail: DataFrame | None = None) -> list[str]:
        """Bring every mart up to date; returns their names in build order.

        Marts that do not read each other are built at the same time, but they take effect in the order of their
        names: when one fails, those before it stand renewed and those after it as they were. The daily mart follows the
        changes since it was last built, by whatever load, also one whose driver was lost before its marts.
        """
        recent = self.tail() if tail is None else tail
        for level in levels(self.marts):
            steps = [partial(self._staged, script, recent) for script in level]
            staged = together(self.spark, *steps, keep_errors=True)
            for script, result in zip(level, staged):
                if isinstance(result, Exception):
                    raise MartFailed(f"mart {script.name} failed: {result}") from result
                if result is not None:
                    result()
        return [script.name for script in self.marts]

    def _staged(self, script: Script, recent: DataFrame) -> Callable | None:
        """Write a mart's new version; what puts it in force, or None when there is nothing new."""
        if script.build is marts.daily:
            return self._staged_daily(script.name)
        inputs = ({name: self.mart(name) for name in script.inputs},) if script.inputs else ()
        rows = marts.in_order(script.name, script.build(recent, self.layout, *inputs))
        return self._write(script.name, rows, {"digest": digest(script.build)})

    def _write(self, name: str, rows: DataFrame, facts: dict, removed: Sequence[str] = ()) -> Callable:
        held = self._published(name)
        load = held.new_load()
        writer = rows.write if held.part is None else rows.withColumn(MONTH, F.date_format("day", "yyyy-MM")).write.partitionBy(MONTH)
        writer.parquet(held.folder(load))
        facts = {**facts, "schema": json.dumps(rows.schema.jsonValue())}
        return lambda: held.publish(load, removed, facts)

    def _staged_daily(self, name: str) -> Callable | None:
        """The daily mart's state, from the rows that changed since; from all rows when that cannot be exact."""
        version = self.table.published.version()
        held = self._published(name)
        before = held.version()
        facts = {"through": version.number, "digest": self.definition()}
        same = before.facts.get("digest") == facts["digest"]
        if same and before.facts["through"] == version.number:
            return None
        feed = self.table.changes_since(before.facts["through"]) if same else None
        if feed is None:
            state, removed = marts.daily_state(self.table.read(version), self.layout), list(before.parts)
        else:
            state, removed = self._folded_state(held, before, feed, version)
        publish = self._write(name, state, facts, removed)

        def finish() -> None:
            publish()
            scratch.delete(self.spark, self._delta_path(version))

        return finish

    def _delta_path(self, version: Version) -> str:
        return f"{self.base}/staging/delta-{version.number}"

    def _folded_state(
        self, states: Published, before: Version, feed: DataFrame, version: Version
    ) -> tuple[DataFrame, list[str]]:
        """The state of the months that a feed touches, and those months; reads no row that did not change, but for days
        whose largest value may have gone."""
        schema = T.StructType.fromJson(json.loads(before.facts["schema"]))
        delta = marts.daily_delta(feed, self.layout)
        path = self._delta_path(version)
        delta.write.mode("overwrite").parquet(path)
        delta = self.spark.read.schema(delta.schema).parquet(path)
        months = [row[0] for row in delta.select(F.date_format("day", "yyyy-MM")).distinct().collect()]
        state = marts.daily_folded(states.read(schema, before, months).drop(MONTH), delta)
        # Calendar days only come to the driver.
        lost = [row["day"] for row in state.where("peak IS NULL").select("day").collect()]
        if lost:
            # A local day lies within one day of its UTC dates.
            near = {day + timedelta(days=step) for day in lost for step in (-1, 0, 1)}
            rows = marts.daily_state(self.table.read_days(near, version), self.layout).where(F.col("day").isin(lost))
            peaks = rows.select("day", F.col("peak").alias("_peak"))
            state = state.join(peaks, "day", "left").withColumn("peak", F.coalesce("peak", "_peak")).drop("_peak")
        return state.select(*schema.names), months

    # -- ledger -------------------------------------------------------------------------------

    def events(self) -> DataFrame:
        """The ledger's events: the last one of each run, and all that are not folded yet."""
        return self.ledger.read()

    def runs(self) -> DataFrame:
        return ledger.fold(self.events()).select(*ledger.RUNS.names)

    def refused(self) -> DataFrame:
        """Landed files that were refused and not loaded since, with the reason: origin, run_id, problem."""
        return ledger.fold(self.files.read(), "origin", "run_id", keep=True).where("problem IS NOT NULL")

    def note_files(self, files: DataFrame, run_id: int) -> None:
        """Adds what became of landed files (origin, problem) in a run; a null problem means loaded.

        Folding drops files that are loaded, so what is kept for good are the files refused now.
        """
        rows = files.select("origin", F.lit(run_id).cast("bigint").alias("run_id"), F.col("problem").cast("string"))
        self.files.append(rows)

    def _append(self, **event) -> None:
        row = Row(*ledger.EVENT.names)(*[event.get(name) for name in ledger.EVENT.names])
        self.ledger.append(self.spark.createDataFrame([row], ledger.EVENT).coalesce(1), high=event["run_id"])

    def start_run(
        self,
        started_at: datetime,
        window_start: datetime | None,
        window_end: datetime | None,
        stream: str | None = None,
        batch_id: int | None = None,
    ) -> dict:
        """Append the ``running`` event; a micro-batch that a lost driver had begun keeps its run id."""
        run_id = None
        if stream is not None and batch_id is not None:
            mine = (F.col("stream") == stream) & (F.col("batch_id") == batch_id)
            run_id = self.events().where(mine).agg(F.max("run_id")).first()[0]
        if run_id is None:
            run_id = self.ledger.high() + 1
        opened = {
            "run_id": run_id,
            "started_at": started_at,
            "window_start": window_start,
            "window_end": window_end,
            "stream": stream,
            "batch_id": batch_id,
        }
        self._append(**opened, status="running", event_seq=0)
        return opened

    def finish_run(
        self,
        opened: dict,
        status: str,
        rows_fetched: int = 0,
        rows_rejected: int = 0,
        rows_inserted: int = 0,
        rows_updated: int = 0,
        quality: str = "",
        error: str = "",
    ) -> None:
        """Append the closing event; what was not reached counts as 0 or empty text."""
        self._append(
            **opened,
            finished_at=datetime.now(timezone.utc),
            rows_fetched=rows_fetched,
            rows_rejected=rows_rejected,
            rows_inserted=rows_inserted,
            rows_updated=rows_updated,
            status=status,
            quality=quality,
            error=error,
            event_seq=1,
        )
