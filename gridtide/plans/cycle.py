"""One ingestion cycle: window, fetch, contract, gate, upsert, marts, checks, ledger."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from gridtide.functions import clock, coerce
from gridtide.operators import quality
from gridtide.operators.contract import GRID, Layout, accepted, apply_contract
from gridtide.operators.incremental import Params, collect_window, compute_window
from gridtide.operators.marts import MARTS
from gridtide.operators.script import Script
from gridtide.plans.store import Store
from gridtide.plans.together import together
from gridtide.sources import landing, scratch, split
from gridtide.sources.index import LandedIndex

#: (window start, window end) -> records as (seq, record) with an optional ``problem``.
Source = Callable[[datetime, datetime], DataFrame]


@dataclass(frozen=True)
class RunOutcome:
    run_id: int
    status: str
    window_start: datetime | None
    window_end: datetime | None
    report: Row
    rows_fetched: int = 0
    rows_rejected: int = 0
    rows_inserted: int = 0
    rows_updated: int = 0
    marts: list[str] = field(default_factory=list)
    duration_seconds: float = 0.0

    SCHEMA = (
        "run_id bigint, status string, window_start timestamp, window_end timestamp, "
        "rows_fetched bigint, rows_rejected bigint, rows_inserted bigint, rows_updated bigint, "
        "marts array<string>, duration_seconds double, "
        "quality struct<status: string, checks: array<struct<name: string, passed: boolean, "
        "severity: string, detail: string>>>"
    )

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """The outcome as one nested row; ``toJSON`` or ``to_json`` renders it."""
        checks = [(c["name"], c["passed"], c["severity"], c["detail"]) for c in self.report["checks"]]
        row = (
            self.run_id, self.status, self.window_start, self.window_end,
            self.rows_fetched, self.rows_rejected, self.rows_inserted, self.rows_updated,
            self.marts, round(self.duration_seconds, 2), (self.report["status"], checks),
        )
        return spark.createDataFrame([row], self.SCHEMA)

    def to_markdown(self) -> str:
        """The run report: a header about the cycle, then the quality table."""
        start, end = (
            "-" if moment is None else f"{moment:%Y-%m-%d %H:%M}"
            for moment in (self.window_start, self.window_end)
        )
        return "\n".join(
            [
                f"# run {self.run_id}",
                "",
                f"- window: {start} -> {end} UTC",
                f"- fetched {self.rows_fetched} · rejected {self.rows_rejected} · "
                f"inserted {self.rows_inserted} · updated {self.rows_updated}",
                f"- marts rebuilt: {', '.join(self.marts) or 'none'} · {self.duration_seconds:.1f}s",
                "",
                self.report["markdown"],
                "",
            ]
        )


def _inside(records: DataFrame, start: datetime | None, end: datetime | None, layout: Layout) -> DataFrame:
    """Records whose key lies in the window, or cannot be read, which the contract then rejects."""
    if start is None or end is None:
        return records
    key = coerce.instant(f"get_json_object(record, '$.{layout.key}')")
    lower, upper = (clock.literal(bound.replace(microsecond=0), clock.INSTANT) for bound in (start, end))
    kept = f"coalesce({key} >= {lower} AND {key} < {upper}, true)"
    return records.where(f"problem IS NOT NULL OR {kept}" if "problem" in records.columns else kept)


def _dated(payloads: DataFrame, start: datetime | None, end: datetime | None, file_date: str | None) -> DataFrame:
    """Without the files whose date, the first group of ``file_date`` in their path, is days off the window."""
    if file_date is None or start is None or end is None:
        return payloads
    dated = F.try_to_date(F.regexp_extract("_metadata.file_path", file_date, 1))
    first, last = start.date() - timedelta(days=1), end.date() + timedelta(days=1)
    return payloads.where(F.coalesce(dated.between(F.lit(first), F.lit(last)), F.lit(True)))


def export_source(
    spark: SparkSession, path: str, layout: Layout = GRID, file_date: str | None = None
) -> Source:
    """The records of landed export files, each a JSON array, that lie in the window.

    ``file_date`` states a layout by date: a pattern whose first group is an ISO date in the path. Files
    dated more than a day off the window are then not read at all.
    """

    def fetch(start: datetime | None, end: datetime | None) -> DataFrame:
        files = _dated(spark.read.text(path, wholetext=True), start, end, file_date)
        return _inside(landing.explode_records(landing.triage(landing.payloads(files))), start, end, layout)

    return fetch


def indexed_source(spark: SparkSession, index: LandedIndex, layout: Layout = GRID) -> Source:
    """The records in the window of landed export files whose names tell no date: the index says which files to open."""

    def fetch(start: datetime | None, end: datetime | None) -> DataFrame:
        index.refresh()
        paths = index.landed if start is None or end is None else index.files(start, end)
        if not paths:
            return spark.createDataFrame([], "seq struct<origin: string, pos: bigint>, record string, problem string")
        files = spark.read.text(paths, wholetext=True)
        return _inside(landing.explode_records(landing.triage(landing.payloads(files))), start, end, layout)

    return fetch


def split_source(spark: SparkSession, path: str, layout: Layout = GRID) -> Source:
    """As :func:`export_source` for files too large for one task: each is read by byte ranges."""

    def fetch(start: datetime | None, end: datetime | None) -> DataFrame:
        return _inside(split.split_records(spark, path), start, end, layout)

    return fetch


def lines_source(
    spark: SparkSession, path: str, layout: Layout = GRID, file_date: str | None = None
) -> Source:
    """The records of landed JSON lines that lie in the window; ``file_date`` as for export files."""

    def fetch(start: datetime | None, end: datetime | None) -> DataFrame:
        lines = _dated(spark.read.text(path), start, end, file_date)
        return _inside(landing.records_of_lines(lines), start, end, layout)

    return fetch


def table_source(rows: DataFrame, layout: Layout = GRID) -> Source:
    """An upstream table of measurements, read by window like the export endpoint.

    Records leave as JSON text with explicit nulls and UTC offsets, in key order.
    """

    def fetch(start: datetime, end: datetime) -> DataFrame:
        kept = landing.scan_window(rows, layout.key, start, end, ordered=False)
        dtype = clock.type_of(rows, layout.key)
        stamp = clock.iso_text(clock.utc_wall(layout.key, dtype))
        columns = ", ".join(
            f"{stamp if name == layout.key else name} AS {name}" for name in rows.columns
        )
        return kept.selectExpr(
            f"{clock.micros(layout.key, dtype)} AS seq",
            f"to_json(struct({columns}), map('ignoreNullFields', 'false')) AS record",
        )

    return fetch


def load_batch(
    store: Store,
    records: DataFrame,
    opened: dict,
    now: datetime,
    params: Params,
    started: float,
    by_file: bool = False,
) -> RunOutcome:
    """From fetched records to the finished ledger entry of one opened run.

    ``by_file`` judges landed files one by one: broken ones are refused and the others loaded, and a
    batch that the gate fails is refused with all its files. Refused files are noted in the store.
    """
    stage = f"{store.base}/staging/run={opened['run_id']}"
    try:
        return _load_batch(store, records, opened, now, params, started, by_file, stage)
    finally:
        scratch.delete(store.spark, stage)


def _load_batch(
    store: Store, records: DataFrame, opened: dict, now: datetime, params: Params, started: float,
    by_file: bool, stage: str,
) -> RunOutcome:
    spark, layout = store.spark, store.layout
    keep = ("problem",) if "problem" in records.columns else ()
    coerced = apply_contract(records, layout.fields, layout.key, keep=keep, more_keys=layout.more_keys)
    # Payloads are parsed once; the gate and the load both read the written columns, and the write itself tells the gate
    # what it needs of every row.
    noted = Observation()
    asked = {"layout": layout, "tolerance_pct": params.balance_tolerance_pct, "every": "problem IS NULL" if keep else "true"}
    quality.observe_batch(coerced, noted, **asked).write.mode("overwrite").parquet(stage)
    facts = quality.observed_facts(coerced, noted, **asked)
    batch = spark.read.schema(coerced.schema).parquet(stage)
    refused, error = None, ""
    if keep:
        problem = landing.first_problem(batch)
        if problem is not None and not by_file:
            raise landing.PayloadError(problem)
        if problem is not None:
            refused = batch.where("problem IS NOT NULL").select(F.col("seq.origin").alias("origin"), "problem")
            store.note_files(refused, opened["run_id"])
            if batch.where("problem IS NULL").isEmpty():
                raise landing.PayloadError(problem)
            error = f"refused landed file(s), first: {problem}"
        batch = batch.where("problem IS NULL").drop("problem")

    checks = quality.batch_checks(batch, layout, params.balance_tolerance_pct, facts=facts)
    report = quality.report(checks).first()
    by_name = {check["name"]: check for check in report["checks"]}
    counts = {
        "rows_fetched": by_name["window_not_empty"]["counted"],
        "rows_rejected": by_name["contract_coercion"]["counted"],
    }
    built: list[str] = []
    if report["status"] != "fail":
        rows = accepted(batch).drop("seq")
        loaded_at = F.lit(datetime.now(timezone.utc))
        # The gate has shown the keys to be unique, so no row order has to be settled.
        loaded = store.table.upsert(rows.withColumn("ingested_at", loaded_at), None, staged=True)
        counts |= {"rows_inserted": loaded.inserted, "rows_updated": loaded.updated}
        after = quality.stored_checks(
            store.table.synopsis(), now, params.freshness_warn_hours, params.freshness_fail_hours
        )
        seen = spark.createDataFrame(report["checks"], quality.CHECK)
        built, final = together(
            spark,
            store.build_marts,
            lambda: quality.report(seen.unionByName(after)).first(),
        )
    else:
        final = report
    if by_file:
        origins = batch.select(F.col("seq.origin").alias("origin")).distinct()
        outcome = "quality gate failed" if report["status"] == "fail" else None
        store.note_files(origins.withColumn("problem", F.lit(outcome)), opened["run_id"])

    store.finish_run(opened, final["status"], quality=final["json"], error=error, **counts)
    return RunOutcome(
        run_id=opened["run_id"],
        status=final["status"],
        window_start=opened["window_start"],
        window_end=opened["window_end"],
        report=final,
        marts=built,
        duration_seconds=time.monotonic() - started,
        **counts,
    )


def run_cycle(
    spark: SparkSession,
    base: str,
    source: Source,
    now: datetime | None = None,
    since: datetime | None = None,
    params: Params = Params(),
    layout: Layout = GRID,
    report_path: str | None = None,
    scripts: Sequence[Script | tuple] = MARTS,
) -> RunOutcome:
    """One cycle, with every way it can end recorded in the ledger; ``scripts`` are the store's marts.

    A batch whose gate says ``fail`` is not loaded. Checks after the load can
    lower the status but take nothing back. An exception leaves ``error`` in the
    ledger and is raised again.
    """
    started = time.monotonic()
    now = now or datetime.now(timezone.utc)
    store = Store(spark, base, layout, scripts)
    store.recover()
    start, end = collect_window(compute_window(store.watermark(), now, since, params))
    opened = store.start_run(now, start, end)
    try:
        outcome = load_batch(store, source(start, end), opened, now, params, started)
    except Exception as problem:
        store.finish_run(opened, "error", error=str(problem))
        raise
    if report_path is not None:
        write_report(spark, outcome, report_path)
    return outcome


def write_report(spark: SparkSession, outcome: RunOutcome, path: str) -> None:
    """The Markdown report as a one-file text dataset on any file system."""
    text = spark.createDataFrame([(outcome.to_markdown(),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(path)
