"""Read queries over a store or over plain frames."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.operators import ledger, quality, synopsis
from gridtide.operators.contract import GRID, Layout
from gridtide.plans.store import Store

MAX_DAYS = 365


def health(
    raw: DataFrame,
    runs: DataFrame,
    now: datetime,
    stale_hours: float = 48.0,
    layout: Layout = GRID,
) -> DataFrame:
    """One row: ``empty``, ``stale`` or ``ok``, the newest observation and the newest run."""
    return health_of(quality.newest_observed(raw, layout), runs, now, stale_hours)


def health_of(newest: DataFrame, runs: DataFrame, now: datetime, stale_hours: float = 48.0) -> DataFrame:
    """:func:`health` from the one row that tells the newest observation."""
    run = runs.agg(F.expr("max(struct(run_id, status, finished_at)) AS last_run"))
    lag = quality.lag_hours("last_micros", now)
    return quality.one_row([newest, run]).selectExpr(
        f"CASE WHEN last IS NULL THEN 'empty' WHEN {lag} > {float(stale_hours)}D THEN 'stale' "
        "ELSE 'ok' END AS status",
        "last AS last_observed",
        f"round({lag}, 1) AS lag_hours",
        "last_run",
    )


def daily(mart: DataFrame, days: int = 30) -> DataFrame:
    """The newest ``days`` days, oldest first."""
    if not 1 <= days <= MAX_DAYS:
        raise ValueError(f"days must be between 1 and {MAX_DAYS}")
    return mart.orderBy(F.desc("day")).limit(days).orderBy("day")


def status(
    raw: DataFrame,
    runs: DataFrame,
    now: datetime,
    layout: Layout = GRID,
) -> tuple[DataFrame, DataFrame]:
    """The summary row (row count, newest observation, lag) and the last runs."""
    counted = raw.agg(F.expr("count(1) AS raw_rows"))
    return status_of(quality.newest_observed(raw, layout), counted, runs, now)


def status_of(
    newest: DataFrame, counted: DataFrame, runs: DataFrame, now: datetime
) -> tuple[DataFrame, DataFrame]:
    """:func:`status` from the one-row frames that tell the newest observation and the number of rows."""
    summary = quality.one_row([newest, counted]).selectExpr(
        "raw_rows",
        "last AS last_observed",
        f"{quality.lag_hours('last_micros', now)} AS lag_hours",
    )
    return summary, ledger.status_lines(runs)


class Reads:
    """The read queries of one store, each a DataFrame; counts and newest keys come from the table's synopsis."""

    def __init__(self, store: Store, stale_hours: float = 48.0) -> None:
        self.store = store
        self.stale_hours = stale_hours

    def health(self, now: datetime) -> DataFrame:
        newest = synopsis.newest(self.store.table.synopsis())
        return health_of(newest, self.store.runs(), now, self.stale_hours)

    def latest(self) -> DataFrame:
        return self.store.mart("02_mart_latest")

    def daily(self, days: int = 30) -> DataFrame:
        return daily(self.store.mart("01_mart_daily"), days)

    def mix(self) -> DataFrame:
        return self.store.mart("03_mart_mix_7d")

    def runs(self, limit: int = 20) -> DataFrame:
        return ledger.runs_page(self.store.runs(), limit)

    def status(self, now: datetime) -> tuple[DataFrame, DataFrame]:
        held = self.store.table.synopsis()
        return status_of(synopsis.newest(held), synopsis.counted(held), self.store.runs(), now)
