"""Watermark and window of an incremental cycle."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.functions import clock
from gridtide.operators.contract import GRID, observed


@dataclass(frozen=True)
class Params:
    """Cycle parameters; hour counts below one are refused."""

    # The published defaults.
    bootstrap_hours: int = 72
    overlap_hours: int = 24
    horizon_hours: int = 36
    freshness_warn_hours: float = 6.0
    freshness_fail_hours: float = 48.0
    balance_tolerance_pct: float = 5.0

    def __post_init__(self) -> None:
        for field in fields(self):
            if field.name in ("bootstrap_hours", "overlap_hours", "horizon_hours"):
                value = getattr(self, field.name)
                if not isinstance(value, int) or value < 1:
                    raise ValueError(f"{field.name} must be >= 1")

    @classmethod
    def load(cls, **overrides: float | None) -> Params:
        """Defaults, then ``GRIDTIDE_<NAME>`` variables, then arguments that are not None."""
        given: dict = {}
        for field in fields(cls):
            value = overrides.pop(field.name, None)
            if value is None:
                value = os.environ.get(f"GRIDTIDE_{field.name.upper()}")
            if value is None:
                continue
            kind = type(field.default)
            try:
                given[field.name] = kind(value)
            except ValueError as problem:
                raise ValueError(f"{field.name}: {problem}") from problem
        if overrides:
            raise ValueError(f"unknown parameters: {sorted(overrides)}")
        return cls(**given)


def as_utc(moment: datetime | str) -> datetime:
    """A moment or ISO 8601 text; naive text and naive moments mean UTC."""
    value = datetime.fromisoformat(moment) if isinstance(moment, str) else moment
    return value if value.tzinfo else value.replace(tzinfo=timezone.utc)


def watermark(
    raw: DataFrame, key: str = GRID.key, consumption: str = GRID.consumption
) -> DataFrame:
    """One row: the newest observed key, null when nothing is observed."""
    return raw.agg(F.expr(f"max({key}) FILTER (WHERE {observed(consumption)}) AS watermark"))


def compute_window(
    watermark_row: DataFrame, now: datetime, since: datetime | None = None, params: Params = Params()
) -> DataFrame:
    """One row with the window's bounds in epoch microseconds, from :func:`watermark`'s row.

    Start is ``since``, else the watermark minus the overlap that late revisions
    need, else a bootstrap span; the end reaches past now for forecast rows.
    """
    hour = clock.HOUR_MICROS
    moment = clock.micros_of(now)
    override = "NULL" if since is None else f"{clock.micros_of(since)}L"
    mark = clock.micros("watermark", clock.type_of(watermark_row, "watermark"))
    return watermark_row.selectExpr(
        f"coalesce({override}, {mark} - {params.overlap_hours * hour}L, "
        f"{moment - params.bootstrap_hours * hour}L) AS window_start",
        f"{moment + params.horizon_hours * hour}L AS window_end",
    )


def collect_window(window: DataFrame) -> tuple[datetime, datetime]:
    """The two bounds on the driver, where they become literals for pruning."""
    row = window.first()
    return clock.moment_of(row["window_start"]), clock.moment_of(row["window_end"])
