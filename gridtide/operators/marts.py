"""The three marts over observed rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.functions import clock, energy
from gridtide.operators.contract import GRID, Layout, observed
from gridtide.operators.merge import BEFORE

# The labels counted as renewable, and the measures of the daily and latest marts
# with the labels each one adds up.
RENEWABLE = ("wind", "solar", "hydro", "bioenergy")
MEASURES = {
    "nuclear": ("nuclear",),
    "wind": ("wind",),
    "solar": ("solar",),
    "hydro": ("hydro",),
    "gas": ("gas",),
    "oil_coal": ("oil", "coal"),
    "bioenergy": ("bioenergy",),
}
MIX_DAYS = 7


def _power(layout: Layout, labels: tuple[str, ...]) -> str:
    return energy.total(layout.sources[label] for label in labels)


#: Sums of a local day besides its measures: everything the daily mart divides or rounds.
_SUMS = ("n", "used", "renewable", "produced", "co2", "co2_n")


def daily_state(raw: DataFrame, layout: Layout = GRID, zone: str = clock.PARIS) -> DataFrame:
    """Integer sums, counts and the peak of each local day: what :func:`daily_of` needs, and what can be added up.

    One scan, one map-side-combined aggregate.
    """
    used = layout.consumption
    measures = {name: _power(layout, labels) for name, labels in MEASURES.items()}
    renewable, produced = _power(layout, RENEWABLE), energy.total(layout.sources.values())
    return (
        raw.where(observed(used))
        .groupBy(F.expr(f"{clock.local_day(layout.key, clock.type_of(raw, layout.key), zone)} AS day"))
        .agg(
            F.expr("count(1) AS n"),
            F.expr(f"sum(CAST({used} AS bigint)) AS used"),
            F.expr(f"max({used}) AS peak"),
            *[F.expr(f"sum({power}) AS {name}") for name, power in measures.items()],
            F.expr(f"sum({renewable}) AS renewable"),
            F.expr(f"sum({produced}) AS produced"),
            F.expr(f"sum(CAST({layout.co2} AS bigint)) AS co2"),
            F.expr(f"count({layout.co2}) AS co2_n"),
        )
    )


def daily_of(state: DataFrame) -> DataFrame:
    """The daily mart from its state; sums stay integral until the single division per measure, so the result does
    not depend on how rows were spread over tasks or loads."""
    return state.selectExpr(
        "day",
        "n AS quarters_observed",
        "round(CAST(used AS double) / n) AS avg_consumption_mw",
        "peak AS peak_consumption_mw",
        f"{energy.mwh('used')} AS energy_consumed_mwh",
        *[f"{energy.mwh(name)} AS {name}_mwh" for name in MEASURES],
        f"{energy.share_pct('renewable', 'produced')} AS renewable_share_pct",
        "round(CAST(co2 AS double) / nullif(co2_n, 0), 1) AS avg_co2_g_kwh",
    )


def daily(raw: DataFrame, layout: Layout = GRID, zone: str = clock.PARIS) -> DataFrame:
    """One row per local day."""
    return daily_of(daily_state(raw, layout, zone))


LOST, GAINED = "_lost_peak", "_gained_peak"


def daily_delta(feed: DataFrame, layout: Layout = GRID, zone: str = clock.PARIS) -> DataFrame:
    """What a change feed (:func:`merge.changes`) does to the state of each local day it touches.

    Sums and counts come with their sign. A maximum cannot be taken back, so ``_gained_peak`` and ``_lost_peak`` say the
    largest value that came and that went.
    """
    sums = [*_SUMS, *MEASURES]
    after = daily_state(feed, layout, zone)
    before = daily_state(feed.where(f"{BEFORE} IS NOT NULL").select(f"{BEFORE}.*"), layout, zone)
    came = after.selectExpr("day", *[f"coalesce({s}, 0L) AS {s}" for s in sums], f"peak AS {GAINED}", f"CAST(NULL AS int) AS {LOST}")
    went = before.selectExpr("day", *[f"-coalesce({s}, 0L) AS {s}" for s in sums], f"CAST(NULL AS int) AS {GAINED}", f"peak AS {LOST}")
    return came.union(went).groupBy("day").agg(
        *[F.sum(s).alias(s) for s in sums], F.max(GAINED).alias(GAINED), F.max(LOST).alias(LOST)
    )


def daily_folded(state: DataFrame, delta: DataFrame) -> DataFrame:
    """State and delta made one, days without observed rows left out. ``peak`` is null where the largest value may
    be among those that went: it must be looked up in the rows."""
    held = state.select("day", F.struct(*[c for c in state.columns if c != "day"]).alias("_held"))
    both = held.join(delta, "day", "full_outer")
    sums = [*_SUMS, *MEASURES]
    most = f"greatest(_held.peak, {GAINED})"
    return both.selectExpr(
        "day", *[f"coalesce(_held.{s}, 0L) + coalesce({s}, 0L) AS {s}" for s in sums],
        f"CASE WHEN {LOST} IS NULL OR {LOST} < {most} THEN {most} END AS peak",
    ).where("n > 0").select("day", "n", "used", "peak", *MEASURES, *_SUMS[2:])


def latest(raw: DataFrame, layout: Layout = GRID) -> DataFrame:
    """The most recent observed row with derived totals; planned as a top-1, not a sort."""
    last = raw.where(observed(layout.consumption)).orderBy(F.desc(layout.key)).limit(1)
    pumped, exchanged = layout.flows[:2]
    renewable, produced = _power(layout, RENEWABLE), energy.total(layout.sources.values())
    return last.selectExpr(
        layout.key,
        f"{layout.consumption} AS consumption_mw",
        f"{layout.co2} AS co2_g_kwh",
        *[f"{_power(layout, labels)} AS {name}_mw" for name, labels in MEASURES.items()],
        f"coalesce({pumped}, 0) AS pumped_storage_mw",
        f"coalesce({exchanged}, 0) AS net_exchange_mw",
        f"{produced} AS production_total_mw",
        f"{energy.share_pct(renewable, produced)} AS renewable_share_pct",
    )


def last_days(raw: DataFrame, layout: Layout = GRID, days: int = MIX_DAYS) -> DataFrame:
    """Observed rows of the last ``days`` times 24 hours back from the newest one, inclusive.

    The bound is a one-row scalar subquery. Stored tables pass a pruned ``raw``
    (see ``plans.store``), because a subquery cannot prune partitions.
    """
    kept = raw.where(observed(layout.consumption))
    dtype = clock.type_of(raw, layout.key)
    span = days * 24 * clock.HOUR_MICROS
    bound = clock.from_micros(f"{clock.micros(f'max({layout.key})', dtype)} - {span}L", dtype)
    return kept.where(F.col(layout.key) >= kept.agg(F.expr(f"{bound} AS bound")).scalar())


def _source_sums(rows: DataFrame, layout: Layout) -> DataFrame:
    return rows.agg(
        *[F.expr(f"sum(coalesce({column}, 0)) AS {name}") for name, column in layout.sources.items()]
    )


def mix_long(rows: DataFrame, layout: Layout = GRID) -> DataFrame:
    """Wide sums turned long: one scan and at most eight rows reach the unpivot."""
    long = _source_sums(rows, layout).unpivot([], list(layout.sources), "source", "mw")
    return long.where("mw IS NOT NULL")


def mix_7d(raw: DataFrame, layout: Layout = GRID) -> DataFrame:
    """Energy and share per source over the last seven days.

    The grand total is taken from the one wide row before it turns long, so no
    un-partitioned window is needed.
    """
    labels = list(layout.sources)
    sums = _source_sums(last_days(raw, layout), layout)
    wide = sums.selectExpr("*", f"{' + '.join(labels)} AS total")
    return (
        wide.unpivot("total", labels, "source", "mw")
        .where("mw IS NOT NULL")
        .selectExpr(
            "source", f"{energy.mwh('mw')} AS mwh", f"{energy.share_pct('mw', 'total')} AS share_pct"
        )
    )


#: Published mart names, in build order.
MARTS: tuple[tuple[str, Callable[[DataFrame, Layout], DataFrame]], ...] = (
    ("01_mart_daily", daily),
    ("02_mart_latest", latest),
    ("03_mart_mix_7d", mix_7d),
)


def in_order(name: str, mart: DataFrame) -> DataFrame:
    """A mart in the order its readers rely on, ties broken by source; files keep none."""
    if name == "01_mart_daily":
        return mart.orderBy("day")
    if name == "03_mart_mix_7d":
        return mart.orderBy(F.desc("mwh"), "source")
    return mart
