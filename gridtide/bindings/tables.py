"""Measurement tables derived from the benchmark tables, by Spark, from all of their rows."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.functions import clock
from gridtide.operators.contract import GRID, Field, Layout
from gridtide.operators.ledger import RUNS

QUARTER_MICROS = 900_000_000


def at(*parts: int) -> datetime:
    return datetime(*parts, tzinfo=timezone.utc)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stamp_sql(wall: str) -> str:
    """A wall clock as text with all six fraction digits, the same on every engine."""
    plain = f"CAST({wall} AS string)"
    return f"rpad(if(length({plain}) = 19, concat({plain}, '.'), {plain}), 26, '0')"


def stamp(wall: str) -> Column:
    return F.expr(stamp_sql(wall))


def _whole(columns: dict[str, str]) -> list[str]:
    """All 39 contract columns; those without a rule are null."""
    kinds = {"timestamp": "timestamp_ntz", "integer": "int", "text": "string"}
    return [
        f"CAST({columns.get(f.name, 'NULL')} AS {kinds[f.kind]}) AS {f.name}" for f in GRID.fields
    ]


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarter-hour rows in contract form out of ``events``: one map-side-combined aggregate.

    A source's power is the largest event value of its kind in the quarter-hour, so
    values stay in range however many events there are. About a tenth of the rows
    are forecasts, solar is null where nothing was bought, and consumption misses
    supply by -6 to +6 percent.
    """
    events = table(spark, sf_dir, "events").selectExpr(
        f"{clock.micros('ts', clock.WALL)} AS us",
        "user_id",
        "event_type",
        "CAST(round(value * 100) AS bigint) AS mw",
    )
    largest = {
        "view": "event_type = 'view'",
        "click": "event_type = 'click'",
        "purchase": "event_type = 'purchase'",
        "signup0": "event_type = 'signup' AND user_id % 2 = 0",
        "signup1": "event_type = 'signup' AND user_id % 2 = 1",
        "error0": "event_type = 'error' AND user_id % 3 = 0",
        "error1": "event_type = 'error' AND user_id % 3 = 1",
        "error2": "event_type = 'error' AND user_id % 3 = 2",
    }
    slots = events.groupBy(F.expr(f"us div {QUARTER_MICROS} AS slot")).agg(
        F.expr("count(1) AS n"),
        F.expr("sum(user_id) AS u"),
        *[F.expr(f"max(mw) FILTER (WHERE {rule}) AS {name}") for name, rule in largest.items()],
    )
    parts = {
        "nucleaire": "coalesce(view, 0)",
        "eolien": "coalesce(click, 0)",
        "solaire": "purchase",
        "hydraulique": "coalesce(signup0, 0)",
        "bioenergies": "coalesce(signup1, 0)",
        "gaz": "coalesce(error0, 0)",
        "fioul": "coalesce(error1, 0)",
        "charbon": "coalesce(error2, 0)",
        "pompage": "-(u % 500)",
        "ech_physiques": "(u % 7 - 3) * 100",
        "stockage_batterie": "-(n % 4)",
        "destockage_batterie": "n % 3",
    }
    supply = " + ".join(f"coalesce({rule}, 0)" for rule in parts.values())
    rules = parts | {
        "date_heure": "date_heure",
        "perimetre": "'France'",
        "nature": "CASE WHEN u % 10 <> 0 THEN 'measured' ELSE 'forecast' END",
        "consommation": "CASE WHEN u % 10 <> 0 THEN (supply * (94 + u % 13)) div 100 END",
        "prevision_j": "supply + u % 100",
        "taux_co2": "CASE WHEN n % 5 <> 0 THEN u % 60 END",
    }
    wall = clock.wall_from_micros(f"slot * {QUARTER_MICROS}")
    timed = slots.selectExpr("*", f"{wall} AS date_heure", f"{supply} AS supply")
    # Generated columns keep later filters from being inferred through all these rules, which
    # would cost the optimizer more than the query.
    return timed.select(F.inline(F.array(F.struct(*[F.expr(rule) for rule in _whole(rules)]))))


def event_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row in contract form for every event, told apart by its moment and, in prevision_j1, its id.

    A tenth of the rows are forecasts; each event's value counts for the source of its kind.
    """
    events = table(spark, sf_dir, "events").selectExpr(
        "ts", "event_id", "user_id", "event_type", "CAST(round(value * 100) AS int) AS mw"
    )
    kinds = {"view": "nucleaire", "click": "eolien", "purchase": "solaire", "signup": "hydraulique", "error": "gaz"}
    rules = {column: f"CASE WHEN event_type = '{kind}' THEN mw ELSE 0 END" for kind, column in kinds.items()}
    rules |= {
        "date_heure": "ts",
        "prevision_j1": "event_id",
        "nature": "CASE WHEN user_id % 10 <> 0 THEN 'measured' ELSE 'forecast' END",
        "consommation": "CASE WHEN user_id % 10 <> 0 THEN mw + event_id % 7 END",
        "taux_co2": "CASE WHEN event_id % 5 <> 0 THEN user_id % 60 END",
    }
    return events.select(F.inline(F.array(F.struct(*[F.expr(rule) for rule in _whole(rules)]))))


#: The feed's layout for rows that a moment alone does not tell apart.
EVENT_GRID = replace(GRID, more_keys=("prevision_j1",))


def batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid as a contract batch: arrival number and a reject on every 32nd quarter-hour."""
    rows = grid(spark, sf_dir).selectExpr("*", f"{clock.micros('date_heure', clock.WALL)} AS seq")
    return rows.selectExpr(
        "*", f"CASE WHEN seq div {QUARTER_MICROS} % 32 = 0 THEN concat(seq, ': refused') END AS reject"
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One measured row per order, over six years and both clock offsets."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS k",
        "timestampadd(MINUTE, CAST(o_orderkey % 96 AS int) * 15, o_orderdate) AS date_heure",
        "CAST(round(o_totalprice) AS bigint) AS p",
    )
    rules = {
        "date_heure": "date_heure",
        "consommation": "CASE WHEN k % 10 <> 0 THEN p END",
        "nucleaire": "p div 2",
        "eolien": "CASE WHEN k % 3 = 0 THEN p div 5 END",
        "solaire": "CASE WHEN k % 4 = 0 THEN p div 7 END",
        "hydraulique": "p div 9",
        "gaz": "p div 11",
        "fioul": "p % 100",
        "charbon": "p % 50",
        "bioenergies": "CASE WHEN k % 5 = 0 THEN p div 13 END",
        "taux_co2": "CASE WHEN k % 6 <> 0 THEN k % 90 END",
    }
    return orders.selectExpr(*_whole(rules))


#: A small contract over event records: one required number, one optional text.
EVENT_FIELDS = (
    Field("ts", "timestamp", required=True),
    Field("k", "integer", required=True, lo=10, hi=90),
    Field("note", "text"),
)


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event records as JSON text, one in five of them spoilt by ``event_id``."""
    events = table(spark, sf_dir, "events")
    wall = f"replace({stamp_sql('ts')}, ' ', 'T')"
    k = "get_json_object(props, '$.k')"
    rest = f"""CASE event_id % 20
        WHEN 0 THEN ''
        WHEN 1 THEN ',"k":null'
        WHEN 2 THEN ',"k":"a lot"'
        WHEN 3 THEN concat(',"k":"', {k}, '.5"')
        WHEN 4 THEN concat(',"k":', {k}, '.5,"zzz":1,"note":"half"')
        WHEN 5 THEN concat(',"k":"-', {k}, '"')
        ELSE concat(',"k":', {k}, ',"note":"', event_type, '"') END"""
    zone = "CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN '+02:00' ELSE 'Z' END"
    return events.selectExpr(
        "event_id AS seq", f"concat('{{\"ts\":\"', {wall}, {zone}, '\"', {rest}, '}}') AS record"
    )


def runs_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger events out of ``conversations``: a run per conversation, an event per turn."""
    rules = {
        "run_id": "conv_id",
        "started_at": "timestamp_seconds(1704067200 + conv_id * 60)",
        "finished_at": "timestamp_seconds(1704067200 + conv_id * 60 + turn)",
        "rows_fetched": "length(text)",
        "rows_inserted": "CASE WHEN turn % 2 = 0 THEN length(text) % 100 END",
        "status": "role",
        "error": "CASE WHEN turn % 3 <> 0 THEN text END",
    }
    columns = [
        f"CAST({rules.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in RUNS
    ]
    return table(spark, sf_dir, "conversations").selectExpr(*columns, "turn AS event_seq")


#: Layout in which every event counts as an observed row.
EVENTS_LAYOUT = Layout(
    fields=(), key="ts", consumption="value", sources={}, flows=(), co2="value"
)
