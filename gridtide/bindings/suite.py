"""The registered queries: each runs a real operator over a whole table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from gridtide.bindings.tables import (
    EVENT_FIELDS,
    EVENT_GRID,
    EVENTS_LAYOUT,
    at,
    batch,
    event_grid,
    event_records,
    grid,
    readings,
    runs_from,
    stamp,
    stamp_sql,
    table,
)
from gridtide.functions import clock, coerce
from gridtide.operators import incremental, ledger, marts, merge, quality, synopsis
from gridtide.operators.contract import GRID, Field, accepted, apply_contract, observed, rejected
from gridtide.operators.script import Script
from gridtide.plans import cycle, reads
from gridtide.plans.store import Store
from gridtide.sources import landing, scratch, split
from gridtide.sources.index import LandedIndex
from gridtide.sources.log import FoldedLog
from gridtide.sources.table import KeyedTable
from gridtide.streaming import follow

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CHECK_COLUMNS = ["name", "passed", "severity", "detail", "counted", "total", "measure"]


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("date_heure", stamp("date_heure"))


def _check(rows: DataFrame) -> DataFrame:
    return rows.select(*CHECK_COLUMNS)


# -- scans and payloads ------------------------------------------------------------------


@query
def scan_window(spark, sf_dir):
    kept = landing.scan_window(
        table(spark, sf_dir, "events"), "ts", at(2024, 1, 10), at(2024, 1, 11, 0, 0, 0, 900_000)
    )
    return kept.select("event_id", stamp("ts").alias("ts"), "event_type", "value")


def _payloads(spark, sf_dir):
    rule = """CASE event_id % 20
        WHEN 0 THEN concat('[', props, ',', props, ']')
        WHEN 1 THEN '{"error_code":"E1","message":"upstream down"}'
        WHEN 2 THEN '{"error_code":"E2"}'
        WHEN 3 THEN '{"other":1}'
        WHEN 4 THEN '"text"'
        WHEN 5 THEN '<html>gateway</html>'
        WHEN 6 THEN concat('[', props, ',')
        WHEN 7 THEN '[]'
        ELSE concat('[', props, ']') END"""
    return table(spark, sf_dir, "events").selectExpr("event_id AS origin", f"{rule} AS payload")


@query
def payload_triage(spark, sf_dir):
    triaged = landing.triage(_payloads(spark, sf_dir))
    return triaged.select("origin", "problem", F.size("elements").alias("records")).fillna(
        {"records": -1}
    )


@query
def payload_records(spark, sf_dir):
    records = landing.explode_records(landing.triage(_payloads(spark, sf_dir)))
    return records.select(
        F.col("seq.origin").alias("origin"),
        F.col("seq.pos").alias("pos"),
        F.get_json_object("record", "$.k").cast("int").alias("k"),
        "problem",
    )


@query
def payload_split(spark, sf_dir):
    """All events as one export file, a single JSON array, read by byte ranges."""
    folder = scratch.fresh_dir(spark, "array")
    # Notes hold brackets, quotes and backslashes, which are text and no structure.
    rule = r"""to_json(named_struct('id', event_id, 'note', concat('[', event_type, '} "', event_id, '\\'),
        'props', from_json(props, 'k int'))) AS record"""
    records = table(spark, sf_dir, "events").selectExpr("event_id", rule)
    # The k-th record opens the array or follows a comma; one task writes the one file, in order.
    first = records.agg(F.min("event_id")).first()[0]
    lines = records.select("event_id", F.concat(F.when(F.col("event_id") == first, "[").otherwise(","), "record").alias("value"))
    end = spark.createDataFrame([(None, "]")], "event_id bigint, value string")
    lines.union(end).orderBy(F.col("event_id").asc_nulls_last()).select("value").coalesce(1).write.text(folder)
    found = split.split_records(spark, folder)
    return found.select(
        F.get_json_object("record", "$.id").cast("bigint").alias("event_id"),
        F.col("seq.pos").alias("pos"), F.get_json_object("record", "$.note").alias("note"),
        F.get_json_object("record", "$.props.k").cast("int").alias("k"), "problem",
    )


@query
def count_raw(spark, sf_dir):
    return grid(spark, sf_dir).agg(F.count(F.lit(1)).alias("raw_rows"))


@query
def adhoc_sql(spark, sf_dir):
    text = """SELECT nature, count(*) AS quarters, sum(CAST(nucleaire AS bigint)) AS nuclear,
                (SELECT count(*) FROM {mart_daily}) AS days, (SELECT count(*) FROM {runs}) AS runs
              FROM {raw} WHERE nucleaire >= :floor GROUP BY nature"""
    base, _, _ = _two_runs(spark, sf_dir)
    return Store(spark, base).sql(text, args={"floor": 500})


# -- contract ------------------------------------------------------------------------------


def _contract(spark, sf_dir):
    return apply_contract(event_records(spark, sf_dir), EVENT_FIELDS, key="ts")


@query
def contract_null_key(spark, sf_dir):
    """Records whose key is absent, null, empty or spoilt, and why each is refused."""
    rule = """CASE event_id % 5 WHEN 0 THEN concat('{"k":', event_id, '}') WHEN 1 THEN concat('{"ts":null,"k":', event_id, '}')
        WHEN 2 THEN concat('{"ts":"","k":', event_id, '}') WHEN 3 THEN concat('{"ts":"soon","k":', event_id, '}')
        ELSE concat('{"ts":"2024-01-01T00:00:00Z","k":null}') END AS record"""
    records = table(spark, sf_dir, "events").selectExpr("event_id AS seq", rule)
    fields = (Field("ts", "timestamp"), Field("k", "integer"))
    return rejected(apply_contract(records, fields, key="ts", more_keys=("k",)))


@query
def contract_project(spark, sf_dir):
    rows = accepted(_contract(spark, sf_dir))
    wall = clock.utc_wall("ts", clock.INSTANT)
    return rows.select("seq", stamp(wall).alias("ts"), "k", "note")


@query
def contract_rejects(spark, sf_dir):
    return rejected(_contract(spark, sf_dir))


@query
def coerce_integer(spark, sf_dir):
    raw = """CASE event_id % 12
        WHEN 0 THEN 'a lot' WHEN 1 THEN NULL WHEN 2 THEN 'NaN' WHEN 3 THEN concat(event_id, '.5')
        WHEN 4 THEN concat('-', event_id, '.5') WHEN 5 THEN concat(' ', event_id, ' ')
        WHEN 6 THEN concat(event_id, 'e3') WHEN 7 THEN '' WHEN 8 THEN concat(event_id, '000000000')
        WHEN 9 THEN 'Infinity' ELSE CAST(event_id AS string) END"""
    rows = table(spark, sf_dir, "events").selectExpr("event_id", f"{raw} AS raw")
    return rows.selectExpr("event_id", f"{coerce.integer('raw')} AS value")


@query
def coerce_timestamp(spark, sf_dir):
    wall = f"replace({stamp_sql('ts')}, ' ', 'T')"
    raw = f"""CASE event_id % 8
        WHEN 0 THEN concat({wall}, 'Z') WHEN 1 THEN concat({wall}, '+02:00') WHEN 2 THEN {wall}
        WHEN 3 THEN 'yesterday' WHEN 4 THEN NULL WHEN 5 THEN concat({wall}, '-05:30')
        WHEN 6 THEN concat(substring({wall}, 12), 'Z') ELSE concat({wall}, '+00:00') END"""
    rows = table(spark, sf_dir, "events").selectExpr("event_id", f"{raw} AS raw")
    return rows.selectExpr("event_id", f"unix_micros({coerce.instant('raw')}) AS micros")


@query
def filter_observed(spark, sf_dir):
    return _keyed(grid(spark, sf_dir).where(observed()).select("date_heure", "consommation"))


@query
def forecast_rows(spark, sf_dir):
    return _keyed(grid(spark, sf_dir).where(f"NOT ({observed()})").select("date_heure", "prevision_j"))


# -- quality gate ------------------------------------------------------------------------------


@query
def check_coercion(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.expr("CASE WHEN event_id % 20 = 7 THEN concat('event ', event_id) END").alias("reject"),
    )
    return _check(quality.check_coercion(rows))


@query
def check_window_not_empty(spark, sf_dir):
    return _check(quality.check_window_not_empty(table(spark, sf_dir, "events")))


@query
def check_primary_key(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return _check(quality.check_primary_key(lines, ["l_orderkey", "l_linenumber"]))


@query
def duplicate_keys(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return quality.duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


@query
def check_alignment(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn(
        "ts", F.expr("CASE WHEN event_id % 20 = 0 THEN date_trunc('HOUR', ts) ELSE ts END")
        .cast("timestamp_ntz")
    )
    return _check(quality.check_alignment(rows, "ts", "event_id"))


LINE_FIELDS = [
    Field("l_quantity", "integer", lo=5, hi=45),
    Field("l_linenumber", "integer", lo=2, hi=6),
]


@query
def range_violations(spark, sf_dir):
    return quality.range_violations(table(spark, sf_dir, "lineitem"), LINE_FIELDS)


@query
def check_ranges(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("v", F.expr("CAST(round(value) AS bigint)"))
    fields = [Field("v", "integer", lo=1, hi=200), Field("user_id", "integer", lo=1, hi=140)]
    return _check(quality.check_ranges(rows, fields, "ts", "event_id"))


@query
def check_balance(spark, sf_dir):
    return _check(quality.check_balance(grid(spark, sf_dir)))


@query
def balance_rows(spark, sf_dir):
    return _keyed(quality.balance_rows(grid(spark, sf_dir)))


@query
def balance_large(spark, sf_dir):
    """Parts that each fill 32 bits: their sum needs more."""
    large = {name: F.expr(f"CAST(2147483000 + {name} % 500 AS int)") for name in ("nucleaire", "gaz", "eolien")}
    return _keyed(quality.balance_rows(grid(spark, sf_dir).withColumns(large)))


@query
def check_freshness(spark, sf_dir):
    raw = table(spark, sf_dir, "events")
    return _check(quality.check_freshness(raw, at(2024, 1, 31, 12), layout=EVENTS_LAYOUT))


@query
def check_completeness(spark, sf_dir):
    return _check(quality.check_completeness(grid(spark, sf_dir)))


@query
def quality_batch(spark, sf_dir):
    """As a cycle does it: the write of the batch observes the facts, and only keys and examples are read from it."""
    rows, noted = batch(spark, sf_dir), Observation()
    folder = scratch.fresh_dir(spark, "batch")
    quality.observe_batch(rows, noted).write.parquet(folder)
    facts = quality.observed_facts(rows, noted)
    return _check(quality.batch_checks(spark.read.schema(rows.schema).parquet(folder), facts=facts))


@query
def quality_warehouse(spark, sf_dir):
    return _check(quality.warehouse_checks(grid(spark, sf_dir), at(2024, 2, 3)))


@query
def report_status(spark, sf_dir):
    return quality.status(quality.batch_checks(batch(spark, sf_dir)))


@query
def report_failures(spark, sf_dir):
    return quality.failures(quality.batch_checks(batch(spark, sf_dir))).select("name", "severity")


@query
def report_markdown(spark, sf_dir):
    return quality.markdown(quality.warehouse_checks(grid(spark, sf_dir), at(2024, 2, 3)))


@query
def report_json(spark, sf_dir):
    return quality.json(quality.warehouse_checks(grid(spark, sf_dir), at(2024, 2, 3)))


@query
def gate_blocks(spark, sf_dir):
    """Rows that cycles let through: all of a clean batch, none of one with every key twice."""
    _, clean, _ = _two_runs(spark, sf_dir)
    base = scratch.fresh_dir(spark, "blocked")
    rows = grid(spark, sf_dir)
    twice = cycle.run_cycle(
        spark, base, cycle.table_source(rows.union(rows)), now=at(2024, 1, 20), since=at(2024, 1, 1)
    )
    blocked = Store(spark, base).raw().count()
    loads = [("clean", clean.rows_fetched, clean.rows_inserted), ("doubled", twice.rows_fetched, blocked)]
    return spark.createDataFrame(loads, "batch string, fetched bigint, loaded bigint")


# -- marts -----------------------------------------------------------------------------------------


def _daily(rows):
    return rows.withColumn("day", F.col("day").cast("string")).withColumn(
        "peak_consumption_mw", F.col("peak_consumption_mw").cast("bigint")
    )


@query
def mart_daily(spark, sf_dir):
    return _daily(marts.daily(grid(spark, sf_dir)))


@query
def mart_daily_dst(spark, sf_dir):
    return _daily(marts.daily(readings(spark, sf_dir)))


@query
def mart_latest(spark, sf_dir):
    return _keyed(marts.latest(grid(spark, sf_dir)))


@query
def mart_mix_7d(spark, sf_dir):
    return marts.mix_7d(grid(spark, sf_dir))


@query
def mix_long(spark, sf_dir):
    return marts.mix_long(readings(spark, sf_dir))


@query
def last_days(spark, sf_dir):
    return _keyed(marts.last_days(readings(spark, sf_dir)).select("date_heure", "nucleaire"))


# -- incremental logic and the keyed table --------------------------------------------------------------


@query
def watermark(spark, sf_dir):
    return incremental.watermark(grid(spark, sf_dir)).select(stamp("watermark").alias("watermark"))


@query
def compute_window(spark, sf_dir):
    rows = grid(spark, sf_dir)
    mark = incremental.watermark(rows)
    none = incremental.watermark(rows.where(f"NOT ({observed()})"))
    now, since = at(2024, 2, 1), at(2023, 12, 1)
    shapes = {
        "watermark": incremental.compute_window(mark, now),
        "bootstrap": incremental.compute_window(none, now),
        "since": incremental.compute_window(mark, now, since),
    }
    named = [w.select(F.lit(name).alias("shape"), "*") for name, w in shapes.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


EVENT_KEYS = ["ts", "event_id"]


def _base_events(spark, sf_dir):
    return table(spark, sf_dir, "events").where("ts < timestamp_ntz'2024-01-20 00:00:00'")


def _revisions(spark, sf_dir):
    """Everything after the base and late revisions of its last day; errors come twice."""
    events = table(spark, sf_dir, "events").where("ts >= timestamp_ntz'2024-01-19 00:00:00'")
    once = "named_struct('value', value + 1, 'event_type', event_type, 'seq', 1)"
    again = "named_struct('value', value + 2, 'event_type', CAST(NULL AS string), 'seq', 2)"
    copies = f"inline(CASE WHEN event_type = 'error' THEN array({once}, {again}) ELSE array({once}) END)"
    return events.selectExpr("event_id", "ts", "user_id", "props", copies)


def _events_out(rows):
    return rows.select("event_id", stamp("ts").alias("ts"), "user_id", "event_type", "value")


@query
def upsert_merge(spark, sf_dir):
    return _events_out(
        merge.upsert(_base_events(spark, sf_dir), _revisions(spark, sf_dir), EVENT_KEYS)
    )


@query
def upsert_counts(spark, sf_dir):
    return merge.upsert_counts(_base_events(spark, sf_dir), _revisions(spark, sf_dir), EVENT_KEYS)


def _event_table(spark, sf_dir, label):
    schema = table(spark, sf_dir, "events").schema
    return KeyedTable(spark, f"{scratch.fresh_dir(spark, label)}/events", EVENT_KEYS, "ts", schema)


@query
def upsert_idempotent(spark, sf_dir):
    """The stored table after a base load and the same batch twice."""
    stored = _event_table(spark, sf_dir, "upsert")
    stored.upsert(_base_events(spark, sf_dir), None)
    for _ in range(2):
        stored.upsert(_revisions(spark, sf_dir))
    return _events_out(stored.read())


@query
def upsert_table_counts(spark, sf_dir):
    """What the stored table reports for a base load, a batch and the batch again."""
    stored = _event_table(spark, sf_dir, "counts")
    loads = [stored.upsert(_base_events(spark, sf_dir), None)]
    loads += [stored.upsert(_revisions(spark, sf_dir)) for _ in range(2)]
    rows = [(n, load.inserted, load.updated, len(load.days)) for n, load in enumerate(loads)]
    return spark.createDataFrame(rows, "load int, inserted bigint, updated bigint, days int")


@query
def stream_upsert(spark, sf_dir):
    """Two landings, the second revising part of the first, followed by a stream."""
    folder = scratch.fresh_dir(spark, "stream")
    stored = KeyedTable(
        spark, f"{folder}/events", EVENT_KEYS, "ts", table(spark, sf_dir, "events").schema
    )
    for wave in (_base_events(spark, sf_dir).withColumn("seq", F.lit(0)), _revisions(spark, sf_dir)):
        wave.write.mode("append").parquet(f"{folder}/landed")
        stream = spark.readStream.schema(wave.schema).parquet(f"{folder}/landed")
        follow.stream_upsert(stream, stored, f"{folder}/checkpoint")
    return _events_out(stored.read())


def _nulled(spark, sf_dir):
    """Revisions that also take values away: an error's second copy has none."""
    return _revisions(spark, sf_dir).withColumn("value", F.expr("CASE WHEN seq = 1 THEN value END"))


@query
def upsert_changes(spark, sf_dir):
    """The change of every row that a batch makes, with the value before and after."""
    feed = merge.changes(_base_events(spark, sf_dir), _revisions(spark, sf_dir), EVENT_KEYS)
    return feed.select(
        "event_id", F.col(merge.CHANGE).alias("change"), F.col(merge.COPIES).alias("copies"),
        F.col(f"{merge.BEFORE}.value").alias("value_before"), "value",
    )


@query
def change_feed(spark, sf_dir):
    """What a stored table tells of two loads after a base load: only rows that changed, by load."""
    stored = _event_table(spark, sf_dir, "feed")
    stored.upsert(_base_events(spark, sf_dir), None)
    since = stored.published.version().number
    stored.upsert(_revisions(spark, sf_dir))
    stored.upsert(_nulled(spark, sf_dir))
    feed = stored.changes_since(since)
    return feed.select(
        (F.col("_load") - since).alias("load"), "event_id", F.col(merge.CHANGE).alias("change"),
        F.col(f"{merge.BEFORE}.value").alias("value_before"), "value",
    )


@query
def read_beside_publish(spark, sf_dir):
    """A read planned before a load and run after it: the rows of its own time."""
    stored = _event_table(spark, sf_dir, "beside")
    stored.upsert(_base_events(spark, sf_dir), None)
    planned = stored.read()
    stored.upsert(_revisions(spark, sf_dir))
    stored.recover()
    return _events_out(planned)


@query
def synopsis_reads(spark, sf_dir):
    """Rows, newest observed moment and observed rows of each local day of a stored table after revisions that null
    values out, from the synopsis its loads kept."""
    events = table(spark, sf_dir, "events").schema
    folder = scratch.fresh_dir(spark, "synopsis")
    stored = KeyedTable(spark, f"{folder}/events", EVENT_KEYS, "ts", events, "value IS NOT NULL")
    stored.upsert(_base_events(spark, sf_dir), None)
    stored.upsert(_nulled(spark, sf_dir))
    held = stored.synopsis()
    facts = [
        synopsis.counted(held).selectExpr("'rows' AS fact", "raw_rows AS n"),
        synopsis.newest(held).selectExpr("'newest' AS fact", "last_micros AS n"),
        synopsis.observed_days(held).selectExpr("CAST(day AS string) AS fact", "quarters AS n"),
    ]
    return facts[0].unionByName(facts[1]).unionByName(facts[2])


# -- whole cycles -----------------------------------------------------------------------------------------


def _two_runs(spark, sf_dir):
    """A backfill, then an incremental run over revised rows, in a store of their own."""
    base = scratch.fresh_dir(spark, "runs")
    rows = grid(spark, sf_dir)
    revised = rows.withColumn("consommation", F.expr("consommation + 1"))
    first = cycle.run_cycle(
        spark, base, cycle.table_source(rows), now=at(2024, 1, 20), since=at(2024, 1, 1)
    )
    second = cycle.run_cycle(spark, base, cycle.table_source(revised), now=at(2024, 1, 31))
    return base, first, second


@query
def run_cycle(spark, sf_dir):
    """The outcome of one backfill cycle over the whole grid."""
    outcome = cycle.run_cycle(
        spark,
        scratch.fresh_dir(spark, "cycle"),
        cycle.table_source(grid(spark, sf_dir)),
        now=at(2024, 1, 31),
        since=at(2024, 1, 1),
    )
    return outcome.to_frame(spark).select(
        "run_id", "status", "rows_fetched", "rows_rejected", "rows_inserted", "rows_updated",
        F.array_join("marts", ",").alias("marts"), F.size("quality.checks").alias("checks"),
    )


@query
def incremental_two_runs(spark, sf_dir):
    base, _, _ = _two_runs(spark, sf_dir)
    return _keyed(Store(spark, base).raw().select(
        F.expr(clock.utc_wall("date_heure", clock.INSTANT)).alias("date_heure"),
        "consommation", "nucleaire",
    ))


@query
def incremental_outcomes(spark, sf_dir):
    """The ledger and marts after both runs: counts per run, and the incrementally kept mart."""
    base, _, _ = _two_runs(spark, sf_dir)
    runs = Store(spark, base).runs()
    return runs.select(
        "run_id", "status", "rows_fetched", "rows_rejected", "rows_inserted", "rows_updated",
        F.unix_micros("window_start").alias("window_start"),
        F.unix_micros("window_end").alias("window_end"),
    )


@query
def mart_daily_incremental(spark, sf_dir):
    """The stored daily mart after two runs, the second of which rebuilt touched months only."""
    base, _, _ = _two_runs(spark, sf_dir)
    return _daily(Store(spark, base).mart("01_mart_daily"))


@query
def mart_daily_recovered(spark, sf_dir):
    """The stored daily mart when loads lacked their marts: one published by a driver that was lost, one
    followed by an empty batch, and cycles elsewhere in time after them."""
    base = scratch.fresh_dir(spark, "recovered")
    store = Store(spark, base)
    rows = grid(spark, sf_dir)
    instant = F.expr(clock.from_micros(clock.micros("date_heure", clock.WALL), clock.INSTANT))
    early = rows.where("date_heure < timestamp_ntz'2024-01-08 00:00:00'").withColumn("date_heure", instant)
    bare = early.withColumn("ingested_at", F.lit(None).cast("timestamp"))
    store.table.upsert(bare.where("nature = 'measured'"), None)
    cycle.run_cycle(spark, base, cycle.table_source(rows), now=at(2024, 1, 20), since=at(2024, 1, 12))
    store.table.upsert(bare, None)
    cycle.run_cycle(spark, base, cycle.table_source(rows), now=at(2025, 1, 20), since=at(2025, 1, 19))
    return _daily(store.mart("01_mart_daily"))


def _instants(rows):
    """Rows as a store keeps them."""
    instant = clock.from_micros(clock.micros("date_heure", clock.WALL), clock.INSTANT)
    return rows.withColumn("date_heure", F.expr(instant)).withColumn("ingested_at", F.lit(None).cast("timestamp"))


@query
def mart_daily_delta(spark, sf_dir):
    """The daily mart over all events, built once and then kept from the change feed of two loads: revisions that
    lower the largest values and take some away, and new events."""
    store = Store(spark, scratch.fresh_dir(spark, "delta"), EVENT_GRID)
    rows = _instants(event_grid(spark, sf_dir))
    early = F.col("date_heure") < F.lit("2024-01-20 00:00:00+00:00").cast("timestamp")
    store.table.upsert(rows.where(early), None)
    store.build_marts()
    lower = "CASE WHEN prevision_j1 % 11 <> 0 AND consommation < 40000 THEN consommation + 1 WHEN prevision_j1 % 11 <> 0 THEN 1 END"
    store.table.upsert(rows.where(early & F.expr("prevision_j1 % 3 = 0")).withColumn("consommation", F.expr(lower)), None)
    store.table.upsert(rows.where(~early), None)
    store.build_marts()
    return _daily(store.mart("01_mart_daily"))


def _monthly(rows, layout, built):
    """Whole months of the daily mart."""
    return built["01_mart_daily"].groupBy(F.date_format("day", "yyyy-MM").alias("of_month")).agg(
        F.sum("quarters_observed").alias("quarters"), F.max("peak_consumption_mw").cast("bigint").alias("peak"),
        F.sum("energy_consumed_mwh").alias("energy"),
    )


def _ranked(rows, layout, built):
    """The days of a month that reach its peak, from two marts."""
    days = built["01_mart_daily"].withColumn("of_month", F.date_format("day", "yyyy-MM"))
    top = days.join(built["04_mart_monthly"], "of_month").where("peak_consumption_mw = peak")
    return top.select("of_month", F.col("day").cast("string").alias("day"), "quarters", "peak", "energy")


@query
def marts_dependent(spark, sf_dir):
    """A mart that reads a mart that reads the daily mart, kept by a whole cycle."""
    scripts = [
        *marts.MARTS, Script("05_mart_peaks", _ranked, ("01_mart_daily", "04_mart_monthly")),
        Script("04_mart_monthly", _monthly, ("01_mart_daily",)),
    ]
    base = scratch.fresh_dir(spark, "dependent")
    source = cycle.table_source(grid(spark, sf_dir))
    cycle.run_cycle(spark, base, source, now=at(2024, 1, 31), since=at(2024, 1, 1), scripts=scripts)
    return Store(spark, base, scripts=scripts).mart("05_mart_peaks")


def _events_stored(store):
    return store.raw().select(
        F.unix_micros("date_heure").alias("micros"), F.col("prevision_j1").alias("event_id"), "consommation", "nature"
    )


@query
def event_cycle(spark, sf_dir):
    """One whole cycle over every event: rows told apart by two columns, as many stored as there are events."""
    base = scratch.fresh_dir(spark, "events")
    source = cycle.table_source(event_grid(spark, sf_dir), EVENT_GRID)
    cycle.run_cycle(spark, base, source, now=at(2024, 2, 1), since=at(2024, 1, 1), layout=EVENT_GRID)
    return _events_stored(Store(spark, base, EVENT_GRID))


@query
def event_stream(spark, sf_dir):
    """Every event in landed daily export files, followed by a stream."""
    folder = scratch.fresh_dir(spark, "event-files")
    _land(spark, sf_dir, folder, rows=event_grid(spark, sf_dir), layout=EVENT_GRID)
    return _events_stored(_follow(spark, folder, EVENT_GRID))


@query
def marts_built(spark, sf_dir):
    """Build order, names and sizes of the marts of a store holding the whole grid."""
    base = scratch.fresh_dir(spark, "marts")
    store = Store(spark, base)
    rows = grid(spark, sf_dir)
    instant = clock.from_micros(clock.micros("date_heure", clock.WALL), clock.INSTANT)
    instants = rows.withColumn("date_heure", F.expr(instant)).withColumn(
        "ingested_at", F.lit(None).cast("timestamp")
    )
    store.table.upsert(instants, None)
    names = store.build_marts()
    sizes = [
        store.mart(name).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(n).alias("position"), F.lit(name).alias("mart"), "rows"
        )
        for n, name in enumerate(names)
    ]
    return sizes[0].unionByName(sizes[1]).unionByName(sizes[2])


def _land(spark, sf_dir, folder, where="true", name="landed", rows=None, layout=GRID):
    """The grid (or given rows) as daily export files, a JSON array a day, in folders by date."""
    rows = grid(spark, sf_dir) if rows is None else rows
    first, last = rows.where(where).agg(F.min("date_heure"), F.max("date_heure")).first()
    bounds = (moment.replace(tzinfo=timezone.utc) for moment in (first, last + timedelta(minutes=15)))
    records = cycle.table_source(rows.where(where), layout)(*bounds)
    dated = records.withColumn("day", F.expr("date_from_unix_date(CAST(seq div 86400000000 AS int))"))
    # A day's file is written by one task, which sorts with spilling and holds no more than a record.
    in_day = Window.partitionBy("day").orderBy("seq", "record")
    lines = dated.withColumns({"number": F.row_number().over(in_day), "next": F.lead("seq").over(in_day)}).select(
        "day", "seq", "record",
        F.concat(
            F.when(F.col("number") == 1, "[").otherwise(","), "record", F.when(F.col("next").isNull(), "]").otherwise("")
        ).alias("value"),
    )
    ordered = lines.sortWithinPartitions("day", "seq", "record").select("day", "value")
    ordered.write.mode("append").partitionBy("day").text(f"{folder}/{name}")


def _follow(spark, folder, layout=GRID):
    follow.stream_cycle(
        spark, f"{folder}/landed", f"{folder}/store", f"{folder}/checkpoint",
        files_per_batch=1000, now=lambda: at(2024, 1, 31), layout=layout,
    )
    return Store(spark, f"{folder}/store", layout)


def _raw_out(store):
    return store.raw().select(F.unix_micros("date_heure").alias("micros"), "consommation", "solaire", "nature")


@query
def stream_cycle(spark, sf_dir):
    """Daily export files of the whole grid, followed by a stream."""
    folder = scratch.fresh_dir(spark, "exports")
    _land(spark, sf_dir, folder)
    return _raw_out(_follow(spark, folder))


@query
def stream_after_batch(spark, sf_dir):
    """A store that a batch cycle has used, then followed by a stream: all rows, and a run id for each run."""
    folder = scratch.fresh_dir(spark, "batch-stream")
    cycle.run_cycle(
        spark, f"{folder}/store", cycle.table_source(grid(spark, sf_dir)), now=at(2024, 1, 10), since=at(2024, 1, 8)
    )
    _land(spark, sf_dir, folder)
    store = _follow(spark, folder)
    return _raw_out(store).withColumn("runs", F.lit(store.runs().count()))


@query
def stream_mixed_files(spark, sf_dir):
    """Good files and a broken one in a micro-batch: the good are stored, the broken is listed; once
    repaired, it loads when the stream is started again."""
    folder = scratch.fresh_dir(spark, "mixed")
    _land(spark, sf_dir, folder, "date_heure < timestamp_ntz'2024-01-20 00:00:00'")
    broken = spark.createDataFrame([("<html>gateway",)], "value string").coalesce(1)
    broken.write.mode("append").text(f"{folder}/landed/day=2024-01-20")
    store = _follow(spark, folder)
    before = store.refused().count()
    scratch.delete(spark, f"{folder}/landed/day=2024-01-20")
    _land(spark, sf_dir, folder, "date_heure >= timestamp_ntz'2024-01-20 00:00:00'")
    store = _follow(spark, folder)
    return _raw_out(store).withColumn("refused", F.lit(before))


@query
def landed_window(spark, sf_dir):
    """Of landed export files and JSON lines, the records in the window; files dated off it are not read."""
    folder = scratch.fresh_dir(spark, "window")
    _land(spark, sf_dir, folder)
    start, end = at(2024, 1, 9, 6), at(2024, 1, 12)
    exports = cycle.export_source(spark, f"{folder}/landed", file_date="day=([0-9-]+)")(start, end)
    every = cycle.table_source(grid(spark, sf_dir))(at(1970, 1, 1), at(2100, 1, 1))
    every.select("record").write.text(f"{folder}/lines")
    lines = cycle.lines_source(spark, f"{folder}/lines")(start, end)
    found = [("exports", exports), ("lines", lines)]
    parts = [
        apply_contract(rows).select(F.lit(name).alias("source"), F.unix_micros("date_heure").alias("micros"), "gaz")
        for name, rows in found
    ]
    return parts[0].unionByName(parts[1])


@query
def landed_index(spark, sf_dir):
    """Of landed export files whose names tell no date, the records in the window; only files that hold some are opened."""
    folder = scratch.fresh_dir(spark, "undated")
    _land(spark, sf_dir, folder)
    plain = spark.read.text(f"{folder}/landed", wholetext=True).select("value")
    plain.repartition(8).write.option("maxRecordsPerFile", 1).text(f"{folder}/undated")
    index = LandedIndex(spark, f"{folder}/index", f"{folder}/undated", "date_heure")
    found = cycle.indexed_source(spark, index)(at(2024, 1, 9, 6), at(2024, 1, 12))
    opened = len(index.files(at(2024, 1, 9, 6), at(2024, 1, 12)))
    return apply_contract(found).select(F.unix_micros("date_heure").alias("micros"), "gaz", F.lit(opened).alias("opened"))


# -- ledger and read queries ---------------------------------------------------------------------------------


@query
def ledger_fold(spark, sf_dir):
    folded = ledger.fold(runs_from(spark, sf_dir))
    return folded.select("run_id", "status", "rows_fetched", "rows_inserted", "error")


@query
def ledger_compacted(spark, sf_dir):
    """The latest state of each run out of a log whose entries, an append for every turn, were folded again and again."""
    log = FoldedLog(spark, scratch.fresh_dir(spark, "log"), ledger.EVENT, "run_id", "event_seq", limit=3)
    events = runs_from(spark, sf_dir).withColumns({"stream": F.lit(None).cast("string"), "batch_id": F.lit(None).cast("bigint")})
    events = events.withColumn("event_seq", F.col("event_seq").cast("bigint")).select(*ledger.EVENT.names)
    for row in events.select("event_seq").distinct().orderBy("event_seq").collect():
        log.append(events.where(F.col("event_seq") == row["event_seq"]))
    folded = ledger.fold(log.read())
    return folded.select("run_id", "status", "rows_fetched", "rows_inserted", "error")


@query
def run_report(spark, sf_dir):
    """The report file of a cycle, line by line, without its run time."""
    folder = scratch.fresh_dir(spark, "report")
    cycle.run_cycle(
        spark, f"{folder}/store", cycle.table_source(grid(spark, sf_dir)), now=at(2024, 1, 31), since=at(2024, 1, 1),
        report_path=f"{folder}/report",
    )
    lines = spark.read.text(f"{folder}/report").where("value RLIKE '^(# run|- )'")
    return lines.select(F.regexp_replace("value", r" · [0-9.]+s$", "").alias("line"))


@query
def raw_schema(spark, sf_dir):
    """Names and types of the columns that a cycle's stored table has, with the number of rows that fill each."""
    base = scratch.fresh_dir(spark, "schema")
    cycle.run_cycle(spark, base, cycle.table_source(grid(spark, sf_dir)), now=at(2024, 1, 31), since=at(2024, 1, 1))
    raw = Store(spark, base).raw()
    kinds = {field.name: field.dataType.simpleString() for field in raw.schema}
    counts = raw.agg(*[F.count(name).alias(name) for name in kinds])
    long = counts.unpivot([], list(kinds), "name", "filled")
    named = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    return long.select("name", named[F.col("name")].alias("type"), "filled")


@query
def last_runs(spark, sf_dir):
    runs = ledger.last_runs(ledger.fold(runs_from(spark, sf_dir)), 20)
    return runs.select("run_id", "status", "rows_fetched", "rows_inserted", "error")


@query
def read_runs(spark, sf_dir):
    runs = ledger.runs_page(ledger.fold(runs_from(spark, sf_dir)), 50)
    return runs.select("run_id", F.unix_seconds("finished_at").alias("finished_at"), "status")


@query
def read_health(spark, sf_dir):
    state = reads.health(
        table(spark, sf_dir, "events"), ledger.fold(runs_from(spark, sf_dir)), at(2024, 2, 3),
        layout=EVENTS_LAYOUT,
    )
    return state.select(
        "status", stamp("last_observed").alias("last_observed"), "lag_hours",
        F.col("last_run.run_id").alias("run_id"), F.col("last_run.status").alias("run_status"),
        F.unix_seconds("last_run.finished_at").alias("run_finished"),
    )


@query
def read_daily(spark, sf_dir):
    return _daily(reads.daily(marts.daily(readings(spark, sf_dir)), 30))


@query
def read_latest(spark, sf_dir):
    base, _, _ = _two_runs(spark, sf_dir)
    rows = reads.Reads(Store(spark, base)).latest()
    wall = F.expr(clock.utc_wall("date_heure", clock.INSTANT))
    return _keyed(rows.withColumn("date_heure", wall)).select("date_heure", "consumption_mw", "production_total_mw")


@query
def read_mix(spark, sf_dir):
    base, _, _ = _two_runs(spark, sf_dir)
    return reads.Reads(Store(spark, base)).mix()


@query
def read_status(spark, sf_dir):
    summary, _ = reads.status(
        grid(spark, sf_dir), ledger.fold(runs_from(spark, sf_dir)), at(2024, 1, 31)
    )
    return summary.select("raw_rows", stamp("last_observed").alias("last_observed"), "lag_hours")


@query
def status_lines(spark, sf_dir):
    _, lines = reads.status(
        grid(spark, sf_dir), ledger.fold(runs_from(spark, sf_dir)), at(2024, 1, 31)
    )
    return lines.withColumn("started_at", F.unix_seconds("started_at"))
