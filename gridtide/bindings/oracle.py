"""The same results in DuckDB SQL, written against the benchmark tables."""

from __future__ import annotations

from gridtide.operators.contract import GRID

ORACLE: dict[str, str] = {}

SOURCES = {
    "nuclear": "nucleaire", "wind": "eolien", "solar": "solaire", "hydro": "hydraulique",
    "gas": "gaz", "oil": "fioul", "coal": "charbon", "bioenergy": "bioenergies",
}
FLOWS = ["pompage", "ech_physiques", "stockage_batterie", "destockage_batterie"]

GRID_CTE = """
ev AS (
  SELECT epoch_us(ts) // 900000000 AS slot, user_id, event_type,
         CAST(round(value * 100) AS BIGINT) AS mw
  FROM events
),
slots AS (
  SELECT slot, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS u,
    coalesce(max(mw) FILTER (event_type = 'view'), 0) AS nucleaire,
    coalesce(max(mw) FILTER (event_type = 'click'), 0) AS eolien,
    max(mw) FILTER (event_type = 'purchase') AS solaire,
    coalesce(max(mw) FILTER (event_type = 'signup' AND user_id % 2 = 0), 0) AS hydraulique,
    coalesce(max(mw) FILTER (event_type = 'signup' AND user_id % 2 = 1), 0) AS bioenergies,
    coalesce(max(mw) FILTER (event_type = 'error' AND user_id % 3 = 0), 0) AS gaz,
    coalesce(max(mw) FILTER (event_type = 'error' AND user_id % 3 = 1), 0) AS fioul,
    coalesce(max(mw) FILTER (event_type = 'error' AND user_id % 3 = 2), 0) AS charbon
  FROM ev GROUP BY slot
),
flows AS (
  SELECT *, -(u % 500) AS pompage, (u % 7 - 3) * 100 AS ech_physiques,
    -(n % 4) AS stockage_batterie, n % 3 AS destockage_batterie
  FROM slots
),
supplied AS (
  SELECT *, nucleaire + eolien + coalesce(solaire, 0) + hydraulique + bioenergies + gaz + fioul
    + charbon + pompage + ech_physiques + stockage_batterie + destockage_batterie AS supply
  FROM flows
),
grid AS (
  SELECT make_timestamp(slot * 900000000) AS date_heure, slot, nucleaire, eolien, solaire,
    hydraulique, bioenergies, gaz, fioul, charbon, pompage, ech_physiques, stockage_batterie,
    destockage_batterie,
    CASE WHEN u % 10 <> 0 THEN 'measured' ELSE 'forecast' END AS nature,
    CASE WHEN u % 10 <> 0 THEN CAST(trunc((supply * (94 + u % 13)) / 100.0) AS BIGINT) END
      AS consommation,
    supply + u % 100 AS prevision_j,
    CASE WHEN n % 5 <> 0 THEN u % 60 END AS taux_co2
  FROM supplied
)"""

READINGS_CTE = """
bought AS (
  SELECT o_orderkey AS k, CAST(round(o_totalprice) AS BIGINT) AS p,
    o_orderdate + to_minutes(CAST((o_orderkey % 96) * 15 AS BIGINT)) AS date_heure
  FROM orders
),
readings AS (
  SELECT date_heure, CASE WHEN k % 10 <> 0 THEN p END AS consommation, p // 2 AS nucleaire,
    CASE WHEN k % 3 = 0 THEN p // 5 END AS eolien, CASE WHEN k % 4 = 0 THEN p // 7 END AS solaire,
    p // 9 AS hydraulique, p // 11 AS gaz, p % 100 AS fioul, p % 50 AS charbon,
    CASE WHEN k % 5 = 0 THEN p // 13 END AS bioenergies,
    CASE WHEN k % 6 <> 0 THEN k % 90 END AS taux_co2
  FROM bought
)"""


def with_grid(body: str) -> str:
    return f"WITH {GRID_CTE}\n{body}"


def with_readings(body: str) -> str:
    return f"WITH {READINGS_CTE}\n{body}"


def stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def paris_day(column: str) -> str:
    return f"CAST(timezone('Europe/Paris', timezone('UTC', {column})) AS DATE)"


def check(
    name: str, passed: str, severity: str, detail: str,
    counted: str = "NULL", total: str = "NULL", measure: str = "NULL", source: str = "",
) -> str:
    return f"""SELECT '{name}' AS name, {passed} AS passed, {severity} AS severity,
      {detail} AS detail, CAST({counted} AS BIGINT) AS counted, CAST({total} AS BIGINT) AS total,
      CAST({measure} AS DOUBLE) AS measure {source}"""


def total(columns: list[str]) -> str:
    return "(" + " + ".join(f"coalesce({c}, 0)" for c in columns) + ")"


def share(part: str, whole: str) -> str:
    return f"round(100.0::DOUBLE * CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0), 1)"


RENEWABLE = ["eolien", "solaire", "hydraulique", "bioenergies"]
PRODUCED = list(SOURCES.values())


def daily(rows: str, extra: str = "") -> str:
    def mwh(columns: list[str]) -> str:
        return f"round(CAST(sum({total(columns)}) AS DOUBLE) / 4.0::DOUBLE)"

    return f"""SELECT CAST({paris_day('date_heure')} AS VARCHAR) AS day,
      count(*) AS quarters_observed, round(avg(consommation)) AS avg_consumption_mw,
      CAST(max(consommation) AS BIGINT) AS peak_consumption_mw,
      round(CAST(sum(consommation) AS DOUBLE) / 4.0::DOUBLE) AS energy_consumed_mwh,
      {mwh(['nucleaire'])} AS nuclear_mwh, {mwh(['eolien'])} AS wind_mwh,
      {mwh(['solaire'])} AS solar_mwh, {mwh(['hydraulique'])} AS hydro_mwh,
      {mwh(['gaz'])} AS gas_mwh, {mwh(['fioul', 'charbon'])} AS oil_coal_mwh,
      {mwh(['bioenergies'])} AS bioenergy_mwh,
      {share(f'sum({total(RENEWABLE)})', f'sum({total(PRODUCED)})')} AS renewable_share_pct,
      round(avg(taux_co2), 1) AS avg_co2_g_kwh
    FROM {rows} WHERE consommation IS NOT NULL GROUP BY 1 {extra}"""


def mix(rows: str) -> str:
    branches = " UNION ALL ".join(
        f"SELECT '{label}' AS source, coalesce({column}, 0) AS mw FROM week"
        for label, column in SOURCES.items()
    )
    return f""", week AS (
      SELECT * FROM {rows} WHERE consommation IS NOT NULL AND date_heure >= (
        SELECT max(date_heure) - INTERVAL 168 HOUR FROM {rows} WHERE consommation IS NOT NULL)
    ), long AS ({branches})
    SELECT source, round(CAST(sum(mw) AS DOUBLE) / 4.0::DOUBLE) AS mwh,
      {share('sum(mw)', 'sum(sum(mw)) OVER ()')} AS share_pct
    FROM long GROUP BY source"""


# -- scans and payloads ---------------------------------------------------------------------

ORACLE["scan_window"] = f"""
SELECT event_id, {stamp('ts')} AS ts, event_type, value FROM events
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-11 00:00:00'"""

ORACLE["payload_triage"] = """
SELECT event_id AS origin,
  CASE event_id % 20 WHEN 1 THEN 'API error: upstream down' WHEN 2 THEN 'API error: E2'
    WHEN 3 THEN 'API error: unknown error' WHEN 4 THEN 'unexpected payload shape: string'
    WHEN 5 THEN 'invalid JSON' WHEN 6 THEN 'invalid JSON' END AS problem,
  CAST(CASE WHEN event_id % 20 = 0 THEN 2 WHEN event_id % 20 = 7 THEN 0
    WHEN event_id % 20 BETWEEN 1 AND 6 THEN -1 ELSE 1 END AS INTEGER) AS records
FROM events"""

ORACLE["payload_records"] = """
WITH kinds AS (
  SELECT event_id AS origin, event_id % 20 AS kind,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
)
SELECT origin, CAST(0 AS BIGINT) AS pos, CASE WHEN kind NOT BETWEEN 1 AND 6 THEN k END AS k,
  CASE kind WHEN 1 THEN 'API error: upstream down' WHEN 2 THEN 'API error: E2'
    WHEN 3 THEN 'API error: unknown error' WHEN 4 THEN 'unexpected payload shape: string'
    WHEN 5 THEN 'invalid JSON' WHEN 6 THEN 'invalid JSON' END AS problem
FROM kinds WHERE kind <> 7
UNION ALL
SELECT origin, CAST(1 AS BIGINT), k, NULL FROM kinds WHERE kind = 0"""

ORACLE["count_raw"] = with_grid("SELECT count(*) AS raw_rows FROM grid")

# -- contract -----------------------------------------------------------------------------------

EVENT_RECORDS = """
made AS (
  SELECT event_id AS seq, event_id % 20 AS kind, event_id % 7 AS zone, event_type,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, ts,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || CASE event_id % 7 WHEN 0 THEN ''
      WHEN 1 THEN '+02:00' ELSE 'Z' END AS label
  FROM events
)"""

ORACLE["contract_project"] = f"""
WITH {EVENT_RECORDS}
SELECT seq, {stamp("CASE WHEN zone = 1 THEN ts - INTERVAL 2 HOUR ELSE ts END")} AS ts,
  CAST(CASE WHEN kind = 1 THEN NULL WHEN kind IN (3, 4) THEN round_even(k + 0.5, 0)
    WHEN kind = 5 THEN -k ELSE k END AS INTEGER) AS k,
  CASE WHEN kind = 4 THEN 'half' WHEN kind > 5 THEN event_type END AS note
FROM made WHERE zone <> 0 AND kind NOT IN (0, 2)"""

ORACLE["contract_rejects"] = f"""
WITH {EVENT_RECORDS}
SELECT seq, label || ': ' || CASE
  WHEN zone = 0 THEN 'field ''ts'': timestamp lacks a timezone offset'
  WHEN kind = 0 THEN 'required field ''k'' is missing'
  ELSE 'field ''k'': could not convert string to float: ''a lot''' END AS reject
FROM made WHERE zone = 0 OR kind IN (0, 2)"""

ORACLE["coerce_integer"] = """
SELECT event_id, CAST(CASE event_id % 12
  WHEN 3 THEN round_even(event_id + 0.5, 0) WHEN 4 THEN round_even(-event_id - 0.5, 0)
  WHEN 5 THEN event_id
  WHEN 6 THEN CASE WHEN event_id * 1000 <= 2147483647 THEN event_id * 1000 END
  WHEN 8 THEN CASE WHEN event_id * 1000000000 <= 2147483647 THEN event_id * 1000000000 END
  WHEN 10 THEN event_id WHEN 11 THEN event_id END AS INTEGER) AS value
FROM events"""

ORACLE["coerce_timestamp"] = """
SELECT event_id, CASE event_id % 8 WHEN 0 THEN epoch_us(ts) WHEN 7 THEN epoch_us(ts)
  WHEN 1 THEN epoch_us(ts) - 7200000000 WHEN 5 THEN epoch_us(ts) + 19800000000 END AS micros
FROM events"""

ORACLE["filter_observed"] = with_grid(f"""
SELECT {stamp('date_heure')} AS date_heure, CAST(consommation AS INTEGER) AS consommation
FROM grid WHERE consommation IS NOT NULL""")

ORACLE["forecast_rows"] = with_grid(f"""
SELECT {stamp('date_heure')} AS date_heure, CAST(prevision_j AS INTEGER) AS prevision_j
FROM grid WHERE consommation IS NULL""")

# -- quality gate -----------------------------------------------------------------------------------


def coercion_check(rejected: str, fetched: str, first: str, source: str) -> str:
    ratio = f"CASE WHEN {fetched} > 0 THEN CAST({rejected} AS DOUBLE) / {fetched} ELSE 0.0 END"
    return check(
        "contract_coercion", f"{rejected} = 0", f"CASE WHEN {ratio} > 0.05 THEN 'fail' ELSE 'warn' END",
        f"{rejected} || '/' || {fetched} || ' record(s) rejected' || "
        f"CASE WHEN {rejected} > 0 THEN ' — first: ' || {first} ELSE '' END",
        rejected, fetched, ratio, source,
    )


ORACLE["check_coercion"] = f"""
WITH facts AS (
  SELECT count(*) AS fetched, count(*) FILTER (event_id % 20 = 7) AS rejected,
    'event ' || min(event_id) FILTER (event_id % 20 = 7) AS first FROM events
)
{coercion_check('rejected', 'fetched', 'first', 'FROM facts')}"""

ORACLE["check_window_not_empty"] = f"""
WITH facts AS (SELECT count(*) AS fetched FROM events)
{check('window_not_empty', 'fetched > 0', "'warn'", "fetched || ' record(s) fetched'", 'fetched',
       source='FROM facts')}"""

ORACLE["check_primary_key"] = f"""
WITH copies AS (
  SELECT l_orderkey AS a, l_linenumber AS b FROM lineitem GROUP BY ALL HAVING count(*) > 1
), facts AS (
  SELECT count(*) AS n, (SELECT a || ', ' || b FROM copies ORDER BY a, b LIMIT 1) AS eg FROM copies
)
{check('primary_key_unique', 'n = 0', "'fail'",
       "n || ' duplicated timestamp(s)' || CASE WHEN n > 0 THEN ' — e.g. ' || eg ELSE '' END", 'n',
       source='FROM facts')}"""

ORACLE["duplicate_keys"] = """
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1"""

EXAMPLE = (
    "CASE WHEN epoch_us({0}) % 1000000 = 0 THEN strftime({0}, '%Y-%m-%d %H:%M:%S') "
    "ELSE strftime({0}, '%Y-%m-%d %H:%M:%S.%f') END || '+00:00'"
)

ORACLE["check_alignment"] = f"""
WITH moved AS (
  SELECT event_id, CASE WHEN event_id % 20 = 0 THEN date_trunc('hour', ts) ELSE ts END AS ts
  FROM events
), bad AS (
  SELECT * FROM moved WHERE minute(ts) % 15 <> 0 OR second(ts) <> 0
), facts AS (SELECT count(*) AS n, arg_min(ts, event_id) AS first FROM bad)
{check('quarter_hour_grid', 'n = 0', "'warn'",
       "n || ' timestamp(s) off the quarter-hour grid' || CASE WHEN n > 0 THEN ' — e.g. ' || "
       + EXAMPLE.format('first') + " ELSE '' END", 'n', source='FROM facts')}"""

ORACLE["range_violations"] = """
SELECT 'l_quantity' AS field, count(*) FILTER (l_quantity < 5 OR l_quantity > 45) AS violations
FROM lineitem
UNION ALL
SELECT 'l_linenumber', count(*) FILTER (l_linenumber < 2 OR l_linenumber > 6) FROM lineitem"""

RANGE_DETAIL = (
    "n || ' value(s) outside plausible bounds' || CASE WHEN n > 0 THEN ' — ' || eg ELSE '' END"
)

ORACLE["check_ranges"] = f"""
WITH cells AS (
  SELECT 0 AS rank, event_id AS seq, 'v' AS field, CAST(round(value) AS BIGINT) AS v, 1 AS lo,
    200 AS hi, ts FROM events
  UNION ALL SELECT 1, event_id, 'user_id', user_id, 1, 140, ts FROM events
), bad AS (SELECT * FROM cells WHERE v < lo OR v > hi),
shown AS (
  SELECT string_agg(field || '=' || v || ' at ' || {EXAMPLE.format('ts')}, '; ' ORDER BY rank, seq)
    AS eg
  FROM (SELECT * FROM bad ORDER BY rank, seq LIMIT 3)
), facts AS (SELECT (SELECT count(*) FROM bad) AS n, eg FROM shown)
{check('plausible_ranges', 'n = 0', "'warn'", RANGE_DETAIL, 'n', source='FROM facts')}"""

PARTS_SUM = " + ".join([*PRODUCED, *FLOWS])
DEVIATIONS_CTE = f"""
deviations AS (
  SELECT * FROM (
    SELECT *, CASE WHEN consommation <> 0 THEN
      CAST(abs({PARTS_SUM} - consommation) AS DOUBLE) / CAST(consommation AS DOUBLE) * 100.0::DOUBLE
      END AS deviation_pct
    FROM grid
  ) WHERE deviation_pct IS NOT NULL
)"""


def balance_check(rows: str) -> str:
    return check(
        "grid_balance", "beyond = 0", "'warn'",
        "checked || ' row(s) checked, ' || beyond || ' beyond ±5% (worst ' || "
        "printf('%.1f', worst) || '%)'",
        "beyond", "checked", "worst",
        f"""FROM (SELECT count(*) AS checked, count(*) FILTER (deviation_pct > 5) AS beyond,
             greatest(coalesce(max(deviation_pct), 0.0), 0.0) AS worst FROM {rows})""",
    )


ORACLE["check_balance"] = f"WITH {GRID_CTE}, {DEVIATIONS_CTE}\n{balance_check('deviations')}"

ORACLE["balance_rows"] = f"""
WITH {GRID_CTE}, {DEVIATIONS_CTE}
SELECT {stamp('date_heure')} AS date_heure, deviation_pct, deviation_pct > 5 AS beyond
FROM deviations"""


LARGE = ", ".join(f"2147483000 + {name} % 500 AS {name}" for name in ("nucleaire", "gaz", "eolien"))
ORACLE["balance_large"] = f"""
WITH {GRID_CTE.replace("grid AS (", "plain AS (")}, grid AS (SELECT * REPLACE ({LARGE}) FROM plain),
{DEVIATIONS_CTE}
SELECT {stamp('date_heure')} AS date_heure, deviation_pct, deviation_pct > 5 AS beyond
FROM deviations"""


def freshness_check(last: str, now: str, source: str) -> str:
    lag = f"greatest(CAST(epoch_us(TIMESTAMP '{now}') - epoch_us({last}) AS DOUBLE) / 3600000000.0::DOUBLE, 0.0)"
    return check(
        "freshness", f"{lag} <= 6.0", f"CASE WHEN {lag} > 48.0 THEN 'fail' ELSE 'warn' END",
        f"'last observed quarter-hour ' || strftime({last}, '%Y-%m-%d %H:%M') || ' UTC (' || "
        f"printf('%.1f', {lag}) || ' h ago)'",
        measure=lag, source=source,
    )


ORACLE["check_freshness"] = f"""
WITH facts AS (SELECT max(ts) AS last FROM events WHERE value IS NOT NULL)
{freshness_check('last', '2024-01-31 12:00:00', 'FROM facts')}"""

DAYS_CTE = f"""
days AS (
  SELECT {paris_day('date_heure')} AS day, count(*) AS n FROM grid WHERE consommation IS NOT NULL
  GROUP BY 1 ORDER BY 1 DESC LIMIT 1 OFFSET 1
)"""

COMPLETE = check(
    "day_completeness", "n IN (92, 96, 100)", "'warn'",
    "day || ': ' || n || ' observed quarter-hour(s) (expected 96, DST days 92/100)'", "n",
    source="FROM days",
)

ORACLE["check_completeness"] = f"WITH {GRID_CTE}, {DAYS_CTE}\n{COMPLETE}"

_BOUNDED = [
    (rank, f.name, f.lo, f.hi)
    for rank, f in enumerate(GRID.bounded)
    if f.name in {"consommation", "prevision_j", "taux_co2", *PRODUCED, *FLOWS}
]
BATCH_CTE = f"""{GRID_CTE},
batch AS (
  SELECT *, slot * 900000000 AS seq,
    CASE WHEN slot % 32 = 0 THEN (slot * 900000000) || ': refused' END AS reject
  FROM grid
),
kept AS (SELECT * FROM batch WHERE reject IS NULL),
seen AS (SELECT * FROM kept WHERE consommation IS NOT NULL),
{DEVIATIONS_CTE.replace("FROM grid", "FROM seen")},
cells AS ({" UNION ALL ".join(
    f"SELECT {rank} AS rank, seq, date_heure, '{name}' AS field, {name} AS v, {lo} AS lo, {hi} AS hi FROM seen"
    for rank, name, lo, hi in _BOUNDED)}),
bad AS (SELECT * FROM cells WHERE v < lo OR v > hi),
shown AS (
  SELECT string_agg(field || '=' || v || ' at ' || {EXAMPLE.format('date_heure')}, '; '
    ORDER BY rank, seq) AS eg
  FROM (SELECT * FROM bad ORDER BY rank, seq LIMIT 3)
),
coerced AS (
  SELECT count(*) AS fetched, count(reject) AS rejected,
    arg_min(reject, seq) FILTER (reject IS NOT NULL) AS first FROM batch
),
ranged AS (SELECT (SELECT count(*) FROM bad) AS n, eg FROM shown),
gate AS (
{coercion_check('rejected', 'fetched', 'first', 'FROM coerced')}
UNION ALL {check('window_not_empty', 'fetched > 0', "'warn'",
                 "fetched || ' record(s) fetched'", 'fetched', source='FROM coerced')}
UNION ALL {check('primary_key_unique', 'true', "'fail'", "'0 duplicated timestamp(s)'", '0')}
UNION ALL {check('quarter_hour_grid', 'true', "'warn'",
                 "'0 timestamp(s) off the quarter-hour grid'", '0')}
UNION ALL {check('plausible_ranges', 'n = 0', "'warn'", RANGE_DETAIL, 'n', source='FROM ranged')}
UNION ALL {balance_check('deviations')}
)"""

ORACLE["quality_batch"] = f"WITH {BATCH_CTE}\nSELECT * FROM gate"

ORACLE["report_status"] = f"""WITH {BATCH_CTE}
SELECT CASE WHEN bool_or(NOT passed AND severity = 'fail') THEN 'fail'
  WHEN bool_or(NOT passed) THEN 'warn' ELSE 'pass' END AS status FROM gate"""

ORACLE["report_failures"] = f"WITH {BATCH_CTE}\nSELECT name, severity FROM gate WHERE NOT passed"

STORED_CTE = f"""{GRID_CTE}, {DAYS_CTE},
facts AS (SELECT max(date_heure) AS last FROM grid WHERE consommation IS NOT NULL),
stored AS (
  {freshness_check('last', '2024-02-03 00:00:00', 'FROM facts')}
  UNION ALL {COMPLETE}
),
folded AS (
  SELECT CASE WHEN bool_or(NOT passed AND severity = 'fail') THEN 'fail'
    WHEN bool_or(NOT passed) THEN 'warn' ELSE 'pass' END AS status FROM stored
)"""

ORACLE["quality_warehouse"] = f"WITH {STORED_CTE}\nSELECT * FROM stored"

ORACLE["report_markdown"] = f"""WITH {STORED_CTE}
SELECT '## Data quality — ' || CASE status WHEN 'pass' THEN '✅' WHEN 'warn' THEN '⚠️'
    ELSE '🛑' END || ' ' || upper(status) || chr(10) || chr(10)
    || '| check | result | detail |' || chr(10) || '|---|---|---|' || chr(10)
    || (SELECT string_agg('| ' || name || ' | ' || CASE WHEN passed THEN 'ok'
          ELSE upper(severity) END || ' | ' || detail || ' |', chr(10) ORDER BY name DESC)
        FROM stored) AS markdown
FROM folded"""

ORACLE["report_json"] = f"""WITH {STORED_CTE}
SELECT '{{"status":"' || status || '","checks":[' || (
    SELECT string_agg('{{"name":"' || name || '","passed":' || passed || ',"severity":"'
      || severity || '","detail":"' || detail || '"}}', ',' ORDER BY name DESC) FROM stored
  ) || ']}}' AS json FROM folded"""

# -- marts -------------------------------------------------------------------------------------------------

ORACLE["mart_daily"] = with_grid(daily("grid"))
ORACLE["mart_daily_dst"] = with_readings(daily("readings"))
ORACLE["read_daily"] = with_readings(daily("readings", "ORDER BY 1 DESC LIMIT 30"))

_LATEST = f"""
SELECT {stamp('date_heure')} AS date_heure, CAST(consommation AS INTEGER) AS consumption_mw,
  CAST(taux_co2 AS INTEGER) AS co2_g_kwh, CAST(nucleaire AS BIGINT) AS nuclear_mw,
  CAST(eolien AS BIGINT) AS wind_mw, CAST(coalesce(solaire, 0) AS BIGINT) AS solar_mw,
  CAST(hydraulique AS BIGINT) AS hydro_mw, CAST(gaz AS BIGINT) AS gas_mw,
  CAST(fioul + charbon AS BIGINT) AS oil_coal_mw, CAST(bioenergies AS BIGINT) AS bioenergy_mw,
  CAST(pompage AS INTEGER) AS pumped_storage_mw, CAST(ech_physiques AS INTEGER) AS net_exchange_mw,
  CAST({total(PRODUCED)} AS BIGINT) AS production_total_mw,
  {share(total(RENEWABLE), total(PRODUCED))} AS renewable_share_pct
FROM grid WHERE consommation IS NOT NULL ORDER BY grid.date_heure DESC LIMIT 1"""

ORACLE["mart_latest"] = with_grid(_LATEST)
ORACLE["mart_mix_7d"] = f"WITH {GRID_CTE}{mix('grid')}"

ORACLE["mix_long"] = with_readings(" UNION ALL ".join(
    f"SELECT '{label}' AS source, CAST(sum(coalesce({column}, 0)) AS BIGINT) AS mw FROM readings"
    for label, column in SOURCES.items()
))

ORACLE["last_days"] = with_readings(f"""
SELECT {stamp('date_heure')} AS date_heure, CAST(nucleaire AS INTEGER) AS nucleaire
FROM readings WHERE consommation IS NOT NULL AND readings.date_heure >= (
  SELECT max(date_heure) - INTERVAL 168 HOUR FROM readings WHERE consommation IS NOT NULL)""")

# -- incremental logic and the keyed table ---------------------------------------------------------------------

ORACLE["watermark"] = with_grid(
    f"SELECT {stamp('max(date_heure)')} AS watermark FROM grid WHERE consommation IS NOT NULL"
)

ORACLE["compute_window"] = with_grid("""
SELECT 'watermark' AS shape, epoch_us(max(date_heure)) - 86400000000 AS window_start,
  epoch_us(TIMESTAMP '2024-02-02 12:00:00') AS window_end
FROM grid WHERE consommation IS NOT NULL
UNION ALL SELECT 'bootstrap', epoch_us(TIMESTAMP '2024-01-29'), epoch_us(TIMESTAMP '2024-02-02 12:00:00')
UNION ALL SELECT 'since', epoch_us(TIMESTAMP '2023-12-01'), epoch_us(TIMESTAMP '2024-02-02 12:00:00')""")

MERGED = f"""
SELECT event_id, {stamp('ts')} AS ts, user_id,
  CASE WHEN revised AND event_type = 'error' THEN NULL ELSE event_type END AS event_type,
  CASE WHEN revised AND event_type = 'error' THEN value + 2 WHEN revised THEN value + 1 ELSE value END
    AS value
FROM (SELECT *, ts >= TIMESTAMP '2024-01-19 00:00:00' AS revised FROM events)"""
for _name in ("upsert_merge", "upsert_idempotent", "stream_upsert"):
    ORACLE[_name] = MERGED

_COUNTS = """
facts AS (
  SELECT count(*) FILTER (ts < TIMESTAMP '2024-01-20') AS base,
    count(DISTINCT CAST(ts AS DATE)) FILTER (ts < TIMESTAMP '2024-01-20') AS base_days,
    count(*) FILTER (ts >= TIMESTAMP '2024-01-20') AS fresh,
    count(*) FILTER (ts >= TIMESTAMP '2024-01-19') AS keys,
    count(DISTINCT CAST(ts AS DATE)) FILTER (ts >= TIMESTAMP '2024-01-19') AS batch_days,
    count(*) FILTER (ts >= TIMESTAMP '2024-01-19' AND event_type = 'error') AS twice
  FROM events
)"""

ORACLE["upsert_counts"] = (
    f"WITH {_COUNTS} SELECT fresh AS inserted, keys + twice - fresh AS updated FROM facts"
)

ORACLE["upsert_table_counts"] = f"""WITH {_COUNTS}
SELECT 0 AS load, base AS inserted, CAST(0 AS BIGINT) AS updated, CAST(base_days AS INTEGER) AS days
FROM facts
UNION ALL SELECT 1, fresh, keys + twice - fresh, CAST(batch_days AS INTEGER) FROM facts
UNION ALL SELECT 2, 0, keys + twice, CAST(batch_days AS INTEGER) FROM facts"""

# -- whole cycles --------------------------------------------------------------------------------------------------

ORACLE["run_cycle"] = with_grid("""
SELECT CAST(1 AS BIGINT) AS run_id, 'warn' AS status, CAST(count(*) AS BIGINT) AS rows_fetched,
  CAST(0 AS BIGINT) AS rows_rejected, CAST(count(*) AS BIGINT) AS rows_inserted,
  CAST(0 AS BIGINT) AS rows_updated, '01_mart_daily,02_mart_latest,03_mart_mix_7d' AS marts,
  CAST(8 AS INTEGER) AS checks
FROM grid WHERE date_heure >= TIMESTAMP '2024-01-01' AND date_heure < TIMESTAMP '2024-02-01 12:00:00'""")

RUNS_CTE = f"""{GRID_CTE},
one AS (
  SELECT * FROM grid
  WHERE date_heure >= TIMESTAMP '2024-01-01' AND date_heure < TIMESTAMP '2024-01-21 12:00:00'
),
mark AS (SELECT max(date_heure) AS mark FROM one WHERE consommation IS NOT NULL),
two AS (
  SELECT grid.* REPLACE (consommation + 1 AS consommation) FROM grid, mark
  WHERE date_heure >= mark - INTERVAL 24 HOUR AND date_heure < TIMESTAMP '2024-02-01 12:00:00'
),
after AS (
  SELECT * FROM two
  UNION ALL SELECT one.* FROM one ANTI JOIN two ON one.slot = two.slot
)"""

ORACLE["incremental_two_runs"] = f"""WITH {RUNS_CTE}
SELECT {stamp('date_heure')} AS date_heure, CAST(consommation AS INTEGER) AS consommation,
  CAST(nucleaire AS INTEGER) AS nucleaire FROM after"""

ORACLE["incremental_outcomes"] = f"""WITH {RUNS_CTE}
SELECT CAST(1 AS BIGINT) AS run_id, 'warn' AS status, CAST(count(*) AS BIGINT) AS rows_fetched,
  CAST(0 AS BIGINT) AS rows_rejected, CAST(count(*) AS BIGINT) AS rows_inserted,
  CAST(0 AS BIGINT) AS rows_updated, epoch_us(TIMESTAMP '2024-01-01') AS window_start,
  epoch_us(TIMESTAMP '2024-01-21 12:00:00') AS window_end FROM one
UNION ALL
SELECT 2, 'warn', CAST(count(*) AS BIGINT), 0,
  CAST(count(*) FILTER (slot NOT IN (SELECT slot FROM one)) AS BIGINT),
  CAST(count(*) FILTER (slot IN (SELECT slot FROM one)) AS BIGINT),
  (SELECT epoch_us(mark) - 86400000000 FROM mark), epoch_us(TIMESTAMP '2024-02-01 12:00:00') FROM two"""

ORACLE["mart_daily_incremental"] = f"WITH {RUNS_CTE}\n{daily('after')}"

ORACLE["mart_daily_recovered"] = f"""WITH {GRID_CTE}, held AS (
  SELECT * FROM grid WHERE date_heure < TIMESTAMP '2024-01-08'
  UNION ALL SELECT * FROM grid
    WHERE date_heure >= TIMESTAMP '2024-01-12' AND date_heure < TIMESTAMP '2024-01-21 12:00:00'
)
{daily('held')}"""

ORACLE["adhoc_sql"] = f"""WITH {RUNS_CTE}
SELECT nature, count(*) AS quarters, CAST(sum(nucleaire) AS BIGINT) AS nuclear,
  (SELECT count(DISTINCT {paris_day('date_heure')}) FROM after WHERE consommation IS NOT NULL) AS days,
  CAST(2 AS BIGINT) AS runs
FROM after WHERE nucleaire >= 500 GROUP BY nature"""

ORACLE["gate_blocks"] = f"""WITH {RUNS_CTE}
SELECT 'clean' AS batch, count(*) AS fetched, count(*) AS loaded FROM one
UNION ALL SELECT 'doubled', 2 * count(*), 0 FROM one"""

ORACLE["read_latest"] = f"""WITH {RUNS_CTE}
SELECT date_heure, consumption_mw, production_total_mw FROM ({_LATEST.replace('grid', 'after')})"""
ORACLE["read_mix"] = f"WITH {RUNS_CTE}{mix('after')}"

ORACLE["marts_built"] = f"""WITH {GRID_CTE}
SELECT 0 AS position, '01_mart_daily' AS mart, count(DISTINCT {paris_day('date_heure')}) AS rows
FROM grid WHERE consommation IS NOT NULL
UNION ALL SELECT 1, '02_mart_latest', 1
UNION ALL SELECT 2, '03_mart_mix_7d', 8"""

ORACLE["stream_cycle"] = with_grid("""
SELECT epoch_us(date_heure) AS micros, CAST(consommation AS INTEGER) AS consommation,
  CAST(solaire AS INTEGER) AS solaire, nature FROM grid""")

ORACLE["stream_after_batch"] = with_grid("""
SELECT epoch_us(date_heure) AS micros, CAST(consommation AS INTEGER) AS consommation,
  CAST(solaire AS INTEGER) AS solaire, nature, CAST(2 AS BIGINT) AS runs FROM grid""")
ORACLE["stream_mixed_files"] = with_grid("""
SELECT epoch_us(date_heure) AS micros, CAST(consommation AS INTEGER) AS consommation,
  CAST(solaire AS INTEGER) AS solaire, nature, CAST(1 AS BIGINT) AS refused FROM grid""")

ORACLE["landed_window"] = with_grid("""
SELECT source, epoch_us(date_heure) AS micros, CAST(gaz AS INTEGER) AS gaz
FROM grid, (VALUES ('exports'), ('lines')) AS sources(source)
WHERE date_heure >= TIMESTAMP '2024-01-09 06:00:00' AND date_heure < TIMESTAMP '2024-01-12'""")

# -- ledger and read queries ------------------------------------------------------------------------------------------

FOLD_CTE = """
latest AS (
  SELECT conv_id AS run_id, turn, role AS status, CAST(length(text) AS INTEGER) AS rows_fetched,
    CASE WHEN turn % 2 = 0 THEN CAST(length(text) % 100 AS INTEGER) END AS rows_inserted,
    CASE WHEN turn % 3 <> 0 THEN text END AS error,
    1704067200 + conv_id * 60 AS started, 1704067200 + conv_id * 60 + turn AS finished
  FROM conversations
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1
)"""

_RUN_COLUMNS = "run_id, status, rows_fetched, rows_inserted, error"
ORACLE["ledger_fold"] = f"WITH {FOLD_CTE} SELECT {_RUN_COLUMNS} FROM latest"
ORACLE["last_runs"] = f"{ORACLE['ledger_fold']} ORDER BY run_id DESC LIMIT 20"
ORACLE["read_runs"] = f"""WITH {FOLD_CTE}
SELECT run_id, finished AS finished_at, status FROM latest ORDER BY run_id DESC LIMIT 50"""

ORACLE["read_health"] = f"""WITH {FOLD_CTE},
newest AS (SELECT max(ts) AS last FROM events WHERE value IS NOT NULL),
lagged AS (
  SELECT last, CAST(epoch_us(TIMESTAMP '2024-02-03') - epoch_us(last) AS DOUBLE)
    / 3600000000.0::DOUBLE AS lag FROM newest
)
SELECT CASE WHEN lag > 48 THEN 'stale' ELSE 'ok' END AS status, {stamp('last')} AS last_observed,
  round(lag, 1) AS lag_hours, run_id, latest.status AS run_status, finished AS run_finished
FROM lagged, (SELECT * FROM latest ORDER BY run_id DESC LIMIT 1) AS latest"""

ORACLE["read_status"] = with_grid(f"""
SELECT count(*) AS raw_rows, {stamp('max(date_heure) FILTER (consommation IS NOT NULL)')}
  AS last_observed,
  greatest(CAST(epoch_us(TIMESTAMP '2024-01-31')
    - epoch_us(max(date_heure) FILTER (consommation IS NOT NULL)) AS DOUBLE)
    / 3600000000.0::DOUBLE, 0.0) AS lag_hours
FROM grid""")

ORACLE["status_lines"] = f"""WITH {FOLD_CTE}
SELECT run_id, started AS started_at, status, rows_fetched, coalesce(rows_inserted, 0)
  AS rows_inserted, CAST(0 AS INTEGER) AS rows_updated, substr(coalesce(error, ''), 1, 60) AS error
FROM latest ORDER BY run_id DESC LIMIT 10"""

# -- changes, versions, dependent marts and rows told apart by two columns ------------------------------------------

ORACLE["payload_split"] = r"""
SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS pos, '[' || event_type || '} "' || event_id || '\' AS note,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS problem
FROM events"""

_LATE, _NEW = "ts >= TIMESTAMP '2024-01-19'", "ts >= TIMESTAMP '2024-01-20'"
_REVISED = f"CASE WHEN {_LATE} AND event_type = 'error' THEN value + 2 WHEN {_LATE} THEN value + 1 ELSE value END"
_CHANGE = f"CASE WHEN {_NEW} THEN 'inserted' WHEN {_LATE} THEN 'updated' ELSE 'unchanged' END"
_BEFORE = f"CASE WHEN {_LATE} AND NOT {_NEW} THEN value END"

ORACLE["upsert_changes"] = f"""
SELECT event_id, {_CHANGE} AS change,
  CAST(CASE WHEN NOT {_LATE} THEN 0 WHEN event_type = 'error' THEN 2 ELSE 1 END AS BIGINT) AS copies,
  {_BEFORE} AS value_before, {_REVISED} AS value
FROM events"""

ORACLE["change_feed"] = f"""
SELECT 1 AS load, event_id, {_CHANGE} AS change, {_BEFORE} AS value_before, {_REVISED} AS value FROM events WHERE {_LATE}
UNION ALL
SELECT 2, event_id, 'updated', {_REVISED}, CASE WHEN event_type IS DISTINCT FROM 'error' THEN value + 1 END
FROM events WHERE {_LATE}"""

ORACLE["read_beside_publish"] = f"""
SELECT event_id, {stamp('ts')} AS ts, user_id, event_type, value FROM events WHERE NOT {_NEW}"""

ORACLE["synopsis_reads"] = f"""
WITH held AS (
  SELECT ts, CASE WHEN NOT {_LATE} THEN value WHEN event_type IS DISTINCT FROM 'error' THEN value + 1 END AS value FROM events
)
SELECT 'rows' AS fact, count(*) AS n FROM held
UNION ALL SELECT 'newest', max(epoch_us(ts)) FILTER (value IS NOT NULL) FROM held
UNION ALL SELECT CAST({paris_day('ts')} AS VARCHAR), count(*) FROM held WHERE value IS NOT NULL GROUP BY 1"""

EVENT_GRID_CTE = """
valued AS (SELECT *, CAST(round(value * 100) AS INTEGER) AS mw FROM events),
event_grid AS (
  SELECT ts AS date_heure, CAST(event_id AS INTEGER) AS event_id, NULL AS fioul, NULL AS charbon, NULL AS bioenergies,
    CASE WHEN event_type = 'view' THEN mw ELSE 0 END AS nucleaire, CASE WHEN event_type = 'click' THEN mw ELSE 0 END AS eolien,
    CASE WHEN event_type = 'purchase' THEN mw ELSE 0 END AS solaire,
    CASE WHEN event_type = 'signup' THEN mw ELSE 0 END AS hydraulique, CASE WHEN event_type = 'error' THEN mw ELSE 0 END AS gaz,
    CASE WHEN user_id % 10 <> 0 THEN 'measured' ELSE 'forecast' END AS nature,
    CASE WHEN user_id % 10 <> 0 THEN CAST(mw + event_id % 7 AS INTEGER) END AS consommation,
    CASE WHEN event_id % 5 <> 0 THEN user_id % 60 END AS taux_co2
  FROM valued
)"""

ORACLE["mart_daily_delta"] = f"""WITH {EVENT_GRID_CTE},
kept AS (
  SELECT * REPLACE (CASE
    WHEN date_heure >= TIMESTAMP '2024-01-20' OR event_id % 3 <> 0 THEN consommation
    WHEN event_id % 11 <> 0 AND consommation < 40000 THEN consommation + 1
    WHEN event_id % 11 <> 0 THEN 1 END AS consommation)
  FROM event_grid
)
{daily('kept')}"""

for _name in ("event_cycle", "event_stream"):
    ORACLE[_name] = f"""WITH {EVENT_GRID_CTE}
SELECT epoch_us(date_heure) AS micros, event_id, consommation, nature FROM event_grid"""

_CYCLE_GRID = f"""{GRID_CTE},
loaded AS (SELECT * FROM grid WHERE date_heure >= TIMESTAMP '2024-01-01' AND date_heure < TIMESTAMP '2024-02-01 12:00:00')"""

ORACLE["marts_dependent"] = f"""WITH {_CYCLE_GRID},
days AS (SELECT *, substr(day, 1, 7) AS of_month FROM ({daily('loaded')})),
months AS (
  SELECT of_month, CAST(sum(quarters_observed) AS BIGINT) AS quarters, max(peak_consumption_mw) AS peak,
    sum(energy_consumed_mwh) AS energy
  FROM days GROUP BY of_month
)
SELECT of_month, day, quarters, peak, energy FROM days JOIN months USING (of_month) WHERE peak_consumption_mw = peak"""

ORACLE["landed_index"] = with_grid("""
SELECT epoch_us(date_heure) AS micros, CAST(gaz AS INTEGER) AS gaz,
  CAST(count(DISTINCT CAST(date_heure AS DATE)) OVER () AS INTEGER) AS opened
FROM grid WHERE date_heure >= TIMESTAMP '2024-01-09 06:00:00' AND date_heure < TIMESTAMP '2024-01-12'""")

ORACLE["ledger_compacted"] = ORACLE["ledger_fold"]

ORACLE["run_report"] = f"""WITH {_CYCLE_GRID}
SELECT '# run 1' AS line
UNION ALL SELECT '- window: 2024-01-01 00:00 -> 2024-02-01 12:00 UTC'
UNION ALL SELECT '- fetched ' || count(*) || ' · rejected 0 · inserted ' || count(*) || ' · updated 0' FROM loaded
UNION ALL SELECT '- marts rebuilt: 01_mart_daily, 02_mart_latest, 03_mart_mix_7d'"""

_KINDS = {"timestamp": "timestamp", "integer": "int", "text": "string"}
_KNOWN = {"date_heure", "nature", "consommation", "prevision_j", "taux_co2", *PRODUCED, *FLOWS}


def _filled(name: str) -> str:
    return f"count({name})" if name in _KNOWN else "count(*)" if name in ("perimetre", "ingested_at") else "count(NULL)"


ORACLE["raw_schema"] = f"WITH {_CYCLE_GRID}\n" + " UNION ALL ".join(
    f"SELECT '{name}' AS name, '{kind}' AS type, CAST({_filled(name)} AS BIGINT) AS filled FROM loaded"
    for name, kind in [*[(f.name, _KINDS[f.kind]) for f in GRID.fields], ("ingested_at", "timestamp")]
)

ORACLE["contract_null_key"] = """
SELECT event_id AS seq, CASE event_id % 5
  WHEN 2 THEN '<no ts>: field ''ts'': Invalid isoformat string: '''''
  WHEN 3 THEN 'soon: field ''ts'': Invalid isoformat string: ''soon'''
  WHEN 4 THEN '2024-01-01T00:00:00Z: k must not be null' ELSE '<no ts>: ts must not be null' END AS reject
FROM events"""
