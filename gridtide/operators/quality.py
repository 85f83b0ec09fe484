"""The quality gate: named checks with severities, folded into a status.

A check is one row of ``CHECK``. ``detail`` is for people; ``counted``,
``total`` and ``measure`` carry the same facts as numbers. All batch checks
except key uniqueness come out of one map-side-combined aggregate, which the write of the batch can observe.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gridtide.functions import clock, text
from gridtide.operators import synopsis
from gridtide.operators.contract import GRID, Field, Layout, observed

CHECK = (
    "position int, name string, passed boolean, severity string, detail string, "
    "counted bigint, total bigint, measure double"
)

# Report order, tolerated reject ratio, quarter-hours of a whole local day
# (96, or 92/100 on the days the clock changes) and number of shown examples.
ORDER = (
    "contract_coercion",
    "window_not_empty",
    "primary_key_unique",
    "quarter_hour_grid",
    "plausible_ranges",
    "grid_balance",
    "freshness",
    "day_completeness",
)
REJECT_RATIO = 0.05
WHOLE_DAYS = (92, 96, 100)
EXAMPLES = 3
ICONS = {"pass": "✅", "warn": "⚠️", "fail": "🛑"}


def _check(
    name: str,
    passed: str,
    severity: str,
    detail: str,
    counted: str = "NULL",
    total: str = "NULL",
    measure: str = "NULL",
) -> str:
    """A check as a struct over the columns of a one-row summary."""
    return f"""named_struct('position', {ORDER.index(name) + 1}, 'name', '{name}',
        'passed', {passed}, 'severity', {severity}, 'detail', {detail},
        'counted', CAST({counted} AS bigint), 'total', CAST({total} AS bigint),
        'measure', CAST({measure} AS double))"""


def _emit(summary: DataFrame, *checks: str) -> DataFrame:
    """One summary row -> one row per check."""
    return summary.selectExpr(f"inline(array({', '.join(checks)}))")


def _facts(rows: DataFrame, *facts: str) -> DataFrame:
    return rows.agg(*[F.expr(fact) for fact in facts])


# -- contract_coercion and window_not_empty ---------------------------------------


# Facts are plain aggregates without FILTER, so that a write can observe them on its way.


def _first(value: str, seq: str, kept: str) -> str:
    """The value that arrived first among the rows kept."""
    return f"min(CASE WHEN {kept} THEN struct({seq} AS s, {value} AS v) END).v"


def _coercion_facts(reject: str, seq: str, every: str = "true") -> list[str]:
    refused = f"({every} AND {reject} IS NOT NULL)"
    return [
        f"count_if({every}) AS fetched",
        f"count_if({refused}) AS rejected",
        f"{_first(reject, seq, refused)} AS first_reject",
    ]


def _coercion() -> str:
    ratio = "CASE WHEN fetched > 0 THEN CAST(rejected AS double) / CAST(fetched AS double) ELSE 0.0D END"
    return _check(
        "contract_coercion",
        "rejected = 0",
        f"CASE WHEN {ratio} > {REJECT_RATIO}D THEN 'fail' ELSE 'warn' END",
        "concat(rejected, '/', fetched, ' record(s) rejected', "
        "CASE WHEN rejected > 0 THEN concat(' — first: ', first_reject) ELSE '' END)",
        "rejected",
        "fetched",
        ratio,
    )


def _not_empty() -> str:
    detail = "concat(fetched, ' record(s) fetched')"
    return _check("window_not_empty", "fetched > 0", "'warn'", detail, "fetched")


def check_coercion(rows: DataFrame, reject: str = "reject", seq: str = "seq") -> DataFrame:
    return _emit(_facts(rows, *_coercion_facts(reject, seq)), _coercion())


def check_window_not_empty(rows: DataFrame) -> DataFrame:
    return _emit(_facts(rows, "count(1) AS fetched"), _not_empty())


# -- primary_key_unique -------------------------------------------------------------


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys held by more than one row, with the number of rows.

    Counting combines map-side, so a key holding a large part of the rows costs
    one partial row per task rather than one huge group.
    """
    return rows.groupBy(*keys).agg(F.expr("count(1) AS copies")).where("copies > 1")


def _key_facts(rows: DataFrame, keys: list[str]) -> DataFrame:
    facts = _facts(
        duplicate_keys(rows, keys),
        "count(1) AS duplicated",
        f"min(struct({', '.join(keys)})) AS smallest",
    )
    shown = []
    for key in keys:
        dtype = clock.type_of(rows, key)
        value = f"smallest.{key}"
        moment = dtype.typeName().startswith("timestamp")
        shown.append(clock.text(clock.utc_wall(value, dtype)) if moment else value)
    return facts.selectExpr("duplicated", f"concat_ws(', ', {', '.join(shown)}) AS first_duplicate")


def _unique() -> str:
    detail = (
        "concat(duplicated, ' duplicated timestamp(s)', "
        "CASE WHEN duplicated > 0 THEN concat(' — e.g. ', first_duplicate) ELSE '' END)"
    )
    return _check("primary_key_unique", "duplicated = 0", "'fail'", detail, "duplicated")


def check_primary_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    return _emit(_key_facts(rows, keys), _unique())


# -- quarter_hour_grid ----------------------------------------------------------------


def off_grid(wall: str) -> str:
    """Minute and second off the quarter-hour; fractions of a second do not count."""
    return f"(minute({wall}) % 15 <> 0 OR second({wall}) <> 0)"


def _alignment_facts(wall: str, seq: str, kept: str) -> list[str]:
    bad = f"({kept} AND {off_grid(wall)})"
    return [f"count_if({bad}) AS off_grid", f"{_first(wall, seq, bad)} AS first_off_grid"]


def _aligned() -> str:
    detail = (
        "concat(off_grid, ' timestamp(s) off the quarter-hour grid', CASE WHEN off_grid > 0 "
        f"THEN concat(' — e.g. ', {clock.text('first_off_grid')}) ELSE '' END)"
    )
    return _check("quarter_hour_grid", "off_grid = 0", "'warn'", detail, "off_grid")


def check_alignment(rows: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    wall = clock.utc_wall(key, clock.type_of(rows, key))
    return _emit(_facts(rows, *_alignment_facts(wall, seq, "true")), _aligned())


# -- plausible_ranges -------------------------------------------------------------------


def outside(field: Field) -> str:
    """False or null unless the value is out of its inclusive bounds."""
    return f"({field.name} < {field.lo} OR {field.name} > {field.hi})"


def range_violations(rows: DataFrame, fields: list[Field]) -> DataFrame:
    """Violations per bounded field: conditional counts in one pass, then turned long.

    Rows are never multiplied by the number of fields.
    """
    wide = _facts(rows, *[f"count_if({outside(f)}) AS {f.name}" for f in fields])
    return wide.unpivot([], [field.name for field in fields], "field", "violations")


def _range_facts(fields: list[Field], kept: str) -> list[str]:
    per_row = " + ".join(f"if({outside(f)}, 1, 0)" for f in fields) or "0"
    return [f"coalesce(sum(CASE WHEN {kept} THEN {per_row} END), 0) AS out_of_range"]


def range_examples(
    rows: DataFrame, fields: list[Field], key: str, seq: str, limit: int = EXAMPLES
) -> DataFrame:
    """The first violations by field, then arrival: a top-``limit`` over violating rows only."""
    wall = clock.utc_wall(key, clock.type_of(rows, key))
    cells = ", ".join(
        f"if({outside(f)}, named_struct('rank', {rank}, 'field', '{f.name}', "
        f"'value', CAST({f.name} AS string)), NULL)"
        for rank, f in enumerate(fields)
    ) or "CAST(NULL AS struct<rank: int, field: string, value: string>)"
    return (
        rows.where(" OR ".join(outside(field) for field in fields) or "false")
        .selectExpr(
            f"{seq} AS _seq", f"{clock.text(wall)} AS at", f"inline(array_compact(array({cells})))"
        )
        .orderBy("rank", "_seq")
        .limit(limit)
    )


def _example_facts(examples: DataFrame) -> DataFrame:
    line = "concat(field, '=', value, ' at ', at)"
    shown = f"array_sort(collect_list(struct(rank, _seq, {line} AS line)))"
    return _facts(examples, f"array_join(transform({shown}, e -> e.line), '; ') AS examples")


def _plausible() -> str:
    detail = (
        "concat(out_of_range, ' value(s) outside plausible bounds', "
        "CASE WHEN out_of_range > 0 THEN concat(' — ', examples) ELSE '' END)"
    )
    return _check("plausible_ranges", "out_of_range = 0", "'warn'", detail, "out_of_range")


def check_ranges(rows: DataFrame, fields: list[Field], key: str, seq: str = "seq") -> DataFrame:
    facts = _facts(rows, *_range_facts(fields, "true"))
    examples = _example_facts(range_examples(rows, fields, key, seq))
    return _emit(one_row([facts, examples]), _plausible())


# -- grid_balance ---------------------------------------------------------------------------


def balance_deviation(layout: Layout = GRID) -> str:
    """Percent by which supply misses consumption.

    Null unless the row is observed, its consumption is not zero and every part is known.
    """
    used = layout.consumption
    if not layout.parts:
        return "CAST(NULL AS double)"
    supply = " + ".join(f"CAST({part} AS bigint)" for part in layout.parts)
    gap = f"CAST(abs({supply} - {used}) AS double)"
    return f"CASE WHEN {used} <> 0 THEN {gap} / CAST({used} AS double) * 100.0D END"


def balance_rows(rows: DataFrame, layout: Layout = GRID, tolerance_pct: float = 5.0) -> DataFrame:
    """Checked rows with their deviation and verdict."""
    deviation = rows.selectExpr(layout.key, f"{balance_deviation(layout)} AS deviation_pct")
    return deviation.where("deviation_pct IS NOT NULL").selectExpr(
        "*", f"deviation_pct > {float(tolerance_pct)}D AS beyond"
    )


def _balance_facts(layout: Layout, tolerance_pct: float, kept: str) -> list[str]:
    deviation = f"CASE WHEN {kept} THEN {balance_deviation(layout)} END"
    return [
        f"count({deviation}) AS checked",
        f"count_if({deviation} > {float(tolerance_pct)}D) AS beyond",
        f"greatest(max({deviation}), 0.0D) AS worst",
    ]


def _balanced(tolerance_pct: float) -> str:
    detail = (
        f"concat(checked, ' row(s) checked, ', beyond, ' beyond ±{tolerance_pct:g}% (worst ', "
        f"{text.one_digit('worst')}, '%)')"
    )
    return _check("grid_balance", "beyond = 0", "'warn'", detail, "beyond", "checked", "worst")


def check_balance(rows: DataFrame, layout: Layout = GRID, tolerance_pct: float = 5.0) -> DataFrame:
    return _emit(_facts(rows, *_balance_facts(layout, tolerance_pct, "true")), _balanced(tolerance_pct))


# -- freshness and day_completeness -------------------------------------------------------------


def newest_observed(raw: DataFrame, layout: Layout = GRID) -> DataFrame:
    """One row: ``last`` (UTC wall clock) and ``last_micros`` of the newest observed key."""
    dtype = clock.type_of(raw, layout.key)
    newest = f"max({layout.key}) FILTER (WHERE {observed(layout.consumption)})"
    return _facts(
        raw,
        f"{clock.utc_wall(newest, dtype)} AS last",
        f"{clock.micros(newest, dtype)} AS last_micros",
    )


def lag_hours(last_micros: str, now: datetime) -> str:
    """Hours from an instant to ``now``, never negative; null without an instant."""
    lag = f"CAST({clock.micros_of(now)}L - {last_micros} AS double) / 3600000000.0D"
    return f"CASE WHEN {last_micros} IS NOT NULL THEN greatest({lag}, 0.0D) END"


def _fresh(now: datetime, warn_hours: float, fail_hours: float) -> str:
    lag = lag_hours("last_micros", now)
    detail = f"""CASE WHEN last IS NULL THEN 'no observed rows in the warehouse' ELSE
        concat('last observed quarter-hour ', {clock.minute_text('last')}, ' UTC (',
               {text.one_digit(f'({lag})')}, ' h ago)') END"""
    return _check(
        "freshness",
        f"coalesce({lag} <= {float(warn_hours)}D, false)",
        f"CASE WHEN {lag} <= {float(fail_hours)}D THEN 'warn' ELSE 'fail' END",
        detail,
        measure=lag,
    )


def check_freshness(
    raw: DataFrame,
    now: datetime,
    warn_hours: float = 6.0,
    fail_hours: float = 48.0,
    layout: Layout = GRID,
) -> DataFrame:
    return _emit(newest_observed(raw, layout), _fresh(now, warn_hours, fail_hours))


def observed_days(raw: DataFrame, layout: Layout = GRID, zone: str = clock.PARIS) -> DataFrame:
    day = clock.local_day(layout.key, clock.type_of(raw, layout.key), zone)
    rows = raw.where(observed(layout.consumption))
    return rows.groupBy(F.expr(f"{day} AS day")).agg(F.expr("count(1) AS quarters"))


def _completeness_facts(raw: DataFrame, layout: Layout) -> DataFrame:
    """The second newest local day that has observed rows; nulls without one."""
    finished = observed_days(raw, layout).orderBy(F.desc("day")).offset(1).limit(1)
    return _facts(finished, *_FINISHED)


_FINISHED = ("max(day) AS day", "max(quarters) AS quarters")


def _complete() -> str:
    detail = """CASE WHEN day IS NULL THEN 'not enough history for a finished day yet' ELSE
        concat(day, ': ', quarters, ' observed quarter-hour(s) (expected 96, DST days 92/100)') END"""
    passed = f"coalesce(quarters IN {WHOLE_DAYS}, true)"
    return _check("day_completeness", passed, "'warn'", detail, "quarters")


def check_completeness(raw: DataFrame, layout: Layout = GRID) -> DataFrame:
    return _emit(_completeness_facts(raw, layout), _complete())


# -- assembly ---------------------------------------------------------------------------------------


def one_row(parts: list[DataFrame]) -> DataFrame:
    """Several one-row frames with different columns -> one row holding all of them."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return _facts(stacked, *[f"max({name}) AS {name}" for name in stacked.columns])


def batch_facts(
    rows: DataFrame,
    layout: Layout = GRID,
    tolerance_pct: float = 5.0,
    reject: str = "reject",
    seq: str = "seq",
    every: str = "true",
) -> list[str]:
    """What the batch checks need of all rows but keys and examples, as aggregates over the rows for which ``every`` holds."""
    ok = f"({every} AND {reject} IS NULL)"
    seen = f"({ok} AND {observed(layout.consumption)})"
    wall = clock.utc_wall(layout.key, clock.type_of(rows, layout.key))
    return [
        *_coercion_facts(reject, seq, every),
        *_alignment_facts(wall, seq, ok),
        *_range_facts(layout.bounded, seen),
        *_balance_facts(layout, tolerance_pct, seen),
    ]


def observe_batch(rows: DataFrame, observation: Observation, **options) -> DataFrame:
    """``rows``, with the facts of :func:`batch_facts` noted by the first action on them."""
    return rows.observe(observation, *[F.expr(fact) for fact in batch_facts(rows, **options)])


def observed_facts(rows: DataFrame, observation: Observation, **options) -> DataFrame:
    """The facts that :func:`observe_batch` noted, as the one row that a second read would give."""
    schema = _facts(rows, *batch_facts(rows, **options)).schema
    noted = observation.get
    return rows.sparkSession.createDataFrame([tuple(noted[name] for name in schema.names)], schema)


def batch_checks(
    rows: DataFrame,
    layout: Layout = GRID,
    tolerance_pct: float = 5.0,
    reject: str = "reject",
    seq: str = "seq",
    facts: DataFrame | None = None,
) -> DataFrame:
    """The six checks a batch must face before anything is loaded.

    ``rows`` holds accepted and rejected records alike, as the contract leaves them. Pass a written batch: it is read
    for keys and examples, and, unless the write has observed them (:func:`observed_facts`), for ``facts``, each time
    with only the columns that are needed.
    """
    ok = f"{reject} IS NULL"
    seen = f"({ok} AND {observed(layout.consumption)})"
    if facts is None:
        facts = _facts(rows, *batch_facts(rows, layout, tolerance_pct, reject, seq))
    examples = range_examples(rows.where(seen), layout.bounded, layout.key, seq)
    summary = one_row([facts, _key_facts(rows.where(ok), layout.unique), _example_facts(examples)])
    return _emit(
        summary,
        _coercion(),
        _not_empty(),
        _unique(),
        _aligned(),
        _plausible(),
        _balanced(tolerance_pct),
    )


def warehouse_checks(
    raw: DataFrame,
    now: datetime,
    warn_hours: float = 6.0,
    fail_hours: float = 48.0,
    layout: Layout = GRID,
) -> DataFrame:
    """The two checks on the stored table after a load."""
    summary = one_row([newest_observed(raw, layout), _completeness_facts(raw, layout)])
    return _emit(summary, _fresh(now, warn_hours, fail_hours), _complete())


def stored_checks(
    held: DataFrame, now: datetime, warn_hours: float = 6.0, fail_hours: float = 48.0
) -> DataFrame:
    """The same two checks from the table's synopsis, whatever the history."""
    finished = synopsis.observed_days(held).orderBy(F.desc("day")).offset(1).limit(1)
    summary = one_row([synopsis.newest(held), _facts(finished, *_FINISHED)])
    return _emit(summary, _fresh(now, warn_hours, fail_hours), _complete())


# -- report -------------------------------------------------------------------------------------------


def _status() -> str:
    return """CASE WHEN coalesce(bool_or(NOT passed AND severity = 'fail'), false) THEN 'fail'
        WHEN coalesce(bool_or(NOT passed), false) THEN 'warn' ELSE 'pass' END AS status"""


def status(checks: DataFrame) -> DataFrame:
    """One row: ``fail`` over ``warn`` over ``pass``."""
    return _facts(checks, _status())


def failures(checks: DataFrame) -> DataFrame:
    return checks.where("NOT passed")


def report(checks: DataFrame) -> DataFrame:
    """One row: ``status``, the ordered ``checks`` (at most eight), ``markdown`` and ``json``."""
    columns = "position, name, passed, severity, detail, counted, total, measure"
    listed = f"array_sort(collect_list(struct({columns}))) AS checks"
    line = (
        "c -> concat('| ', c.name, ' | ', if(c.passed, 'ok', upper(c.severity)), ' | ', c.detail, ' |')"
    )
    icons = ", ".join(f"'{state}', '{icon}'" for state, icon in ICONS.items())
    head = f"concat('## Data quality — ', map({icons})[status], ' ', upper(status))"
    frame = f"array({head}, '', '| check | result | detail |', '|---|---|---|')"
    plain = (
        "transform(checks, c -> named_struct('name', c.name, 'passed', c.passed, "
        "'severity', c.severity, 'detail', c.detail))"
    )
    return _facts(checks, _status(), listed).selectExpr(
        "status",
        "checks",
        f"array_join(concat({frame}, transform(checks, {line})), '\\n') AS markdown",
        f"to_json(named_struct('status', status, 'checks', {plain})) AS json",
    )


def markdown(checks: DataFrame) -> DataFrame:
    return report(checks).select("markdown")


def json(checks: DataFrame) -> DataFrame:
    return report(checks).select("json")
