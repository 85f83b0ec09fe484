from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from records import BASE, WINDOW, at, quarters, record, stored

from gridtide.operators.incremental import Params, as_utc, collect_window, compute_window, watermark
from gridtide.sources import landing

NOW = BASE


def mark(spark, rows):
    return watermark(stored(spark, rows))


def test_watermark_ignores_forecasts(spark):
    rows = [record(BASE), record(BASE + timedelta(hours=6), consommation=None)]
    assert mark(spark, rows).select(F.unix_micros("watermark")).first()[0] == int(BASE.timestamp()) * 10**6
    assert mark(spark, []).first()["watermark"] is None


@pytest.mark.parametrize("zone", ["UTC", "Europe/Paris"])
def test_window_shapes(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        empty, held = mark(spark, []), mark(spark, [record(NOW - timedelta(hours=3))])
        end = NOW + timedelta(hours=36)
        assert collect_window(compute_window(empty, NOW)) == (NOW - timedelta(hours=72), end)
        assert collect_window(compute_window(held, NOW)) == (NOW - timedelta(hours=27), end)
        since = NOW - timedelta(days=30)
        assert collect_window(compute_window(held, NOW, since)) == (since, end)
        wide = Params(overlap_hours=1, horizon_hours=2, bootstrap_hours=3)
        assert collect_window(compute_window(held, NOW, params=wide)) == (
            NOW - timedelta(hours=4), NOW + timedelta(hours=2),
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("name", ["bootstrap_hours", "overlap_hours", "horizon_hours"])
def test_hours_must_be_positive(name):
    with pytest.raises(ValueError, match=name):
        Params(**{name: 0})


def test_parameters_from_environment_and_arguments(monkeypatch):
    monkeypatch.setenv("GRIDTIDE_BOOTSTRAP_HOURS", "120")
    monkeypatch.setenv("GRIDTIDE_OVERLAP_HOURS", "48")
    loaded = Params.load(overlap_hours=6, horizon_hours=None)
    assert (loaded.bootstrap_hours, loaded.overlap_hours, loaded.horizon_hours) == (120, 6, 36)
    monkeypatch.setenv("GRIDTIDE_HORIZON_HOURS", "soon")
    with pytest.raises(ValueError, match="horizon_hours"):
        Params.load()
    with pytest.raises(ValueError, match="speed"):
        Params.load(horizon_hours=1, speed=2)


def test_since_text_without_offset_is_utc():
    assert as_utc("2026-06-01T00:00:00") == at(2026, 6, 1)
    assert as_utc("2026-06-01T02:00:00+02:00") == at(2026, 6, 1)
    with pytest.raises(ValueError):
        as_utc("not-a-date")


def test_scan_is_half_open_ordered_and_in_utc(spark):
    rows = stored(spark, list(reversed(WINDOW)))
    offset = datetime.fromisoformat
    kept = landing.scan_window(
        rows, "date_heure", offset("2026-07-14T02:00:00+02:00"), offset("2026-07-14T02:45:00.9+02:00")
    )
    assert [row["consommation"] for row in kept.collect()] == [41716, 41397, 40449]
    with pytest.raises(ValueError, match="timezone-aware"):
        landing.scan_window(rows, "date_heure", datetime(2026, 7, 14), BASE)


def test_scan_bounds_reach_the_files(spark, tmp_path):
    path = str(tmp_path / "rows")
    stored(spark, quarters(BASE, 8)).write.parquet(path)
    kept = landing.scan_window(spark.read.parquet(path), "date_heure", BASE, BASE + timedelta(hours=1))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(date_heure), GreaterThanOrEqual(date_heure" in plan
    assert kept.count() == 4


PAYLOADS = {
    '[{"a":1},{"a":null}]': None,
    "[]": None,
    '[{"a":1}]\r\n': None,
    '{"message":"down"}\n': "API error: down",
    '  [{"a": {"z": [1, 2.5]}}]  ': None,
    '{"error_code":"E","message":"unexpected token"}': "API error: unexpected token",
    '{"error_code":"E"}': "API error: E",
    '{"message":"","error_code":"E"}': "API error: E",
    "{}": "API error: unknown error",
    '"text"': "unexpected payload shape: string",
    "5": "unexpected payload shape: bigint",
    "null": "unexpected payload shape: void",
    "<html>gateway</html>": "invalid JSON",
    "": "invalid JSON",
    '[{"a":1},{"a":': "invalid JSON",
    '{"a":': "invalid JSON",
    "[{'a':1}]": "invalid JSON",
    '[{"a":1}] x': "invalid JSON",
}


def test_payload_triage(spark):
    df = spark.createDataFrame([(p,) for p in PAYLOADS], "payload string")
    got = {row["payload"]: row for row in landing.triage(df).collect()}
    assert {p: row["problem"] for p, row in got.items()} == PAYLOADS
    assert got['[{"a":1},{"a":null}]']["elements"] == ['{"a":1}', '{"a":null}']


def test_records_keep_arrival_order_and_problems(spark):
    rows = [("f2", '[{"n":3}]'), ("f1", '[{"n":1},{"n":2},5]'), ("f3", "<html>")]
    df = spark.createDataFrame(rows, "origin string, payload string")
    records = landing.explode_records(landing.triage(df)).orderBy("seq")
    assert [row["record"] for row in records.collect()] == ['{"n":1}', '{"n":2}', "5", '{"n":3}', "null"]
    assert landing.first_problem(records) == "invalid JSON"
    assert landing.first_problem(records.where("problem IS NULL")) is None
