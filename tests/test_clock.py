from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest

from gridtide.functions import clock

# Walls in the gaps and overlaps of several zones, a fraction, and moments before 1970.
WALLS = [
    "2024-03-31 02:30:00", "2024-10-27 02:30:00", "2024-03-10 02:15:00.5", "2024-11-03 01:45:00",
    "2026-07-14 12:00:00.000001", "1969-12-31 23:59:59.25", "1995-01-01 00:00:00",
]
ZONES = ["UTC", "Europe/Paris", "America/Los_Angeles", "Asia/Kolkata"]


@pytest.fixture(params=ZONES)
def zoned(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield spark
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_wall_clocks_know_no_session_zone(zoned):
    rows = zoned.createDataFrame([(w,) for w in WALLS], "t string").selectExpr(
        "t", "CAST(t AS timestamp_ntz) AS w"
    )
    back = clock.wall_from_micros(clock.micros("w", clock.WALL))
    got = rows.selectExpr(
        "t", f"{clock.micros('w', clock.WALL)} AS us", f"CAST({back} AS string) AS back",
        f"{clock.text('w')} AS text", f"{clock.iso_text('w')} AS iso",
        f"CAST({clock.utc_day('w', clock.WALL)} AS string) AS day",
        f"unix_micros({clock.from_micros(clock.micros('w', clock.WALL), clock.INSTANT)}) AS via",
    ).collect()
    for row in got:
        moment = datetime.fromisoformat(row["t"]).replace(tzinfo=timezone.utc)
        assert row["us"] == row["via"] == clock.micros_of(moment), row
        assert row["back"] == row["t"]
        assert row["text"] == str(moment)
        assert datetime.fromisoformat(row["iso"]) == moment
        assert row["day"] == str(moment.date())


def test_instants_and_literals(zoned):
    moments = [datetime.fromisoformat(w).replace(tzinfo=timezone.utc) for w in WALLS]
    rows = zoned.createDataFrame([(clock.micros_of(m),) for m in moments], "us bigint").selectExpr(
        "us", "timestamp_micros(us) AS t"
    )
    got = rows.selectExpr(
        "us", f"{clock.micros('t', clock.INSTANT)} AS back", f"{clock.text(clock.utc_wall('t', clock.INSTANT))} AS text",
    ).collect()
    assert all(row["us"] == row["back"] for row in got)
    assert sorted(row["text"] for row in got) == sorted(str(m) for m in moments)
    kept = rows.where(f"t = {clock.literal(moments[0], clock.INSTANT)}")
    assert kept.count() == 1


def test_local_days_across_both_clock_changes(zoned):
    spring, autumn = datetime(2024, 3, 31, tzinfo=timezone.utc), datetime(2024, 10, 27, tzinfo=timezone.utc)
    for day, quarters in ((spring, 92), (autumn, 100)):
        first = clock.micros_of(day - timedelta(days=1))
        rows = zoned.range(0, 96 * 3).selectExpr(f"timestamp_micros({first}L + id * 900000000L) AS t")
        held = rows.where(f"{clock.local_day('t', clock.INSTANT)} = DATE'{day.date()}'").count()
        assert held == quarters


def test_naive_moments_are_refused():
    with pytest.raises(ValueError):
        clock.micros_of(datetime(2024, 1, 1))
    assert clock.moment_of(None) is None
