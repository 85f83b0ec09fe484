from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F
from records import OBSERVED, WINDOW, at, quarters, record, stored

from gridtide.functions import clock
from gridtide.operators import marts

# Hand-computed marts of the measured records.
DAILY = {
    "observed": (OBSERVED, 3, 48472, 48586, 36354, 28108, 1719, 12683, 2562, 284, 26, 745, 38.4, 11.3),
    "window": (WINDOW, 4, 40819, 41716, 40819, 36320, 5930, 0, 4138, 4359, 34, 1012, 21.4, 46.0),
}
MIX = {
    "observed": {"nuclear": 60.9, "solar": 27.5, "hydro": 5.6, "wind": 3.7, "bioenergy": 1.6,
                 "gas": 0.6, "oil": 0.1, "coal": 0.0},
    "window": {"nuclear": 70.1, "wind": 11.4, "gas": 8.4, "hydro": 8.0, "bioenergy": 2.0,
               "oil": 0.1, "coal": 0.0, "solar": 0.0},
}


@pytest.mark.parametrize("name", DAILY)
def test_daily_of_measured_records(spark, name):
    records, *expected = DAILY[name]
    (row,) = marts.daily(stored(spark, records)).collect()
    assert row["day"] == date(2026, 7, 14)
    assert list(row)[1:] == expected


@pytest.mark.parametrize("name", MIX)
def test_mix_of_measured_records(spark, name):
    mart = marts.in_order("03_mart_mix_7d", marts.mix_7d(stored(spark, DAILY[name][0])))
    rows = mart.collect()
    assert [(row["source"], row["share_pct"]) for row in rows] == list(MIX[name].items())
    assert abs(sum(row["share_pct"] for row in rows) - 100) < 1


def test_daily_arithmetic(spark):
    powers = {"nucleaire": 40_000, "eolien": 4_000, "solaire": 6_000, "hydraulique": 2_000,
              "gaz": 1_000, "fioul": 0, "charbon": 0, "bioenergies": 1_000}
    rows = [
        record(at(2026, 7, 13, 10), consommation=50_000, taux_co2=20, **powers),
        record(at(2026, 7, 13, 10, 15), consommation=54_000, taux_co2=30, **powers),
    ]
    (row,) = marts.daily(stored(spark, rows)).collect()
    assert (row["quarters_observed"], row["avg_consumption_mw"]) == (2, 52_000)
    assert (row["peak_consumption_mw"], row["energy_consumed_mwh"]) == (54_000, 26_000)
    assert (row["nuclear_mwh"], row["renewable_share_pct"], row["avg_co2_g_kwh"]) == (20_000, 24.1, 25.0)


@pytest.mark.parametrize("zone", ["UTC", "Europe/Paris", "America/Los_Angeles"])
def test_days_split_at_paris_midnight(spark, zone):
    rows = stored(spark, [record(at(2026, 7, 13, 21, 45)), record(at(2026, 7, 13, 22))])
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        days = [row["day"] for row in marts.daily(rows).orderBy("day").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert days == [date(2026, 7, 13), date(2026, 7, 14)]


def test_wall_clock_input_gives_the_same_days(spark):
    rows = stored(spark, quarters(at(2026, 3, 28, 20), 40))
    wall = rows.withColumn("date_heure", F.expr(clock.utc_wall("date_heure", clock.INSTANT)))
    assert marts.daily(rows).orderBy("day").collect() == marts.daily(wall).orderBy("day").collect()


def test_forecasts_stay_out(spark):
    rows = stored(spark, [record(at(2026, 7, 13, 10)), record(at(2026, 7, 13, 11), consommation=None)])
    (row,) = marts.daily(rows).collect()
    assert row["quarters_observed"] == 1
    (last,) = marts.latest(rows).selectExpr("unix_micros(date_heure)").collect()
    assert clock.moment_of(last[0]) == at(2026, 7, 13, 10)


def test_latest_derives_totals(spark):
    newest = record(
        at(2026, 7, 13, 12), consommation=50_000, nucleaire=30_000, eolien=5_000, solaire=10_000,
        hydraulique=4_000, gaz=500, fioul=250, charbon=250, bioenergies=0, taux_co2=None,
    )
    (row,) = marts.latest(stored(spark, [record(at(2026, 7, 13, 10)), newest])).collect()
    assert (row["consumption_mw"], row["production_total_mw"]) == (50_000, 50_000)
    assert (row["renewable_share_pct"], row["oil_coal_mw"], row["co2_g_kwh"]) == (38.0, 500, None)
    assert (row["pumped_storage_mw"], row["net_exchange_mw"]) == (-2242, -10140)


def test_nulls_and_zero_production(spark):
    none = dict.fromkeys(
        ["nucleaire", "eolien", "solaire", "hydraulique", "gaz", "fioul", "charbon", "bioenergies"]
    )
    rows = stored(spark, [record(**none)])
    assert marts.daily(rows).first()["renewable_share_pct"] is None
    assert marts.latest(rows).first()["renewable_share_pct"] is None
    mix = marts.mix_7d(rows).collect()
    assert len(mix) == 8 and all(row["share_pct"] is None and row["mwh"] == 0 for row in mix)


def test_nothing_observed_gives_empty_marts(spark):
    rows = stored(spark, [record(consommation=None)])
    assert [build(rows).count() for _, build in marts.MARTS] == [0, 0, 0]


def test_seven_days_are_closed_at_the_old_end(spark):
    end = at(2026, 7, 14, 12)
    keys = [end, at(2026, 7, 7, 12), at(2026, 7, 7, 11, 45)]
    rows = stored(spark, [record(key) for key in keys])
    assert marts.last_days(rows).count() == 2


def test_seven_days_are_168_hours_across_a_clock_change(paris):
    keys = [at(2026, 3, 31, 12), at(2026, 3, 24, 12), at(2026, 3, 24, 11, 45)]
    assert marts.last_days(stored(paris, [record(key) for key in keys])).count() == 2


def test_long_form_matches_shares(spark):
    rows = stored(spark, WINDOW)
    long = {row["source"]: row["mw"] for row in marts.mix_long(rows).collect()}
    assert long["nuclear"] == sum(r["nucleaire"] for r in WINDOW)
    assert set(long) == set(MIX["window"])
