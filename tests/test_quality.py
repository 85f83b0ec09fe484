from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from records import BASE, at, frame, parsed, quarters, record, stored

from gridtide.functions import text
from gridtide.operators import quality
from gridtide.operators.contract import GRID, Field


def checks(spark, records, **options):
    rows = quality.batch_checks(parsed(spark, records), **options).collect()
    assert [row["position"] for row in sorted(rows, key=lambda r: r["position"])] == [1, 2, 3, 4, 5, 6]
    return {row["name"]: row for row in rows}


def made(spark, *rows):
    """Check rows (name, passed, severity, detail) in order."""
    full = [(n + 1, *row, 0, 0, 0.0) for n, row in enumerate(rows)]
    return spark.createDataFrame(full, quality.CHECK)


def test_clean_batch_passes(spark):
    batch = quality.batch_checks(parsed(spark, quarters(BASE, 8)))
    report = quality.report(batch).first()
    assert report["status"] == "pass"
    assert quality.failures(batch).count() == 0
    assert [check["name"] for check in report["checks"]] == list(quality.ORDER[:6])
    details = {check["name"]: check["detail"] for check in report["checks"]}
    assert details["contract_coercion"] == "0/8 record(s) rejected"
    assert details["grid_balance"].startswith("8 row(s) checked, 0 beyond ±5% (worst 0.0%)")


def test_rejections_warn_then_fail_on_ratio(spark):
    bad = record(drop=("consommation",))
    warn = checks(spark, quarters(BASE, 40) + [bad])["contract_coercion"]
    assert (warn["passed"], warn["severity"], warn["counted"], warn["total"]) == (False, "warn", 1, 41)
    assert warn["detail"].startswith("1/41 record(s) rejected — first: ")
    fail = checks(spark, quarters(BASE, 40) + [bad] * 5)["contract_coercion"]
    assert (fail["passed"], fail["severity"]) == (False, "fail")
    edge = checks(spark, quarters(BASE, 19) + [bad])["contract_coercion"]
    assert edge["severity"] == "warn", "a ratio of exactly 0.05 only warns"


def test_first_reject_follows_arrival_not_partitions(spark):
    rows = [record(drop=("nucleaire",)), *quarters(BASE, 3), record(drop=("consommation",))]
    shuffled = quality.batch_checks(parsed(spark, rows).orderBy(F.desc("seq")).repartition(5))
    detail = {r["name"]: r["detail"] for r in shuffled.collect()}["contract_coercion"]
    assert "'nucleaire'" in detail


def test_duplicates_fail_and_show_the_smallest(spark):
    later = BASE + timedelta(hours=1)
    check = checks(spark, [record(later), record(later), record(), record(), record()])
    row = check["primary_key_unique"]
    assert (row["passed"], row["severity"], row["counted"]) == (False, "fail", 2)
    assert row["detail"] == "2 duplicated timestamp(s) — e.g. 2026-07-14 12:00:00+00:00"


def test_off_grid_warns_with_the_first_in_arrival_order(spark):
    moved = [BASE + timedelta(minutes=7), BASE + timedelta(minutes=1)]
    row = checks(spark, [record(moment) for moment in moved])["quarter_hour_grid"]
    assert (row["passed"], row["severity"], row["counted"]) == (False, "warn", 2)
    assert row["detail"].endswith("— e.g. 2026-07-14 12:07:00+00:00")


def test_fractions_of_a_second_stay_on_the_grid(spark):
    row = checks(spark, [record(date_heure="2026-07-14T12:15:00.500+00:00")])["quarter_hour_grid"]
    assert row["passed"]


def test_empty_window_warns(spark):
    row = checks(spark, [])
    assert (row["window_not_empty"]["passed"], row["window_not_empty"]["severity"]) == (False, "warn")
    assert row["contract_coercion"]["passed"] and row["grid_balance"]["passed"]
    assert row["plausible_ranges"]["passed"] and row["primary_key_unique"]["passed"]


def test_range_violation_names_the_value(spark):
    row = checks(spark, [record(consommation=200_000)])["plausible_ranges"]
    assert not row["passed"]
    assert row["detail"] == (
        "1 value(s) outside plausible bounds — consommation=200000 at 2026-07-14 12:00:00+00:00"
    )


def test_range_examples_go_by_field_then_arrival(spark):
    rows = [
        record(BASE, gaz=99_999),
        record(BASE + timedelta(minutes=15), gaz=88_888, consommation=1),
        record(BASE + timedelta(minutes=30), taux_co2=999),
    ]
    row = checks(spark, rows)["plausible_ranges"]
    assert row["counted"] == 4
    shown = row["detail"].split(" — ")[1].split("; ")
    assert [text.split(" at ")[0] for text in shown] == ["consommation=1", "gaz=99999", "gaz=88888"]


def test_range_bounds_are_inclusive_and_nulls_skipped(spark):
    rows = [record(gaz=0), record(gaz=15_000), record(gaz=None), record(gaz=-1), record(gaz=15_001)]
    counts = quality.range_violations(parsed(spark, rows), GRID.bounded)
    assert {r["field"]: r["violations"] for r in counts.collect()}["gaz"] == 2


def test_balance_violation_warns(spark):
    row = checks(spark, [record(nucleaire=5_000)])["grid_balance"]
    assert not row["passed"] and "1 beyond" in row["detail"]
    assert (row["counted"], row["total"]) == (1, 1)
    assert row["measure"] == pytest.approx(abs(48588 - 32432 - 48586) / 48586 * 100)


def test_balance_skips_rows_with_unknown_parts_or_no_consumption(spark):
    row = checks(spark, [record(pompage=None), record(consommation=0)])["grid_balance"]
    assert row["passed"] and row["detail"].startswith("0 row(s) checked")


def test_negative_consumption_is_never_beyond(spark):
    row = checks(spark, [record(consommation=-100)])["grid_balance"]
    assert (row["passed"], row["total"], row["measure"]) == (True, 1, 0.0)


def test_forecast_rows_are_exempt(spark):
    rows = checks(spark, [record(consommation=None, nucleaire=999_999)])
    assert rows["plausible_ranges"]["passed"] and rows["grid_balance"]["passed"]


def test_status_fold(spark):
    ok, warn, fail = ("a", True, "fail", ""), ("b", False, "warn", ""), ("c", False, "fail", "")
    status = lambda *rows: quality.status(made(spark, *rows)).first()["status"]
    assert status(ok) == "pass"
    assert status(ok, warn) == "warn"
    assert status(ok, warn, fail) == "fail"
    assert status() == "pass"


def test_markdown_and_json(spark):
    one = made(spark, ("grid_balance", False, "warn", "worst 9.9%"))
    text = quality.markdown(one).first()["markdown"].split("\n")
    assert text[0] == "## Data quality — ⚠️ WARN"
    assert text[1:] == [
        "", "| check | result | detail |", "|---|---|---|", "| grid_balance | WARN | worst 9.9% |",
    ]
    assert quality.json(one).first()["json"] == (
        '{"status":"warn","checks":[{"name":"grid_balance","passed":false,'
        '"severity":"warn","detail":"worst 9.9%"}]}'
    )


@pytest.mark.parametrize(
    ("hours", "passed", "severity"), [(2, True, "warn"), (6, True, "warn"), (12, False, "warn"),
                                      (48, False, "warn"), (60, False, "fail"), (-3, True, "warn")]
)
def test_freshness(spark, hours, passed, severity):
    raw = stored(spark, [record(at(2026, 7, 14)), record(at(2026, 7, 15), consommation=None)])
    (row,) = quality.check_freshness(raw, at(2026, 7, 14) + timedelta(hours=hours)).collect()
    assert (row["passed"], row["severity"]) == (passed, severity)
    assert row["measure"] == max(hours, 0)
    assert row["detail"] == (
        f"last observed quarter-hour 2026-07-14 00:00 UTC ({max(hours, 0):.1f} h ago)"
    )


def test_freshness_without_rows_fails(spark):
    (row,) = quality.check_freshness(stored(spark, []), BASE).collect()
    assert (row["passed"], row["severity"]) == (False, "fail")
    assert row["detail"] == "no observed rows in the warehouse"


def full_day():
    start = at(2026, 7, 12, 22)  # midnight in Paris
    return quarters(start, 96), quarters(start + timedelta(days=1), 4)


def test_complete_day(spark):
    finished, running = full_day()
    (row,) = quality.check_completeness(stored(spark, finished + running)).collect()
    assert row["passed"]
    assert row["detail"] == (
        "2026-07-13: 96 observed quarter-hour(s) (expected 96, DST days 92/100)"
    )


def test_day_with_gap(spark):
    finished, running = full_day()
    (row,) = quality.check_completeness(stored(spark, finished[:10] + finished[18:] + running)).collect()
    assert not row["passed"] and row["counted"] == 88


def test_completeness_needs_two_days(spark):
    (row,) = quality.check_completeness(stored(spark, full_day()[1])).collect()
    assert row["passed"] and row["detail"] == "not enough history for a finished day yet"


def test_whole_days_when_clocks_change(spark):
    spring = quarters(at(2026, 3, 28, 23), 92) + quarters(at(2026, 3, 29, 22), 1)
    autumn = quarters(at(2026, 10, 24, 22), 100) + quarters(at(2026, 10, 25, 23), 1)
    for rows, expected in ((spring, 92), (autumn, 100)):
        (row,) = quality.check_completeness(stored(spark, rows)).collect()
        assert row["passed"] and row["counted"] == expected


def test_warehouse_checks_order(spark):
    finished, running = full_day()
    rows = quality.warehouse_checks(stored(spark, finished + running), at(2026, 7, 13, 23)).collect()
    assert [row["name"] for row in sorted(rows, key=lambda r: r["position"])] == list(quality.ORDER[6:])


def test_results_do_not_depend_on_the_session_zone(paris):
    finished, running = full_day()
    rows = stored(paris, finished + running)
    got = quality.warehouse_checks(rows, at(2026, 7, 14, 3)).collect()
    details = {row["name"]: row["detail"] for row in got}
    assert details["freshness"].startswith("last observed quarter-hour 2026-07-13 22:45 UTC (4.2 h")
    assert details["day_completeness"].startswith("2026-07-13: 96 ")
    off = quality.batch_checks(parsed(paris, [record(BASE + timedelta(minutes=7))])).collect()
    assert any("e.g. 2026-07-14 12:07:00+00:00" in row["detail"] for row in off)


def test_checks_run_on_any_table(spark):
    rows = spark.range(10).select(
        F.col("id").alias("seq"), (F.col("id") % 3).alias("k"), (F.col("id") * 10).alias("q"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("t"),
    )
    assert quality.duplicate_keys(rows, ["k"]).count() == 3
    (row,) = quality.check_ranges(rows, [Field("q", "integer", lo=10, hi=80)], "t").collect()
    assert row["counted"] == 2 and row["detail"].count(";") == 1


def test_apply_on_frame_keeps_seq(spark):
    assert frame(spark, [record()]).columns == ["seq", "record"]


def test_one_digit_text_rounds_like_the_report(spark):
    values = [n / 20 for n in range(400)] + [0.0, 2.0499999, 9.95, 99.95, 1e6 + 0.25, 287.123, 1 / 3]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.selectExpr("v", f"{text.one_digit('v')} AS t").collect()
    assert {row["v"]: row["t"] for row in got} == {v: f"{v:.1f}" for v in values}


def test_a_write_observes_the_facts_of_the_gate(spark, tmp_path):
    """The facts that a write notes are those of a second read, also when only part of the rows count."""
    records = [record(BASE, gaz=-1), record(BASE + timedelta(minutes=7)), *quarters(BASE + timedelta(hours=1), 4, consommation=None)]
    records += [{"date_heure": None}, record(BASE, consommation=10**6)]
    rows = parsed(spark, records).withColumn("problem", F.expr("CASE WHEN seq % 5 = 4 THEN 'broken' END"))
    for every in ("true", "problem IS NULL"):
        noted = Observation()
        quality.observe_batch(rows, noted, every=every).write.parquet(str(tmp_path / every.split()[0]))
        seen = quality.observed_facts(rows, noted, every=every)
        again = rows.where(every).agg(*[F.expr(fact) for fact in quality.batch_facts(rows)])
        assert seen.schema == again.schema and seen.collect() == again.collect()
    kept = rows.where("problem IS NULL").drop("problem")
    facts = kept.agg(*[F.expr(fact) for fact in quality.batch_facts(kept)])
    assert quality.batch_checks(kept, facts=facts).collect() == quality.batch_checks(kept).collect()
