from __future__ import annotations

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from records import at, frame, quarters, record

from gridtide.operators import ledger, marts
from gridtide.operators.incremental import Params
from gridtide.plans import cycle, reads
from gridtide.plans.store import MartFailed, MartNotBuilt, Store
from gridtide.sources.landing import PayloadError

NOW = at(2026, 7, 14, 12)
NAMES = ["01_mart_daily", "02_mart_latest", "03_mart_mix_7d"]


class Scripted:
    """A source that hands out prepared batches and remembers the windows asked for."""

    def __init__(self, spark, *batches):
        self.spark, self.batches, self.calls = spark, list(batches), []

    def __call__(self, start, end):
        self.calls.append((start, end))
        batch = self.batches.pop(0)
        if isinstance(batch, Exception):
            raise batch
        return frame(self.spark, batch)


def counts(outcome):
    return (
        outcome.rows_fetched, outcome.rows_rejected, outcome.rows_inserted, outcome.rows_updated
    )


def run(spark, base, source, now=NOW, **options):
    return cycle.run_cycle(spark, str(base), source, now=now, **options)


def test_first_and_second_run(spark, tmp_path):
    first = NOW - timedelta(hours=2)
    source = Scripted(
        spark, quarters(first, 8), quarters(first, 10, gaz=479), quarters(first, 10, gaz=479)
    )
    outcome = run(spark, tmp_path, source, report_path=str(tmp_path / "report"))
    assert (outcome.status, counts(outcome), outcome.marts) == ("pass", (8, 0, 8, 0), NAMES)
    assert source.calls[0] == (NOW - timedelta(hours=72), NOW + timedelta(hours=36))
    text = "\n".join(row["value"] for row in spark.read.text(str(tmp_path / "report")).collect())
    assert "# run 1" in text and "inserted 8" in text and "## Data quality — ✅ PASS" in text

    later = NOW + timedelta(hours=1)
    second = run(spark, tmp_path, source, now=later)
    watermark = first + timedelta(minutes=15 * 7)
    assert source.calls[1][0] == watermark - timedelta(hours=24)
    assert counts(second) == (10, 0, 2, 8)
    again = run(spark, tmp_path, source, now=later)
    assert counts(again) == (10, 0, 0, 10)

    store = Store(spark, str(tmp_path))
    assert store.raw().count() == 10 and store.raw().where("gaz = 479").count() == 10
    assert store.raw().where("ingested_at IS NULL").count() == 0
    runs = reads.Reads(store).runs(5).collect()
    assert [row["run_id"] for row in runs] == [3, 2, 1]
    assert {row["status"] for row in runs} == {"pass"}
    assert runs[0]["finished_at"] is not None and "quality" not in runs[0].asDict()
    assert not (tmp_path / "staging" / "run=1").exists()

    row = outcome.to_frame(spark).select(F.to_json(F.struct("*")).alias("j")).first()["j"]
    body = json.loads(row)
    assert body["rows_inserted"] == 8 and body["quality"]["status"] == "pass"
    assert len(body["quality"]["checks"]) == 8

    view = reads.Reads(store)
    assert view.health(later).first()["status"] == "ok"
    assert view.health(later + timedelta(days=3)).first()["status"] == "stale"
    assert view.health(later).first()["last_run"]["run_id"] == 3
    (latest,) = view.latest().collect()
    assert latest["production_total_mw"] == 60_984
    mix = view.mix().collect()
    assert len(mix) == 8 and mix[0]["source"] == "nuclear"
    assert [row["mwh"] for row in mix] == sorted((row["mwh"] for row in mix), reverse=True)
    (day,) = view.daily(5).collect()
    assert day["quarters_observed"] == 10
    summary, lines = view.status(later)
    assert summary.first()["raw_rows"] == 10
    assert [tuple(row)[2:] for row in lines.collect()][-1] == ("pass", 8, 8, 0, "")
    told = store.sql("SELECT count(*) AS n FROM {raw} WHERE gaz >= :floor", {"floor": 479})
    assert told.first()["n"] == 10


def test_failing_batch_is_not_loaded(spark, tmp_path):
    records = quarters(NOW - timedelta(hours=1), 10)
    for spoilt in records[:2]:
        del spoilt["consommation"]
    outcome = run(spark, tmp_path, Scripted(spark, records))
    assert (outcome.status, counts(outcome), outcome.marts) == ("fail", (10, 2, 0, 0), [])
    store = Store(spark, str(tmp_path))
    assert store.raw().count() == 0
    (entry,) = store.runs().collect()
    assert (entry["status"], entry["rows_fetched"], entry["rows_rejected"]) == ("fail", 10, 2)
    assert json.loads(entry["quality"])["status"] == "fail"
    with pytest.raises(MartNotBuilt):
        store.mart(NAMES[0])


def test_warning_batch_loads(spark, tmp_path):
    records = quarters(NOW - timedelta(hours=8), 32)
    del records[0]["consommation"]
    outcome = run(spark, tmp_path, Scripted(spark, records))
    assert (outcome.status, counts(outcome)) == ("warn", (32, 1, 31, 0))
    failed = [check["name"] for check in outcome.report["checks"] if not check["passed"]]
    assert failed == ["contract_coercion"]


def test_stale_data_fails_after_the_load(spark, tmp_path):
    outcome = run(spark, tmp_path, Scripted(spark, quarters(NOW - timedelta(hours=70), 4)))
    assert (outcome.status, counts(outcome), outcome.marts) == ("fail", (4, 0, 4, 0), NAMES)


def test_errors_reach_the_ledger_and_the_caller(spark, tmp_path):
    with pytest.raises(ConnectionError):
        run(spark, tmp_path, Scripted(spark, ConnectionError("upstream down")))
    landed = tmp_path / "landed"
    landed.mkdir()
    (landed / "a.json").write_text(json.dumps(quarters(NOW, 2)) + "\n")
    (landed / "b.json").write_text('{"error_code": "X", "message": "unexpected token"}')
    with pytest.raises(PayloadError, match="unexpected token"):
        run(spark, tmp_path, cycle.export_source(spark, str(landed)))
    runs = Store(spark, str(tmp_path)).runs().orderBy("run_id").collect()
    assert [row["status"] for row in runs] == ["error", "error"]
    assert "down" in runs[0]["error"] and "unexpected token" in runs[1]["error"]
    assert [row["rows_inserted"] for row in runs] == [0, 0]
    assert Store(spark, str(tmp_path)).raw().count() == 0


def test_export_files_and_json_lines_give_the_same_table(spark, tmp_path):
    records = quarters(NOW - timedelta(hours=2), 8)
    exports, lines = tmp_path / "exports", tmp_path / "lines"
    for folder in (exports, lines):
        folder.mkdir()
    (exports / "a.json").write_text(json.dumps(records[:5], indent=1) + "\n")
    (exports / "b.json").write_text(json.dumps(records[5:]))
    (lines / "a.json").write_text("\n".join(json.dumps(r) for r in records) + "\n\n")
    tables = []
    for name, source in (
        ("e", cycle.export_source(spark, str(exports))), ("l", cycle.lines_source(spark, str(lines)))
    ):
        outcome = run(spark, tmp_path / name, source)
        assert (outcome.status, counts(outcome)) == ("pass", (8, 0, 8, 0))
        raw = Store(spark, str(tmp_path / name)).raw().drop("ingested_at")
        tables.append(raw.orderBy("date_heure").collect())
    assert tables[0] == tables[1]


def test_empty_fetch_warns_and_since_overrides(spark, tmp_path):
    source = Scripted(spark, [], [])
    outcome = run(spark, tmp_path, source, since=NOW - timedelta(days=30))
    assert source.calls[0][0] == NOW - timedelta(days=30)
    assert (outcome.status, counts(outcome), outcome.marts) == ("fail", (0, 0, 0, 0), NAMES)
    failed = {check["name"] for check in outcome.report["checks"] if not check["passed"]}
    assert failed == {"window_not_empty", "freshness"}
    store = Store(spark, str(tmp_path))
    assert reads.Reads(store).latest().count() == 0
    assert reads.Reads(store).health(NOW).first()["status"] == "empty"


def filled(spark, tmp_path, records):
    store = Store(spark, str(tmp_path))
    rows = cycle.apply_contract(frame(spark, records)).drop("reject")
    return store, rows.withColumn("ingested_at", F.lit(None).cast("timestamp"))


def test_touched_months_equal_a_full_rebuild(spark, tmp_path):
    history = [record(at(2026, 6, 30, 21, 45) + timedelta(hours=7 * n)) for n in range(150)]
    store, rows = filled(spark, tmp_path, history)
    store.table.upsert(rows)
    store.build_marts()
    _, revised = filled(spark, tmp_path, quarters(at(2026, 7, 31, 20), 12, consommation=30_000))
    store.table.upsert(revised)
    store.build_marts()
    whole = marts.daily(store.raw()).orderBy("day").collect()
    assert store.mart(NAMES[0]).collect() == whole
    # A month that loses its only observed day must vanish as well.
    alone, first = at(2026, 3, 10), [record(at(2026, 3, 10))]
    store.table.upsert(filled(spark, tmp_path, first)[1])
    store.build_marts()
    assert store.mart(NAMES[0]).where("day = date'2026-03-10'").count() == 1
    nulled = filled(spark, tmp_path, [record(alone, consommation=None)])[1]
    store.table.upsert(nulled)
    store.build_marts()
    assert store.mart(NAMES[0]).collect() == marts.daily(store.raw()).orderBy("day").collect()


def test_tail_answers_like_the_whole_table(spark, tmp_path):
    rows = [record(at(2026, 1, 1) + timedelta(days=n), consommation=50_000 + n) for n in range(60)]
    rows += [record(at(2026, 3, 2) + timedelta(days=n), consommation=None) for n in range(30)]
    store, batch = filled(spark, tmp_path, rows)
    store.table.upsert(batch)
    tail, raw = store.tail(), store.raw()
    assert tail.count() < raw.count()
    for build in (marts.latest, marts.mix_7d):
        assert sorted(build(tail).collect()) == sorted(build(raw).collect())
    for checks in (lambda df: cycle.quality.warehouse_checks(df, at(2026, 3, 3)),):
        assert sorted(checks(tail).collect()) == sorted(checks(raw).collect())


def test_a_failing_mart_is_named(spark, tmp_path):
    _, batch = filled(spark, tmp_path, quarters(NOW, 2))

    def broken(raw, layout):
        raise ZeroDivisionError("no")

    failing = Store(spark, str(tmp_path), scripts=[*marts.MARTS[:2], ("03_mart_mix_7d", broken)])
    failing.table.upsert(batch)
    with pytest.raises(MartFailed, match="03_mart_mix_7d"):
        failing.build_marts()
    # What the failed build left undone is done by the next, though nothing new was loaded.
    store = Store(spark, str(tmp_path))
    store.table.upsert(filled(spark, tmp_path, quarters(NOW, 3))[1])
    assert store.dirty() == [NOW.date()]
    store.build_marts()
    assert not store.dirty() and store.mart(NAMES[0]).count() == 1


def test_own_mart_scripts(spark, tmp_path):
    _, batch = filled(spark, tmp_path, quarters(NOW, 2))
    own = [*marts.MARTS, ("04_gas", lambda rows, layout: rows.groupBy().agg({"gaz": "max"}).toDF("peak"))]
    store = Store(spark, str(tmp_path), scripts=own)
    store.table.upsert(batch)
    assert store.build_marts()[-1] == "04_gas"
    assert store.sql("SELECT peak FROM {gas}").first()["peak"] == 478


def test_runs_close_beyond_32_bits(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.finish_run(store.start_run(NOW, NOW, NOW), "pass", rows_fetched=2**31)
    assert store.runs().first()["rows_fetched"] == 2**31


def test_a_failed_batch_leaves_no_staging(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    (landed / "1.json").write_text("<html>")
    source = cycle.export_source(spark, str(landed))
    with pytest.raises(cycle.landing.PayloadError):
        cycle.run_cycle(spark, str(tmp_path / "store"), source, now=NOW)
    assert not (tmp_path / "store" / "staging" / "run=1").exists()


def test_ledger_roundtrip_and_limits(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.runs().count() == 0
    first = store.start_run(NOW, NOW, NOW)
    assert store.runs().first()["status"] == "running"
    store.finish_run(first, "warn", rows_fetched=10, rows_rejected=1, quality='{"status": "warn"}')
    second = store.start_run(NOW, NOW, NOW)
    assert (first["run_id"], second["run_id"]) == (1, 2)
    store.finish_run(second, "error", error="x" * 100)
    rows = ledger.last_runs(store.runs(), 5).collect()
    assert [row["run_id"] for row in rows] == [2, 1]
    assert (rows[1]["status"], rows[1]["rows_fetched"], rows[1]["rows_updated"]) == ("warn", 10, 0)
    assert rows[1]["error"] == "" and rows[1]["finished_at"] is not None
    assert len(ledger.status_lines(store.runs()).first()["error"]) == 60
    for limit in (0, 201):
        with pytest.raises(ValueError):
            ledger.runs_page(store.runs(), limit)
    for days in (0, 366):
        with pytest.raises(ValueError):
            reads.daily(store.runs(), days)


def test_run_cycle_under_another_session_zone(paris, tmp_path):
    first = NOW - timedelta(hours=2)
    source = Scripted(paris, quarters(first, 8), quarters(first, 10))
    run(paris, tmp_path, source, params=Params(overlap_hours=1))
    outcome = run(paris, tmp_path, source, now=NOW + timedelta(hours=1), params=Params(overlap_hours=1))
    assert source.calls[1][0] == NOW - timedelta(minutes=15) - timedelta(hours=1)
    assert (outcome.status, counts(outcome)) == ("pass", (10, 0, 2, 8))
    days = Store(paris, str(tmp_path)).table.days()
    assert [day.isoformat() for day in days] == ["2026-07-14"]
