from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from records import at, quarters

from gridtide.__main__ import main as job
from gridtide.plans.store import Store


# Midday and, in summer and winter, both sides of UTC midnight and of midnight in Paris.
CLOCKS = [at(2026, 7, 14, 12), at(2026, 7, 14, 23, 30), at(2026, 7, 15, 0, 30), at(2026, 12, 5, 0, 30)]


@pytest.mark.parametrize("now", CLOCKS[:1])
def test_job_entry(spark, tmp_path, capfd, now):
    landed, base = tmp_path / "landed", str(tmp_path / "store")
    landed.mkdir()
    records = quarters(now - timedelta(hours=2), 8, consommation=48_586)

    def main(arguments):
        return job(arguments, now)

    (landed / "a.json").write_text(json.dumps(records))
    assert main(["status", "--base", base]) == 1
    command = ["run", "--base", base, "--exports", str(landed), "--report", str(tmp_path / "r")]
    assert main([*command, "--json", "--since", "2026-06-01T00:00:00"]) == 0
    line = [text for text in capfd.readouterr().out.splitlines() if text.startswith("{")][-1]
    body = json.loads(line)
    assert (body["status"], body["rows_inserted"]) == ("pass", 8)
    opened = Store(spark, base).runs().selectExpr("unix_seconds(window_start) AS s").first()
    assert opened["s"] == int(datetime(2026, 6, 1, tzinfo=timezone.utc).timestamp())
    assert main(["status", "--base", base]) == 0
    assert "pass" in capfd.readouterr().out
    (landed / "a.json").write_text(json.dumps([*records, {**records[0], "date_heure": now.isoformat(), "gaz": -1}]))
    assert main([*command, "--strict"]) == 1
    (landed / "a.json").write_text(json.dumps([*records, *records]))
    assert main(command) == 2


@pytest.mark.parametrize("now", CLOCKS)
def test_outcome_at_any_hour(spark, tmp_path, capfd, now):
    """Two hours of rows: whole within one local day, else the day before them is short and the run warns."""
    landed = tmp_path / "landed"
    landed.mkdir()
    first = now - timedelta(hours=2)
    (landed / "a.json").write_text(json.dumps(quarters(first, 8, consommation=48_586)))
    assert job(["run", "--base", str(tmp_path / "store"), "--exports", str(landed), "--json"], now) == 0
    line = [text for text in capfd.readouterr().out.splitlines() if text.startswith("{")][-1]
    paris = ZoneInfo("Europe/Paris")
    days = {(first + timedelta(minutes=15 * n)).astimezone(paris).date() for n in range(8)}
    assert json.loads(line)["status"] == ("pass" if len(days) == 1 else "warn")


def test_bad_since_is_refused(tmp_path):
    with pytest.raises(SystemExit) as stop:
        job(["run", "--base", "x", "--lines", "y", "--since", "not-a-date"])
    assert stop.value.code == 2
