from __future__ import annotations

import json
import os
from datetime import timedelta

from pyspark.sql import functions as F
from records import at, quarters

from gridtide.plans.store import Store
from gridtide.streaming import follow

NOW = at(2026, 7, 14, 12)


def land(folder, name, content, age):
    path = folder / name
    path.write_text(content if isinstance(content, str) else json.dumps(content))
    os.utime(path, (1_700_000_000 + age, 1_700_000_000 + age))


def follow_files(spark, tmp_path, **options):
    outcomes = []
    follow.stream_cycle(
        spark, str(tmp_path / "landed"), str(tmp_path / "store"), str(tmp_path / "checkpoint"),
        now=lambda: NOW, on_outcome=outcomes.append, **options,
    )
    return outcomes, Store(spark, str(tmp_path / "store"))


def test_files_become_cycles(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    first = NOW - timedelta(hours=2)
    spoilt = quarters(first, 10)
    for record in spoilt[:2]:
        del record["consommation"]
    land(landed, "1.json", quarters(first, 8), 1)
    land(landed, "2.json", "<html>gateway</html>", 2)
    land(landed, "3.json", spoilt, 3)
    land(landed, "4.json", quarters(first + timedelta(hours=1), 6, gaz=479), 4)
    outcomes, store = follow_files(spark, tmp_path)
    assert [o.status for o in outcomes] == ["pass", "fail", "pass"]
    runs = store.runs().orderBy("run_id").collect()
    assert [row["status"] for row in runs] == ["pass", "error", "fail", "pass"]
    assert (runs[3]["rows_inserted"], runs[3]["rows_updated"]) == (2, 4)
    assert runs[1]["error"] == "invalid JSON" and runs[1]["rows_inserted"] == 0
    raw = store.raw()
    assert raw.count() == 10 and raw.where("gaz = 479").count() == 6
    assert store.mart("01_mart_daily").first()["quarters_observed"] == 10

    # Nothing new: only the refused files are offered again, each in a run of its own.
    refused = {row["origin"][-6:]: row["problem"] for row in store.refused().collect()}
    assert refused == {"2.json": "invalid JSON", "3.json": "quality gate failed"}
    again, store = follow_files(spark, tmp_path)
    assert [(o.run_id, o.status) for o in again] == [(6, "fail")]
    assert [row["status"] for row in store.runs().orderBy("run_id").collect()][4:] == ["error", "fail"]
    # A new file: it and the repaired one are read.
    land(landed, "2.json", quarters(first + timedelta(hours=3), 2), 6)
    os.remove(landed / "3.json")
    land(landed, "5.json", quarters(first, 1, gaz=480), 5)
    outcomes, store = follow_files(spark, tmp_path)
    assert store.raw().where("gaz = 480").count() == 1 and store.raw().count() == 12
    assert [row["origin"][-6:] for row in store.refused().collect()] == ["3.json"]
    ids = [row["run_id"] for row in store.runs().collect()]
    assert len(ids) == len(set(ids))


def test_one_broken_file_costs_no_other(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    first = NOW - timedelta(hours=2)
    land(landed, "1.json", quarters(first, 4), 1)
    land(landed, "2.json", "[", 2)
    outcomes, store = follow_files(spark, tmp_path, files_per_batch=10)
    assert [o.rows_inserted for o in outcomes] == [4] and store.raw().count() == 4
    assert [row["origin"][-6:] for row in store.refused().collect()] == ["2.json"]


def test_a_large_file_is_spread_over_tasks(spark, tmp_path, monkeypatch):
    """A file of several byte ranges is neither read nor parsed whole by one task."""
    landed = tmp_path / "landed"
    landed.mkdir()
    land(landed, "1.json", quarters(NOW - timedelta(days=1), 96), 1)
    tasks, load = [], follow.load_batch

    def noted(store, records, *rest, **options):
        tasks.append(records.select(F.spark_partition_id()).distinct().count())
        return load(store, records, *rest, **options)

    monkeypatch.setattr(follow, "load_batch", noted)
    settings = {"spark.sql.files.maxPartitionBytes": "8k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        _, store = follow_files(spark, tmp_path)
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert store.raw().count() == 96 and tasks[0] > 1
    # What the run cut and staged is gone.
    assert os.listdir(tmp_path / "store" / "staging") == []


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    land(landed, "1.json", quarters(NOW - timedelta(hours=2), 8), 1)
    _, store = follow_files(spark, tmp_path)
    before = store.raw().orderBy("date_heure").collect()
    events = store.events().count()
    # Without its commit the stream has to run the batch again.
    for name in os.listdir(tmp_path / "checkpoint" / "commits"):
        os.remove(tmp_path / "checkpoint" / "commits" / name)
    outcomes, store = follow_files(spark, tmp_path)
    assert outcomes == []
    assert store.events().count() == events
    assert store.raw().orderBy("date_heure").collect() == before


def test_refused_paths_come_in_pages(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    names = [f"{n:02d}.json" for n in range(11)]
    notes = spark.createDataFrame([(name, "invalid JSON") for name in reversed(names)], "origin string, problem string")
    store.note_files(notes.repartition(4, "origin"), 1)
    # No single task writes them all.
    (entry,) = (tmp_path / "store" / "refused" / "tail").iterdir()
    assert len(list(entry.glob("*.parquet"))) > 1
    monkeypatch.setattr(follow, "PAGE", 5)
    held = []
    collect = type(notes).collect
    monkeypatch.setattr(type(notes), "collect", lambda frame: held.append(collect(frame)) or held[-1])
    for size in (1, 2, 3, 11, 20):
        groups = []
        for paths in follow._grouped(store.refused(), size):
            groups.append(paths)
            again = spark.createDataFrame([(path, "still broken") for path in paths], "origin string, problem string")
            store.note_files(again, 2)  # as a run does that refuses them again
        assert groups == [names[at : at + size] for at in range(0, 11, size)]
        assert max(map(len, held)) <= max(5, size)
