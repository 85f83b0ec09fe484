from __future__ import annotations

import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from records import BASE, at, parsed, quarters, record

from gridtide.operators import merge, quality, synopsis
from gridtide.operators.contract import accepted, table_schema
from gridtide.sources.table import KeyedTable


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "raw"), ["date_heure"], "date_heure", table_schema())


def rows(spark, records):
    return accepted(parsed(spark, records)).withColumn("ingested_at", F.lit(None).cast("timestamp"))


def counts(loaded):
    return loaded.inserted, loaded.updated


def files(table):
    return sorted(
        os.path.join(folder, name)
        for folder, _, names in os.walk(table.path)
        for name in names
        if name.endswith(".parquet")
    )


def test_counts_and_idempotence(spark, table):
    batch = rows(spark, quarters(BASE, 4))
    assert counts(table.upsert(batch)) == (4, 0)
    first = table.read().orderBy("date_heure").collect()
    assert counts(table.upsert(batch)) == (0, 4)
    assert table.read().orderBy("date_heure").collect() == first


def test_revisions_overwrite_every_column_nulls_included(spark, table):
    table.upsert(rows(spark, [record(consommation=50_000, gaz=5)]))
    table.upsert(rows(spark, [record(consommation=51_234, gaz=None)]))
    (row,) = table.read().collect()
    assert (row["consommation"], row["gaz"]) == (51_234, None)


def test_last_row_of_a_key_wins_in_one_batch(spark, table):
    batch = [record(consommation=n) for n in (1, 2, 3)] + quarters(BASE + timedelta(hours=1), 2)
    shuffled = rows(spark, batch).orderBy(F.desc("seq"))
    assert counts(table.upsert(shuffled)) == (3, 2)
    assert table.read().where("consommation < 10").first()["consommation"] == 3


def test_empty_batch_is_a_no_op(spark, table):
    assert counts(table.upsert(rows(spark, []))) == (0, 0)
    assert table.read().count() == 0 and table.days() == []


def test_only_touched_dates_are_rewritten(spark, table):
    table.upsert(rows(spark, quarters(at(2026, 7, 12), 96 * 3)))
    before = files(table)
    loaded = table.upsert(rows(spark, quarters(at(2026, 7, 14), 4, consommation=7)))
    assert loaded.days == (date(2026, 7, 14),)
    # Files are never changed; of the touched date the rows now come from the new load.
    assert set(before) < set(files(table))
    read = {row[0].rpartition("/raw/")[2] for row in table.read().select(F.input_file_name()).distinct().collect()}
    old = {name.rpartition("/raw/")[2] for name in before}
    assert {name for name in read if "2026-07-14" not in name} == {name for name in old if "2026-07-14" not in name}
    assert not {name for name in read & old if "2026-07-14" in name}
    assert table.read().count() == 96 * 3
    assert table.read().where("consommation = 7").count() == 4


def test_reads_name_their_dates(spark, table):
    table.upsert(rows(spark, quarters(at(2026, 7, 12), 96 * 3)))
    assert table.days() == [date(2026, 7, day) for day in (12, 13, 14)]
    some = table.read_days([date(2026, 7, 13), date(1999, 1, 1)])
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert some.count() == 96 and "PartitionFilters: [" in plan and "utc_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert all("2026-07-13" in row[0] for row in some.select(F.input_file_name()).distinct().collect())
    assert table.read_since(date(2026, 7, 13)).count() == 192
    assert table.read().columns == table.schema.names


def test_a_load_that_dies_before_publishing_changes_nothing_until_recovery(spark, table, monkeypatch):
    table.upsert(rows(spark, quarters(BASE, 4)))
    monkeypatch.setattr(table, "_publish", lambda number: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.upsert(rows(spark, quarters(BASE, 6, consommation=7)))
    assert table.read().count() == 4 and table.read().where("consommation = 7").count() == 0
    monkeypatch.undo()
    assert table.recover() == 1
    assert table.read().count() == 6 and table.read().where("consommation = 7").count() == 6
    assert table.recover() == 0


def test_an_unfinished_load_is_dropped_after_the_grace_time(spark, table):
    table.upsert(rows(spark, quarters(BASE, 4)))
    half = [f"{table.path}/data/load=half/utc_date=2026-07-14", f"{table.path}/staging/batch"]
    for folder in half:
        os.makedirs(folder)
    assert table.recover() == 0 and all(map(os.path.exists, half))
    assert table.recover(timedelta(0)) == 0 and not any(map(os.path.exists, half))
    assert table.read().count() == 4


def test_a_half_written_pointer_is_dropped(spark, table):
    table.upsert(rows(spark, quarters(BASE, 4)))
    with open(f"{table.path}/versions/_next-000000000002", "w") as draft:
        draft.write('{"parts": {')
    assert table.recover() == 0
    assert table.upsert(rows(spark, quarters(BASE, 5))).inserted == 1
    assert table.read().count() == 5


def test_a_read_planned_before_a_load_gives_the_old_rows(spark, table):
    table.upsert(rows(spark, quarters(BASE, 4, gaz=1)))
    planned = table.read()
    table.upsert(rows(spark, quarters(BASE, 6, gaz=2)))
    table.recover()  # the old files are young
    assert sorted(row["gaz"] for row in planned.collect()) == [1] * 4
    assert sorted(row["gaz"] for row in table.read().collect()) == [2] * 6
    old = table.published.version(1)
    assert table.read(old).count() == 4
    table.recover(timedelta(0))
    assert table.published.numbers() == [2]
    with pytest.raises(LookupError):
        table.published.version(1)
    assert table.read().count() == 6 and len(os.listdir(f"{table.path}/data")) == 1


def test_two_writers_do_not_lose_a_load(spark, table):
    table.upsert(rows(spark, quarters(BASE, 4)))
    over = table.published.version()
    table.upsert(rows(spark, quarters(BASE, 5)))
    load = table.published.new_load()
    table.read().withColumn("utc_date", F.lit(BASE.date())).write.partitionBy("utc_date").parquet(table.published.folder(load))
    with pytest.raises(RuntimeError, match="another writer"):
        table.published.put_in_force(table.published.draft(load, over=over))


def test_change_feed(spark, table):
    table.upsert(rows(spark, quarters(BASE, 3, gaz=1)))
    first = table.published.version().number
    table.upsert(rows(spark, [record(BASE, gaz=2), record(BASE, gaz=3), record(BASE + timedelta(hours=1), gaz=4)]))
    table.upsert(rows(spark, [record(BASE, gaz=None)]))
    told = table.changes_since(first).orderBy("_load", "date_heure").collect()
    assert [(row["_change"], row["_copies"], row["_before"] and row["_before"]["gaz"], row["gaz"]) for row in told] == [
        ("updated", 2, 1, 3), ("inserted", 1, None, 4), ("updated", 1, 3, None)
    ]
    assert table.changes_since(table.published.version().number).count() == 0
    table.recover(timedelta(0))
    assert table.changes_since(first) is None


def test_synopsis_equals_full_scans(spark, tmp_path):
    table = KeyedTable(
        spark, str(tmp_path / "raw"), ["date_heure"], "date_heure", table_schema(), "consommation IS NOT NULL"
    )
    table.upsert(rows(spark, quarters(at(2026, 3, 28, 20), 200)))
    table.upsert(rows(spark, quarters(at(2026, 3, 30, 12), 60, consommation=None)))
    held, raw = table.synopsis(), table.read()
    assert synopsis.counted(held).first()["raw_rows"] == raw.count()
    assert synopsis.newest(held).first() == quality.newest_observed(raw).first()
    days = [sorted(map(tuple, found.collect())) for found in (synopsis.observed_days(held), quality.observed_days(raw))]
    assert days[0] == days[1]
    assert sorted(quality.stored_checks(held, at(2026, 4, 1)).collect()) == sorted(
        quality.warehouse_checks(raw, at(2026, 4, 1)).collect()
    )


def test_time_column_must_be_part_of_the_key(spark, tmp_path):
    with pytest.raises(ValueError):
        KeyedTable(spark, str(tmp_path), ["perimetre"], "date_heure", table_schema())


def test_small_batch_is_broadcast_and_the_table_not_shuffled(spark, table, tmp_path):
    table.upsert(rows(spark, quarters(BASE, 8)))
    path = str(tmp_path / "batch")
    rows(spark, quarters(BASE, 2)).drop("seq").write.parquet(path)
    merged = merge.upsert(table.read(), spark.read.parquet(path), ["date_heure"], None)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_lazy_counts_agree_with_the_table(spark, table):
    existing = rows(spark, quarters(BASE, 4)).drop("seq")
    batch = rows(spark, quarters(BASE + timedelta(minutes=30), 4) + [record(BASE)])
    (row,) = merge.upsert_counts(existing, batch, ["date_heure"]).collect()
    table.upsert(rows(spark, quarters(BASE, 4)))
    assert tuple(row) == counts(table.upsert(batch)) == (2, 3)


def test_one_key_with_a_third_of_all_rows(spark, table):
    """A hot key reduces inside the tasks; the plan has no window over whole groups."""
    many = quarters(BASE, 20) + [record(BASE, consommation=n) for n in range(10)]
    batch = rows(spark, many)
    assert counts(table.upsert(batch)) == (20, 10)
    plan = merge.last_per_key(batch, ["date_heure"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_a_date_with_most_rows_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(60_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN timestampadd(DAY, CAST(id % 10 AS int), timestamp_ntz'2024-01-02 00:00:00')"
        " ELSE timestamp_ntz'2024-01-01 00:00:00' END AS ts",
        "id",
        "sha2(CAST(id AS string), 256) AS payload",
    )
    hot = KeyedTable(spark, str(tmp_path / "hot"), ["ts", "id"], "ts", rows.schema)
    sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "512k"}
    sizes["spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor"] = "0.1"
    for name, value in sizes.items():
        spark.conf.set(name, value)
    try:
        assert counts(hot.upsert(rows, None)) == (60_000, 0)
    finally:
        for name in sizes:
            spark.conf.unset(name)
    staged = [name for name in files(hot) if "utc_date=2024-01-01" in name and "/data/" in name]
    assert len(staged) > 1
    assert hot.read().count() == 60_000


def test_asked_dates_only_however_many(spark, tmp_path):
    """Sparse dates far apart: exactly those asked for are read, and an upsert leaves other files alone."""
    table = KeyedTable(spark, str(tmp_path / "t"), ["ts"], "ts", T.StructType.fromDDL("ts timestamp, v int"))
    rows = spark.sql(
        "SELECT make_timestamp(1990, 1, 1, 0, 0, 0) + make_interval(0, 0, 0, CAST(id * 7 AS int)) AS ts, "
        "CAST(id AS int) AS v FROM range(2200)"
    )
    table.upsert(rows, None)
    held = table.days()
    assert len(held) == 2200
    asked = held[::2]
    assert {row["ts"].date() for row in table.read_days(asked).collect()} == set(asked)
    before = table.published.version().parts
    table.upsert(rows.where("v IN (0, 2199)").withColumn("v", F.lit(-1)), None)
    after = table.published.version().parts
    assert [day for day in after if after[day] != before[day]] == [held[0].isoformat(), held[-1].isoformat()]
    assert table.read().where("v = -1").count() == 2
