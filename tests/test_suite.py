"""Every registered query against its SQL oracle, on the smallest tables."""

from __future__ import annotations

import json
import os

import duckdb
import pytest

import __spark_entry__ as entry
from gridtide.bindings import suite
from gridtide.bindings.oracle import ORACLE
from gridtide.bindings.suite import QUERIES
from gridtide.bindings.tables import EVENT_GRID, event_grid, table
from tools_check import TABLES, compare

SF_DIR = "/root/testdata/sf0.001"
# Whole-cycle queries whose flows test_cycle and test_table already cover; tools_check runs them too.
COVERED = {
    "run_cycle", "incremental_outcomes", "incremental_two_runs", "mart_daily_incremental", "read_mix", "raw_schema",
    "event_stream", "upsert_table_counts",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in COVERED])
def test_query_equals_oracle(spark, con, name):
    _, rows, verdict = compare(spark, con, name, SF_DIR)
    assert verdict == "ok", verdict
    assert rows > 0


def test_landed_days_are_arrays_of_a_record_a_line(spark, tmp_path):
    """No row of the written frame holds more than a record, and a day is one array in order."""
    suite._land(spark, SF_DIR, str(tmp_path), rows=event_grid(spark, SF_DIR), layout=EVENT_GRID)
    ids = []
    for day in (tmp_path / "landed").glob("day=*"):
        (file,) = day.glob("*.txt")
        records = json.loads(file.read_text())
        assert len(file.read_text().splitlines()) == len(records)
        moments = [record["date_heure"] for record in records]
        assert moments == sorted(moments) and {moment[:10] for moment in moments} == {day.name[4:]}
        ids += [record["prevision_j1"] for record in records]
    assert sorted(ids) == [row[0] for row in table(spark, SF_DIR, "events").select("event_id").orderBy("event_id").collect()]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
