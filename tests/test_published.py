"""Versions, folded logs, mart scripts, split arrays and the index of landed files."""

from __future__ import annotations

import gzip
import json
import os
from datetime import timedelta
from functools import partial

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from records import at, quarters

from gridtide.operators import ledger
from gridtide.operators.script import Script, digest, levels, scripts_of
from gridtide.plans import cycle
from gridtide.plans.store import MartFailed, Store
from gridtide.sources import landing, split
from gridtide.sources.index import LandedIndex
from gridtide.sources.log import FoldedLog
from gridtide.sources.published import Published

ROWS = T.StructType([T.StructField("v", T.IntegerType())])
NOW = at(2026, 7, 14, 12)


def publish(spark, held, part, value, **options):
    load = held.new_load()
    frame = spark.createDataFrame([(value, part)], f"v int, {held.part.name} string").coalesce(1)
    frame.write.partitionBy(held.part.name).parquet(held.folder(load))
    return held.publish(load, **options)


def test_versions(spark, tmp_path):
    held = Published(spark, str(tmp_path / "d"), T.StructField("part", T.StringType()))
    assert held.version().number == 0 and held.read(ROWS).count() == 0
    publish(spark, held, "a", 1)
    first = held.read(ROWS)
    publish(spark, held, "b", 2, facts={"note": "x"})
    publish(spark, held, "a", 3)
    publish(spark, held, "it's", 4)
    assert held.version().facts == {"note": "x"}
    assert sorted(row["v"] for row in held.read(ROWS).where("part <> 'c'").collect()) == [2, 3, 4]
    assert [row["v"] for row in held.read(ROWS, wanted=["it's"]).collect()] == [4]
    assert [row["v"] for row in first.collect()] == [1]
    publish(spark, held, "c", 5, removed=["b"])
    assert sorted(row["v"] for row in held.read(ROWS).collect()) == [3, 4, 5]
    assert len(held.since(3)) == 2 and held.since(5) == []
    assert held.tidy() == []  # all young
    assert len(held.tidy(timedelta(0), keep=2)) == 1 and held.numbers() == [4, 5]
    assert held.since(2) is None


def event(spark, run, seq, status="x"):
    row = {name: None for name in ledger.EVENT.names} | {"run_id": run, "event_seq": seq, "status": status}
    return spark.createDataFrame([tuple(row.values())], ledger.EVENT).coalesce(1)


def test_a_log_keeps_few_files(spark, tmp_path):
    log = FoldedLog(spark, str(tmp_path / "log"), ledger.EVENT, "run_id", "event_seq", "status = 'gone'", limit=4)
    planned, sizes = None, []
    for run in range(1, 12):
        for seq, status in ((0, "running"), (1, "gone" if run % 5 == 0 else "pass")):
            log.append(event(spark, run, seq, status), high=run)
        sizes.append(sum(len(names) for _, _, names in os.walk(tmp_path / "log")))
        if run == 9:
            planned = log.read()
    assert log.high() == 11
    runs = ledger.fold(log.read())
    assert {row["run_id"]: row["status"] for row in runs.where("status <> 'gone'").collect()} == {
        run: "pass" for run in range(1, 12) if run % 5
    }
    assert max(sizes) < 60  # four files an entry, at most two foldings' worth of entries, two checkpoints
    # Planned four appends and one folding ago.
    assert planned.agg(F.max("run_id")).first()[0] == 9


def test_scripts_are_ordered_by_name_and_by_what_they_read():
    found = scripts_of([Script("03_c", len, ("01_a",)), ("01_a", len), ("02_b", len)])
    assert [s.name for s in found] == ["01_a", "02_b", "03_c"]
    assert [[s.name for s in level] for level in levels(found)] == [["01_a", "02_b"], ["03_c"]]
    with pytest.raises(ValueError, match="no earlier script"):
        scripts_of([Script("01_a", len, ("02_b",)), ("02_b", len)])
    with pytest.raises(ValueError, match="two marts"):
        scripts_of([("01_a", len), ("01_a", len)])


def test_any_callable_has_a_digest():
    made: dict = {}
    exec("def build(rows, layout): return rows.limit(1)", made)
    exec("def other(rows, layout): return rows.limit(2)", made)

    class Build:
        def __init__(self, n):
            self.n = n

        def __call__(self, rows, layout):
            return rows.limit(self.n)

    def closed(n):
        return lambda rows, layout: rows.limit(n)

    given = [made["build"], made["other"], partial(made["build"], 1), partial(made["build"], 2), Build(1), Build(2), closed(1), closed(2), len]
    assert len({digest(build) for build in given}) == len(given)
    assert digest(closed(1)) == digest(closed(1)) and digest(Build(1)) == digest(Build(1))


def top(limit, rows, layout):
    return rows.agg(F.max("gaz").alias("peak")).limit(limit)


def test_marts_of_marts_take_effect_in_order(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    (landed / "a.json").write_text(json.dumps(quarters(NOW - timedelta(hours=2), 8, gaz=7)))
    scripts = [("01_top", partial(top, 1)), Script("02_twice", lambda rows, layout, marts: marts["01_top"].selectExpr("peak * 2 AS twice"), ("01_top",))]
    source = cycle.export_source(spark, str(landed))
    outcome = cycle.run_cycle(spark, str(tmp_path / "s"), source, now=NOW, scripts=scripts)
    assert outcome.marts == ["01_top", "02_twice"]
    assert Store(spark, str(tmp_path / "s"), scripts=scripts).mart("02_twice").first()["twice"] == 14
    # The second fails: the first is renewed, the third not run.
    broken = [scripts[0], ("02_twice", lambda rows, layout: 1 / 0), ("03_late", partial(top, 1))]
    (landed / "a.json").write_text(json.dumps(quarters(NOW - timedelta(hours=2), 8, gaz=9)))
    with pytest.raises(MartFailed, match="02_twice"):
        cycle.run_cycle(spark, str(tmp_path / "s"), source, now=NOW, scripts=broken)
    store = Store(spark, str(tmp_path / "s"), scripts=broken)
    assert (store.mart("01_top").first()["peak"], store.mart("02_twice").first()["twice"]) == (9, 14)
    with pytest.raises(LookupError):
        store.mart("03_late")


PAYLOADS = {
    "plain": '[{"a": 1}, {"b": {"c": [1, {"d": 2}]}},{"e":[]}]',
    "text": '[{"a": "x}] \\\\"}, {"b": "\\"}{[\\\\\\\\"}\n]\n',
    "values": '[1, "}", {"a": 1}, null, {"b": 2}, "]", [{"c": 3}]]',
    "none": " [ ] ",
    "empty": "",
    "object": '{"message": "down", "more": {"x": 1}}',
    "open": '[{"a": 1}, {"b": 2}',
    "cut": '[{"a": 1}, {"b": ',
    "comma": '[{"a": 1},]',
    "gap": '[{"a": 1} {"b": 2}]',
    "after": '[{"a": 1}] x',
    "html": "<html>}</html>",
}


@pytest.mark.parametrize("size", ["64m", "16"])
def test_split_arrays_read_like_whole_files(spark, tmp_path, size):
    for name, text in PAYLOADS.items():
        (tmp_path / f"{name}.json").write_text(text)
    name_of = F.regexp_extract("seq.origin", r"([a-z]+)\.json", 1)
    place = F.struct("seq.*")

    def found(rows):
        rows = rows.select(name_of.alias("name"), place.alias("at"), "record", "problem").orderBy("name", "at").collect()
        return [(row["name"], row["record"], row["problem"]) for row in rows]

    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = found(split.split_records(spark, str(tmp_path / "*.json")))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = found(landing.export_records(spark, str(tmp_path / "*.json")))
    # A file without any byte has no byte range; read whole it is invalid.
    assert got == [row for row in want if row[0] != "empty"]


def test_split_reads_compressed_files(spark, tmp_path):
    payloads = {
        "array": '[{"a": "[b", "c": "d}"}, {"a": "]", "c": 1}, {"a": "x\\\\"}]',
        "object": '{"message": "down", "more": {"x": 1}}',
        "open": '{"message": "down", "more": {"x": 1}',
        "cut": '[{"a": 1}, {"b": 2}',
    }
    for name, text in payloads.items():
        (tmp_path / f"{name}.json.gz").write_bytes(gzip.compress(text.encode()))

    def found(rows):
        return [tuple(row) for row in rows.orderBy("seq.origin", "seq.pos").select("seq.origin", "record", "problem").collect()]

    got = found(split.split_records(spark, str(tmp_path / "*.gz")))
    assert got == found(landing.export_records(spark, str(tmp_path / "*.gz")))
    assert {row[2] for row in got} == {None, "API error: down", "invalid JSON"}


def test_index_opens_only_files_of_the_window(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    for n in range(4):
        (landed / f"{n}.json").write_text(json.dumps(quarters(at(2026, 7, 1 + n), 96)))
    index = LandedIndex(spark, str(tmp_path / "index"), str(landed), "date_heure")
    assert (index.refresh(), index.refresh()) == (4, 0)
    names = [os.path.basename(path) for path in index.files(at(2026, 7, 2), at(2026, 7, 3))]
    assert names == ["1.json"]
    (landed / "2.json").write_text("<html>")
    (landed / "9.json").write_text(json.dumps(quarters(at(2026, 7, 2, 12), 4)))
    rows = cycle.indexed_source(spark, index)(at(2026, 7, 2), at(2026, 7, 3))
    assert rows.where("problem IS NULL").count() == 100 and rows.where("problem IS NOT NULL").count() == 1
    names = [os.path.basename(path) for path in index.files(at(2026, 7, 2), at(2026, 7, 3))]
    assert names == ["1.json", "2.json", "9.json"]
