from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from records import BASE, OBSERVED, RECORDS, WINDOW, frame, parsed, record

from gridtide.functions import coerce
from gridtide.operators.contract import GRID, accepted, apply_contract, observed, rejected, table_schema


def reasons(spark, *records):
    rows = parsed(spark, list(records)).orderBy("seq").select("reject").collect()
    return [row["reject"] for row in rows]


def only(spark, made):
    (row,) = parsed(spark, [made]).collect()
    return row


def test_field_table_shape():
    assert len(GRID.fields) == 39
    assert [f.name for f in GRID.fields if f.required] == ["date_heure", "consommation", "nucleaire"]
    assert len(GRID.bounded) == 36
    assert len(GRID.parts) == 12
    assert table_schema().names[-1] == "ingested_at"
    by_name = {f.name: f for f in GRID.fields}
    assert (by_name["solaire"].lo, by_name["solaire"].hi) == (-300, 30000)
    assert (by_name["stockage_batterie"].lo, by_name["stockage_batterie"].hi) == (-4000, 100)


def test_measured_records_pass(spark):
    assert reasons(spark, *RECORDS) == [None] * len(RECORDS)
    assert parsed(spark, RECORDS).where(observed()).count() == len(RECORDS)


def test_every_field_value_survives(spark):
    row = only(spark, OBSERVED[0]).asDict()
    for name in GRID.names[1:]:
        assert row[name] == OBSERVED[0][name], name


def test_balance_closes_on_a_measured_record(spark):
    row = only(spark, OBSERVED[0])
    supply = sum(row[name] for name in GRID.parts)
    assert supply == 48588
    assert abs(supply - row["consommation"]) / row["consommation"] < 0.01


def test_missing_is_not_null(spark):
    forecast, missing = record(consommation=None), record(drop=("consommation",))
    got = reasons(spark, forecast, missing)
    assert got[0] is None
    assert got[1] == f"{BASE.isoformat()}: required field 'consommation' is missing"


def test_first_failure_in_contract_order_wins(spark):
    both = record(drop=("nucleaire",), consommation="a lot", gaz="x")
    assert "'consommation'" in reasons(spark, both)[0]


@pytest.mark.parametrize(
    ("overrides", "fragment"),
    [
        ({"date_heure": None}, "<no date_heure>: date_heure must not be null"),
        ({"date_heure": "2026-07-14T12:00:00"}, "timestamp lacks a timezone offset"),
        ({"date_heure": "yesterday"}, "Invalid isoformat string: 'yesterday'"),
        ({"consommation": "a lot"}, "field 'consommation': could not convert string to float: 'a lot'"),
        ({"gaz": float("nan")}, "field 'gaz': not a number"),
        ({"gaz": "-inf"}, "field 'gaz': not a finite number"),
        ({"gaz": 3_000_000_000}, "field 'gaz': number out of 32-bit range"),
        ({"gaz": ""}, "field 'gaz'"),
        ({"gaz": True}, "field 'gaz'"),
    ],
)
def test_reject_reasons(spark, overrides, fragment):
    assert fragment in reasons(spark, record(**overrides))[0]


def test_missing_key_has_no_label(spark):
    assert reasons(spark, record(drop=("date_heure",))) == [
        "<no date_heure>: required field 'date_heure' is missing"
    ]


def test_non_object_record_is_rejected_alone(spark):
    got = reasons(spark, 5, [1], None, record())
    assert [reason is None for reason in got] == [False, False, False, True]


def test_numeric_text_offset_and_unknown_keys(spark):
    row = only(
        spark,
        record(consommation="48586.0", date_heure="2026-07-14T14:00:00+02:00", brand_new=42),
    )
    assert row["consommation"] == 48586
    assert row["reject"] is None
    assert set(row.asDict()) == {"seq", "reject", *GRID.names}
    moment = parsed(spark, [record(date_heure="2026-07-14T14:00:00+02:00")])
    micros = moment.select(F.unix_micros("date_heure")).first()[0]
    assert micros == int(BASE.timestamp()) * 1_000_000


def test_optional_keys_may_be_absent(spark):
    row = only(spark, record(drop=("gaz", "nature")))
    assert row["gaz"] is None and row["nature"] is None and row["reject"] is None


def test_duplicate_json_keys_last_wins(spark):
    text = json.dumps(record())[:-1] + ', "gaz": 1, "gaz": 7}'
    df = spark.createDataFrame([(0, text)], "seq bigint, record string")
    assert apply_contract(df).first()["gaz"] == 7


def test_split(spark):
    rows = parsed(spark, [*WINDOW, record(drop=("nucleaire",))])
    assert accepted(rows).count() == 4
    (bad,) = rejected(rows).collect()
    assert bad["seq"] == 4


NUMBERS = {
    "0": 0, "-0": 0, "+7": 7, "12.5": 12, "13.5": 14, "-0.5": 0, "-1.5": -2, "2.5": 2, "1e3": 1000,
    "1_000": 1000, " 42 ": 42, "\t9\n": 9, ".5": 0, "5.": 5, "1E-3": 0, "2147483647": 2147483647,
    "2147483648": None, "-2147483648": -2147483648, "-2147483649": None, "12d": None, "12f": None,
    "1__0": None, "_1": None, "0x10": None, "nan": None, "NaN": None, "inf": None,
    "-Infinity": None, "": None, " ": None, "1,5": None, "true": None, "1e400": None, "--1": None,
}


def test_integer_corpus(spark):
    df = spark.createDataFrame([(k,) for k in NUMBERS], "raw string")
    got = df.selectExpr("raw", f"{coerce.integer('raw')} AS v").collect()
    assert {row["raw"]: row["v"] for row in got} == NUMBERS


def test_integer_corpus_agrees_with_python(spark):
    for text, expected in NUMBERS.items():
        try:
            value = round(float(text))
            value = value if -(2**31) <= value < 2**31 else None
        except (ValueError, OverflowError):
            value = None
        assert value == expected, text


INSTANTS = {
    "2026-07-14T12:00:00+00:00": 1784030400_000000,
    "2026-07-14T12:00:00Z": 1784030400_000000,
    "2026-07-14 14:00:00+02:00": 1784030400_000000,
    "2026-07-14T12:00:00.250+00:00": 1784030400_250000,
    "2026-07-14T12:00+00:00": 1784030400_000000,
    "2026-07-14T14:00:00+0200": 1784030400_000000,
    "2026-07-14T14:00+02": 1784030400_000000,
    "2026-07-14T12:00:00": None,
    "2026-07-14": None,
    "12:00:00Z": None,
    "2026-07-14T12:00:00 Europe/Paris": None,
    "2026-13-14T12:00:00Z": None,
    "2026-02-30T12:00:00Z": None,
    "20260714T120000Z": None,
    "": None,
    "now": None,
}


@pytest.mark.parametrize("zone", ["UTC", "Europe/Paris"])
def test_instant_corpus(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(k,) for k in INSTANTS], "raw string")
        got = df.selectExpr("raw", f"unix_micros({coerce.instant('raw')}) AS v").collect()
        assert {row["raw"]: row["v"] for row in got} == INSTANTS
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_reject_reason_is_per_record_whatever_the_order(spark):
    made = [record(consommation="bad"), *WINDOW, record(drop=("nucleaire",))]
    rows = apply_contract(frame(spark, made).orderBy(F.desc("seq")))
    by_seq = {row["seq"]: row["reject"] for row in rows.collect()}
    assert by_seq[0] and by_seq[5] and not any(by_seq[n] for n in (1, 2, 3, 4))
