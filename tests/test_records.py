from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import at, rows
from fraudlens import schemas as s
from fraudlens.functions.records import assemble, decode_lenient, decode_strict, encode, with_event_time
from fraudlens.sources.messages import SCHEMAS, decoded, from_files

PAYLOADS = [
    '{"transaction_id":"1","amount":5,"timestamp":"2024-01-01 00:00:01"}',
    '{"transaction_id":"2","amount":"12000000","timestamp":"2024-01-01 00:00:01"}',
    '{"transaction_id":"3","amount":"abc","timestamp":"bad"}',
    '{"transaction_id":"4"}',
    "not json",
    '{"transaction_id":"6","amount":1.5,"timestamp":"2024-01-01 00:00:01.123"}',
    '{"transaction_id":7,"amount":5,"timestamp":"2024-01-01T00:00:01"}',
    "[1]",
    "",
]


def messages(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_lenient_decoding_of_the_nine_shapes(spark):
    df = decode_lenient(messages(spark, [*PAYLOADS, None]), s.TRANSACTIONS)
    assert df.schema == s.TRANSACTIONS
    assert rows(df, "transaction_id", "amount", "timestamp") == [
        ("1", 5, at("00:00:01")),
        ("2", 12_000_000, at("00:00:01")),
        ("3", None, None),
        ("4", None, None),
        ("6", None, at("00:00:01.123")),
        ("7", 5, None),
    ]


def test_lenient_numbers_and_times(spark):
    values = [" 12 ", "-7", "+3", "9223372036854775808", "1e3", "", "TX5"]
    df = decode_lenient(messages(spark, [json.dumps({"amount": v}) for v in values]), s.TRANSACTIONS)
    assert [r["amount"] for r in df.collect()] == [12, -7, 3, None, None, None, None]
    texts = ["2024-01-01 00:00:01.1", "2024-01-01 00:00:01.123987654", "2024-1-1 00:00:01", "2024-01-01", "2024-02-30 00:00:00"]
    df = decode_lenient(messages(spark, [json.dumps({"timestamp": v}) for v in texts]), s.TRANSACTIONS)
    assert [r["timestamp"] for r in df.collect()] == [at("00:00:01.100"), at("00:00:01.123"), None, None, None]


def test_narrow_schema_turns_text_ids_into_null(spark):
    df = decode_lenient(messages(spark, ['{"transaction_id":"TX1"}', '{"transaction_id":"8"}']), s.TRANSACTIONS_NARROW)
    assert [r["transaction_id"] for r in df.collect()] == [None, 8]


def test_strict_decoding(spark):
    good = '{"transaction_id":"1","amount":"5","timestamp":"2024-01-01 00:00:01","merchant":"m"}'
    df = decode_strict(messages(spark, [good]), s.TRANSACTIONS_RELATIONAL)
    assert rows(df, "transaction_id", "amount", "timestamp", "mercant") == [("1", 5, at("00:00:01"), None)]
    for bad in ("not json", "", '{"amount":"abc"}', '{"amount":3000000000}', '{"timestamp":"2024-01-01T00:00:01"}'):
        with pytest.raises(Exception):
            decode_strict(messages(spark, [good, bad]), s.TRANSACTIONS_RELATIONAL).collect()


def test_encoding_keeps_nulls_and_trims_fractions(spark):
    df = spark.createDataFrame(
        [("a", at("00:00:10"), 5, None), ("b", at("00:00:10.120"), 6, "⚠️ ≥")], "customer_id string, window_start timestamp, n long, note string"
    )
    keyed = encode(df, ["customer_id", "window_start"]).collect()
    assert keyed[0]["key"] == '{"customer_id":"a","window_start":"2024-01-01 00:00:10"}'
    assert keyed[0]["value"] == '{"customer_id":"a","window_start":"2024-01-01 00:00:10","n":5,"note":null}'
    assert json.loads(keyed[1]["value"]) == {"customer_id": "b", "window_start": "2024-01-01 00:00:10.12", "n": 6, "note": "⚠️ ≥"}
    assert encode(df, []).columns == ["value"]


def test_encoded_records_decode_to_themselves(spark):
    df = spark.createDataFrame([("TX1", "C1", 5, "x", "m", "p", "d", at("00:00:01.007"))], s.TRANSACTIONS)
    assert rows(decode_lenient(encode(df, []), s.TRANSACTIONS)) == rows(df)


def test_assembled_records(spark):
    df = spark.createDataFrame([("C1", 5, "x", "m", "p", "d", at("00:00:01.9"))], "customer_id string, amount long, location string, merchant string, payment_method string, device_id string, time timestamp_ntz")
    assert assemble(df, "time").first().asDict() == {
        "transaction_id": "TX20240101000001", "customer_id": "C1", "amount": "5", "merchant": "m", "location": "x",
        "payment_method": "p", "device_id": "d", "timestamp": "2024-01-01 00:00:01",
    }


def test_computed_event_time(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:01",), ("2024-01-01",), (None,)], "timestamp string")
    timed = with_event_time(df, "timestamp", "event_time", s.TIME_PATTERN_SECONDS)
    assert [r["event_time"] for r in timed.collect()] == [datetime(2024, 1, 1, 0, 0, 1), None, None]


def test_the_record_is_parsed_once(spark):
    df = decode_lenient(messages(spark, PAYLOADS).where(F.length("value") >= 0), s.TRANSACTIONS)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_json_line_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"customer_id":"C1","description":"x"}\noops\n{"customer_id":"C2"}\n')
    df = decoded(from_files(spark, str(tmp_path), streaming=False), "blacklist_customers")
    assert df.schema == SCHEMAS["blacklist_customers"]
    assert rows(df) == [("C1", "x"), ("C2", None)]
