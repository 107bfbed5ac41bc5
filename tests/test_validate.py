"""Every validator case: one changed field, the expected code."""

import json

import pytest
from pyspark.sql import functions as F

from riskloom.operators import validate
from riskloom.sources.events import decode_payloads

NOW = "2024-06-15 12:00:00"
GONE = object()
BASE = {
    "event_version": "v1", "tenant_id": 1, "transaction_id": 12345, "transaction_reference": "TEST-001",
    "account_id": "ACC-TEST-001", "amount": 500.00, "currency": "MYR", "direction": "DEBIT", "status": "BOOKED",
    "timestamp": "2024-06-15T12:00:00",
}
CASES = [
    ({}, None),
    *[({"direction": d}, None) for d in ("CREDIT", "DR", "CR", "in", " out ")],
    *[({"currency": c}, None) for c in ("MYR", "USD", "SGD", "EUR", "GBP", "myr")],
    *[({"status": s}, None) for s in ("BOOKED", "POSTED", "PENDING", "SETTLED", "COMPLETED")],
    ({"vendor_code": "V", "employee_id": "E"}, None),
    ({"amount": 0.01}, None), ({"amount": 10_000_000}, None), ({"amount": "500.00"}, None),
    *[({f: GONE}, "MISSING_FIELD") for f in ("transaction_id", "transaction_reference", "account_id", "amount", "currency", "direction", "status", "timestamp")],
    ({"account_id": ""}, "MISSING_FIELD"), ({"account_id": " \t\n "}, "MISSING_FIELD"),
    ({"tenant_id": GONE}, "INVALID_TENANT"), ({"tenant_id": 0}, "INVALID_TENANT"), ({"tenant_id": -1}, "INVALID_TENANT"),
    ({"tenant_id": "abc"}, "INVALID_TENANT"), ({"tenant_id": 99}, None),
    ({"tenant_id": GONE, "account_id": ""}, "INVALID_TENANT"),
    ({"amount": 0}, "INVALID_AMOUNT"), ({"amount": -100}, "INVALID_AMOUNT"), ({"amount": 10_000_001}, "INVALID_AMOUNT"),
    ({"amount": "abc"}, "INVALID_AMOUNT"), ({"amount": None}, "MISSING_FIELD"), ({"amount": "NaN"}, "INVALID_AMOUNT"),
    ({"amount": "500.00d"}, "INVALID_AMOUNT"), ({"amount": "inf"}, "INVALID_AMOUNT"), ({"amount": "1e3"}, None),
    ({"currency": "XYZ"}, "INVALID_CURRENCY"), ({"currency": "123"}, "INVALID_CURRENCY"), ({"currency": ""}, "MISSING_FIELD"),
    ({"direction": "SIDEWAYS"}, "INVALID_DIRECTION"), ({"direction": ""}, "MISSING_FIELD"),
    ({"status": "BOGUS"}, "INVALID_STATUS"),
    ({"timestamp": "2023-05-12T12:00:00"}, "STALE_EVENT"),
    ({"timestamp": "2024-06-15T12:06:40"}, "INVALID_TIMESTAMP"), ({"timestamp": "not-a-date"}, "INVALID_TIMESTAMP"),
    ({"timestamp": "2024"}, "INVALID_TIMESTAMP"), ({"timestamp": "2024-02-30"}, "INVALID_TIMESTAMP"),
    ({"timestamp": "2024-06-15T11:00:00"}, None), ({"timestamp": "2024-06-15T12:01:00"}, None),
    ({"timestamp": "2024-06-15T12:05:00"}, None), ({"timestamp": "2024-06-15T12:05:01"}, "INVALID_TIMESTAMP"),
    ({"timestamp": "2023-06-16T12:00:00"}, None), ({"timestamp": "20240615T120000"}, None),
    ({"timestamp": "2024-06-15T12:00:00Z"}, None), ({"timestamp": "2024-06-15T20:04:00+08:00"}, None),
    ({"timestamp": "2024-06-15T12:04:00-08:00"}, "INVALID_TIMESTAMP"),
    ({"transaction_id": "T1"}, "SCHEMA_ERROR"),
    ({"tenant_id": 1.0}, None), ({"tenant_id": 1.9}, None), ({"tenant_id": True}, None), ({"tenant_id": 2e0}, None),
    ({"tenant_id": "1"}, None), ({"tenant_id": " 1 "}, None), ({"tenant_id": "1.0"}, "INVALID_TENANT"), ({"tenant_id": "true"}, "INVALID_TENANT"),
    ({"tenant_id": 0.9}, "INVALID_TENANT"), ({"tenant_id": False}, "INVALID_TENANT"), ({"tenant_id": -1.5}, "INVALID_TENANT"),
    ({"tenant_id": [1]}, "INVALID_TENANT"), ({"tenant_id": {"a": 1}}, "INVALID_TENANT"), ({"tenant_id": None}, "INVALID_TENANT"),
    ({"tenant_id": 1e300}, "INVALID_TENANT"),
    ({"transaction_id": 12.0}, None), ({"transaction_id": 12.5}, "SCHEMA_ERROR"), ({"transaction_id": "12"}, None),
]


def event(change):
    return {k: v for k, v in {**BASE, **change}.items() if v is not GONE}


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, json.dumps(event(c))) for i, (c, _) in enumerate(CASES)]
    extra = ["{bad", "[1]", "5", "null", '"text"']
    rows += [(1000 + i, t) for i, t in enumerate(extra)]
    df = spark.createDataFrame(rows, "case int, value string")
    return validate.validate(decode_payloads(df), NOW).cache()


def test_codes(judged):
    got = {r.case: r.rejection_code for r in judged.select("case", "rejection_code").collect()}
    wrong = [(c, want, got[i]) for i, (c, want) in enumerate(CASES) if got[i] != want]
    assert not wrong
    assert {got[1000 + i] for i in range(5)} == {"SCHEMA_ERROR"}


def test_missing_field_is_named(judged):
    reasons = {r.case: r.rejection_reason for r in validate.verdicts(judged, "case", as_of=NOW).collect()}
    for i, (change, code) in enumerate(CASES):
        if code == "MISSING_FIELD":
            assert f"'{next(iter(change))}'" in reasons[i]


def test_reject_record(spark):
    rows = [(json.dumps(event({"amount": -50})),), (json.dumps(event({"tenant_id": GONE})),)]
    j = validate.validate(decode_payloads(spark.createDataFrame(rows, "value string")), NOW)
    a, b = validate.rejected(j, as_of=NOW).orderBy(F.desc("rejection_code")).collect()
    assert (b.rejection_code, b.pipeline_stage, b.account_id, float(b.amount)) == ("INVALID_AMOUNT", "raw", "ACC-TEST-001", -50.0)
    assert json.loads(b.raw_payload)["amount"] == -50 and b.event_id_text == "TEST-001"
    assert b.rejection_reason == "amount -50.0 is below minimum 0.01 (zero or negative amounts rejected)"
    assert (a.rejection_code, a.tenant_id) == ("INVALID_TENANT", None)


def test_offset_keeps_wall_clock(spark):
    df = spark.createDataFrame([(json.dumps(event({"timestamp": "2024-06-15T19:30:00+08:00"})),)], "value string")
    r = validate.valid(validate.validate(decode_payloads(df), NOW)).select(
        F.col("event_time").cast("string").alias("t"), F.col("event_wall").cast("string").alias("w")
    ).first()
    assert (r.t, r.w) == ("2024-06-15 11:30:00", "2024-06-15 19:30:00")


def test_typed_ids_keep_their_numbers(spark):
    rows = [(json.dumps(event({"tenant_id": t, "transaction_id": x})),) for t, x in ((2.7, 5.0), (True, 6), ("3", "7"))]
    good = validate.valid(validate.validate(decode_payloads(spark.createDataFrame(rows, "value string")), NOW))
    assert sorted((r.tenant_id, r.transaction_id) for r in good.collect()) == [(1, 6), (2, 5), (3, 7)]


def test_valid_and_rejected_split_everything(judged):
    n = judged.count()
    assert validate.valid(judged).count() + validate.rejected(judged, as_of=NOW).count() == n
