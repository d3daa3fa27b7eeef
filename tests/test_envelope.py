import dataclasses
import datetime as dt
import json

import pytest

from logweir.functions import envelope as E

GOOD = {
    "timestamp": "2026-01-31T12:00:00Z", "metric_date": "2026-01-31", "service_name": "s", "endpoint": "/e",
    "method": "GET", "status_code": 200, "response_time_ms": 5,
}


def wrap(data, log_type="api_metrics", **more):
    return json.dumps({"_log_type": log_type, "_log_class": "X", "_version": "1.0.0", "data": data, **more})


CASES = [
    ("ok", wrap(GOOD), None, {"status_code": 200}),
    ("extra key", wrap({**GOOD, "zzz": 1}, other=2), None, {"status_code": 200}),
    ("number for string", wrap({**GOOD, "user_id": 123}), None, {"user_id": "123"}),
    ("zone-less time", wrap({**GOOD, "timestamp": "2026-01-30T17:00:00.123456"}), None,
     {"timestamp": dt.datetime(2026, 1, 30, 17, 0, 0, 123456)}),
    ("missing required", wrap({k: v for k, v in GOOD.items() if k != "endpoint"}), "missing_required", {"endpoint": None}),
    ("null required", wrap({**GOOD, "endpoint": None}), "missing_required", {"endpoint": None, "status_code": 200}),
    ("bad int", wrap({**GOOD, "status_code": "abc"}), "bad_type", {"status_code": None, "method": "GET"}),
    ("numeric string", wrap({**GOOD, "status_code": "200"}), "bad_type", {"status_code": None}),
    ("int overflow", wrap({**GOOD, "status_code": 99999999999}), "bad_type", {"status_code": None}),
    ("bad date", wrap({**GOOD, "metric_date": "not-a-date"}), "bad_type", {"metric_date": None}),
    ("flat", json.dumps(GOOD), "no_envelope", {"status_code": None}),
    ("data is a list", wrap([1, 2]), "no_envelope", {"status_code": None}),
    ("data is text", wrap(json.dumps(GOOD)), "no_envelope", {"status_code": None}),
    ("data is null", wrap(None), "no_envelope", {"status_code": None}),
    ("other type", wrap(GOOD, "someone_else"), "unknown_type", {"status_code": 200}),
    ("cut early", wrap(GOOD)[:20], "malformed", {"status_code": None}),
    ("cut inside data", wrap(GOOD)[:150], "malformed", {"response_time_ms": None}),
    ("not an object", "[1]", "malformed", {"status_code": None}),
    ("empty", "", "null_payload", {"status_code": None}),
    ("null", None, "null_payload", {"status_code": None}),
]


@pytest.fixture(scope="module")
def raw(spark):
    rows = [(name, "k", value) for name, value, _, _ in CASES]
    return spark.createDataFrame(rows, "case string, key string, value string")


def test_reasons(raw, config):
    got = {r.case: r["_reason"] for r in E.classify(raw, [config("api_metrics", "d")]).collect()}
    assert got == {name: reason for name, _, reason, _ in CASES}


def test_decode_keeps_every_message(raw, config):
    got = {r.case: r for r in E.decode(raw, config("api_metrics", "d"), keep=("case",)).collect()}
    assert len(got) == len(CASES)
    for name, _, _, expected in CASES:
        for field, value in expected.items():
            assert got[name][field] == value, name


def test_accepted_and_rejected_are_all_messages(raw, config):
    c = config("api_metrics", "d")
    classified = E.classify(raw, [c, config("user_events", "d")])
    good, bad = E.records(classified, c), E.rejects(classified)
    assert good.count() + bad.count() == len(CASES)
    assert good.count() == sum(reason is None for _, _, reason, _ in CASES)
    assert {r.value for r in bad.collect()} == {v for _, v, reason, _ in CASES if reason}


def test_null_rows_keep_what_decodes(raw, config):
    c = config("api_metrics", "d")
    rows = E.null_rows(E.classify(raw, [c]), c).collect()
    assert len(rows) == sum(reason is not None for _, _, reason, _ in CASES)
    assert sum(r.status_code == 200 for r in rows) == 3  # missing, null required, bad date


def test_defaults_apply_before_the_required_check(spark, config):
    c = config("api_metrics", "d")
    fields = tuple(dataclasses.replace(f, default="/none") if f.name == "endpoint" else f for f in c.fields)
    c = dataclasses.replace(c, fields=fields)
    rows = spark.createDataFrame([("k", wrap({k: v for k, v in GOOD.items() if k != "endpoint"}))],
                                 "key string, value string")
    classified = E.classify(rows, [c])
    assert classified.first()["_reason"] is None
    assert E.records(classified, c).first().endpoint == "/none"


def test_default_of_a_map(spark, config):
    c = config("user_events", "d")
    fields = tuple(dataclasses.replace(f, default='{"a":"b"}') if f.name == "properties" else f for f in c.fields)
    rows = spark.createDataFrame([("k", wrap({}, "user_events"))], "key string, value string")
    assert E.decode(rows, dataclasses.replace(c, fields=fields)).first().properties == {"a": "b"}


def test_encode_leaves_out_or_keeps_nulls(spark, config):
    c = config("api_metrics", "d")
    row = spark.createDataFrame([("svc", 7)], "service_name string, response_time_ms long")
    short = json.loads(E.encode(row, c).first().value)
    assert short["_log_type"] == "api_metrics" and short["_log_class"] == "ApiMetrics"
    assert short["data"] == {"service_name": "svc", "response_time_ms": 7}
    full = json.loads(E.encode(row, c, keep_nulls=True).first().value)
    assert list(full["data"]) == [f.name for f in c.fields]


def test_bytes_payload(spark, config):
    rows = spark.createDataFrame([("k", bytearray(wrap(GOOD), "utf8"))], "key string, value binary")
    c = config("api_metrics", "d")
    assert E.decode(rows, c).first().status_code == 200
    assert E.classify(rows, [c]).first()["_reason"] is None


def test_odd_values_survive_the_trip(spark, config):
    """Text with quotes, control and wide characters, extreme numbers, early dates."""
    c = config("all_types", "d")
    texts = ["", "null", '"', "\\", "a\nb\tc\r", "\u0001\u001f", "é ü 漢字 😀", "{\"a\":1}", "</x>", " padded "]
    values = [
        (t, 2**31 - 1 - i, -(2**63) + i, float(i) / 8, [1e308, -0.0, 1 / 3, 5e-324, 2.0**53][i % 5], i % 2 == 0,
         dt.datetime(1969, 12, 31, 23, 59, 59, 999999 - i), dt.date(1, 1, 1 + i), [t, "x"], [i, -i], [2**62 + i], {t: t})
        for i, t in enumerate(texts)
    ]
    schema = E.record_schema(c.fields)
    rows = spark.createDataFrame(values, schema)
    messages = E.encode(rows, c)
    back = E.decode(messages, c)
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
    assert {r["_reason"] for r in E.classify(messages, [c]).select("_reason").collect()} == {None}
