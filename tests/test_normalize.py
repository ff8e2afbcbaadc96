import json
import math
from datetime import datetime, timedelta, timezone

import pytest
from conftest import NOW
from pyspark.sql import functions as F

from siftlake.functions.timestamps import iso_text, parse_event_time
from siftlake.functions.values import first_truthy
from siftlake.operators.normalize import ColumnMapping, normalize, python_mapping, register_mapper

ID = "0123abcd-0123-abcd-0123-0123456789ab"
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)

def normalized(raw, rows, **kwargs):
    return normalize(raw([(ID, source, json.dumps(p)) for source, p in rows]), NOW, **kwargs).orderBy("seq").collect()


#: A value and its instant in microseconds, None (no timestamp) or 'error'.
TIMES = [
    ('2025-01-15T10:30:00Z', 1736937000000000),
    ('2025-01-15T10:30:00.123456Z', 1736937000123456),
    ('2025-01-15T10:30:00.5Z', 1736937000500000),
    ('2025-01-15t10:30:00z', 1736937000000000),
    ('2025-01-15T10:30:00+05:30', 1736917200000000),
    ('2025-01-15T10:30:00.25-0800', 1736965800250000),
    ('2025-01-15T10:30:00+01:02:03', 1736933277000000),
    ('2025-01-15T10:30:00+010203', 1736933277000000),
    ('2025-01-15T10:30:00+01:0203', None),
    ('2025-01-15T10:30:00+01:02:03.25', 1736933276750000),
    ('2025-01-15T10:30:00+23:59', 1736850660000000),
    ('2025-01-15T10:30:00-19:00', 1737005400000000),
    ('2025-01-15T10:30:00+24:00', None),
    ('2025-01-15T10:30:00+01:60', None),
    ('2025-01-15 10:30:00', 1736937000000000),
    ('2025-1-5 1:2:3', 1736038923000000),
    ('2025-1-5T1:2:3Z', 1736038923000000),
    ('2025-01-15   10:30:00', 1736937000000000),
    ('2025-01-15\t10:30:00', 1736937000000000),
    ('2025-01- 5 10:30:00', 1736073000000000),
    ('2025-01- 5T10:30:00Z', 1736073000000000),
    ('2025-01-15', None),
    ('2025-01-15T10:30:00', None),
    ('2025-01-15 10:30:00Z', None),
    ('2025-01-15 10:30:00.5', None),
    ('2025-01-15T10:30Z', None),
    ('2025-01-15T10:30:00.1234567Z', None),
    ('2025-02-30T10:30:00Z', None),
    ('2025-13-01T10:30:00Z', None),
    ('2025-01-15T24:00:00Z', None),
    ('2025-01-15T10:30:60Z', None),
    ('2025-01-15T10:30:00Z ', None),
    (' 2025-01-15T10:30:00Z', None),
    ('2025-01-15T10:30:00Z\n', None),
    ('0001-01-01T00:00:00Z', -62135596800000000),
    ('9999-12-31T23:59:59Z', 253402300799000000),
    ('0000-01-01T00:00:00Z', None),
    ('25-01-15T10:30:00Z', None),
    ('12025-01-15T10:30:00Z', None),
    ('2025-01-15T10:30:00 +05:30', None),
    ('now', None),
    ('', None),
    ('1705000000', None),
    ('10:30', None),
    ('2025-01-15T10:30:00.Z', None),
    (1705000000, 1705000000000000),
    (1705000000000, 1705000000000000),
    (1705000000123, 1705000000123000),
    (1705000000.123456, 1705000000123456),
    (1705000001.0, 1705000001000000),
    (1000000000000.0, 1000000000000000),
    (999999999999, 'error'),
    (1, 1000000),
    (-1, -1000000),
    (-62135596800, -62135596800000000),
    (-62135596801, 'error'),
    (253402300799, 253402300799000000),
    (253402300800, 'error'),
    (253402300799999, 253402300799998993),
    (253402300800000, 'error'),
    (1e+300, 'error'),
    (-1e+300, 'error'),
    (1.5, 1500000),
    (-1.5, -1500000),
    (2500000000000.75, 2500000000000750),
    (True, 1000000),
    (0.1, 100000),
    (123456789.0000005, 123456789000001),
]


def test_every_time_value_matches_the_stated_rules(raw):
    events = normalize(raw([(ID, "s", json.dumps({"created_at": t, "x": 1})) for t, _ in TIMES]), NOW).orderBy("seq")
    got = events.select("parse_error", "ts_fallback", F.unix_micros("event_timestamp").alias("us")).collect()
    for (value, want), row in zip(TIMES, got, strict=True):
        if want == "error":
            assert row.parse_error, value
        elif want is None:
            assert row.ts_fallback and not row.parse_error, value
        else:
            assert not row.parse_error and not row.ts_fallback, value
            assert row.us == want, value


def test_first_truthy_of_each_kind(spark):
    empties = ["null", '""', "0", "0.0", "-0.0", "false", "[]", "{}"]
    df = spark.createDataFrame([(e, '"x"') for e in empties] + [('"0"', '"x"'), ("1", '"x"')], "a string, b string")
    assert [r[0] for r in df.select(first_truthy(F.col("a"), F.col("b"))).collect()] == ['"x"'] * 8 + ['"0"', "1"]


def test_all_falsy_keeps_the_last_operand(raw):
    zero, false, empty = normalized(raw, [
        ("s", {"timestamp": "", "created_at": 0}), ("s", {"created_at": False}), ("s", {"timestamp": 0, "created_at": []}),
    ])
    assert zero.event_timestamp == false.event_timestamp == datetime(1970, 1, 1)
    assert empty.ts_fallback


def test_orders(raw):
    full, bare, null = normalized(raw, [
        ("kafka-orders", {"order_id": "ORD-1", "created_at": "2025-01-15T10:30:00Z", "amount": 99.99, "currency": "EUR",
                          "customer_id": "C-1", "items": 3}),
        ("kafka-orders", {"order_id": "ORD-2", "created_at": "2025-01-15T10:30:00Z"}),
        ("kafka-orders", {"order_id": "ORD-3", "currency": None, "timestamp": 1705000000000}),
    ])
    assert json.loads(full.payload) == {"order_id": "ORD-1", "amount": 99.99, "currency": "EUR", "customer_id": "C-1"}
    assert full.event_timestamp == datetime(2025, 1, 15, 10, 30)
    assert json.loads(bare.payload) == {"order_id": "ORD-2", "amount": None, "currency": "USD", "customer_id": None}
    assert json.loads(null.payload)["currency"] is None
    assert null.event_timestamp.year == 2024
    assert full.version == 1 and full.event_id == ID


def test_payload_values_of_any_kind_survive_the_mapping(raw):
    odd = {"order_id": {"a": [1, {"b": None}]}, "amount": "quote \" and \\ and é", "customer_id": [True, 1.5]}
    (row,) = normalized(raw, [("kafka-orders", odd)])
    assert json.loads(row.payload) == {**odd, "currency": "USD"}


def test_clicks(raw):
    (row,) = normalized(raw, [("kafka-clicks", {"click_id": "c", "url": "/", "user_id": "u", "ts": 1705000000000, "device": "m"})])
    assert row.event_timestamp.year == 2024
    assert json.loads(row.payload) == {"click_id": "c", "url": "/", "user_id": "u", "referrer": None}


def test_generic_passes_the_payload_through(raw):
    text = '{"timestamp": "2025-06-01T00:00:00Z",  "custom_field": "é", "z": 1, "a": [ ]}'
    (row,) = normalize(raw([(ID, "somewhere", text)]), NOW).collect()
    assert row.payload == text
    assert row.event_timestamp == datetime(2025, 6, 1)


def test_missing_time_falls_back_to_processing_time(raw):
    (row,) = normalized(raw, [("s", {"custom_field": 1})])
    assert row.ts_fallback and row.event_timestamp == datetime(2024, 2, 1)


def test_repeated_key_keeps_the_last_value(raw):
    (row,) = normalize(raw([(ID, "kafka-orders", '{"order_id":"a","order_id":"b"}')]), NOW).collect()
    assert json.loads(row.payload)["order_id"] == "b"


def test_custom_mapping(raw):
    mappers = register_mapper(None, "mine", ColumnMapping(
        event_time=lambda doc: F.timestamp_seconds(F.try_variant_get(doc, "$.when", "bigint")),
        payload=lambda doc: F.to_json(F.struct(F.try_variant_get(doc, "$.n", "int").alias("twice") * 2)),
    ))
    mine, other = normalized(raw, [("mine", {"when": 10, "n": 4}), ("kafka-clicks", {"click_id": 1})], mappers=mappers)
    assert mine.event_timestamp == datetime(1970, 1, 1, 0, 0, 10)
    assert "8" in mine.payload
    assert json.loads(other.payload)["click_id"] == 1


def test_a_failed_custom_mapping_concerns_its_own_event(raw):
    mapping = ColumnMapping(
        event_time=lambda doc: F.timestamp_seconds(F.variant_get(doc, "$.when", "bigint")),
        payload=lambda doc: F.to_json(F.struct(F.try_variant_get(doc, "$.n", "int").alias("n"))),
        error=lambda doc: F.try_variant_get(doc, "$.when", "bigint").isNull(),
    )

    def opaque(document):
        return datetime.fromtimestamp(document["when"], timezone.utc), {"n": document["n"] + 1}

    for mappers in (register_mapper(None, "mine", mapping), register_mapper(None, "mine", python_mapping(opaque))):
        events = [("mine", {"when": 10, "n": 4}), ("mine", {"when": "oops", "n": 4}), ("mine", {"n": 1}), ("other", {"a": 1})]
        rows = normalized(raw, events, mappers=mappers)
        assert [r.parse_error for r in rows] == [False, True, True, False]
        assert rows[0].event_timestamp == datetime(1970, 1, 1, 0, 0, 10)


def test_plan_stays_small(raw):
    df = normalize(raw([(ID, "s", "{}")]), NOW).filter("ts_fallback AND NOT parse_error")
    assert len(df._jdf.queryExecution().optimizedPlan().toString()) < 40_000


@pytest.mark.parametrize("offset", [0, 19_800_000_000, -28_800_000_000, 3_723_000_000, 3_723_250_000])
@pytest.mark.parametrize("micros", [0, 1_705_000_000_000_000, 1_705_000_000_123_450, -1])
def test_iso_text(spark, micros, offset):
    got = spark.range(1).select(iso_text(F.lit(micros).cast("bigint"), F.lit(offset).cast("bigint"))).first()[0]
    zone = timezone(timedelta(microseconds=offset))
    assert got == (EPOCH + timedelta(microseconds=micros)).astimezone(zone).isoformat()


def test_times_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([('"2025-01-15 10:30:00"',), ('"2025-01-15T10:30:00+02:00"',)], "j string")
    before = [r.event_us for r in parse_event_time(df, "j").collect()]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert [r.event_us for r in parse_event_time(df, "j").collect()] == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert not any(math.isnan(v) for v in before)


def test_a_python_mapping_sees_each_event_of_its_source_once(spark, tmp_path):
    log = str(tmp_path / "calls")

    def noted(payload):
        with open(log, "a") as out:
            out.write(f"{payload['n']}\n")
        return None, {"n": payload["n"]}

    rows = [(i, f"e{i}", "mine" if i % 10 == 0 else "other", json.dumps({"n": i}), NOW) for i in range(100)]
    raw = spark.createDataFrame(rows, "seq bigint, event_id string, source string, payload string, received_at string")
    got = normalize(raw, NOW, register_mapper(None, "mine", python_mapping(noted))).filter("NOT parse_error AND payload IS NOT NULL").collect()
    assert len(got) == 100
    assert sorted(map(int, open(log).read().split())) == list(range(0, 100, 10))
