from datetime import datetime, timedelta

import pytest
from conftest import NOW
from pyspark.sql import functions as F

from siftlake.functions.text import is_blank, quoted
from siftlake.operators.validate import error_reason, rule_counts, validate

NOW_TIME = datetime(2024, 2, 1)
GOOD = {
    "event_id": "550e8400-e29b-41d4-a716-446655440000", "source": "test",
    "event_timestamp": NOW_TIME, "payload": '{"k":"v"}', "version": 1,
}


def checked(spark, *changes):
    rows = [tuple({**GOOD, **change}.values()) for change in changes]
    df = spark.createDataFrame(rows, "event_id string, source string, event_timestamp timestamp, payload string, version int")
    return validate(df, NOW)


def reason(spark, **change):
    row = checked(spark, change).select("is_valid", error_reason(F.col("violations"))).first()
    assert row[0] == (row[1] == "")
    return row[1]


@pytest.mark.parametrize("change, message", [
    ({}, ""),
    ({"event_id": "550E8400E29B41D4A716446655440000"}, ""),
    ({"event_id": "550e8400-e29b41d4-a716446655440000"}, ""),
    ({"event_id": "not-a-uuid"}, "event_id is not a valid UUID: 'not-a-uuid'"),
    ({"event_id": ""}, "event_id is not a valid UUID: ''"),
    ({"event_id": "it's"}, "event_id is not a valid UUID: \"it's\""),
    ({"source": ""}, "source is empty"),
    ({"source": " \t 　\x1c "}, "source is empty"),
    ({"source": "é"}, ""),
    ({"event_timestamp": NOW_TIME + timedelta(minutes=1)}, ""),
    ({"event_timestamp": NOW_TIME + timedelta(minutes=5)}, ""),
    ({"event_timestamp": NOW_TIME + timedelta(minutes=5, microseconds=1)},
     "event_timestamp is in the future: 2024-02-01T00:05:00.000001+00:00"),
    ({"event_timestamp": NOW_TIME + timedelta(days=365)}, "event_timestamp is in the future: 2025-01-31T00:00:00+00:00"),
    ({"payload": "{}"}, "payload is empty"),
    ({"payload": " { } "}, "payload is empty"),
    ({"version": 0}, "version must be >= 1, got 0"),
])
def test_rules(spark, change, message):
    assert reason(spark, **change) == message


def test_all_violations_are_collected_in_order(spark):
    got = reason(spark, event_id="bad", source="", payload="{}", version=-2)
    assert got == "event_id is not a valid UUID: 'bad'; source is empty; payload is empty; version must be >= 1, got -2"


def test_rule_counts(spark):
    counts = rule_counts(checked(spark, {}, {"event_id": "bad"}, {"event_id": "bad", "source": ""})).collect()
    assert {r.rule: r.n for r in counts} == {"event_id": 2, "source": 1}


def test_quoted_matches_repr(spark):
    texts = ["plain", "it's", 'say "hi"', "both ' and \"", "back\\slash", "tab\tnew\nret\r", "\x00\x7f\x85\xa0\xad",
             "é☃😀", "​ ", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(quoted(F.col("t"))).collect()] == [repr(t) for t in texts]


def test_blank_matches_strip(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = [*spaces, "", "a", " a ", "​", ".", "\x00"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(is_blank(F.col("t"))).collect()] == [not t.strip() for t in texts]


@pytest.mark.parametrize("end, fine", [("", True), ("\n", True), ("\r", False), ("\r\n", False), ("\u0085", False), ("\u2028", False)])
def test_line_ends_after_an_id(spark, end, fine):
    from siftlake.operators.validate import UUID_PATTERN

    df = spark.createDataFrame([("0123abcd-0123-abcd-0123-0123456789ab" + end,)], "event_id string")
    assert df.select(df.event_id.rlike(UUID_PATTERN)).first()[0] is fine
