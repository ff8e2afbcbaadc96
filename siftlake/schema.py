"""Record layouts shared by sources, operators and sinks."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_EVENT = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("received_at", T.TimestampType()),
])

CANONICAL_EVENT = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("ingest_timestamp", T.TimestampType(), False),
    T.StructField("event_timestamp", T.TimestampType(), False),
    T.StructField("payload", T.StringType(), False),
    T.StructField("version", T.IntegerType(), False),
])

DLQ_RECORD = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("raw_payload", T.StringType()),
    T.StructField("error_reason", T.StringType()),
    T.StructField("first_seen_at", T.TimestampType()),
])

CANONICAL_COLUMNS = CANONICAL_EVENT.fieldNames()
DLQ_COLUMNS = DLQ_RECORD.fieldNames()
