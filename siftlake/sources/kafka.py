"""Kafka topics as raw events.

The reader needs Spark's Kafka connector on the classpath. Everything after it
works on any frame with ``topic, partition, offset, value, timestamp``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlake.functions.plan import fence, step
from siftlake.functions.timestamps import as_instant
from siftlake.functions.values import after_blanks, field_json, is_string, is_truthy, string_content

DEFAULT_TOPICS = ("orders", "clicks")
MALFORMED_REASON = "malformed message"

# Bits of seq: offset above, then partition, then the topic's place in the list.
_TOPIC_BITS, _PARTITION_BITS = 9, 14


def kafka_options(
    servers: str,
    topics: tuple[str, ...] = DEFAULT_TOPICS,
    starting: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Reader options. Progress lives in the query's checkpoint, not in a consumer group."""
    if starting not in ("earliest", "latest"):
        raise ValueError("starting must be 'earliest' or 'latest'")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_kafka(spark: SparkSession, servers: str, streaming: bool = True, **kwargs: object) -> DataFrame:
    """The topics as a stream (or, for ``streaming=False``, all there is now)."""
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**kafka_options(servers, **kwargs)).load()


def message_seq(topics: tuple[str, ...]) -> Column:
    """A unique number per message, the same on every replay; a topic outside the list fails the read."""
    if len(topics) >= 1 << _TOPIC_BITS:
        raise ValueError("too many topics for a message number")
    place = F.array_position(F.lit(list(topics)), F.col("topic"))
    known = (place > 0) & F.col("partition").between(0, (1 << _PARTITION_BITS) - 1)
    outside = F.raise_error(F.concat(F.lit("no message number for topic "), F.coalesce("topic", F.lit("null")), F.lit(", partition "), F.col("partition").cast("string")))
    place = F.when(known, place).otherwise(outside.cast("bigint"))
    tail = F.shiftleft(F.col("partition").cast("bigint"), _TOPIC_BITS) + place
    return F.shiftleft(F.col("offset"), _TOPIC_BITS + _PARTITION_BITS) + tail


def stable_uuid(*parts: Column) -> Column:
    """A UUID made of ``parts``: a retried task or a replayed batch gives the same one."""
    digest = F.md5(F.concat_ws("\x1f", *parts))
    spans = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in spans])


def kafka_to_raw(
    messages: DataFrame, topics: tuple[str, ...] = DEFAULT_TOPICS, as_of: object = None
) -> DataFrame:
    """One raw event per message, with ``is_object`` and ``malformed``.

    An object keeps its own non-empty ``event_id``; anything else is wrapped as
    ``{"raw": value}`` and gets a new id. Text that is no JSON, and an object
    whose id is not a string, is malformed: it belongs in the dead letters.
    ``received_at`` is ``as_of``, else the message's own timestamp.
    """
    received = F.col("timestamp") if as_of is None else as_instant(as_of)
    text = F.col("value").cast("string")
    df = messages.select(
        message_seq(topics).alias("seq"),
        F.concat(F.lit("kafka-"), F.col("topic")).alias("source"),
        text.alias("_text"),
        received.cast("timestamp").alias("received_at"),
        stable_uuid(F.col("topic"), F.col("partition").cast("string"), F.col("offset").cast("string")).alias("_new"),
    )
    df = step(df, _doc=F.try_parse_json("_text"))
    df = step(
        df,
        _id=field_json(F.col("_doc"), "event_id"),
        _is_json=F.col("_doc").isNotNull(),
        _is_object=F.col("_doc").isNotNull() & after_blanks(F.col("_text")).startswith("{"),
    ).drop("_doc")
    own = F.col("_is_object") & is_truthy(F.col("_id"))
    df = df.select(
        "seq",
        F.when(own, string_content(F.col("_id"))).otherwise(F.col("_new")).alias("event_id"),
        "source",
        F.when(F.col("_is_object") | ~F.col("_is_json"), F.col("_text"))
        .otherwise(F.concat(F.lit('{"raw":'), F.col("_text"), F.lit("}")))
        .alias("payload"),
        "received_at",
        own.alias("has_id"),
        F.col("_is_object").alias("is_object"),
        (~F.col("_is_json") | (own & ~is_string(F.col("_id")))).alias("malformed"),
    )
    return fence(df, "has_id", "is_object", "malformed")


def malformed_records(raw: DataFrame, as_of: object = None) -> DataFrame:
    """Dead-letter records of the malformed messages."""
    return raw.filter("malformed").select(
        "seq",
        F.when(F.col("has_id") & F.col("event_id").isNull(), F.lit("")).otherwise(F.col("event_id")).alias("event_id"),
        "source",
        F.col("payload").alias("raw_payload"),
        F.lit(MALFORMED_REASON).alias("error_reason"),
        as_instant(as_of).alias("first_seen_at"),
    )
