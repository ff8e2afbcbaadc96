"""JSON envelopes in a landing folder as raw events.

An envelope is ``{"event_id"?, "source"?, "timestamp"?, "payload"?}``. Its own
``timestamp`` is accepted and not used; other keys are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlake.functions.plan import fence, step
from siftlake.functions.values import after_blanks, field_json, is_object, is_string, string_content
from siftlake.session import scratch_path
from siftlake.sources.kafka import stable_uuid

DEFAULT_SOURCE = "webhook"

# Bits of seq on a stream: the file above, its line below; two bits stay free for merging.
_FILE_BITS, _LINE_BITS = 37, 24


def read_landing(spark: SparkSession, path: str, staged_at: str | None = None) -> DataFrame:
    """All lines under ``path`` as ``seq, body, received_at``, read and numbered once.

    A row number of a text scan depends on how the files were split, so the
    numbered lines are written out (by default to the shared folder) and every
    later step reads that table.
    """
    lines = spark.read.text(path).select(
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("body"),
        F.col("_metadata.file_modification_time").alias("received_at"),
    )
    target = staged_at or scratch_path(spark, "landing")
    lines.filter(F.trim("body") != "").write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def read_landing_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1_000) -> DataFrame:
    """Lines of new files under ``path`` as a stream of ``seq, body, file, line, received_at``.

    A line is known by its file and its place there, the same on every replay.
    Streams cannot number rows, so a file is read as one value and must fit in
    a task's memory. ``seq`` orders the lines of a file; made ids come from
    ``file`` and ``line`` themselves.
    """
    files = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", max_files_per_trigger).load(path)
    lines = files.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("received_at"),
        F.posexplode(F.split("value", r"\r\n|\r|\n")).alias("line", "body"),
    )
    place = F.pmod(F.xxhash64("file"), F.lit(1 << _FILE_BITS))
    seq = F.shiftleft(place, _LINE_BITS) + F.col("line")
    return lines.filter(F.trim("body") != "").select(seq.alias("seq"), "body", "file", "line", "received_at")


def _checked(envelopes: DataFrame, text: str) -> DataFrame:
    """Parse and type-check: ``reason`` is NULL for an acceptable envelope."""
    body = F.col(text)
    df = step(envelopes, _doc=F.try_parse_json(body))
    names = ("event_id", "source", "timestamp", "payload")
    df = step(df, _parsed=F.col("_doc").isNotNull(), **{f"_{n}": field_json(F.col("_doc"), n) for n in names})
    df = df.drop("_doc")

    def text_or_null(name: str) -> Column:
        value = F.col(f"_{name}")
        return value.isNull() | (value == "null") | is_string(value)

    reason = (
        F.when(~F.col("_parsed"), "body is not valid JSON")
        .when(~after_blanks(body).startswith("{"), "body is not an object")
        .when(~text_or_null("event_id"), "event_id is not a string")
        .when(~text_or_null("source"), "source is not a string")
        .when(~text_or_null("timestamp"), "timestamp is not a string")
        .when(F.col("_payload").isNotNull() & ~is_object(F.col("_payload")), "payload is not an object")
    )
    return fence(df.withColumn("reason", reason), "reason")


def accept_envelopes(
    envelopes: DataFrame, text: str = "body", default_source: str = DEFAULT_SOURCE
) -> DataFrame:
    """Raw events of the acceptable envelopes in ``seq, <text>, received_at``.

    A missing id is made of ``file`` and ``line`` where the input has them, else
    of the number, the time and the text.
    """
    placed = {"file", "line"} <= set(envelopes.columns)

    def given(name: str) -> Column:
        value = string_content(F.col(f"_{name}"))
        return F.when(value != "", value)

    at = F.unix_micros(F.col("received_at").cast("timestamp")).cast("string")
    place = (F.col("file"), F.col("line").cast("string")) if placed else (F.col("seq").cast("string"), at, F.col(text))
    new_id = stable_uuid(*place)
    return _checked(envelopes, text).filter(F.col("reason").isNull()).select(
        "seq",
        F.coalesce(given("event_id"), new_id).alias("event_id"),
        F.coalesce(given("source"), F.lit(default_source)).alias("source"),
        F.coalesce(F.col("_payload"), F.lit("{}")).alias("payload"),
        F.col("received_at").cast("timestamp").alias("received_at"),
    )


def reject_envelopes(envelopes: DataFrame, text: str = "body") -> DataFrame:
    """The refused envelopes, as they came, with the first thing wrong with them."""
    return _checked(envelopes, text).filter(F.col("reason").isNotNull()).select(
        "seq", F.col(text).alias("raw_text"), "reason"
    )
