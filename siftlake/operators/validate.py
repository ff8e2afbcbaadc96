"""Data-quality rules on canonical events: every violation is collected."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlake.functions.plan import fence, step
from siftlake.functions.text import is_blank, quoted
from siftlake.functions.timestamps import MICROS, as_instant, iso_text
from siftlake.functions.values import is_empty_object

# Fixed pattern: a UUID of any version, each hyphen optional.
UUID_PATTERN = r"(?i)^[0-9a-f]{8}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{12}\n?\z"
# Fixed value: tolerated clock skew.
FUTURE_TOLERANCE_SECONDS = 300

RULES = ("event_id", "source", "event_timestamp", "payload", "version")


def validate(events: DataFrame, as_of: object = None) -> DataFrame:
    """Add ``violations`` (array<struct<rule, message>>, in rule order) and ``is_valid``.

    ``event_offset_us`` (zone the time was written in) and ``may_be_empty``
    are used when present; without them UTC is shown and payloads are checked.
    """
    offset_us = F.col("event_offset_us") if "event_offset_us" in events.columns else F.lit(0).cast("bigint")
    may_be_empty = F.col("may_be_empty") if "may_be_empty" in events.columns else F.lit(True)
    event_id, version, event_us = F.col("event_id"), F.col("version"), F.unix_micros("event_timestamp")
    limit_us = F.unix_micros(as_instant(as_of)) + F.lit(FUTURE_TOLERANCE_SECONDS * MICROS)
    # The five message texts.
    failures = [
        (~F.coalesce(event_id.rlike(UUID_PATTERN), F.lit(False)),
         F.concat(F.lit("event_id is not a valid UUID: "), quoted(event_id))),
        (is_blank(F.col("source")), F.lit("source is empty")),
        (event_us > limit_us,
         F.concat(F.lit("event_timestamp is in the future: "), iso_text(event_us, offset_us))),
        (may_be_empty & is_empty_object(F.col("payload")), F.lit("payload is empty")),
        (version < 1, F.concat(F.lit("version must be >= 1, got "), version.cast("string"))),
    ]
    # Flags first: messages are only put together for the few events that fail.
    flags = [f"_failed_{rule}" for rule in RULES]
    flagged = step(events, **{flag: F.coalesce(failed, F.lit(False)) for flag, (failed, _) in zip(flags, failures)})
    nothing = F.array().cast("array<struct<rule:string,message:string>>")
    found = F.flatten(F.array(*[
        F.when(F.col(flag), F.array(F.struct(F.lit(rule).alias("rule"), message.alias("message")))).otherwise(nothing)
        for flag, rule, (_, message) in zip(flags, RULES, failures)
    ]))
    any_failed = reduce(lambda left, right: left | right, [F.col(flag) for flag in flags])
    checked = flagged.withColumn("violations", F.when(any_failed, found).otherwise(nothing)).drop(*flags)
    return fence(checked, "violations").withColumn("is_valid", F.size("violations") == 0)


def error_reason(violations: Column) -> Column:
    """All messages of one event in one text."""
    return F.array_join(violations["message"], "; ")


def rule_counts(validated: DataFrame) -> DataFrame:
    """Events failing each rule (an event counts once per rule it fails)."""
    return (
        validated.filter(~F.col("is_valid"))
        .select(F.explode(F.col("violations")["rule"]).alias("rule"))
        .groupBy("rule")
        .agg(F.count("*").alias("n"))
    )
