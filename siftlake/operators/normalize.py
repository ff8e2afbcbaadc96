"""Raw events to the canonical schema, by per-source mappings.

Input columns: ``seq, event_id, source, payload, received_at``. All sources go
through one pass: every output column is a single CASE over ``source``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field as dataclass_field
from datetime import datetime, timedelta, timezone
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlake.functions.plan import fence, step
from siftlake.functions.timestamps import as_instant, parse_event_time
from siftlake.functions.values import after_blanks, field_json, first_truthy

CANONICAL_VERSION = 1
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


@dataclass(frozen=True)
class FieldMapping:
    """Event time from the first non-empty of some fields, payload from named fields.

    ``payload_fields=None`` passes the payload through as it is. ``defaults``
    apply to absent fields only; an explicit null stays null.
    """

    time_fields: tuple[str, ...]
    payload_fields: tuple[str, ...] | None = None
    defaults: dict[str, object] = dataclass_field(default_factory=dict)

    def payload(self, document: Column, raw: Column) -> Column:
        if self.payload_fields is None:
            return raw

        def member(name: str) -> Column:
            absent = json.dumps(self.defaults.get(name), ensure_ascii=False)
            return F.concat(F.lit(json.dumps(name) + ":"), F.coalesce(field_json(document, name), F.lit(absent)))

        members = F.concat_ws(",", *[member(name) for name in self.payload_fields])
        return F.concat(F.lit("{"), members, F.lit("}"))


@dataclass(frozen=True)
class ColumnMapping:
    """A mapping written as Columns over the parsed payload.

    ``event_time(document)`` gives a TIMESTAMP (NULL means processing time) and
    ``payload(document)`` the cleaned payload as JSON text. Where
    ``error(document)`` is true neither is evaluated, and the event becomes an
    unhandled error; so does one whose payload comes out NULL. All stay inside
    Catalyst, so write them with the ``try_`` functions: a cast that fails ends
    the job. ``python_mapping`` makes one of an opaque Python function.
    """

    event_time: Callable[[Column], Column]
    payload: Callable[[Column], Column]
    error: Callable[[Column], Column] | None = None

    def failed(self, document: Column) -> Column:
        return F.lit(False) if self.error is None else F.coalesce(self.error(document), F.lit(False))


def python_mapping(function: Callable[[dict], tuple[datetime | None, dict]]) -> ColumnMapping:
    """A mapping by a Python function from the parsed payload to event time and cleaned payload.

    Runs in Arrow batches, once for each event of its sources. An event for which it raises, or gives no JSON object
    or a time without zone, becomes an unhandled error; the others go on.
    """

    @F.pandas_udf("event_us bigint, payload string, error boolean")
    def mapped(documents: pd.Series) -> pd.DataFrame:
        rows = []
        for text in documents:
            if text is None:  # no object, or an event of another source
                rows.append((None, None, True))
                continue
            try:
                at, payload = function(json.loads(text))
                micros = None if at is None else (at - _EPOCH) // timedelta(microseconds=1)
                if not isinstance(payload, dict):
                    raise TypeError("a mapped payload must be a dict")
                rows.append((micros, json.dumps(payload, ensure_ascii=False), False))
            except Exception:  # whatever an opaque function raises concerns its own event only
                rows.append((None, None, True))
        frame = pd.DataFrame(rows, columns=["event_us", "payload", "error"])
        return frame.astype({"event_us": "Int64", "error": "bool"})

    def part(name: str) -> Callable[[Column], Column]:
        return lambda document: mapped(F.to_json(document))[name]

    return ColumnMapping(lambda document: F.timestamp_micros(part("event_us")(document)), part("payload"), part("error"))


Mapping = FieldMapping | ColumnMapping

# The fields of the two known sources, and the time fields of all others.
ORDERS = FieldMapping(
    time_fields=("created_at", "timestamp"),
    payload_fields=("order_id", "amount", "currency", "customer_id"),
    defaults={"currency": "USD"},
)
CLICKS = FieldMapping(
    time_fields=("ts", "timestamp"),
    payload_fields=("click_id", "url", "user_id", "referrer"),
)
GENERIC = FieldMapping(time_fields=("timestamp", "event_timestamp", "ts", "created_at"))

BUILT_IN: dict[str, Mapping] = {"kafka-orders": ORDERS, "kafka-clicks": CLICKS}


def register_mapper(mappers: dict[str, Mapping] | None, source: str, mapping: Mapping) -> dict[str, Mapping]:
    """A new registry in which ``source`` uses ``mapping``; the given one is unchanged."""
    return {**(BUILT_IN if mappers is None else mappers), source: mapping}


def _per_source(mappers: dict[str, Mapping], value: Callable[[Mapping], Column]) -> Column:
    """CASE over the source, the generic mapping for every other one."""
    branches = [(F.col("source") == source, value(mapping)) for source, mapping in mappers.items()]
    if not branches:
        return value(GENERIC)
    chain = reduce(lambda case, branch: case.when(*branch), branches[1:], F.when(*branches[0]))
    return chain.otherwise(value(GENERIC))


def _time_fields(mappings: Iterable[Mapping]) -> list[str]:
    names = [n for m in mappings if isinstance(m, FieldMapping) for n in m.time_fields]
    return list(dict.fromkeys(names))


def normalize(
    raw: DataFrame,
    as_of: object = None,
    mappers: dict[str, Mapping] | None = None,
) -> DataFrame:
    """Canonical events plus the facts later stages need.

    Beyond the canonical columns: ``seq``, ``raw_payload``, ``ts_fallback`` (no
    usable timestamp, processing time taken), ``parse_error`` (an epoch number
    outside the calendar, a payload that is no JSON object, or a custom mapping
    that failed),
    ``event_offset_us`` and ``may_be_empty`` (the mapping can yield an empty
    payload). ``malformed`` is handed on where the input has it.
    """
    mappers = BUILT_IN if mappers is None else mappers
    used = [*mappers.values(), GENERIC]
    document = F.col("_doc")
    handed_on = [name for name in ("malformed",) if name in raw.columns]
    df = raw.select(
        "seq",
        "event_id",
        "source",
        F.col("received_at").cast("timestamp").alias("ingest_timestamp"),
        F.col("payload").alias("raw_payload"),
        *handed_on,
    )
    df = step(df, _doc=F.try_parse_json(F.col("raw_payload")))
    names = _time_fields(used)
    df = step(df, **{f"_t{i}": field_json(document, name) for i, name in enumerate(names)})
    texts = {name: F.col(f"_t{i}") for i, name in enumerate(names)}

    def time_json(mapping: Mapping) -> Column:
        if isinstance(mapping, ColumnMapping):
            return F.lit(None).cast("string")
        return first_truthy(*[texts[name] for name in mapping.time_fields])

    def mapped(source: str, mapping: ColumnMapping) -> Column:
        # Branches do not keep other sources' events from a Python function, nulls do.
        own = F.when(F.col("source") == source, document)
        found = F.struct(F.unix_micros(mapping.event_time(own)).alias("us"), mapping.payload(own).alias("payload"))
        return F.when(own.isNotNull() & ~mapping.failed(own), found)

    columns = {source: mapping for source, mapping in mappers.items() if isinstance(mapping, ColumnMapping)}
    nothing = F.lit(None).cast("struct<us: bigint, payload: string>")
    df = df.select(
        "seq", "event_id", "source", "ingest_timestamp", "raw_payload", *handed_on,
        document.alias("doc"),
        _per_source(mappers, time_json).alias("time_json"),
        F.coalesce(*[mapped(source, mapping) for source, mapping in columns.items()], nothing).alias("custom"),
    )
    # The fences also split the generated code: a method the JVM finds too long
    # to compile runs several times slower.
    df = parse_event_time(fence(df, "time_json", "custom"), "time_json")
    df = fence(df, "event_us", "event_offset_us", "parse_error")
    document = F.col("doc")
    event_us = F.coalesce(F.col("custom.us"), F.col("event_us"))

    def cleaned(mapping: Mapping) -> Column:
        if isinstance(mapping, ColumnMapping):
            return F.col("custom.payload")
        return mapping.payload(document, F.col("raw_payload"))

    def unmapped(mapping: Mapping) -> Column:
        return cleaned(mapping).isNull() if isinstance(mapping, ColumnMapping) else F.lit(False)

    def may_be_empty(mapping: Mapping) -> Column:
        return F.lit(isinstance(mapping, ColumnMapping) or mapping.payload_fields is None)

    is_document = F.coalesce(after_blanks(F.col("raw_payload")).startswith("{") & document.isNotNull(), F.lit(False))
    failed = F.col("parse_error") | ~is_document
    if columns:
        failed = failed | _per_source(mappers, unmapped)
    return df.select(
        "event_id",
        "source",
        "ingest_timestamp",
        F.coalesce(F.timestamp_micros(event_us), as_instant(as_of)).alias("event_timestamp"),
        _per_source(mappers, cleaned).alias("payload"),
        F.lit(CANONICAL_VERSION).alias("version"),
        "seq",
        "raw_payload",
        (event_us.isNull() & ~F.col("parse_error")).alias("ts_fallback"),
        failed.alias("parse_error"),
        F.when(event_us.isNull() | F.col("custom.us").isNotNull(), F.lit(0).cast("bigint"))
        .otherwise(F.col("event_offset_us"))
        .alias("event_offset_us"),
        _per_source(mappers, may_be_empty).alias("may_be_empty"),
        *handed_on,
    )
