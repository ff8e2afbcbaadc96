"""Duplicate marking on a stream, with one number of state per id."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import chain

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from siftlake.operators.dedup import DedupPolicy
from siftlake.session import STREAM_SETTINGS

_FOREVER = (1 << 63) - 1
# Rows outside the decision are spread over this many keys, none of which gets state.
_BYPASS_KEYS = 1_024

# The process that sets up the state on the driver does not see the driver's
# module path, so the processor travels as code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _BlockUntil(StatefulProcessor):
    """Holds, per id, the instant until which the accepted event blocks it."""

    def __init__(self, ttl_us: int | None, max_lag_seconds: int | None) -> None:
        self._ttl_us = ttl_us
        self._max_lag_ms = None if max_lag_seconds is None else max_lag_seconds * 1_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = [T.StructField("until_us", T.LongType()), T.StructField("forget_ms", T.LongType())]
        self._handle = handle
        self._state = handle.getValueState("until", T.StructType(fields))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # Most ids come once per micro-batch, so rows are cheaper here than frames.
        first = next(rows)
        if not first.dedup_eligible:
            for row in chain((first,), rows):
                yield Row(**row.asDict(), is_duplicate=False)
            return
        arrived = [first, *rows]
        arrived.sort(key=lambda row: (row.dedup_at_us, row.seq))
        stored = self._state.get()
        until = before = None if stored is None else stored[0]
        for row in arrived:
            is_duplicate = until is not None and row.dedup_at_us < until
            if not is_duplicate:
                until = _FOREVER if self._ttl_us is None else row.dedup_at_us + self._ttl_us
            yield Row(**row.asDict(), is_duplicate=is_duplicate)
        if until != before:
            forget = _FOREVER
            if self._ttl_us is not None and self._max_lag_ms is not None:
                clock_ms = int(arrived[0].dedup_clock.timestamp() * 1_000)
                forget = clock_ms + self._ttl_us // 1_000 + self._max_lag_ms
                self._handle.registerTimer(forget)
            self._state.update((until, forget))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # A later accepted event has put the moment off and set a timer of its own.
        stored = self._state.get()
        if stored is not None and stored[1] <= expiredTimerInfo.getExpiryTimeInMs():
            self._state.clear()
        return iter([])

    def close(self) -> None:
        pass


def mark_duplicates_stream(
    events: DataFrame,
    policy: DedupPolicy | str = "ttl",
    eligible: Column | None = None,
    max_lag_seconds: int | None = None,
) -> DataFrame:
    """Add ``is_duplicate`` to a stream, like the batch function.

    Within a micro-batch events are taken in arrival order, so file order does
    not matter; between micro-batches the order of the source does. The state
    grows with the number of ids. Under ``ttl`` it is bounded by
    ``max_lag_seconds``, if given: an id is forgotten that much running time
    after its block ends, so a stream that runs further behind its data than
    this (after an outage, say) accepts events the batch function drops. ``lru``
    looks at all ids at once and is for batch data.

    The watermark follows the time of the micro-batches, not the data: it only
    cleans up, and no event, however late, falls behind it.
    """
    policy = DedupPolicy(policy) if isinstance(policy, str) else policy
    if policy.kind == "off":
        return events.withColumn("is_duplicate", F.lit(False))
    if policy.kind == "lru":
        raise ValueError("the lru policy needs all arrivals in order: use it on batch data")
    for key, value in STREAM_SETTINGS.items():
        events.sparkSession.conf.set(key, value)
    eligible = F.lit(True) if eligible is None else eligible
    bypass = F.concat(F.lit("#"), F.pmod(F.xxhash64("seq"), F.lit(_BYPASS_KEYS)).cast("string"))
    keyed = events.withColumns({
        "dedup_eligible": eligible,
        "dedup_at_us": F.unix_micros("ingest_timestamp"),
        "dedup_key": F.when(eligible, F.col("event_id")).otherwise(bypass),
    })
    ttl_us = None if policy.kind == "first" else policy.ttl_seconds * 1_000_000
    timed = ttl_us is not None and max_lag_seconds is not None
    if timed:
        keyed = keyed.withColumn("dedup_clock", F.current_timestamp()).withWatermark("dedup_clock", "0 seconds")
    output = T.StructType([*keyed.schema.fields, T.StructField("is_duplicate", T.BooleanType())])
    marked = keyed.groupBy("dedup_key").transformWithState(
        statefulProcessor=_BlockUntil(ttl_us, max_lag_seconds),
        outputStructType=output,
        outputMode="Append",
        timeMode="EventTime" if timed else "None",
    )
    return marked.drop("dedup_key", "dedup_at_us", "dedup_eligible", "dedup_clock")
