"""Batch formation by size or time, as data.

A timer ticks every ``interval``; between two ticks events fill batches of
``max_size``, and what is left is flushed by the tick. A full batch does not
move the timer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlake.operators.attach import attach
from siftlake.operators.ordering import with_position
from siftlake.session import checkpointed

MICROS = 1_000_000
# The batch limits used when none are given.
MAX_SIZE, INTERVAL_SECONDS = 1_000, 10
# Full batches listed per generated row, so that no array grows with a tick.
_LIST_SPAN = 10_000


def tick(at: Column, interval: int = INTERVAL_SECONDS, start_us: int = 0) -> Column:
    """Which timer period an instant falls into, counted from ``start_us``."""
    return F.floor((F.unix_micros(at) - F.lit(start_us).cast("bigint")) / F.lit(interval * MICROS)).cast("bigint")


def _per_tick(events: DataFrame, at: str, interval: int, start_us: int) -> DataFrame:
    return events.groupBy(tick(F.col(at), interval, start_us).alias("tick")).agg(F.count("*").alias("_n"))


def batch_sizes(
    events: DataFrame, at: str = "ingest_timestamp", max_size: int = MAX_SIZE,
    interval: int = INTERVAL_SECONDS, start_us: int = 0,
) -> DataFrame:
    """``tick, size, batches``: how many batches of each size every tick produced.

    At most two rows per tick (the full ones and the rest), from counts alone.
    """
    full = F.floor(F.col("_n") / max_size).cast("bigint")
    rest = F.pmod(F.col("_n"), F.lit(max_size)).cast("bigint")
    kinds = F.array(
        F.struct(F.lit(max_size).cast("bigint").alias("size"), full.alias("batches")),
        F.struct(rest.alias("size"), F.when(rest > 0, 1).otherwise(0).cast("bigint").alias("batches")),
    )
    return _per_tick(events, at, interval, start_us).select("tick", F.inline(kinds)).filter("batches > 0")


def batches(
    events: DataFrame, at: str = "ingest_timestamp", max_size: int = MAX_SIZE,
    interval: int = INTERVAL_SECONDS, start_us: int = 0,
) -> DataFrame:
    """``tick, chunk, n``: every batch with its size. No order over events is needed."""
    counts = _per_tick(events, at, interval, start_us).withColumn("_chunks", F.ceil(F.col("_n") / max_size))
    spans = counts.withColumn(
        "_span", F.explode(F.sequence(F.lit(0), F.floor((F.col("_chunks") - 1) / _LIST_SPAN).cast("bigint")))
    )
    first = F.col("_span") * _LIST_SPAN
    last = F.least(F.col("_chunks") - 1, first + _LIST_SPAN - 1)
    listed = spans.withColumn("chunk", F.explode(F.sequence(first, last)))
    return listed.select(
        "tick", "chunk", F.least(F.lit(max_size), F.col("_n") - F.col("chunk") * max_size).alias("n")
    )


def assign_batches(
    events: DataFrame, at: str = "ingest_timestamp", max_size: int = MAX_SIZE,
    interval: int = INTERVAL_SECONDS, start_us: int = 0, filled: DataFrame | None = None,
) -> DataFrame:
    """``seq, tick, chunk``: the batch of every event, in arrival order.

    The rank inside a tick is the global position less the first position of
    the tick, so a crowded tick is not sorted by one task. ``filled`` (``tick,
    n``; a tick may be in several rows) counts events that came before all of
    these: their ticks go on where they stopped.
    """
    narrow = events.select(F.unix_micros(at).alias("at_us"), "seq")
    placed, _ = with_position(narrow, ["at_us", "seq"])
    placed = placed.withColumn("tick", tick(F.timestamp_micros("at_us"), interval, start_us))
    starts = checkpointed(
        placed.groupBy("tick").agg(F.count("*").alias("_n"), F.min("position").alias("_start"))
    )
    if filled is not None:
        bounds = starts.agg(F.min("tick"), F.max("tick")).first()
        known = filled.filter(F.col("tick").between(bounds[0], bounds[1])).groupBy("tick").agg(F.sum("n").alias("_filled"))
        start = F.col("_start") - F.coalesce("_filled", F.lit(0))
        starts = checkpointed(starts.join(known, "tick", "left").select("tick", "_n", start.alias("_start")))
    return attach(placed, starts, "tick", "_n").select(
        "seq", "tick", F.floor((F.col("position") - F.col("_start")) / max_size).cast("bigint").alias("chunk")
    )
