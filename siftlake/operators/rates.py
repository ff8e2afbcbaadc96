"""Sliding rates and sliding quantiles: one value per window end.

A window covers ``[end - width, end)`` and windows end on every step. Events
are counted per step first, so what is multiplied by the overlap is the few
step counts and not the events.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siftlake.operators.metrics import bucket_counts, bucket_names, histogram_quantile
from siftlake.streaming.levels import FAN, LevelledTable

MICROS = 1_000_000
# One-minute windows, moved on by the five-second sampling interval.
WIDTH_SECONDS, STEP_SECONDS = 60, 5


def _slot(at: Column, step_us: int) -> Column:
    micros = F.unix_micros(at)
    return (micros - F.pmod(micros, F.lit(step_us).cast("bigint"))).alias("_slot")


def _spread(slots: DataFrame, width: int, step: int) -> DataFrame:
    """Each step count once per window it belongs to, as ``window_end_us``."""
    ends = F.array(*[
        F.col("_slot") + F.lit(k * step * MICROS).cast("bigint") for k in range(1, width // step + 1)
    ])
    return slots.withColumn("window_end_us", F.explode(ends)).drop("_slot")


def rates(
    events: DataFrame, at: Column, by: list[str] | None = None,
    width: int = WIDTH_SECONDS, step: int = STEP_SECONDS,
) -> DataFrame:
    """``window_end_us, by, per_second`` for every window with an event in it."""
    if width % step:
        raise ValueError("width must be a multiple of step")
    by = by or []
    slots = events.groupBy(*by, _slot(at, step * MICROS)).agg(F.count("*").alias("_n"))
    return (
        _spread(slots, width, step)
        .groupBy("window_end_us", *by)
        .agg((F.sum("_n") / F.lit(float(width))).alias("per_second"))
    )


def _slot_table(spark: SparkSession, path: str, by: list[str] | None, fan: int = FAN) -> LevelledTable:
    keys = [*(by or []), "_slot"]
    return LevelledTable(spark, path, lambda rows: rows.groupBy(*keys).agg(F.sum("_n").alias("_n")), ["_slot"], fan=fan)


def slot_writer(
    path: str, at: str, by: list[str] | None = None, step: int = STEP_SECONDS, fan: int = FAN
) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: add the counts per slot of one micro-batch to the table at ``path``.

    Writing a batch again replaces it. No watermark: an event however late adds
    to the slot of its own time, and the windows read from the table correct
    themselves. Batches are merged in levels, so few tables are read however
    long the stream has run.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        slots = batch.groupBy(*(by or []), _slot(F.col(at), step * MICROS)).agg(F.count("*").alias("_n"))
        table = _slot_table(batch.sparkSession, path, by, fan)
        table.tidy(batch_id)
        table.leave(batch_id, slots)

    return write


def stream_rates(
    events: DataFrame, at: str, path: str, checkpoint: str, by: list[str] | None = None,
    step: int = STEP_SECONDS, available_now: bool = False, trigger: str = "10 seconds", fan: int = FAN,
) -> StreamingQuery:
    """Keep the slot counts of a stream at ``path``; ``read_rates`` gives the windows."""
    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(slot_writer(path, at, by, step, fan))
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def read_rates(
    spark: SparkSession, path: str, by: list[str] | None = None, width: int = WIDTH_SECONDS, step: int = STEP_SECONDS,
    fan: int = FAN,
) -> DataFrame:
    """The same rates from the slot counts of all micro-batches so far; ``step`` and ``fan`` as they were written."""
    if width % step:
        raise ValueError("width must be a multiple of step")
    by = by or []
    slots = _slot_table(spark, path, by, fan).latest().groupBy(*by, "_slot").agg(F.sum("_n").alias("_n"))
    return (
        _spread(slots, width, step)
        .groupBy("window_end_us", *by)
        .agg((F.sum("_n") / F.lit(float(width))).alias("per_second"))
    )


def sliding_quantiles(
    events: DataFrame, at: Column, value: Column, bounds: tuple[float, ...],
    qs: dict[str, float] | None = None, weight: Column | None = None,
    width: int = WIDTH_SECONDS, step: int = STEP_SECONDS,
) -> DataFrame:
    """Histogram quantiles of ``value`` in every window, as ``window_end_us, p50, ...``."""
    if width % step:
        raise ValueError("width must be a multiple of step")
    qs = qs or {"p50": 0.50, "p95": 0.95, "p99": 0.99}
    slots = events.groupBy(_slot(at, step * MICROS)).agg(*bucket_counts(value, bounds, weight))
    merged = _spread(slots, width, step).groupBy("window_end_us").agg(
        *[F.sum(name).alias(name) for name in bucket_names(bounds)]
    )
    return merged.select(
        "window_end_us", *[histogram_quantile(q, bounds).alias(name) for name, q in qs.items()]
    )
