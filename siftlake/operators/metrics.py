"""Counters, histograms, quantiles and gauge states.

Everything is one map-side-combined aggregation: a histogram is a handful of
conditional sums per group, never one row per event and bound.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bounds of the three histograms.
LATENCY_BOUNDS = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5)
FLUSH_BOUNDS = (0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
BATCH_SIZE_BOUNDS = (1.0, 10.0, 50.0, 100.0, 250.0, 500.0, 1000.0, 2500.0, 5000.0)

# Where a gauge turns yellow and red.
QUEUE_STATES = (5_000, 9_000)
DLQ_STATES = (10, 100)


def ingested_by_source(raw: DataFrame) -> DataFrame:
    return raw.groupBy("source").agg(F.count("*").alias("n"))


def processed_total(classified: DataFrame) -> DataFrame:
    return classified.agg(F.count_if(F.col("outcome") == "processed").alias("n"))


def failed_by_reason(classified: DataFrame) -> DataFrame:
    return (
        classified.filter(F.col("outcome") != "processed")
        .groupBy(F.col("outcome").alias("reason"))
        .agg(F.count("*").alias("n"))
    )


def gauge_state(value: Column, steps: tuple[int, int]) -> Column:
    yellow, red = steps
    return F.when(value >= red, "red").when(value >= yellow, "yellow").otherwise("green")


def ingest_lag_us(events: DataFrame) -> Column:
    """Microseconds from the event time to its receipt."""
    return F.unix_micros(events["ingest_timestamp"]) - F.unix_micros(events["event_timestamp"])


def bucket_counts(value: Column, bounds: tuple[float, ...], weight: Column | None = None) -> list[Column]:
    """One cumulative count per bound, ``b0 .. bn``, then the total ``b_all``."""
    weight = F.lit(1).cast("bigint") if weight is None else weight
    zero = F.lit(0).cast("bigint")
    counts = [
        F.sum(F.when(value <= bound, weight).otherwise(zero)).alias(f"b{i}") for i, bound in enumerate(bounds)
    ]
    return [*counts, F.sum(weight).alias("b_all")]


def bucket_names(bounds: tuple[float, ...]) -> list[str]:
    return [*(f"b{i}" for i in range(len(bounds))), "b_all"]


def histogram(
    df: DataFrame,
    value: Column,
    bounds: tuple[float, ...],
    by: list[str] | None = None,
    weight: Column | None = None,
) -> DataFrame:
    """``by, le, cumulative_n`` for each bound and +Inf; ``le`` is the printed bound."""
    by = by or []
    counts = df.groupBy(*by).agg(*bucket_counts(value, bounds, weight))
    labels = [*(f"{bound:g}" for bound in bounds), "+Inf"]
    pairs = F.array(*[
        F.struct(F.lit(label).alias("le"), F.coalesce(F.col(name), F.lit(0)).alias("cumulative_n"))
        for label, name in zip(labels, bucket_names(bounds))
    ])
    return counts.select(*by, F.inline(pairs))


def histogram_sum(df: DataFrame, value: Column, by: list[str] | None = None) -> DataFrame:
    """``by, total, n`` of the observed values; integers add up exactly."""
    return df.groupBy(*(by or [])).agg(F.sum(value).alias("total"), F.count(value).alias("n"))


def histogram_quantile(q: float, bounds: tuple[float, ...]) -> Column:
    """The ``q`` quantile from ``bucket_counts`` columns: linear inside its bucket.

    Below the first bound interpolation starts at 0; beyond the last one the
    answer is that bound; nothing observed gives NULL.
    """
    rank = F.lit(q) * F.col("b_all")

    def inside(i: int) -> Column:
        low = 0.0 if i == 0 else bounds[i - 1]
        before = F.lit(0) if i == 0 else F.col(f"b{i - 1}")
        share = (rank - before) / (F.col(f"b{i}") - before)
        return F.lit(low) + F.lit(bounds[i] - low) * share

    first, *rest = range(len(bounds))
    chain = reduce(
        lambda case, i: case.when(F.col(f"b{i}") >= rank, inside(i)), rest,
        F.when(F.col(f"b{first}") >= rank, inside(first)),
    )
    return F.when(F.col("b_all") > 0, chain.otherwise(F.lit(bounds[-1])))


def quantiles(
    df: DataFrame,
    value: Column,
    bounds: tuple[float, ...],
    by: list[str] | None = None,
    weight: Column | None = None,
    qs: dict[str, float] | None = None,
) -> DataFrame:
    """Histogram quantiles per group, named ``p50, p95, p99`` unless given."""
    qs = qs or {"p50": 0.50, "p95": 0.95, "p99": 0.99}
    counts = df.groupBy(*(by or [])).agg(*bucket_counts(value, bounds, weight))
    return counts.select(*(by or []), *[histogram_quantile(q, bounds).alias(name) for name, q in qs.items()])
