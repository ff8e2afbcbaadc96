"""Duplicate detection by event id under an explicit policy.

Every policy works on a narrow table ``event_id, at_us, seq``; arrival order is
``(at_us, seq)`` and ``seq`` is unique. Payloads never travel through the
decision: they meet its result once, at the end.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlake.operators.attach import attach
from siftlake.operators.dedup_lru import lru_duplicates
from siftlake.operators.dedup_ttl import ttl_duplicates
from siftlake.session import checkpointed

POLICIES = ("first", "lru", "ttl", "off")
# The capacity and time-to-live used when none is given.
DEFAULT_CAPACITY = 100_000
DEFAULT_TTL_SECONDS = 3_600


@dataclass(frozen=True)
class DedupPolicy:
    """``first``: one event per id. ``lru``: remembers the ``capacity`` most recent
    ids. ``ttl``: an accepted event blocks its id for ``ttl_seconds``. ``off``:
    everything passes."""

    kind: str = "first"
    capacity: int = DEFAULT_CAPACITY
    ttl_seconds: int = DEFAULT_TTL_SECONDS
    # Execution only, results do not depend on them:
    chunk_rows: int | None = None
    fold_limit: int | None = None

    def __post_init__(self) -> None:
        if self.kind not in POLICIES:
            raise ValueError(f"unknown dedup policy {self.kind!r}, expected one of {POLICIES}")
        if self.capacity < 1 or self.ttl_seconds < 1:
            raise ValueError("capacity and ttl_seconds must be positive")


def arrivals(events: DataFrame, eligible: Column | None = None) -> DataFrame:
    """The narrow table a policy decides on."""
    if eligible is not None:
        events = events.filter(eligible)
    return events.select("event_id", F.unix_micros("ingest_timestamp").alias("at_us"), "seq")


def _join_key(eligible: Column) -> Column:
    """The event id, or for rows outside the decision a value that spreads them.

    Rejected rows may share one id (an empty one, say); they would all meet in
    one task for nothing. The prefix cannot occur in a valid id.
    """
    return F.when(eligible, F.col("event_id")).otherwise(F.concat(F.lit("#"), F.col("seq").cast("string")))


def _mark_first(events: DataFrame, eligible: Column) -> DataFrame:
    """Duplicates are the rows of a repeated id other than its first arrival.

    The aggregation combines before its shuffle, so a hot id costs one row per
    task; only ids that do repeat are kept and joined back.
    """
    repeated = checkpointed(
        arrivals(events, eligible)
        .groupBy("event_id")
        .agg(F.count("*").alias("_n"), F.min(F.struct("at_us", "seq")).alias("_first"))
        .filter(F.col("_n") > 1)
        .select(F.col("event_id").alias("_key"), "_n", F.col("_first.seq").alias("_first_seq"))
    )
    joined = attach(events.withColumn("_key", _join_key(eligible)), repeated, "_key", "_n")
    duplicate = F.col("_first_seq").isNotNull() & (F.col("seq") != F.col("_first_seq"))
    return joined.withColumn("is_duplicate", duplicate).drop("_key", "_first_seq")


def duplicate_keys(narrow: DataFrame, policy: DedupPolicy) -> DataFrame:
    """``event_id, seq`` of the events the policy drops (``lru`` and ``ttl``)."""
    if policy.kind == "lru":
        return lru_duplicates(narrow, policy.capacity, policy.chunk_rows)
    return ttl_duplicates(narrow, policy.ttl_seconds * 1_000_000, policy.fold_limit)


def mark_duplicates(
    events: DataFrame, policy: DedupPolicy | str = "first", eligible: Column | None = None
) -> DataFrame:
    """Add ``is_duplicate``. Only ``eligible`` rows register and are checked."""
    policy = DedupPolicy(policy) if isinstance(policy, str) else policy
    eligible = F.lit(True) if eligible is None else eligible
    if policy.kind == "off":
        return events.withColumn("is_duplicate", F.lit(False))
    if policy.kind == "first":
        return _mark_first(events, eligible)
    keys = duplicate_keys(arrivals(events, eligible), policy).select(
        F.col("seq").alias("_seq"), F.lit(True).alias("_dropped")
    )
    # seq is unique on both sides, so no key can be hot here.
    return (
        events.join(keys, F.col("seq") == F.col("_seq"), "left")
        .withColumn("is_duplicate", F.col("_dropped").isNotNull())
        .drop("_seq", "_dropped")
    )


def drop_duplicates(events: DataFrame, policy: DedupPolicy | str = "first") -> DataFrame:
    return mark_duplicates(events, policy).filter(~F.col("is_duplicate")).drop("is_duplicate")


def seen_size(events: DataFrame, capacity: int | None = None) -> DataFrame:
    """How many ids the policy remembers at the end: all distinct ones, or the capacity."""
    ids = events.groupBy("event_id").agg(F.count("*").alias("_n")).agg(F.count("*").alias("n"))
    if capacity is None:
        return ids
    return ids.select(F.least(F.col("n"), F.lit(capacity).cast("bigint")).alias("n"))
