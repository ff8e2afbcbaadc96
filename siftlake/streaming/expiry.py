"""Dedup state of a stream as a table: until when the accepted event of an id blocks it.

Every micro-batch decides on a narrow table (id, time, order) with joins, and
leaves the blocks it has set as a delta of its own (``streaming/levels.py``).
A batch reads only what batches before it have left. Running it again replaces
its delta and decides the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlake.operators.attach import attach
from siftlake.operators.dedup import DedupPolicy
from siftlake.operators.dedup_ttl import ttl_duplicates
from siftlake.session import checkpointed
from siftlake.streaming.levels import FAN, LevelledTable

#: Later than any event: how long an accepted event blocks its id under ``first``.
FOREVER = (1 << 63) - 1
STATE = "event_id string, until_us bigint"


class ExpiryTable(LevelledTable):
    """``event_id, until_us`` as set so far, under ``folder``; ``max_lag_seconds`` as for the stream."""

    def __init__(self, spark: SparkSession, folder: str, max_lag_seconds: int | None = None, fan: int = FAN) -> None:
        # Sorted by end, so that a batch skips the row groups of blocks that are over.
        super().__init__(spark, folder, self._last_blocks, ["until_us"], STATE, fan)
        self._max_lag_us = None if max_lag_seconds is None else max_lag_seconds * 1_000_000

    def _last_blocks(self, rows: DataFrame) -> DataFrame:
        rows = rows.groupBy("event_id").agg(F.max("until_us").alias("until_us"))
        if self._max_lag_us is None:
            return rows
        now = F.unix_micros(F.current_timestamp())
        return rows.filter((F.col("until_us") == FOREVER) | (F.col("until_us") > now - self._max_lag_us))


def _blocked_until(narrow: DataFrame, state: DataFrame) -> DataFrame:
    """``narrow`` with ``until_us``, null for an id without a block that reaches the batch."""
    seen = checkpointed(narrow.groupBy("event_id").agg(F.count("*").alias("_n"), F.min("at_us").alias("_from")))
    earliest = seen.agg(F.min("_from")).first()[0]
    if earliest is None:
        return narrow.withColumn("until_us", F.lit(None).cast("bigint"))
    # The bound on the end reaches the scan; ids outside the batch leave before any aggregation.
    known = state.filter(F.col("until_us") > earliest).join(seen.drop("_from"), "event_id")
    facts = checkpointed(known.groupBy("event_id").agg(F.max("until_us").alias("until_us"), F.first("_n").alias("_n")))
    rows = narrow.withColumn("_id", F.col("event_id"))
    return attach(rows, facts.withColumnRenamed("event_id", "_id"), "_id", "_n").drop("_id")


def decide(narrow: DataFrame, state: DataFrame | None, policy: DedupPolicy) -> tuple[DataFrame, DataFrame]:
    """``seq`` of the duplicates among ``event_id, at_us, seq``, and the blocks that the accepted ones set.

    As if the rows came one by one in arrival order: a row before the end of
    its id's block is a duplicate, any other is accepted and sets a new block.
    Those before a block of the state are settled by it; the rest is a batch.
    """
    rows = narrow.withColumn("until_us", F.lit(None).cast("bigint")) if state is None else _blocked_until(narrow, state)
    blocked = F.col("until_us").isNotNull() & (F.col("at_us") < F.col("until_us"))
    rows = checkpointed(rows.select("event_id", "at_us", "seq", blocked.alias("blocked")))
    rest = rows.filter("NOT blocked").drop("blocked")
    if policy.kind == "first":
        firsts = checkpointed(rest.groupBy("event_id").agg(F.min(F.struct("at_us", "seq")).alias("_first")).select("event_id", F.col("_first.seq").alias("seq")))
        later, blocks = rest.select("seq").join(firsts.select("seq"), "seq", "left_anti"), firsts.select("event_id", F.lit(FOREVER).alias("until_us"))
    else:
        ttl_us = policy.ttl_seconds * 1_000_000
        later = checkpointed(ttl_duplicates(rest, ttl_us, policy.fold_limit).select("seq"))
        accepted = rest.join(later, "seq", "left_anti")
        blocks = accepted.groupBy("event_id").agg((F.max("at_us") + ttl_us).alias("until_us"))
    return rows.filter("blocked").select("seq").unionByName(later), blocks
