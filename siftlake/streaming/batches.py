"""Batches by size or time on a stream: a batch may span micro-batches.

How many events a tick has had is kept as a levelled table of counts. The
events of a micro-batch go on from there, in arrival order among themselves.
An event that arrives late joins its own tick behind all that came before;
batches already handed out never change.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlake.operators.batches import INTERVAL_SECONDS, MAX_SIZE, assign_batches
from siftlake.streaming.levels import FAN, LevelledTable


def _per_tick(rows: DataFrame) -> DataFrame:
    return rows.groupBy("tick").agg(F.sum("n").alias("n"))


def tick_table(spark: SparkSession, folder: str, fan: int = FAN) -> LevelledTable:
    """``tick, n``: events per timer period, as left by the micro-batches so far."""
    return LevelledTable(spark, folder, _per_tick, ["tick"], "tick bigint, n bigint", fan)


def member_writer(
    path: str, state_folder: str, at: str = "ingest_timestamp", max_size: int = MAX_SIZE,
    interval: int = INTERVAL_SECONDS, start_us: int = 0, fan: int = FAN,
) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: ``seq, tick, chunk`` of one micro-batch to ``path/batch_id=N``.

    The counts of the batch are left after its members are written, and both
    are made from earlier batches alone: running it again replaces both.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = tick_table(spark, state_folder, fan)
        part = f"{path.rstrip('/')}/batch_id={batch_id}"
        members = assign_batches(batch, at, max_size, interval, start_us, state.before(batch_id))
        members.write.mode("overwrite").parquet(part)
        written = spark.read.schema(members.schema).parquet(part)
        state.leave(batch_id, written.groupBy("tick").agg(F.count("*").alias("n")))

    return write


def read_members(spark: SparkSession, path: str) -> DataFrame:
    """``seq, tick, chunk`` of all events so far."""
    return spark.read.parquet(path).select("seq", "tick", "chunk")


def read_batches(members: DataFrame) -> DataFrame:
    """``tick, chunk, n``: every batch begun so far with its size, like ``operators.batches.batches``."""
    return members.groupBy("tick", "chunk").agg(F.count("*").alias("n"))
