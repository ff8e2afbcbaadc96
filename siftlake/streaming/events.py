"""Refined events of a stream as a table that readers see batch by batch, never a part of one.

Every micro-batch leaves a table of its own, partitioned by date; these are
merged in levels (``streaming/levels.py``), so a day lies in few files without
a separate compaction. A table counts once its success marker is written, so
readers follow merges without being moved by hand. A micro-batch counts once
its last output, the ``counts``, is whole: a batch that fails between its
outputs is seen in none of them until its replay is through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from siftlake.functions.timestamps import utc_date
from siftlake.schema import CANONICAL_COLUMNS, DLQ_COLUMNS
from siftlake.session import list_folders, path_exists
from siftlake.sources.refined import DATED_EVENT, between_days, read_dlq
from siftlake.streaming.levels import FAN, LevelledTable


_ATTEMPTS = 5


class EventTable(LevelledTable):
    """Canonical events with ``ingest_date``; the days prune directories of every part."""

    def __init__(self, spark: SparkSession, folder: str, fan: int = FAN) -> None:
        super().__init__(spark, folder, lambda rows: rows, ["ingest_timestamp"], DATED_EVENT, fan)

    def _tables(self, parts: list[tuple[int, int]]) -> DataFrame:
        return super()._tables(parts).select(*DATED_EVENT.names)

    def _reader(self) -> DataFrameReader:
        # The parts have partitions of their own, so they count as partitions of the folder.
        return super()._reader().option("basePath", self._folder)

    def _write(self, rows: DataFrame, level: int, start: int) -> None:
        dated = rows.select(*CANONICAL_COLUMNS, utc_date(F.col("ingest_timestamp")).alias("ingest_date"))
        (
            dated.hint("rebalance", F.col("ingest_date")).write.option("compression", "snappy")
            .partitionBy("ingest_date").mode("overwrite").parquet(self.path(level, start))
        )

    def leave(self, batch_id: int, rows: DataFrame) -> None:
        """A replayed batch comes to the same rows, so a whole table stays as it is for those who read it."""
        if not self._whole(0, batch_id):
            super().leave(batch_id, rows)


def committed_batches(spark: SparkSession, base: str) -> int:
    """How many micro-batches have all their outputs. They run one after another, so the last one tells."""
    ids = (int(folder.rsplit("=", 1)[1]) for folder in list_folders(spark, f"{base.rstrip('/')}/counts") if "=" in folder)
    for batch_id in sorted(ids, reverse=True):
        if path_exists(spark, f"{base.rstrip('/')}/counts/batch_id={batch_id}/_SUCCESS"):
            return batch_id + 1
    return 0


def read_committed(
    spark: SparkSession, base: str, first_day: str | None = None, last_day: str | None = None, fan: int = FAN
) -> DataFrame:
    """The refined events of all whole micro-batches; ``fan`` as they were written.

    What the returned frame reads stays for a batch after a merge has replaced it.
    """
    table = EventTable(spark, f"{base.rstrip('/')}/events", fan)
    for attempt in range(_ATTEMPTS):
        try:
            return between_days(table.latest(committed_batches(spark, base)), first_day, last_day)
        except LookupError:  # several batches ended since the count
            if attempt == _ATTEMPTS - 1:
                raise


def read_committed_dlq(spark: SparkSession, base: str) -> DataFrame:
    """The dead letters of all whole micro-batches."""
    records = read_dlq(spark, f"{base.rstrip('/')}/dlq")
    return records.filter(F.col("batch_id") < committed_batches(spark, base)).select(*DLQ_COLUMNS)
