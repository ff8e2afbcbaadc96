"""File sinks: date-partitioned Parquet and dead letters as JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlake.functions.timestamps import utc_date
from siftlake.schema import CANONICAL_COLUMNS, DLQ_COLUMNS
from siftlake.sources.refined import read_refined


def write_refined(
    events: DataFrame,
    path: str,
    max_records_per_file: int = 0,
    batch_id: int | None = None,
) -> None:
    """Append canonical events under ``ingest_date=YYYY-MM-DD``, Snappy.

    The date is each row's own UTC ingest date. Rows are rebalanced by date
    first: small dates share a task and a date with most of the rows is split
    over many, instead of one file per task and date. With ``batch_id`` the rows
    go to a directory of that batch, which a replay replaces.
    """
    dated = events.select(*CANONICAL_COLUMNS, utc_date(F.col("ingest_timestamp")).alias("ingest_date"))
    partitions = ["ingest_date"]
    if batch_id is not None:
        dated = dated.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        partitions.append("batch_id")
    writer = (
        dated.hint("rebalance", F.col("ingest_date"))
        .write.option("compression", "snappy")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*partitions)
    )
    if batch_id is None:
        writer.mode("append").parquet(path)
    else:
        writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def compact_refined(spark: SparkSession, path: str, target: str, first_day: str, last_day: str) -> None:
    """Write the days from ``first_day`` to ``last_day`` of a stream's table to ``target``, in few files.

    Every micro-batch leaves a directory per date. ``path`` is only read: point
    readers to ``target`` and remove the old days once it is complete.
    """
    days = read_refined(spark, path, first_day, last_day)
    (
        days.select(*CANONICAL_COLUMNS, "ingest_date").hint("rebalance", F.col("ingest_date"))
        .write.option("compression", "snappy").partitionBy("ingest_date").parquet(target)
    )


def _line(first_seen: Column) -> Column:
    """One record as JSON; the payload is embedded as JSON, not as quoted text."""
    shown = F.date_format(first_seen, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    names = [name for name in DLQ_COLUMNS if name not in ("raw_payload", "first_seen_at")]
    # A payload that is no JSON is kept as a JSON string.
    payload = F.coalesce(F.try_parse_json("raw_payload"), F.col("raw_payload").cast("variant"))
    return F.to_json(
        F.struct(*names, payload.alias("raw_payload"), shown.alias("first_seen_at")),
        {"ignoreNullFields": "false"},
    )


def write_dlq(records: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Append dead letters as JSON lines (a directory per batch with ``batch_id``)."""
    lines = records.select(_line(F.col("first_seen_at")).alias("value"))
    if batch_id is None:
        lines.write.mode("append").text(path)
    else:
        lines.write.mode("overwrite").text(f"{path.rstrip('/')}/batch_id={batch_id}")


def show_in_memory(records: DataFrame, name: str) -> DataFrame:
    """The non-durable variant: a view for this session, computed once and kept by the executors.

    What does not fit in their memory spills to their disks, and what a lost
    executor held is computed anew. ``uncacheTable(name)`` lets go of it.
    """
    records.createOrReplaceTempView(name)
    records.sparkSession.catalog.cacheTable(name)
    return records.sparkSession.table(name)
