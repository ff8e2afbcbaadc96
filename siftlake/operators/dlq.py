"""Queries over dead letters (``seq, event_id, source, raw_payload, error_reason, ...``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlake.functions.plan import one_row
from siftlake.operators.ordering import with_position

DEFAULT_LIMIT = 50
MAX_LIMIT = 500
# A page that starts deeper than this is not worth a top-k on one node.
_TOP_K_DEPTH = 100_000


def dlq_page(records: DataFrame, limit: int = DEFAULT_LIMIT, offset: int = 0) -> DataFrame:
    """One page, most recent first.

    Near the top this is a bounded top-k. A deep page is cut out by position, so
    the rows before it are never gathered.
    """
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    if offset < 0:
        raise ValueError("offset must not be negative")
    if offset + limit <= _TOP_K_DEPTH:
        return records.orderBy(F.desc("seq")).offset(offset).limit(limit)
    placed, _ = with_position(records.select("seq"), [F.desc("seq")])
    wanted = placed.filter(F.col("position").between(offset, offset + limit - 1)).select("seq")
    return records.join(F.broadcast(wanted), "seq", "left_semi").orderBy(F.desc("seq"))


def dlq_count(records: DataFrame) -> DataFrame:
    return records.agg(F.count("*").alias("n"))


def dlq_envelope(records: DataFrame, limit: int = DEFAULT_LIMIT, offset: int = 0) -> DataFrame:
    """One row: ``total, offset, limit, records`` (at most 500 of them)."""
    columns = [name for name in records.columns if name != "seq"]
    page = dlq_page(records, limit, offset).select("seq", F.struct(*columns).alias("_record"))
    entries = page.agg(F.sort_array(F.collect_list(F.struct("seq", "_record")), asc=False).alias("_entries"))
    return one_row(dlq_count(records), entries).select(
        F.col("n").alias("total"),
        F.lit(offset).alias("offset"),
        F.lit(limit).alias("limit"),
        F.col("_entries._record").alias("records"),
    )


def dlq_by_source(records: DataFrame) -> DataFrame:
    return records.groupBy("source").agg(F.count("*").alias("n"))


def dlq_by_reason(records: DataFrame) -> DataFrame:
    """Counts per counter label (``validation``, ``unhandled_error``)."""
    return records.groupBy(F.col("outcome").alias("reason")).agg(F.count("*").alias("n"))
