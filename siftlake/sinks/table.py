"""Insert-if-absent into a table keyed by event id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlake.operators.dedup import drop_duplicates
from siftlake.plans.refine import staged
from siftlake.schema import CANONICAL_COLUMNS, CANONICAL_EVENT
from siftlake.session import checkpointed, remove_path, scratch_path


def create_table(spark: SparkSession, table: str, location: str | None = None, buckets: int = 200) -> None:
    """Create the events table unless it exists.

    It is bucketed by the key, so that looking up a batch does not shuffle what
    is already stored, and sorted by it inside a file, so that row groups outside
    a batch's range of ids are not read. Choose ``buckets`` for the final size of
    the table.
    """
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CANONICAL_EVENT.fields)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"CLUSTERED BY (event_id) SORTED BY (event_id) INTO {int(buckets)} BUCKETS{place}"
    )


def _described(spark: SparkSession, table: str, what: str) -> str | None:
    row = spark.sql(f"DESCRIBE EXTENDED {table}").filter(F.lower("col_name") == what).first()
    return None if row is None else row["data_type"]


def _append(events: DataFrame, table: str) -> None:
    """Append canonical events, one file per bucket that gets any."""
    buckets = _described(events.sparkSession, table, "num buckets")
    if buckets is not None:
        # The hash of a shuffle is the hash of a bucket, so a task holds one bucket.
        events = events.repartition(int(buckets), "event_id")
    events.select(*CANONICAL_COLUMNS).write.mode("append").insertInto(table)


def _required(name: str) -> Column:
    missing = F.raise_error(F.lit(f"column {name} must not be null"))
    return F.coalesce(F.col(name), missing.cast(CANONICAL_EVENT[name].dataType)).alias(name)


def insert_if_absent(events: DataFrame, table: str) -> None:
    """Append the events whose id the table does not hold; first arrival wins inside the batch.

    A null in any column fails the batch. Doing it again changes nothing, so a
    replayed micro-batch is harmless.

    The batch is staged once, so that what makes the events runs once: ids are
    looked at several times, whole events when they are appended.
    """
    spark = events.sparkSession
    ordered = ["seq"] if "seq" in events.columns else []
    path = scratch_path(spark, "insert")
    try:
        batch = staged(events.select(*[_required(c) for c in CANONICAL_COLUMNS], *ordered), path)
        low, high = batch.agg(F.min("event_id"), F.max("event_id")).first()
        if low is None:
            return
        # Settled before the table changes.
        known = checkpointed(stored_ids(batch.select("event_id").distinct(), table, low, high))
        if ordered:
            candidates = drop_duplicates(batch)
        else:
            # No order to go by: the least row of an id, so that equal rows count once.
            rest = F.struct(*[c for c in CANONICAL_COLUMNS if c != "event_id"])
            candidates = batch.groupBy("event_id").agg(F.min(rest).alias("_row")).select("event_id", "_row.*")
        _append(candidates.join(known, "event_id", "left_anti"), table)
    finally:
        remove_path(spark, path)


def stored_ids(candidates: DataFrame, table: str, low: str, high: str) -> DataFrame:
    """The candidates' ids, all between ``low`` and ``high``, that the table holds."""
    stored = candidates.sparkSession.table(table).select("event_id").filter(F.col("event_id").between(low, high))
    # The incoming side is the small one; only ids it hits come out of the stored side.
    return stored.join(candidates.select("event_id").hint("shuffle_hash"), "event_id", "left_semi")


def compact_table(spark: SparkSession, table: str, into: str, location: str | None = None, buckets: int = 200) -> None:
    """Write the events of ``table`` to the new table ``into``, one sorted file per bucket.

    Each insert leaves a file in every bucket it touches. The source stays as it
    is, so nothing is lost if this fails; put the new table in its place afterwards.
    """
    if spark.catalog.tableExists(into):
        raise ValueError(f"{into} exists")
    create_table(spark, into, location, buckets)
    # From the files: over the bucketed table the planner drops the shuffle as needless and then the buckets too.
    _append(spark.read.schema(CANONICAL_EVENT).parquet(_described(spark, table, "location")), into)


def jdbc_statements(table: str, staging: str) -> tuple[dict[str, str], str]:
    """Writer options for the staging table of a database, and the statement that
    moves it over. Run the statement once per batch in the database."""
    columns = ", ".join(CANONICAL_COLUMNS)
    options = {"dbtable": staging, "truncate": "true", "batchsize": "1000", "numPartitions": "10"}
    move = (
        f"INSERT INTO {table} ({columns}) SELECT event_id, source, ingest_timestamp, event_timestamp, "
        f"payload::jsonb, version FROM {staging} ON CONFLICT (event_id) DO NOTHING"
    )
    return options, move
