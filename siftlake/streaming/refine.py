"""The pipeline over a stream: the batch expressions, stateful dedup, idempotent sinks."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siftlake.operators.dedup import DedupPolicy, arrivals
from siftlake.operators.normalize import Mapping
from siftlake.plans.refine import PROCESSED, RefineResult, dlq_records, evaluate, outcome_column
from siftlake.session import checkpointed, remove_path
from siftlake.sinks.files import write_dlq, write_refined
from siftlake.streaming.batches import member_writer
from siftlake.streaming.dedup import mark_duplicates_stream
from siftlake.streaming.events import EventTable
from siftlake.streaming.expiry import ExpiryTable, decide
from siftlake.streaming.levels import FAN

# Fixed value: the flush timer, as the interval between micro-batches.
DEFAULT_TRIGGER = "10 seconds"


def classify_stream(
    raw: DataFrame,
    as_of: object = None,
    policy: DedupPolicy | str = "ttl",
    mappers: dict[str, Mapping] | None = None,
    max_lag_seconds: int | None = None,
) -> DataFrame:
    """Every raw event once, with its ``outcome``."""
    evaluated = evaluate(raw, as_of, mappers)
    marked = mark_duplicates_stream(evaluated, policy, F.col("verdict").isNull(), max_lag_seconds)
    return marked.withColumn("outcome", outcome_column()).drop("verdict", "is_duplicate")


def batch_writer(
    base: str, as_of: object = None, max_records_per_file: int = 0, keep_classified: bool = False,
    write_members: Callable[[DataFrame, int], None] | None = None, levelled: bool = False, fan: int = FAN,
) -> Callable[[DataFrame, int], None]:
    """Write one micro-batch; writing it again replaces it.

    The stateful result is written once, to ``classified/batch_id=N``; the
    outputs are then made from that table, so the pipeline runs once per batch.
    It goes once they are written, unless ``keep_classified``. ``refined``:
    date-partitioned events. ``dlq``: JSON lines. ``counts``: events per source
    and outcome, and how long writing the refined events took. ``write_members``
    gets the refined events as well. With ``levelled`` the refined events go to
    the table at ``events`` instead, for ``read_committed``.
    """
    base = base.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        part = f"{base}/classified/batch_id={batch_id}"
        batch.write.mode("overwrite").partitionBy("outcome").parquet(part)
        classified = spark.read.schema(batch.schema).parquet(part)
        refined = classified.filter(F.col("outcome") == PROCESSED)
        start = time.monotonic()
        if levelled:
            table = EventTable(spark, f"{base}/events", fan)
            table.tidy(batch_id)
            table.leave(batch_id, refined)
        else:
            write_refined(refined, f"{base}/refined", max_records_per_file, batch_id)
        spent = time.monotonic() - start
        if write_members is not None:
            write_members(refined, batch_id)
        write_dlq(dlq_records(classified, as_of), f"{base}/dlq", batch_id)
        counts = RefineResult(classified).metrics.withColumn("flush_seconds", F.lit(spent))
        counts.write.mode("overwrite").parquet(f"{base}/counts/batch_id={batch_id}")
        if not keep_classified:
            remove_path(spark, part)

    return write


def table_writer(
    state_folder: str,
    write: Callable[[DataFrame, int], None],
    policy: DedupPolicy,
    base: str,
    max_lag_seconds: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """Mark the duplicates of one evaluated micro-batch by the state table and hand it on to ``write``.

    The evaluated events are staged once; the decision reads three of their
    columns, and its result is joined back. The state is left before the sinks
    are written: a replayed batch replaces it and comes to the same decision.
    """

    def mark(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        part = f"{base.rstrip('/')}/staged/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(part)
        evaluated = spark.read.schema(batch.schema).parquet(part)
        state = ExpiryTable(spark, state_folder, max_lag_seconds)
        open_events = evaluated.filter(F.col("verdict").isNull())
        dropped, blocks = decide(arrivals(open_events), state.before(batch_id), policy)
        dropped = checkpointed(dropped.withColumnRenamed("seq", "_seq"))
        state.leave(batch_id, blocks)
        marked = open_events.join(dropped, F.col("seq") == F.col("_seq"), "left")
        marked = marked.withColumn("is_duplicate", F.col("_seq").isNotNull()).drop("_seq")
        rejected = evaluated.filter(F.col("verdict").isNotNull()).withColumn("is_duplicate", F.lit(False))
        classified = marked.unionByName(rejected).withColumn("outcome", outcome_column()).drop("verdict", "is_duplicate")
        write(classified, batch_id)
        remove_path(spark, part)

    return mark


def start_refine(
    raw: DataFrame,
    base: str,
    checkpoint: str,
    as_of: object = None,
    policy: DedupPolicy | str = "ttl",
    mappers: dict[str, Mapping] | None = None,
    available_now: bool = False,
    trigger: str = DEFAULT_TRIGGER,
    max_records_per_file: int = 0,
    max_lag_seconds: int | None = None,
    keep_classified: bool = False,
    batch_shape: dict[str, int] | None = None,
    levelled: bool = False,
    fan: int = FAN,
) -> StreamingQuery:
    """Run the pipeline into ``base``. A failed batch is replayed from ``checkpoint``.

    Duplicates are marked as in the batch function, micro-batch after
    micro-batch, by a state table beside the checkpoint. It grows with the
    number of ids; under ``ttl`` with ``max_lag_seconds`` an id is forgotten at
    a merge once its block has been over for that much running time.

    With ``batch_shape`` (``max_size``, ``interval``, ``start_us``) the batch of
    every refined event goes to ``base/members`` (``streaming/batches.py``).

    With ``levelled`` the refined events become a table at ``base/events`` that
    compacts itself and shows whole batches only (``streaming/events.py``);
    ``fan`` tables of a level make one of the next.
    """
    policy = DedupPolicy(policy) if isinstance(policy, str) else policy
    members = None
    if batch_shape is not None:
        members = member_writer(f"{base.rstrip('/')}/members", f"{checkpoint.rstrip('/')}/ticks", **batch_shape)
    write = batch_writer(base, as_of, max_records_per_file, keep_classified, members, levelled, fan)
    if policy.kind in ("first", "ttl"):
        rows = evaluate(raw, as_of, mappers)
        write = table_writer(f"{checkpoint.rstrip('/')}/blocks", write, policy, base, max_lag_seconds)
    else:
        rows = classify_stream(raw, as_of, policy, mappers, max_lag_seconds)
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def flush_batches(spark: SparkSession, base: str) -> DataFrame:
    """``batch_id, rows, seconds`` of every micro-batch with refined events, for histograms and quantiles.

    From the ``counts`` written with each batch, so no batch is missing however
    long the stream has run.
    """
    counts = spark.read.parquet(f"{base.rstrip('/')}/counts").filter(F.col("outcome") == PROCESSED)
    return counts.groupBy(F.col("batch_id").cast("bigint").alias("batch_id")).agg(
        F.sum("n").alias("rows"), F.max("flush_seconds").alias("seconds")
    )
