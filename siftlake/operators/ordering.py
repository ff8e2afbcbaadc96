"""A dense global position for every row, without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftlake.session import checkpointed

# monotonically_increasing_id keeps the partition above this bit and the row below it.
_ROW_BITS = 33


def with_position(df: DataFrame, order: list[Column | str]) -> tuple[DataFrame, int]:
    """Add ``position`` (0-based, dense, in ``order``) and return it with the row count.

    Rows are range-partitioned and sorted, so ties on a leading key spread over
    tasks as long as ``order`` ends in a unique column. The sorted rows are
    written to the shared folder once; the only other data are one count per
    partition, which bounds the broadcast below by the number of partitions
    (``spark.sql.shuffle.partitions``, fewer after adaptive coalescing).
    """
    keys = [F.col(key) if isinstance(key, str) else key for key in order]
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    numbered = checkpointed(ordered.withColumn("_row", F.monotonically_increasing_id()))
    part = F.shiftright("_row", _ROW_BITS)
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = checkpointed(
        sizes.select("_part", "_size", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    total = offsets.agg(F.sum("_size")).first()[0] or 0
    within = F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    placed = (
        numbered.withColumn("_part", part)
        .join(F.broadcast(offsets.select("_part", "_offset")), "_part")
        .withColumn("position", F.col("_offset") + within)
        .drop("_row", "_part", "_offset")
    )
    return placed, int(total)
