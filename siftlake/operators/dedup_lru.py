"""Dedup against the most recently used ids, over batch data.

A least-recently-used memory holds exactly the ``capacity`` most recently used
distinct ids, whatever was a hit before. So the line of arrivals can be cut
into chunks: each chunk starts from the most recent distinct ids before it and
is then independent of the others.

1. Arrivals get dense positions; a chunk is a fixed number of positions, so no
   id, however hot, makes a chunk larger.
2. Each chunk is reduced to its most recent distinct ids.
3. Chunks that hold fewer than ``capacity`` distinct ids take over what earlier
   chunks remember, in doubling steps. Usually no step is needed.
4. A chunk's line is the memory left by the chunk before, then its arrivals. An
   arrival is a hit iff fewer than ``capacity`` distinct ids lie between it and
   the last use of its id. Within ``capacity`` places that is certain, and
   across a block with that many ids it is ruled out; for what is left the ids
   are counted, by counts of rows that are lower in two orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftlake.operators.dominance import with_lower
from siftlake.operators.ordering import with_position
from siftlake.session import checkpointed

_MIN_CHUNK_ROWS = 32_768


def _most_recent(last_use: DataFrame, capacity: int) -> DataFrame:
    """The ``capacity`` most recently used ids of each chunk."""
    newest = Window.partitionBy("chunk").orderBy(F.desc("position"))
    return (
        last_use.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= capacity)
        .drop("_rank")
    )


def _memory_after(last_use: DataFrame, capacity: int, chunks: int) -> DataFrame:
    """``chunk, event_id, position``: what is remembered at the end of each chunk."""
    memory = checkpointed(_most_recent(last_use, capacity))
    reach = 1
    while reach < chunks:
        # After this many steps a chunk knows `reach` chunks; one that is full,
        # or that already reaches the first chunk, is final.
        sizes = memory.groupBy("chunk").agg(F.count("*").alias("_n"))
        short = sizes.filter((F.col("_n") < capacity) & (F.col("chunk") >= reach)).select("chunk")
        if short.isEmpty():
            break
        earlier = memory.withColumn("chunk", F.col("chunk") + reach).join(short, "chunk", "left_semi")
        merged = (
            memory.unionByName(earlier).groupBy("chunk", "event_id").agg(F.max("position").alias("position"))
        )
        memory = checkpointed(_most_recent(merged, capacity))
        reach *= 2
    return memory


def _open_repeats(lines: DataFrame, capacity: int) -> DataFrame:
    """Arrivals whose id came before in the chunk's line, at ``place`` and ``before``, without sure misses.

    A line is cut into blocks of twice the capacity. If a block alone holds
    ``capacity`` ids, whatever spans it has missed. ``mark`` is the start of the
    last such block that ends before the own one; it never moves back.
    """
    size = 2 * capacity
    line = Window.partitionBy("chunk").orderBy("position")
    same = Window.partitionBy("chunk", "event_id").orderBy("position")
    rows = checkpointed(
        lines.withColumn("place", F.row_number().over(line).cast("bigint") - 1)
        .withColumn("before", F.lag("place").over(same))
        .withColumn("block", F.expr(f"place DIV {size}L"))
        .drop("position")
    )
    start = F.col("block") * size
    earlier = Window.partitionBy("chunk").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    marks = (
        rows.groupBy("chunk", "block")
        .agg(F.count_if(F.coalesce("before", F.lit(-1)) < start).alias("ids"))
        .withColumn("mark", F.max(F.when(F.col("ids") >= capacity, start)).over(earlier))
    )
    return (
        rows.filter("before IS NOT NULL")
        .join(marks.drop("ids"), ["chunk", "block"])
        .filter("mark IS NULL OR before >= mark")
        .select("chunk", "event_id", "seq", "place", "before")
    )


def _hits(lines: DataFrame, capacity: int, length: int) -> DataFrame:
    """``event_id, seq`` of the arrivals that hit; a chunk's line has at most ``length`` rows.

    Between a use at ``before`` and the next at ``place`` every id counts once:
    all rows there but those that repeat one of them, which are the rows lower
    in place whose own last use is higher. Such a row is no sure miss if the
    arrival is none, as marks only move on.
    """
    repeats = checkpointed(_open_repeats(lines, capacity))
    near = F.col("place") - F.col("before") <= capacity
    # Chunks without a far repeat need no counts; a chunk is one row here.
    unsure = repeats.filter(~near).select("chunk").distinct()
    counted = with_lower(
        repeats.join(unsure, "chunk", "left_semi").withColumn("back", -F.col("before")), "chunk", "place", "back", length
    )
    ids = F.col("place") - F.col("before") - 1 - F.col("lower")
    far = counted.filter(~near & (ids < capacity))
    return repeats.filter(near).select("event_id", "seq").unionByName(far.select("event_id", "seq"))


def lru_duplicates(narrow: DataFrame, capacity: int, chunk_rows: int | None = None) -> DataFrame:
    """``event_id, seq`` of the arrivals whose id is still remembered."""
    chunk_rows = chunk_rows or max(_MIN_CHUNK_ROWS, 4 * capacity)
    placed, total = with_position(narrow, ["at_us", "seq"])
    chunks = max(1, -(-total // chunk_rows))
    placed = placed.select(
        "event_id", "seq", "position", F.floor(F.col("position") / chunk_rows).cast("bigint").alias("chunk")
    )

    last_use = placed.groupBy("chunk", "event_id").agg(F.max("position").alias("position"))
    # The memory of a chunk is put ahead of the next one: its positions are
    # lower, its ids are distinct, and there are at most `capacity` of them.
    memory = _memory_after(last_use, capacity, chunks) if chunks > 1 else last_use.limit(0)
    warm = memory.select(
        "event_id", F.lit(None).cast("bigint").alias("seq"), "position", (F.col("chunk") + 1).alias("chunk")
    ).filter(F.col("chunk") < chunks)

    return _hits(placed.unionByName(warm), capacity, chunk_rows + capacity)
