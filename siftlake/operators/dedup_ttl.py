"""Dedup with a fixed time-to-live, over batch data.

An accepted event blocks its id until ``at + ttl``; dropped ones do not extend
the block. Per id this is a chain: the first event, then the first event at or
after its expiry, and so on.

* Equal ``(id, at)`` collapse before any shuffle: only the first can be accepted.
* An id whose arrivals all fall within one time-to-live needs its first only.
* Short chains are folded over a sorted array of bounded length.
* Longer ones never gather in one task. Every event gets a number and the number
  of its successor by two range sorts; the accepted events are those reached
  from the first of each id, found in a logarithmic number of joins on that
  unique number: jumps are doubled, each time only from where a jump ends, then
  taken from the first events on, the longest first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlake.operators.attach import attach
from siftlake.operators.ordering import with_position
from siftlake.session import checkpointed

# Longest array one row may hold; longer chains take the distributed way.
FOLD_LIMIT = 1_000
_END = (1 << 63) - 1


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _fold(instants: DataFrame, ttl_us: int) -> DataFrame:
    """Accepted instants of ids with few instants."""
    point = "struct<at_us:bigint,seq:bigint>"
    start = F.struct(
        F.lit(None).cast("bigint").alias("expiry"), F.array().cast(f"array<{point}>").alias("kept")
    )

    def step(state: Column, current: Column) -> Column:
        free = state["expiry"].isNull() | (current["at_us"] >= state["expiry"])
        return F.when(
            free,
            F.struct(
                (current["at_us"] + _long(ttl_us)).alias("expiry"),
                F.array_append(state["kept"], current).alias("kept"),
            ),
        ).otherwise(state)

    chains = instants.groupBy("event_id").agg(
        F.sort_array(F.collect_list(F.struct("at_us", "seq"))).alias("_points")
    )
    kept = F.aggregate("_points", start, step, lambda state: state["kept"])
    return chains.select("event_id", F.inline(kept))


def _chain(instants: DataFrame, ids: DataFrame, ttl_us: int) -> DataFrame:
    """Accepted instants of ids with any number of instants.

    One end mark per id stands after all its events and follows itself, so that
    every event has a successor. Each event also sends a probe to its expiry;
    sorted together, the probe of event ``i`` stands right before the successor
    of ``i``, and exactly ``i`` probes stand before it.
    """
    end_marks = ids.select("event_id", _long(_END).alias("at_us"), F.lit(None).cast("bigint").alias("seq"))
    nodes, _ = with_position(
        instants.select("event_id", "at_us", "seq").unionByName(end_marks), ["event_id", "at_us"]
    )
    nodes = checkpointed(nodes.withColumnRenamed("position", "node"))
    probe_at = F.when(F.col("at_us") == _END, F.col("at_us")).otherwise(F.col("at_us") + _long(ttl_us))
    lines = nodes.select("event_id", "at_us", F.lit(1).alias("kind"), "node").unionByName(
        nodes.select("event_id", probe_at.alias("at_us"), F.lit(0).alias("kind"), "node")
    )
    # The node ends the order: probes of one id may share no time, but it keeps ties apart.
    lined, _ = with_position(lines, ["event_id", "at_us", "kind", "node"])
    jump = lined.filter("kind = 0").select("node", (F.col("position") - F.col("node")).alias("next"))
    jump = checkpointed(jump.filter(F.col("node") != F.col("next")))

    roots = nodes.groupBy("event_id").agg(F.min("node").alias("node")).select("node")
    longest = ids.agg(F.max((F.col("last_us") - F.col("first_us")) / ttl_us)).first()[0] or 0
    steps = max(1, math.ceil(math.log2(longest + 2)))
    # From a root, jumps of 2^k start at multiples of 2^k only, which 2^k jumps reach: chains of one id run into each
    # other, so fewer and fewer nodes are left as k grows.
    jumps = [jump]
    for _ in range(1, steps):
        ends = jump.select(F.col("next").alias("node")).unionByName(roots).distinct()
        far = jump.select(F.col("node").alias("_mid"), F.col("next").alias("_far"))
        jump = checkpointed(
            jump.join(ends, "node", "left_semi").join(far, F.col("next") == F.col("_mid")).select("node", F.col("_far").alias("next"))
        )
        jumps.append(jump)
    # The longest jumps first: those of 2^k then start at the multiples of 2^(k + 1) alone.
    reached = checkpointed(roots)
    for jump in reversed(jumps):
        onward = reached.join(jump, "node").select(F.col("next").alias("node"))
        reached = checkpointed(reached.unionByName(onward).distinct())
    return nodes.filter(F.col("seq").isNotNull()).join(reached, "node", "left_semi").select(
        "event_id", "at_us", "seq"
    )


def ttl_duplicates(narrow: DataFrame, ttl_us: int, fold_limit: int | None = None) -> DataFrame:
    """``event_id, seq`` of the arrivals that fall into the block of an accepted one."""
    fold_limit = FOLD_LIMIT if fold_limit is None else fold_limit
    # Several passes follow; they read these three columns and nothing upstream.
    narrow = checkpointed(narrow)
    instants = narrow.groupBy("event_id", "at_us").agg(F.min("seq").alias("seq"), F.count("*").alias("_rows"))
    # Ids that occur once are settled and gone here.
    per_id = checkpointed(
        instants.groupBy("event_id")
        .agg(
            F.sum("_rows").alias("rows"),
            F.count("*").alias("points"),
            F.min("at_us").alias("first_us"),
            F.max("at_us").alias("last_us"),
            F.min(F.struct("at_us", "seq")).alias("_first"),
        )
        .filter("rows > 1")
    )
    firsts = per_id.select("event_id", F.col("_first.at_us").alias("at_us"), F.col("_first.seq").alias("seq"))
    chained = per_id.filter(F.col("last_us") - F.col("first_us") >= _long(ttl_us))
    is_long = F.col("points") > fold_limit

    facts = chained.select("event_id", "points", is_long.alias("_long"))
    points = attach(instants.select("event_id", "at_us", "seq"), facts, "event_id", "points")
    short_points = points.filter("NOT _long").drop("_long")
    accepted = firsts.unionByName(_fold(short_points, ttl_us))
    long_ids = chained.filter(is_long)
    if not long_ids.isEmpty():
        accepted = accepted.unionByName(_chain(points.filter("_long").drop("_long"), long_ids, ttl_us))

    marked = attach(narrow, per_id.select("event_id", "rows", F.lit(True).alias("_repeated")), "event_id", "rows")
    repeated = marked.filter("_repeated")
    return repeated.select("event_id", "seq").join(accepted.select("seq"), "seq", "left_anti")
