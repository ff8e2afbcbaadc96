"""The state table of a stream against a loop over single arrivals."""

import random

import pytest
from pyspark.sql import functions as F

from siftlake.operators.dedup import DedupPolicy
from siftlake.streaming.expiry import FOREVER, ExpiryTable, decide
from siftlake.streaming.levels import parts_before


def loop(batches, policy):
    until, dropped = {}, set()
    for rows in batches:
        for event_id, at, seq in sorted(rows, key=lambda r: r[1:]):
            if at < until.get(event_id, -1):
                dropped.add(seq)
            else:
                until[event_id] = FOREVER if policy.kind == "first" else at + policy.ttl_seconds * 1_000_000
    return dropped, until


def traffic(seed, batches, rows):
    """Batches whose times overlap, with one id in a third of all rows."""
    rng, seq, out = random.Random(seed), 0, []
    for b in range(batches):
        own = []
        for _ in range(rows):
            seq += 1
            own.append(("hot" if rng.random() < 0.33 else f"id{rng.randrange(rows)}", (b * 50 + rng.randrange(80)) * 1_000_000, seq))
        out.append(own)
    return out


@pytest.mark.parametrize("policy", [DedupPolicy("first"), DedupPolicy("ttl", ttl_seconds=40), DedupPolicy("ttl", ttl_seconds=7, fold_limit=3)])
def test_batches_and_replays_as_single_arrivals(spark, tmp_path, policy):
    batches = traffic(1, 6, 150)
    state = ExpiryTable(spark, f"file://{tmp_path}/state", fan=2)
    got = set()
    for number, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "event_id string, at_us bigint, seq bigint")
        runs = []
        for _ in range(2 if number in (2, 4) else 1):  # a batch that failed after leaving its state runs again
            dropped, blocks = decide(df, state.before(number), policy)
            runs.append({r.seq for r in dropped.collect()})
            state.leave(number, blocks)
        assert all(run == runs[0] for run in runs)
        got |= runs[0]
    want, until = loop(batches, policy)
    assert got == want
    left = {r.event_id: r.u for r in state.before(6).groupBy("event_id").agg(F.max("until_us").alias("u")).collect()}
    assert left == until


def test_empty_batches(spark, tmp_path):
    state, policy = ExpiryTable(spark, str(tmp_path / "state")), DedupPolicy("first")
    none = spark.createDataFrame([], "event_id string, at_us bigint, seq bigint")
    dropped, blocks = decide(none, state.before(0), policy)
    assert dropped.isEmpty() and blocks.isEmpty()
    state.leave(0, blocks)
    assert state.before(1).isEmpty()


def test_tables_read_grow_with_the_logarithm():
    for fan in (2, 3, 16):
        for batch in range(300):
            parts = parts_before(batch, fan)
            assert [b for level, start in parts for b in range(start, start + fan**level)] == list(range(batch))
    assert parts_before(0x123) == [(2, 0), (1, 0x100), (1, 0x110), (0, 0x120), (0, 0x121), (0, 0x122)]
    assert len(parts_before(16**5 - 1)) == 5 * 15


def test_merged_tables_go_and_old_blocks_are_forgotten(spark, tmp_path):
    state = ExpiryTable(spark, str(tmp_path / "state"), max_lag_seconds=60, fan=2)
    for number in range(5):
        state.before(number)
        state.leave(number, spark.createDataFrame([(f"old{number}", 1_000_000), ("kept", FOREVER)], "event_id string, until_us bigint"))
    ids = sorted(r.event_id for r in state.before(5).collect())
    assert ids == ["kept", "kept", "old4"]
    folders = {str(p.relative_to(tmp_path / "state")) for p in (tmp_path / "state").glob("*/*")}
    assert folders == {"level=2/from=0", "level=0/from=4"}
