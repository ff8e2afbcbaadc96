import random

import pytest
from pyspark.sql import functions as F

from siftlake.operators import dedup_ttl
from siftlake.operators.attach import attach
from siftlake.operators.dedup import DedupPolicy, drop_duplicates, mark_duplicates, seen_size
from siftlake.operators.dedup_lru import lru_duplicates
from siftlake.operators.dedup_ttl import ttl_duplicates
from siftlake.operators.dominance import with_lower
from siftlake.operators.ordering import with_position
from siftlake.session import checkpointed

MINUTE = 60_000_000


def events(spark, trace):
    """trace: (event_id, at_us) in any order; seq is the place in the list."""
    rows = [(i, key, at) for i, (key, at) in enumerate(trace)]
    df = spark.createDataFrame(rows, "seq bigint, event_id string, at_us bigint")
    return df.select("seq", "event_id", F.timestamp_micros("at_us").alias("ingest_timestamp"))


def dropped(df, policy):
    marked = mark_duplicates(df, policy)
    assert marked.count() == df.count()
    return {r.seq for r in marked.filter("is_duplicate").select("seq").collect()}


def arrival(trace):
    return sorted(range(len(trace)), key=lambda i: (trace[i][1], i))


def brute_first(trace):
    seen, out = set(), set()
    for i in arrival(trace):
        (out.add(i) if trace[i][0] in seen else seen.add(trace[i][0]))
    return out


def brute_lru(trace, capacity):
    """By reuse distance: fewer than ``capacity`` other ids since the last use."""
    order, out = arrival(trace), set()
    keys = [trace[i][0] for i in order]
    for n, i in enumerate(order):
        earlier = [m for m in range(n) if keys[m] == keys[n]]
        if earlier and len(set(keys[earlier[-1] + 1:n])) < capacity:
            out.add(i)
    return out


def brute_ttl(trace, ttl):
    until, out = {}, set()
    for i in arrival(trace):
        key, at = trace[i]
        if key in until and at < until[key]:
            out.add(i)
        else:
            until[key] = at + ttl
    return out


def random_trace(seed, n, ids, span, hot=0.0):
    rng = random.Random(seed)
    return [
        ("hot" if rng.random() < hot else f"id{rng.randrange(ids)}", rng.randrange(span)) for _ in range(n)
    ]


TRACES = [
    random_trace(1, 600, 40, 5_000),
    random_trace(2, 600, 400, 1_000_000, hot=0.4),
    random_trace(3, 500, 5, 300, hot=0.5),
    [("a", 0)] * 50 + [("b", 5)] * 3,
]


@pytest.mark.parametrize("trace", TRACES)
def test_first(spark, trace):
    assert dropped(events(spark, trace), "first") == brute_first(trace)


@pytest.mark.parametrize("capacity, chunk_rows", [(5, 29), (150, 100), (7, None)])
@pytest.mark.parametrize("trace", TRACES[:3])
def test_lru(spark, trace, capacity, chunk_rows):
    policy = DedupPolicy("lru", capacity=capacity, chunk_rows=chunk_rows)
    assert dropped(events(spark, trace), policy) == brute_lru(trace, capacity)


@pytest.mark.parametrize("ttl", [40, 90_000])
@pytest.mark.parametrize("trace", TRACES[1:])
def test_ttl_fold_and_distributed_chain(spark, trace, ttl):
    narrow = events(spark, trace).select("event_id", F.unix_micros("ingest_timestamp").alias("at_us"), "seq")
    want = brute_ttl(trace, ttl)
    for fold_limit in (1_000, 3):
        keys = [r.seq for r in ttl_duplicates(narrow, ttl, fold_limit).collect()]
        assert len(keys) == len(set(keys))
        assert set(keys) == want, fold_limit


def test_longer_jumps_start_at_fewer_events(spark, monkeypatch):
    trace, jumps = random_trace(5, 2_000, 1, 100_000), []

    def counted(df):
        done = checkpointed(df)
        if done.columns == ["node", "next"]:
            jumps.append(done.count())
        return done

    monkeypatch.setattr(dedup_ttl, "checkpointed", counted)
    narrow = events(spark, trace).select("event_id", F.unix_micros("ingest_timestamp").alias("at_us"), "seq")
    assert {r.seq for r in ttl_duplicates(narrow, 400, 3).collect()} == brute_ttl(trace, 400)
    assert jumps[-1] < jumps[0] / 8


@pytest.mark.parametrize("capacity, hits", [(9, 0), (10, 90)])
def test_lru_cyclic_trace(spark, capacity, hits):
    """Ids that come round in turn are the worst case: every repeat is as far as the capacity."""
    trace = [(f"id{i % 10}", i) for i in range(100)]
    for chunk_rows in (None, 17):
        policy = DedupPolicy("lru", capacity=capacity, chunk_rows=chunk_rows)
        assert len(dropped(events(spark, trace), policy)) == hits


def test_lru_far_repeats_of_few_ids(spark):
    """Far apart, yet few distinct ids lie between: only the count of ids can tell."""
    trace = [("first", 0), ("second", 1)] + [("hot", 2 + i) for i in range(60)] + [("second", 62), ("first", 63)]
    for chunk_rows in (None, 20):
        for capacity in (2, 3):
            policy = DedupPolicy("lru", capacity=capacity, chunk_rows=chunk_rows)
            assert dropped(events(spark, trace), policy) == brute_lru(trace, capacity)


def test_lru_stays_in_the_jvm(spark):
    narrow = events(spark, [("a", 0), ("b", 1), ("a", 2)]).select("event_id", F.unix_micros("ingest_timestamp").alias("at_us"), "seq")
    plan = lru_duplicates(narrow, 1)._jdf.queryExecution().toString()
    assert "InPandas" not in plan and "Python" not in plan


@pytest.mark.parametrize("length", [1, 4, 5, 70])
def test_with_lower(spark, length):
    rng = random.Random(length)
    rows = [(g, place, value) for g in (0, 1) for place, value in enumerate(rng.sample(range(500), length)) if rng.random() < 0.8]
    df = spark.createDataFrame(rows, "g bigint, place bigint, value bigint")
    got = {(r.g, r.place): r.lower for r in with_lower(df, "g", "place", "value", length).collect()}
    assert got == {(g, p): sum(h == g and q < p and w < v for h, q, w in rows) for g, p, v in rows}


def test_lru_hit_refreshes(spark):
    trace = [(key, i) for i, key in enumerate(["a", "b", "a", "c", "a", "b"])]
    assert dropped(events(spark, trace), DedupPolicy("lru", capacity=2)) == {2, 4}


def test_lru_eviction(spark):
    trace = [(f"event-{i}", i) for i in range(6)] + [("event-0", 6)]
    assert dropped(events(spark, trace), DedupPolicy("lru", capacity=5)) == set()


def test_ttl_is_not_refreshed_by_duplicates(spark):
    trace = [("a", 0), ("a", 50 * MINUTE), ("a", 70 * MINUTE)]
    assert dropped(events(spark, trace), DedupPolicy("ttl", ttl_seconds=3_600)) == {1}
    exact = [("a", 0), ("a", 60 * MINUTE)]
    assert dropped(events(spark, exact), DedupPolicy("ttl", ttl_seconds=3_600)) == set()


def test_off_and_ids_are_raw_strings(spark):
    assert dropped(events(spark, [("a", 0), ("a", 1)]), "off") == set()
    assert dropped(events(spark, [("ab-c", 0), ("AB-C", 1), ("abc", 2)]), "first") == set()


def test_rejected_events_do_not_register(spark):
    df = events(spark, [("a", 0), ("a", 1), ("a", 2)]).withColumn("ok", F.col("seq") != 0)
    marked = mark_duplicates(df, "first", F.col("ok"))
    assert [r.is_duplicate for r in marked.orderBy("seq").collect()] == [False, False, True]


def test_seen_size(spark):
    kept = events(spark, [("a", 0), ("b", 1), ("c", 2)])
    assert seen_size(kept).first().n == 3
    assert seen_size(kept, 2).first().n == 2


def test_unknown_policy():
    with pytest.raises(ValueError):
        DedupPolicy("sliding")


def test_positions_are_dense_with_ties(spark):
    df = spark.range(1000).select(F.col("id").alias("seq"), (F.col("id") % 3).alias("k"))
    placed, total = with_position(df, ["k", "seq"])
    got = {r.seq: r.position for r in placed.collect()}
    order = sorted(range(1000), key=lambda i: (i % 3, i))
    assert total == 1000 and [got[i] for i in order] == list(range(1000))


def test_positions_of_nothing(spark):
    placed, total = with_position(spark.range(0).select(F.col("id").alias("seq")), ["seq"])
    assert total == 0 and placed.count() == 0


def test_a_hot_id_does_not_make_a_hot_task(spark):
    """A third of all rows share one id; after marking they are spread over all tasks."""
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for name, value in off.items():
        spark.conf.set(name, value)
    try:
        key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("id"), F.col("id").cast("string")))
        df = spark.range(0, 60_000, numPartitions=4).select(
            F.col("id").alias("seq"), key.alias("event_id"), F.timestamp_micros("id").alias("ingest_timestamp")
        )
        marked = mark_duplicates(df, "first")
        assert marked.filter("is_duplicate").count() == 19_999
        sizes = [r["count"] for r in marked.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 4 and max(sizes) < 18_000
    finally:
        for name in off:
            spark.conf.unset(name)


@pytest.mark.parametrize("parts", [1, 8, 1_000])
def test_attach_with_no_some_and_only_hot_keys(spark, parts):
    rows = spark.range(100).select(F.col("id").alias("seq"), F.sqrt(F.col("id")).cast("int").alias("k"))
    facts = rows.filter("k <> 3").groupBy("k").agg(F.count("*").alias("n"), F.max("seq").alias("last"))
    got = {r.seq: (r.k, r["last"]) for r in attach(rows, facts, "k", "n", parts=parts).collect()}
    assert got == {
        i: (int(i**0.5), None if int(i**0.5) == 3 else min(99, (int(i**0.5) + 1) ** 2 - 1)) for i in range(100)
    }


def test_drop(spark):
    assert drop_duplicates(events(spark, [("a", 0), ("a", 1)])).count() == 1
