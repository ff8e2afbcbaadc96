import random
import statistics

import pytest
from conftest import NOW, TESTDATA
from pyspark.sql import functions as F

from siftlake import refine
from siftlake.catalog.fixture import AS_OF, raw_events
from siftlake.operators import batches as B
from siftlake.operators import dlq as Q
from siftlake.operators import metrics as M
from siftlake.operators.dedup import DedupPolicy
from siftlake.operators.load_report import load_report
from siftlake.operators.rates import rates, sliding_quantiles

ID = "0123abcd-0123-abcd-0123-0123456789a{}"


@pytest.fixture(scope="module")
def classified(spark):
    return refine(raw_events(spark, TESTDATA), AS_OF)


GOLDEN = {"processed": 854, "duplicate": 83, "validation": 53, "unhandled_error": 10}


def test_golden_outcomes(spark, classified):
    counts = {r.outcome: r.n for r in classified.metrics.groupBy("outcome").agg(F.sum("n").alias("n")).collect()}
    assert counts == GOLDEN
    assert classified.valid.count() == 854 and classified.duplicates.count() == 83 and classified.dlq.count() == 63
    lazy = refine(raw_events(spark, TESTDATA), AS_OF, stage=False)
    assert {r.outcome: r["count"] for r in lazy.classified.groupBy("outcome").count().collect()} == GOLDEN


def test_rejected_events_keep_the_raw_payload(classified):
    rows = classified.classified.groupBy("outcome").agg(
        F.count("payload").alias("clean"), F.count("raw_payload").alias("raw")
    ).collect()
    for r in rows:
        assert (r.clean == 0) == (r.outcome in ("validation", "unhandled_error"))
        assert (r.raw == 0) != (r.clean == 0)


def test_an_error_wins_over_a_violation_and_a_violation_over_a_duplicate(spark, raw):
    rows = [
        ("bad", "s", '{"timestamp":253402300800}'), (ID.format(1), "s", '{"a":1}'), (ID.format(1), " ", '{"a":1}'),
        (ID.format(1), "s", '{"a":1}'), ("bad", "s", '{"a":1}'),
    ]
    got = [r.outcome for r in refine(raw(rows), NOW).classified.orderBy("seq").collect()]
    assert got == ["unhandled_error", "processed", "validation", "duplicate", "validation"]


def test_empty_payload_passes_for_mapped_sources_only(raw):
    rows = [(ID.format(1), "kafka-orders", "{}"), (ID.format(2), "kafka-clicks", "{}"), (ID.format(3), "x", "{}")]
    got = [r.outcome for r in refine(raw(rows), NOW).classified.orderBy("seq").collect()]
    assert got == ["processed", "processed", "validation"]


def test_optimized_plan_stays_small(spark):
    evaluated = refine(raw_events(spark, TESTDATA), AS_OF, "off").classified.filter("outcome = 'validation'")
    assert len(evaluated._jdf.queryExecution().optimizedPlan().toString()) < 60_000


def test_only_needed_columns_are_read_from_the_stage(classified):
    plan = classified.metrics._jdf.queryExecution().executedPlan().toString()
    schemas = [line for line in plan.split("ReadSchema: ")[1:]]
    assert schemas and all("payload" not in s.split(">")[0] for s in schemas)


def dead(spark, n):
    return spark.range(n).select(
        F.col("id").alias("seq"), F.concat(F.lit("e"), "id").alias("event_id"), F.lit("s").alias("source"),
        F.lit("{}").alias("raw_payload"), F.lit("r").alias("error_reason"), F.lit("validation").alias("outcome"),
    )


def test_pages(spark, monkeypatch):
    df = dead(spark, 120)
    assert [r.seq for r in Q.dlq_page(df).collect()] == list(range(119, 69, -1))
    assert [r.seq for r in Q.dlq_page(df, 10, 115).collect()] == [4, 3, 2, 1, 0]
    assert Q.dlq_page(df, 10, 500).count() == 0
    monkeypatch.setattr(Q, "_TOP_K_DEPTH", 20)
    assert [r.seq for r in Q.dlq_page(df, 10, 60).collect()] == list(range(59, 49, -1))
    for bad in ({"limit": 0}, {"limit": 501}, {"offset": -1}):
        with pytest.raises(ValueError):
            Q.dlq_page(df, **bad)


def test_envelope(spark):
    row = Q.dlq_envelope(dead(spark, 5), limit=2, offset=1).first()
    assert (row.total, row.offset, row.limit) == (5, 1, 2)
    assert [r.event_id for r in row.records] == ["e3", "e2"]
    empty = Q.dlq_envelope(dead(spark, 0)).first()
    assert empty.total == 0 and empty.records == []


def test_gauge_states(spark):
    values = [0, 9, 10, 99, 100]
    df = spark.createDataFrame([(v,) for v in values], "n int")
    states = [r[0] for r in df.select(M.gauge_state(F.col("n"), M.DLQ_STATES)).collect()]
    assert states == ["green", "green", "yellow", "yellow", "red"]


def test_histogram_and_quantiles(spark):
    bounds = (1.0, 2.0, 4.0)
    df = spark.createDataFrame([(0.5,), (1.0,), (1.5,), (3.0,), (9.0,)], "v double")
    cumulative = {r.le: r.cumulative_n for r in M.histogram(df, F.col("v"), bounds).collect()}
    assert cumulative == {"1": 2, "2": 3, "4": 4, "+Inf": 5}
    got = M.quantiles(df, F.col("v"), bounds, qs={"a": 0.2, "b": 0.5, "c": 0.8, "d": 0.99}).first()
    assert got.a == pytest.approx(0.5) and got.b == pytest.approx(1.5) and got.c == pytest.approx(4.0) and got.d == 4.0
    nothing = M.quantiles(df.limit(0), F.col("v"), bounds).first()
    assert nothing.p50 is None
    assert M.histogram_sum(df, F.col("v")).first().n == 5


def brute_batches(times, max_size, interval_us):
    out, fill = {}, {}
    for t in sorted(times):
        tick = t // interval_us
        fill[tick] = fill.get(tick, 0) + 1
        chunk = (fill[tick] - 1) // max_size
        out[(tick, chunk)] = out.get((tick, chunk), 0) + 1
    return out


def test_batches(spark, monkeypatch):
    rng = random.Random(4)
    times = [rng.randrange(60_000_000) for _ in range(300)] + [7_000_000] * 200
    df = spark.createDataFrame(list(enumerate(times)), "seq bigint, us bigint").select(
        "seq", F.timestamp_micros("us").alias("ingest_timestamp")
    )
    want = brute_batches(times, 7, 10_000_000)
    monkeypatch.setattr(B, "_LIST_SPAN", 4)
    got = {(r.tick, r.chunk): r.n for r in B.batches(df, max_size=7).collect()}
    assert got == want
    members = B.assign_batches(df, max_size=7).groupBy("tick", "chunk").count().collect()
    assert {(r.tick, r.chunk): r["count"] for r in members} == want
    sizes = B.batch_sizes(df, max_size=7)
    assert sizes.agg(F.sum(F.col("size") * F.col("batches"))).first()[0] == 500
    assert sizes.agg(F.sum("batches")).first()[0] == len(want)


def test_rates(spark):
    df = spark.createDataFrame([("a", 3), ("a", 4), ("b", 61)], "source string, s bigint")
    at = F.timestamp_seconds("s")
    got = {(r.source, r.window_end_us // 1_000_000): r.per_second for r in rates(df, at, ["source"]).collect()}
    assert len(got) == 24
    assert got[("a", 5)] == 2 / 60 and got[("a", 60)] == 2 / 60 and ("a", 65) not in got
    assert got[("b", 65)] == 1 / 60 and got[("b", 120)] == 1 / 60
    with pytest.raises(ValueError):
        rates(df, at, width=60, step=7)
    panel = sliding_quantiles(df, at, F.col("s").cast("double"), (1.0, 10.0, 100.0)).collect()
    assert {r.window_end_us // 1_000_000 for r in panel} == set(range(5, 65, 5)) | set(range(65, 125, 5))


@pytest.mark.parametrize("n", [0, 1, 2, 7, 100])
def test_load_report(spark, n):
    rng = random.Random(n)
    latencies = [rng.choice([0.001, 0.002, rng.random()]) for _ in range(n)]
    rows = [(i, 202, v) for i, v in enumerate(latencies)] + [(n, 429, 9.0), (n + 1, 0, 9.0), (n + 2, 500, 9.0)]
    got = load_report(spark.createDataFrame(rows, "seq bigint, status int, latency double"), 2.0).first()
    assert (got.total, got.success, got.rejected, got.errors) == (n + 3, n, 1, 2)
    assert got.throughput == (n + 3) / 2.0 and got.success_pct == pytest.approx(100 * n / (n + 3))
    if n:
        ordered = sorted(latencies)
        assert got.p50_ms == pytest.approx(statistics.median(ordered) * 1000)
        assert got.p95_ms == pytest.approx(ordered[int(n * 0.95)] * 1000)
        assert got.p99_ms == pytest.approx(ordered[int(n * 0.99)] * 1000)
    else:
        assert got.p50_ms is None


@pytest.mark.parametrize("policy, counts", [
    (DedupPolicy("lru", capacity=500, chunk_rows=300), (857, 80)),
    (DedupPolicy("ttl", ttl_seconds=3_600), (884, 53)),
    (DedupPolicy("ttl", ttl_seconds=400, fold_limit=1), (929, 8)),
])
def test_golden_policies(spark, policy, counts):
    metrics = refine(raw_events(spark, TESTDATA), AS_OF, policy).metrics
    got = {r.outcome: r.n for r in metrics.groupBy("outcome").agg(F.sum("n").alias("n")).collect()}
    assert (got["processed"], got["duplicate"]) == counts
