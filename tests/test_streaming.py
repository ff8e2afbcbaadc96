import json
from functools import reduce

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from siftlake import refine
from siftlake.catalog.fixture import AS_OF, raw_events, raw_from_events
from siftlake.operators.batches import assign_batches, batches
from siftlake.operators.dedup import DedupPolicy
from siftlake.operators.metrics import FLUSH_BOUNDS, quantiles
from siftlake.operators.rates import rates, read_rates, slot_writer, stream_rates
from siftlake.session import scratch_path
from siftlake.sinks.files import compact_refined
from siftlake.sources.kafka import kafka_to_raw
from siftlake.sources.landing import accept_envelopes, read_landing_stream
from siftlake.sources.merge import merge_sources
from siftlake.sources.refined import read_dlq, read_refined
from siftlake.streaming.batches import member_writer, read_batches, read_members
from siftlake.streaming.dedup import mark_duplicates_stream
from siftlake.streaming.events import EventTable, committed_batches, read_committed, read_committed_dlq
from siftlake.streaming.levels import LevelledTable
from siftlake.streaming.refine import classify_stream, flush_batches, start_refine

PARTS = 3


def part(spark, i):
    raw = raw_events(spark, TESTDATA)
    return raw.withColumn("received_at", F.col("received_at").cast("timestamp")).filter(
        F.floor(F.col("seq") * PARTS / 1_000) == i
    ).coalesce(1)


def land(spark, folder, i):
    part(spark, i).write.mode("append").parquet(str(folder))


def run(spark, folder, base, policy, files_per_trigger=1):
    schema = part(spark, 0).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(str(folder))
    query = start_refine(stream, str(base), str(base / "progress"), AS_OF, policy, available_now=True, keep_classified=True)
    query.awaitTermination()
    return query


def outcomes(spark, base):
    rows = spark.read.parquet(f"{base}/classified").select("seq", "outcome").collect()
    got = {r.seq: r.outcome for r in rows}
    assert len(got) == len(rows)
    return got


def batch_outcomes(spark, policy):
    return {r.seq: r.outcome for r in refine(raw_events(spark, TESTDATA), AS_OF, policy).classified.collect()}


def test_restarted_stream_equals_batch(spark, tmp_path):
    policy = DedupPolicy("ttl", ttl_seconds=3_600)
    folder, base = tmp_path / "in", tmp_path / "out"
    land(spark, folder, 0)
    land(spark, folder, 1)
    run(spark, folder, base, policy)
    land(spark, folder, 2)
    run(spark, folder, base, policy)
    want = batch_outcomes(spark, policy)
    assert outcomes(spark, base) == want
    processed = sum(o == "processed" for o in want.values())
    assert read_refined(spark, f"{base}/refined").count() == processed
    compact_refined(spark, f"{base}/refined", f"{base}/compact", "1970-01-01", "2999-12-31")
    assert read_refined(spark, f"{base}/compact").count() == processed
    days = read_refined(spark, f"{base}/compact").select("ingest_date").distinct().count()
    assert len(list(base.glob("compact/*/*.parquet"))) == days
    assert read_dlq(spark, f"{base}/dlq").count() == sum(o in ("validation", "unhandled_error") for o in want.values())
    counts = spark.read.parquet(f"{base}/counts").agg(F.sum("n")).first()[0]
    assert counts == len(want)
    flushes = flush_batches(spark, str(base))
    assert flushes.filter("seconds > 0").count() == PARTS
    assert flushes.agg(F.sum("rows")).first()[0] == processed
    p95 = quantiles(flushes, F.col("seconds"), FLUSH_BOUNDS, qs={"p95": 0.95}).first().p95
    assert 0 < p95 <= FLUSH_BOUNDS[-1]


def test_file_order_inside_a_batch_does_not_matter(spark, tmp_path):
    folder, base = tmp_path / "in", tmp_path / "out"
    for i in (2, 0, 1):
        land(spark, folder, i)
    run(spark, folder, base, "first", files_per_trigger=10)
    assert outcomes(spark, base) == batch_outcomes(spark, "first")


def test_lru_is_refused_and_off_passes(spark, tmp_path):
    land(spark, tmp_path / "in", 0)
    stream = spark.readStream.schema(part(spark, 0).schema).parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError):
        classify_stream(stream, AS_OF, DedupPolicy("lru"))
    events = stream.withColumn("ingest_timestamp", F.col("received_at"))
    assert "is_duplicate" in mark_duplicates_stream(events, "off").columns


def test_landing_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    same = {"payload": {"a": 1}}
    bodies = [{"event_id": "e", "payload": {"a": 1}}, {"event_id": 5}, {"source": "s"}, same, same]
    for name in ("a", "b"):
        (tmp_path / "in" / f"{name}.json").write_text("\r\n".join(json.dumps(b) for b in bodies) + "\n\n")
    lines = read_landing_stream(spark, str(tmp_path / "in"))
    query = (
        accept_envelopes(lines).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(got) == 8 and {r.source for r in got} == {"webhook", "s"}
    # Equal lines without an id stay apart, in one file and between files.
    assert len({r.event_id for r in got}) == 7 and len({r.seq for r in got}) == 8


def test_batches_go_on_over_micro_batches(spark, tmp_path):
    """Seven micro-batches, two of them replayed and one empty, against one table in arrival order."""
    rows = [(i, 1_000 + i // 3) for i in range(140)]
    frame = lambda part: spark.createDataFrame(part, "seq bigint, at bigint").selectExpr("seq", "timestamp_seconds(at) AS t")
    shape = {"max_size": 4, "interval": 10}
    write = member_writer(str(tmp_path / "members"), str(tmp_path / "ticks"), "t", fan=2, **shape)
    cuts = [0, 11, 12, 50, 50, 90, 133, 140]
    for number, (low, high) in enumerate(zip(cuts, cuts[1:])):
        if number in (2, 5):  # fails after its counts, and is run again
            write(frame(rows[low:high]), number)
        write(frame(rows[low:high]), number)
    members = read_members(spark, str(tmp_path / "members"))
    whole = frame(rows)
    assert sorted(members.collect()) == sorted(assign_batches(whole, "t", **shape).collect())
    assert sorted(read_batches(members).collect()) == sorted(batches(whole, "t", **shape).collect())


def test_late_events_join_their_tick_behind_the_others(spark, tmp_path):
    write = member_writer(str(tmp_path / "members"), str(tmp_path / "ticks"), "t", max_size=2, interval=10)
    for number, rows in enumerate([[(0, 5), (1, 6), (2, 7)], [(3, 15)], [(4, 1)]]):
        write(spark.createDataFrame(rows, "seq bigint, at bigint").selectExpr("seq", "timestamp_seconds(at) AS t"), number)
    got = {r.seq: (r.tick, r.chunk) for r in read_members(spark, str(tmp_path / "members")).collect()}
    assert got == {0: (0, 0), 1: (0, 0), 2: (0, 1), 3: (1, 0), 4: (0, 1)}


def test_slot_tables_are_merged(spark, tmp_path):
    path, at = str(tmp_path / "slots"), "received_at"
    write = slot_writer(path, at, ["source"], fan=2)
    frames = [
        spark.createDataFrame([("s", 100 + (7 * i * k) % 40) for k in range(5)], "source string, at bigint")
        .selectExpr("source", "timestamp_seconds(at) AS received_at") for i in range(7)
    ]
    for number, frame in enumerate(frames):
        write(frame, number)
        if number == 4:
            write(frame, number)
        whole = reduce(lambda a, b: a.unionByName(b), frames[:number + 1])
        assert sorted(read_rates(spark, path, ["source"], fan=2).collect()) == sorted(rates(whole, F.col(at), ["source"]).collect())
    table = LevelledTable(spark, path, lambda rows: rows, ["_slot"], fan=2)
    assert [level for level, _ in table.parts()] == [2, 1, 0]
    folders = {str(p.relative_to(path)) for p in (tmp_path / "slots").glob("*/*")}
    assert len(folders) <= 5 and "level=0/from=0" not in folders


def test_stream_rates_with_late_events(spark, tmp_path):
    """The newest file comes first, so everything after it is late."""
    folder = tmp_path / "in"
    schema = part(spark, 0).schema
    for i in (2, 0, 1):
        land(spark, folder, i)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
        stream_rates(stream, "received_at", str(tmp_path / "slots"), str(tmp_path / "progress"), ["source"], available_now=True).awaitTermination()
    got = {(r.window_end_us, r.source): r.per_second for r in read_rates(spark, str(tmp_path / "slots"), ["source"]).collect()}
    whole = raw_events(spark, TESTDATA).withColumn("received_at", F.col("received_at").cast("timestamp"))
    want = {(r.window_end_us, r.source): r.per_second for r in rates(whole, F.col("received_at"), ["source"]).collect()}
    assert got == want


def test_malformed_messages_in_a_stream(spark, tmp_path):
    """Kafka messages and landing lines through one stream pipeline."""
    (tmp_path / "in").mkdir()
    (tmp_path / "messages").mkdir()
    shared = "0123abcd-0123-abcd-0123-0123456789ab"
    (tmp_path / "in" / "a.json").write_text(json.dumps({"event_id": shared, "payload": {"a": 1}}))
    schema = "topic string, partition int, offset bigint, value string, timestamp timestamp"
    rows = [("orders", 0, 0, "{broken"), ("orders", 0, 1, json.dumps({"event_id": shared, "a": 1})), ("orders", 0, 2, '{"event_id":5}')]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string")
    df.withColumn("timestamp", F.timestamp_seconds(F.lit(1))).write.mode("append").parquet(str(tmp_path / "messages"))
    messages = kafka_to_raw(spark.readStream.schema(schema).parquet(str(tmp_path / "messages")))
    raw = merge_sources(messages, accept_envelopes(read_landing_stream(spark, str(tmp_path / "in"))))
    base = tmp_path / "out"
    start_refine(raw, str(base), str(base / "progress"), policy="first", available_now=True).awaitTermination()
    assert not list(base.glob("classified/batch_id=*"))
    counts = spark.read.parquet(f"{base}/counts").groupBy("source", "outcome").agg(F.sum("n").alias("n")).collect()
    assert {(r.source, r.outcome): r.n for r in counts} == {
        ("kafka-orders", "malformed"): 2, ("kafka-orders", "processed"): 1, ("webhook", "duplicate"): 1,
    }
    dead = read_dlq(spark, f"{base}/dlq").collect()
    assert sorted(r.event_id for r in dead)[0] == "" and {r.error_reason for r in dead} == {"malformed message"}


def test_half_a_batch_is_never_seen(spark, tmp_path, monkeypatch):
    """The batch fails with its events and dead letters written; readers see it once it has run again."""
    from siftlake.streaming import refine as module

    folder, base = tmp_path / "in", tmp_path / "out"

    def go(i):
        land(spark, folder, i)
        stream = spark.readStream.schema(part(spark, 0).schema).parquet(str(folder))
        start_refine(stream, str(base), str(base / "progress"), AS_OF, "off", available_now=True, levelled=True, fan=2).awaitTermination()

    def seen():
        return read_committed(spark, str(base), fan=2).count(), read_committed_dlq(spark, str(base)).count()

    go(0)
    first, write = seen(), module.write_dlq

    def fail(*args, **more):
        write(*args, **more)
        raise OSError("the store is full")

    monkeypatch.setattr(module, "write_dlq", fail)
    with pytest.raises(Exception, match="store is full"):
        go(1)
    assert EventTable(spark, f"{base}/events", 2).latest().count() > first[0]
    assert read_dlq(spark, f"{base}/dlq").count() > first[1]
    assert seen() == first and committed_batches(spark, str(base)) == 1
    monkeypatch.setattr(module, "write_dlq", write)
    go(2)
    want = refine(raw_events(spark, TESTDATA), AS_OF, "off")
    assert seen() == (want.valid.count(), want.dlq.count())
    day = want.valid.agg(F.date_format(F.min("ingest_timestamp"), "yyyy-MM-dd")).first()[0]
    some = read_committed(spark, str(base), day, day, fan=2)
    assert 0 < some.count() < seen()[0] and "PartitionFilters: [isnotnull(ingest_date" in some._jdf.queryExecution().toString()


def test_readers_go_on_through_merges(spark, tmp_path):
    events = refine(raw_events(spark, TESTDATA), AS_OF, "off").valid
    sizes = [events.filter(F.col("seq") % 3 == i).count() for i in range(3)]
    table = EventTable(spark, str(tmp_path), 2)
    assert table.latest(0).count() == 0
    for i in (0, 1):
        table.tidy(i)
        table.leave(i, events.filter(F.col("seq") % 3 == i))
    before = table.latest(2)
    table.tidy(2)  # merges both
    table.leave(2, events.filter(F.col("seq") % 3 == 2))
    assert before.count() == sizes[0] + sizes[1]
    assert table.parts() == [(1, 0), (0, 2)] and table.latest(3).count() == sum(sizes)
    with pytest.raises(LookupError):
        table.latest(4)
    (tmp_path / "level=1" / "from=0" / "_SUCCESS").unlink()  # as if the merge had not come to its end
    assert table.parts() == [(0, 0), (0, 1), (0, 2)] and table.latest(3).count() == sum(sizes)
    table.tidy(2)
    assert table.parts() == [(1, 0), (0, 2)]
    table.tidy(3)
    assert not list(tmp_path.glob("level=0/from=[01]")) and table.latest(3).count() == sum(sizes)


@pytest.mark.parametrize("step", ["write_refined", "write_dlq"])
def test_a_batch_that_fails_midway_is_replayed_whole(spark, tmp_path, monkeypatch, step):
    """Its state and some of its outputs are there when it runs again."""
    from siftlake.streaming import refine as module

    policy, folder, base = DedupPolicy("ttl", ttl_seconds=400), tmp_path / "in", tmp_path / "out"
    land(spark, folder, 0)
    run(spark, folder, base, policy)
    land(spark, folder, 1)
    write, failures = getattr(module, step), []

    def once(*args, **more):
        write(*args, **more)
        failures.append(1)
        raise OSError("the store is full")

    monkeypatch.setattr(module, step, once)
    with pytest.raises(Exception, match="store is full"):
        run(spark, folder, base, policy)
    monkeypatch.setattr(module, step, write)
    land(spark, folder, 2)
    run(spark, folder, base, policy)
    want = batch_outcomes(spark, policy)
    assert failures == [1] and outcomes(spark, base) == want
    processed = sum(o == "processed" for o in want.values())
    refined = read_refined(spark, f"{base}/refined")
    assert refined.count() == processed == refined.select("event_id", "ingest_timestamp", "event_timestamp", "source", "payload").count()
    assert read_dlq(spark, f"{base}/dlq").count() == sum(o in ("validation", "unhandled_error") for o in want.values())
    assert spark.read.parquet(f"{base}/counts").agg(F.sum("n")).first()[0] == len(want)


def test_events_of_one_row_group_are_parsed_in_many_tasks(spark, tmp_path):
    rows = spark.range(2_000).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id) AS ts", "id % 7 AS user_id", "'click' AS event_type", "1.5D AS value", "'{}' AS props")
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    batch = raw_events(spark, str(tmp_path))
    assert batch.count() == 2_000 and batch.select(F.spark_partition_id()).distinct().count() >= 4
    raw = raw_from_events(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/events.parquet"))
    base = scratch_path(spark, "stream")
    tasks = []

    def seen(rows, _):
        tasks.append(rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())

    raw.writeStream.foreachBatch(seen).option("checkpointLocation", f"{base}/progress").trigger(availableNow=True).start().awaitTermination()
    assert sum(t["n"] for t in tasks[0]) == 2_000 and len(tasks[0]) >= 4 and max(t["n"] for t in tasks[0]) < 1_000
