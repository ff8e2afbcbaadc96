import json
from pathlib import Path

import pytest
from conftest import NOW
from pyspark.sql import functions as F

from siftlake import refine
from siftlake.session import scratch_path
from siftlake.sinks.files import show_in_memory, write_dlq, write_refined
from siftlake.sinks.table import compact_table, create_table, insert_if_absent, jdbc_statements, stored_ids
from siftlake.sources.kafka import kafka_options, kafka_to_raw, malformed_records
from siftlake.sources.landing import accept_envelopes, read_landing, reject_envelopes
from siftlake.sources.merge import merge_sources
from siftlake.sources.refined import read_dlq, read_refined

ID = "0123abcd-0123-abcd-0123-0123456789a{}"


def messages(spark, values, topic="orders"):
    rows = [(topic, 0, i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string")
    return df.withColumn("timestamp", F.timestamp_seconds(F.lit(1_706_000_000)))


def test_kafka_values(spark):
    values = ['{"event_id":"x","a":1}', '{"a":1}', '{"event_id":""}', '{"event_id":null}', "[1]", "42", '"s"', "null",
              "{broken", None, '{"event_id":5}', '{"event_id":[]}']
    df = messages(spark, values).withColumn("value", F.col("value").cast("binary"))
    rows = kafka_to_raw(df).orderBy("seq").collect()
    assert [r.malformed for r in rows] == [False] * 8 + [True, True, True, False]
    assert rows[0].event_id == "x" and rows[0].source == "kafka-orders"
    assert json.loads(rows[0].payload) == {"event_id": "x", "a": 1}
    made = [rows[i].event_id for i in (1, 2, 3, 4, 5, 6, 7, 11)]
    assert len(set(made)) == 8 and all(len(m) == 36 for m in made)
    assert [json.loads(rows[i].payload) for i in (4, 5, 6, 7)] == [{"raw": [1]}, {"raw": 42}, {"raw": "s"}, {"raw": None}]
    assert kafka_to_raw(df).orderBy("seq").collect() == rows
    dead = malformed_records(kafka_to_raw(df), NOW).collect()
    assert len(dead) == 3 and {r.error_reason for r in dead} == {"malformed message"}


def test_kafka_seq_is_unique(spark):
    parts = [messages(spark, ["1", "2"], t).withColumn("partition", F.lit(p)) for t in ("orders", "clicks") for p in (0, 5)]
    df = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    assert kafka_to_raw(df).select("seq").distinct().count() == 8


def test_kafka_options():
    options = kafka_options("h:9092", ("a", "b"), "latest", 500)
    assert options == {"kafka.bootstrap.servers": "h:9092", "subscribe": "a,b", "startingOffsets": "latest",
                       "maxOffsetsPerTrigger": "500"}
    with pytest.raises(ValueError):
        kafka_options("h", starting="newest")


BODIES = [
    {"event_id": "e", "source": "s", "timestamp": "t", "payload": {"a": 1}},
    {"source": "s", "payload": {}},
    {"event_id": "e2", "payload": {"a": None}},
    {"event_id": "e3", "source": "", "extra": [1]},
    {"event_id": 5}, {"source": []}, {"timestamp": 1}, {"payload": None}, {"payload": "x"}, [1], "text",
]


def landed(spark):
    rows = [(i, json.dumps(b)) for i, b in enumerate(BODIES)] + [(len(BODIES), "{broken")]
    return spark.createDataFrame(rows, "seq bigint, body string").withColumn("received_at", F.timestamp_seconds("seq"))


def test_envelopes(spark):
    rows = accept_envelopes(landed(spark)).orderBy("seq").collect()
    assert [r.seq for r in rows] == [0, 1, 2, 3]
    assert [r.source for r in rows] == ["s", "s", "webhook", "webhook"]
    assert rows[0].event_id == "e" and len(rows[1].event_id) == 36
    assert [json.loads(r.payload) for r in rows] == [{"a": 1}, {}, {"a": None}, {}]
    reasons = {r.seq: r.reason for r in reject_envelopes(landed(spark)).collect()}
    assert reasons == {
        4: "event_id is not a string", 5: "source is not a string", 6: "timestamp is not a string",
        7: "payload is not an object", 8: "payload is not an object", 9: "body is not an object",
        10: "body is not an object", 11: "body is not valid JSON",
    }


def test_landing_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(json.dumps(b) for b in BODIES) + "\n\n{broken\n")
    df = read_landing(spark, str(tmp_path / "in"))
    assert df.count() == 12 and df.select("seq").distinct().count() == 12
    assert accept_envelopes(df).count() == 4


def outcome_frame(raw):
    rows = [(ID.format(i % 10), "s", '{"a":%d}' % i, i * 43_200) for i in range(8)]
    rows += [("bad", "s", '{"b":[1,{"c":null}]}', 9), (ID.format(9), "s", "not json", 10), (ID.format(9), "s", "[1]", 11)]
    return refine(raw(rows), NOW)


def test_parquet_layout_and_pruning(spark, raw, tmp_path):
    path = str(tmp_path / "refined")
    result = outcome_frame(raw)
    write_refined(result.valid, path)
    write_refined(result.valid.limit(0), path)
    assert read_refined(spark, path).count() == 8
    days = sorted(p.name for p in (tmp_path / "refined").iterdir() if p.is_dir())
    assert days == [f"ingest_date=2024-01-{d}" for d in (23, 24, 25, 26)]
    pruned = read_refined(spark, path, "2024-01-24", "2024-01-24")
    assert pruned.count() == 2
    assert "PartitionFilters: [isnotnull(ingest_date" in pruned._jdf.queryExecution().toString()
    names = [p.name for p in (tmp_path / "refined" / days[0]).iterdir() if p.suffix == ".parquet"]
    assert all(".snappy." in n for n in names)


def test_batch_directory_is_replaced_on_replay(spark, raw, tmp_path):
    path = str(tmp_path / "refined")
    result = outcome_frame(raw)
    for batch in (0, 1, 1):
        write_refined(result.valid, path, batch_id=batch)
    assert read_refined(spark, path).count() == 16


def test_dlq_lines(spark, raw, tmp_path):
    path = str(tmp_path / "dlq")
    records = outcome_frame(raw).dlq
    write_dlq(records, path)
    lines = [json.loads(l) for p in (tmp_path / "dlq").glob("*.txt") for l in p.read_text().splitlines()]
    by_seq = {l["seq"]: l for l in lines}
    assert by_seq[8]["raw_payload"] == {"b": [1, {"c": None}]}
    assert by_seq[8]["error_reason"] == "event_id is not a valid UUID: 'bad'"
    assert by_seq[9]["raw_payload"] == "not json" and by_seq[9]["error_reason"] == "unhandled processing error"
    assert by_seq[8]["first_seen_at"].startswith("2024-02-01T00:00:00.000000")
    assert read_dlq(spark, path).filter("first_seen_at = timestamp'2024-02-01 00:00:00'").count() == 3
    write_dlq(records, path)
    assert read_dlq(spark, path).count() == 6
    assert show_in_memory(records, "dead").count() == 3


def test_insert_if_absent(spark, raw):
    location = scratch_path(spark, "t")
    table = "t_" + location[-12:]
    create_table(spark, table, location, buckets=3)
    create_table(spark, table, location, buckets=3)
    rows = [(ID.format(1), "s", '{"a":1}'), (ID.format(1), "s", '{"a":2}'), (ID.format(2), "s", '{"a":3}')]
    events = refine(raw(rows), NOW, "off").valid
    insert_if_absent(events, table)
    insert_if_absent(events, table)
    insert_if_absent(refine(raw([(ID.format(2), "s", '{"a":9}'), (ID.format(3), "s", '{"a":4}')]), NOW).valid, table)
    got = {r.event_id: r.payload for r in spark.table(table).collect()}
    assert got == {ID.format(1): '{"a":1}', ID.format(2): '{"a":3}', ID.format(3): '{"a":4}'}
    assert spark.table(table).count() == 3


def test_null_in_a_required_column_fails_the_batch(spark, raw):
    location = scratch_path(spark, "t")
    table = "t_" + location[-12:]
    create_table(spark, table, location, buckets=2)
    events = refine(raw([(ID.format(1), "s", '{"a":1}')]), NOW).valid.withColumn("source", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="source must not be null"):
        insert_if_absent(events, table)
    assert spark.table(table).count() == 0


def test_jdbc_statement_keeps_existing_rows():
    options, move = jdbc_statements("events", "events_staging")
    assert options["dbtable"] == "events_staging" and "ON CONFLICT (event_id) DO NOTHING" in move


def test_blanks_before_a_json_object(spark):
    got = kafka_to_raw(messages(spark, ['\n{"event_id":"y"}', '\t {"event_id":"z"}'])).orderBy("seq").collect()
    assert [(r.event_id, r.is_object) for r in got] == [("y", True), ("z", True)]


def test_a_topic_outside_the_list_is_refused(spark):
    with pytest.raises(Exception, match="no message number for topic beta"):
        kafka_to_raw(messages(spark, ["{}"], "beta")).collect()


def test_equal_rows_without_order_are_stored_once(spark):
    create_table(spark, "equal_rows", scratch_path(spark, "equal"), buckets=4)
    row = spark.sql("SELECT 'a' AS event_id, 's' AS source, current_timestamp() AS ingest_timestamp, current_timestamp() AS event_timestamp, '{}' AS payload, 1 AS version")
    insert_if_absent(row.unionByName(row), "equal_rows")
    assert spark.table("equal_rows").count() == 1
    spark.sql("DROP TABLE equal_rows")


def test_rejected_events_skip_the_dedup_join(raw):
    result = refine(raw([("bad", "s", "{}"), ("bad", "s", "{}")]), NOW)
    assert "Join" not in result.dlq._jdf.queryExecution().executedPlan().toString() and result.dlq.count() == 2
    result.discard()


def test_merged_sources_keep_numbers_apart(spark):
    ids = [ID.format(d) for d in "abc"]
    topic = kafka_to_raw(messages(spark, [json.dumps({"event_id": i}) for i in ids[:2]] + ["{broken"]))
    lines = spark.createDataFrame(
        [(i, json.dumps({"event_id": e, "payload": {"a": 1}})) for i, e in enumerate([ids[2], ids[0], ids[1]])], "seq bigint, body string"
    ).withColumn("received_at", F.timestamp_seconds(F.lit(1_706_000_000)))
    merged = merge_sources(topic, accept_envelopes(lines))
    assert merged.select("seq").distinct().count() == merged.count() == 6
    for policy in ("first", "ttl", "lru"):
        result = refine(merged, NOW, policy)
        assert {r.outcome: r.n for r in result.metrics.groupBy("outcome").agg(F.sum("n").alias("n")).collect()} == {
            "processed": 3, "duplicate": 2, "malformed": 1,
        }
        (dead,) = result.dlq.collect()
        assert (dead.raw_payload, dead.error_reason, dead.outcome) == ("{broken", "malformed message", "malformed")
        result.discard()


def test_numbers_that_cannot_be_merged_are_refused(spark):
    raw = spark.sql("SELECT -1L AS seq, 'e' AS event_id, 's' AS source, '{}' AS payload, current_timestamp() AS received_at")
    with pytest.raises(Exception, match="event number out of range"):
        merge_sources(raw, raw).collect()
    with pytest.raises(ValueError):
        merge_sources()


def test_a_stage_that_exists_is_refused(raw, tmp_path):
    (tmp_path / "mine").mkdir()
    (tmp_path / "mine" / "file").write_text("kept")
    with pytest.raises(Exception, match="already exists"):
        refine(raw([("bad", "s", "{}")]), NOW, stage_path=str(tmp_path / "mine"))
    assert (tmp_path / "mine" / "file").read_text() == "kept"


def stored(spark, ids):
    rows = spark.createDataFrame([(i,) for i in ids], "event_id string")
    return rows.selectExpr(
        "event_id", "'s' AS source", "timestamp'2024-01-01' AS ingest_timestamp", "timestamp'2024-01-01' AS event_timestamp",
        "'{}' AS payload", "1 AS version",
    )


def bucket_files(location):
    return [f.name for f in Path(location.removeprefix("file:")).glob("part-*")]


def test_an_insert_leaves_one_file_per_bucket_and_compaction_joins_them(spark):
    table, location = "few_files", scratch_path(spark, "few")
    create_table(spark, table, location, buckets=3)
    for start in (0, 150, 300):
        insert_if_absent(stored(spark, [f"id-{i:05d}" for i in range(start, start + 200)]).repartition(4), table)
    assert len(bucket_files(location)) == 9 and spark.table(table).count() == 500
    whole = scratch_path(spark, "whole")
    compact_table(spark, table, "one_file_each", whole, buckets=3)
    assert len(bucket_files(whole)) == 3
    assert spark.table("one_file_each").exceptAll(spark.table(table)).isEmpty() and spark.table("one_file_each").count() == 500
    insert_if_absent(stored(spark, ["id-00007", "new"]), "one_file_each")
    assert spark.table("one_file_each").count() == 501
    with pytest.raises(ValueError, match="exists"):
        compact_table(spark, table, "one_file_each")
    for name in (table, "one_file_each"):
        spark.sql(f"DROP TABLE {name}")


def test_the_stored_side_is_neither_shuffled_nor_read_outside_the_range_of_ids(spark):
    create_table(spark, "in_range", scratch_path(spark, "range"), buckets=3)
    insert_if_absent(stored(spark, ["a", "m", "z"]), "in_range")
    plan = stored_ids(stored(spark, ["m", "n"]), "in_range", "m", "n")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "GreaterThanOrEqual(event_id,m)" in scan and "LessThanOrEqual(event_id,n)" in scan and "Bucketed: true" in scan
    assert plan.count("Exchange hashpartitioning") == 1  # the incoming side's
    spark.sql("DROP TABLE in_range")


def test_inserting_nothing_changes_nothing(spark):
    create_table(spark, "nothing_new", scratch_path(spark, "nothing"), buckets=2)
    insert_if_absent(stored(spark, ["a"]).limit(0), "nothing_new")
    assert spark.table("nothing_new").count() == 0
    spark.sql("DROP TABLE nothing_new")


def test_dead_letters_cost_no_dedup(raw, monkeypatch):
    from siftlake.plans import refine as plan

    def refuse(*_):
        raise AssertionError("a decision was made")

    monkeypatch.setattr(plan, "mark_duplicates", refuse)
    rows = [("bad", "s", "{}"), (ID.format(1), "s", '{"a":1}'), (ID.format(1), "s", '{"a":1}')]
    result = refine(raw(rows), NOW)
    assert result.dlq.count() == 1
    result.discard()


@pytest.mark.parametrize("ordered", [True, False])
def test_an_insert_makes_its_events_once(spark, ordered):
    made = spark.sparkContext.accumulator(0)

    def mark(text):
        made.add(1)
        return text

    table = f"made_once_{ordered}".lower()
    create_table(spark, table, scratch_path(spark, "made"), buckets=2)
    events = stored(spark, [f"id-{i % 30:03d}" for i in range(40)]).withColumn("payload", F.udf(mark)("payload"))
    insert_if_absent(events.withColumn("seq", F.monotonically_increasing_id()) if ordered else events, table)
    assert made.value == 40 and spark.table(table).count() == 30
    spark.sql(f"DROP TABLE {table}")
