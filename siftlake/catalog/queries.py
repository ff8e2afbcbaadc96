"""One query per operator over the derived ``raw_events``.

Every query reads the whole table and returns scalar columns (instants as epoch
microseconds), so that results compare between engines.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlake.catalog.fixture import AS_OF, raw_events, raw_from_events
from siftlake.functions.plan import one_row
from siftlake.operators import batches as B
from siftlake.operators import dlq as Q
from siftlake.operators import metrics as M
from siftlake.operators.dedup import DedupPolicy, seen_size
from siftlake.operators.load_report import load_report
from siftlake.operators.normalize import ColumnMapping, normalize, register_mapper
from siftlake.operators.rates import rates, read_rates, sliding_quantiles, stream_rates
from siftlake.operators.validate import error_reason, rule_counts, validate
from siftlake.plans.refine import MALFORMED, RefineResult, evaluate, refine, staged
from siftlake.session import configure, remove_path, scratch_path
from siftlake.sinks.files import show_in_memory, write_dlq, write_refined
from siftlake.sinks.table import create_table, insert_if_absent
from siftlake.sources.kafka import kafka_to_raw, malformed_records
from siftlake.sources.landing import accept_envelopes, reject_envelopes
from siftlake.sources.merge import merge_sources
from siftlake.sources.refined import read_dlq, read_refined
from siftlake.streaming.batches import read_members
from siftlake.streaming.events import read_committed
from siftlake.streaming.refine import flush_batches, start_refine

TOPICS = ("orders", "clicks", "misc")
LOAD_SECONDS = 2_592_000.0
BATCH_SHAPE = {"max_size": 4, "interval": 3_600}
# Ticks of ten days, so that batches are open when the stream is started anew.
STREAM_SHAPE = {"max_size": 100, "interval": 864_000}


def us(name: str, alias: str) -> Column:
    return F.unix_micros(F.col(name)).alias(alias)


def json_text(column: str, field: str) -> Column:
    return F.get_json_object(column, f"$.{field}").alias(field)


# Frames the queries start from.


def refined(spark: SparkSession, sf_dir: str, policy: DedupPolicy | str = "first") -> RefineResult:
    return refine(raw_events(spark, sf_dir), AS_OF, policy)


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refined(spark, sf_dir).dlq


def kafka_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as topic messages: objects, other JSON values and broken text."""
    event = F.col("seq")
    rest = F.when(F.col("payload") == "{}", F.lit("}")).otherwise(F.expr("',' || substring(payload, 2)"))
    whole = F.concat(F.lit('{"event_id":"'), F.col("event_id"), F.lit('"'), rest)
    value = (
        F.when(event % 13 == 4, F.lit('{"a":'))
        .when(event % 11 == 3, F.lit("[1,2]"))
        .when(event % 11 == 5, F.lit("42"))
        .when(event % 17 == 2, F.lit('{"event_id":7,"a":1}'))
        .when(event % 19 == 3, F.lit('{"event_id":"","a":1}'))
        .when(event % 19 == 4, F.lit('{"event_id":null}'))
        .when(event % 19 == 5, F.lit('{"a":{"event_id":"inner"}}'))
        .otherwise(whole)
    )
    topic = F.when(F.col("source").startswith("kafka-"), F.expr("substring(source, 7)")).otherwise("misc")
    return raw_events(spark, sf_dir).select(
        topic.alias("topic"),
        (event % 4).cast("int").alias("partition"),
        event.alias("offset"),
        value.alias("value"),
        F.col("received_at").cast("timestamp").alias("timestamp"),
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as landing-folder bodies, some of them unacceptable."""
    event = F.col("seq")
    head = F.concat(F.lit('{"event_id":"'), F.col("event_id"), F.lit('","source":"'), F.col("source"), F.lit('"'))
    body = (
        F.when(event % 23 == 1, F.lit("not json"))
        .when(event % 23 == 2, F.lit("[]"))
        .when(event % 23 == 3, F.lit('{"event_id":5,"payload":{}}'))
        .when(event % 23 == 4, F.lit('{"source":false,"payload":{}}'))
        .when(event % 23 == 5, F.concat(head, F.lit(',"timestamp":1700000000}')))
        .when(event % 23 == 6, F.concat(head, F.lit(',"payload":null}')))
        .when(event % 23 == 7, F.concat(head, F.lit(',"payload":[1]}')))
        .when(event % 23 == 8, F.lit('{"source":"","payload":{"a":1}}'))
        .when(event % 23 == 9, F.lit('{"event_id":null,"source":null,"extra":1}'))
        .when(event % 23 == 10, F.lit('{"event_id":"","source":"s"}'))
        .otherwise(F.concat(head, F.lit(',"timestamp":"ignored","payload":'), F.col("payload"), F.lit("}")))
    )
    return raw_events(spark, sf_dir).select("seq", body.alias("body"), F.col("received_at").cast("timestamp").alias("received_at"))


def merged_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event twice, as a message and as an envelope; both sources number from 0."""
    return merge_sources(
        kafka_to_raw(kafka_messages(spark, sf_dir), TOPICS), accept_envelopes(envelopes(spark, sf_dir))
    )


def strict_signup_mapping() -> ColumnMapping:
    """Fails for some events: their ``k`` is missing or above 50."""
    lenient = signup_mapping()
    key = lambda doc: F.try_variant_get(doc, "$.props.k", "bigint")
    return replace(lenient, error=lambda doc: key(doc).isNull() | (key(doc) > 50))


def signup_mapping() -> ColumnMapping:
    key = lambda doc: F.try_variant_get(doc, "$.props.k", "bigint")
    return ColumnMapping(
        event_time=lambda doc: F.timestamp_seconds(F.lit(1_700_000_000) + key(doc)),
        payload=lambda doc: F.to_json(F.struct(F.try_variant_get(doc, "$.value", "double").alias("value"), key(doc).alias("k"))),
    )


# Queries.


def flagship_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refined(spark, sf_dir).metrics


def normalize_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(raw_events(spark, sf_dir), AS_OF).select(
        "seq", "source", us("event_timestamp", "event_us"), us("ingest_timestamp", "ingest_us"),
        "version", "ts_fallback", "parse_error",
    )


def normalize_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = normalize(raw_events(spark, sf_dir), AS_OF).filter(F.col("source") == "kafka-orders")
    return orders.select(
        "seq", json_text("payload", "order_id"),
        json_text("payload", "amount").cast("double").alias("amount"),
        json_text("payload", "currency"), json_text("payload", "customer_id"),
        F.json_array_length(F.to_json(F.json_object_keys("payload"))).alias("n_fields"),
    )


def normalize_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = normalize(raw_events(spark, sf_dir), AS_OF).filter(F.col("source") == "kafka-clicks")
    return clicks.select("seq", *[json_text("payload", f) for f in ("click_id", "url", "user_id", "referrer")])


def normalize_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    mappers = register_mapper(None, "webhook-signup", signup_mapping())
    mapped = normalize(raw_events(spark, sf_dir), AS_OF, mappers).filter(F.col("source") == "webhook-signup")
    return mapped.select(
        "seq", us("event_timestamp", "event_us"),
        json_text("payload", "value").cast("double").alias("value"),
        json_text("payload", "k").cast("bigint").alias("k"),
    )


def validate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate(normalize(raw_events(spark, sf_dir), AS_OF), AS_OF)
    return checked.filter(~F.col("is_valid") & ~F.col("parse_error")).select(
        "seq", error_reason(F.col("violations")).alias("error_reason")
    )


def validate_rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_counts(validate(normalize(raw_events(spark, sf_dir), AS_OF), AS_OF).filter(~F.col("parse_error")))


def kafka_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = kafka_to_raw(kafka_messages(spark, sf_dir), TOPICS)
    return raw.select(
        "seq", "source", "event_id", "has_id", "is_object", "malformed",
        json_text("payload", "raw").alias("raw_value"), us("received_at", "received_us"),
    )


def kafka_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = malformed_records(kafka_to_raw(kafka_messages(spark, sf_dir), TOPICS), AS_OF)
    return records.select("seq", "source", "raw_payload", "error_reason")


def envelope_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accept_envelopes(envelopes(spark, sf_dir)).select(
        "seq", "source", "event_id", (F.col("payload") == "{}").alias("no_payload")
    )


def envelope_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_envelopes(envelopes(spark, sf_dir)).select("seq", "reason")


def dedup(policy: DedupPolicy) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return refined(spark, sf_dir, policy).classified.select("seq", "event_id", "outcome")

    return query


def dedup_hot(policy: DedupPolicy) -> Callable[[SparkSession, str], DataFrame]:
    """One id holds a third of the events, another third come in pairs."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return refine(raw_events(spark, sf_dir, hot=True), AS_OF, policy).classified.select("seq", "event_id", "outcome")

    return query


def merged_outcomes(policy: DedupPolicy) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return refine(merged_sources(spark, sf_dir), AS_OF, policy).classified.select("seq", "source", "outcome")

    return query


def dlq_with_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    dead = refine(merged_sources(spark, sf_dir), AS_OF).dlq
    return dead.select("seq", "source", "outcome", "error_reason", F.when(F.col("outcome") == MALFORMED, F.col("raw_payload")).alias("text"))


def custom_mapping_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    mappers = register_mapper(None, "webhook-signup", strict_signup_mapping())
    return refine(raw_events(spark, sf_dir), AS_OF, mappers=mappers).classified.select("seq", "source", "outcome")


def batch_members_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks of ten days: the fullest holds a third of the events."""
    return B.assign_batches(refined(spark, sf_dir).valid, max_size=100, interval=864_000)


def dedup_seen_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = evaluate(raw_events(spark, sf_dir), AS_OF).filter(F.col("verdict").isNull())
    return one_row(seen_size(accepted), seen_size(accepted, 500).withColumnRenamed("n", "n_lru_500"))


def duplicates_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refined(spark, sf_dir).duplicates.select("seq", "event_id")


def dlq_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dead_letters(spark, sf_dir).select(
        "seq", "event_id", "source", "raw_payload", "error_reason", us("first_seen_at", "first_seen_us")
    )


def dlq_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.dlq_page(dead_letters(spark, sf_dir), limit=50, offset=7).select("seq", "event_id", "error_reason")


def dlq_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.dlq_count(dead_letters(spark, sf_dir))


def dlq_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    envelope = Q.dlq_envelope(dead_letters(spark, sf_dir), limit=20, offset=5)
    return envelope.select(
        "total", "offset", "limit", F.size("records").alias("n_records"),
        F.array_join("records.event_id", ",").alias("event_ids"),
    )


def dlq_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.dlq_by_reason(dead_letters(spark, sf_dir))


def dlq_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.dlq_by_source(dead_letters(spark, sf_dir))


def dlq_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = Q.dlq_count(dead_letters(spark, sf_dir))
    return count.select(
        "n", M.gauge_state(F.col("n"), M.DLQ_STATES).alias("state"),
        M.gauge_state(F.col("n"), M.QUEUE_STATES).alias("state_as_queue"),
    )


def dlq_in_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return show_in_memory(dead_letters(spark, sf_dir), "siftlake_dead_letters").select("seq", "error_reason")


def events_ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.ingested_by_source(raw_events(spark, sf_dir))


def events_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.processed_total(refined(spark, sf_dir).classified)


def events_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.failed_by_reason(refined(spark, sf_dir).classified)


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.batches(refined(spark, sf_dir).valid)


def batches_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.batches(refined(spark, sf_dir).valid, **BATCH_SHAPE)


def batch_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.assign_batches(refined(spark, sf_dir).valid, **BATCH_SHAPE)


def sink_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "refined")
    write_refined(refined(spark, sf_dir).valid, path)
    return read_refined(spark, path).select(
        "event_id", "source", us("ingest_timestamp", "ingest_us"), us("event_timestamp", "event_us"), "version",
        F.col("ingest_date").cast("string").alias("ingest_date"),
        json_text("payload", "order_id"), json_text("payload", "url"), json_text("payload", "currency"),
    )


def sink_dlq_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "dlq")
    write_dlq(dead_letters(spark, sf_dir), path)
    return read_dlq(spark, path).select(
        "seq", "event_id", "source", "error_reason", us("first_seen_at", "first_seen_us"),
        json_text("raw_payload", "order_id"), json_text("raw_payload", "url"),
    )


def sink_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All topic events first, then all events: ids the table holds already stay as they are."""
    location = scratch_path(spark, "events")
    table = location.rsplit("/", 1)[1].replace("-", "_")
    create_table(spark, table, location, buckets=8)
    stage = scratch_path(spark, "stage")
    valid = staged(refined(spark, sf_dir, "off").valid, stage)
    insert_if_absent(valid.filter(F.col("source").startswith("kafka-")), table)
    insert_if_absent(valid, table)
    remove_path(spark, stage)
    return spark.table(table).select(
        "event_id", "source", us("ingest_timestamp", "ingest_us"), us("event_timestamp", "event_us"), "version"
    )


def histogram_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = refined(spark, sf_dir).valid
    return M.histogram(valid, M.ingest_lag_us(valid) / F.lit(1e6), M.LATENCY_BOUNDS, by=["source"])


def histogram_lag_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = refined(spark, sf_dir).valid
    return M.histogram_sum(valid, M.ingest_lag_us(valid), by=["source"])


def histogram_batch_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = B.batch_sizes(refined(spark, sf_dir).valid, **BATCH_SHAPE)
    return M.histogram(sizes, F.col("size"), M.BATCH_SIZE_BOUNDS, weight=F.col("batches"))


def quantiles_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = refined(spark, sf_dir).valid
    return M.quantiles(valid, M.ingest_lag_us(valid) / F.lit(1e6), M.LATENCY_BOUNDS, by=["source"])


def quantiles_batch_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = B.batch_sizes(refined(spark, sf_dir).valid, **BATCH_SHAPE)
    return M.quantiles(sizes, F.col("size"), M.BATCH_SIZE_BOUNDS, weight=F.col("batches"), qs={"p50": 0.50})


def latency_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = refined(spark, sf_dir).valid
    return sliding_quantiles(
        valid, F.col("ingest_timestamp"), M.ingest_lag_us(valid) / F.lit(1e6), M.LATENCY_BOUNDS
    )


def rate_ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates(raw_events(spark, sf_dir), F.col("received_at").cast("timestamp"), ["source"])


def rate_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates(refined(spark, sf_dir).valid, F.col("ingest_timestamp"))


def rate_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = refined(spark, sf_dir).classified.filter("outcome <> 'processed'")
    return rates(failed.withColumnRenamed("outcome", "reason"), F.col("ingest_timestamp"), ["reason"])


def rate_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates(refined(spark, sf_dir).rejected, F.col("ingest_timestamp"), ["source"])


def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    status = F.when(F.col("event_type") == "error", 500).when(F.col("event_type") == "signup", 429).otherwise(202)
    results = events.select(F.col("event_id").alias("seq"), status.alias("status"), (F.col("value") / 1000).alias("latency"))
    return load_report(results, LOAD_SECONDS)


def _stream(spark: SparkSession, sf_dir: str, policy: DedupPolicy) -> str:
    """Run the pipeline over the events as a file stream to its end; the output folder."""
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    raw = raw_from_events(spark.readStream.schema(schema).parquet(f"{path}*"))
    base = scratch_path(spark, "stream")
    start_refine(raw, base, f"{base}/progress", AS_OF, policy, available_now=True, keep_classified=True).awaitTermination()
    return base


def _arriving(spark: SparkSession, sf_dir: str, piece: Column, order: tuple[int, ...], run: Callable[[DataFrame], None]) -> None:
    """All events as new files, a piece at a time; ``run`` starts the stream anew after each."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    folder = scratch_path(spark, "arriving")
    for place in order:
        events.filter(piece == place).write.mode("append").parquet(folder)
        run(raw_from_events(spark.readStream.schema(events.schema).parquet(folder)))
    remove_path(spark, folder)


def stream_dedup_restarts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three thirds of the events in order, the stream started anew for each."""
    base = scratch_path(spark, "stream")
    last = spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.max("event_id")).first()[0]
    piece = F.expr(f"event_id * 3 DIV {(last or 0) + 1}")
    policy = DedupPolicy("ttl", ttl_seconds=400)
    _arriving(spark, sf_dir, piece, (0, 1, 2), lambda raw: start_refine(
        raw, base, f"{base}/progress", AS_OF, policy, available_now=True, keep_classified=True).awaitTermination())
    return spark.read.parquet(f"{base}/classified").select("seq", "event_id", "outcome")


def flush_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "stream")
    _arriving(spark, sf_dir, F.col("event_id") % 3, (0, 1, 2), lambda raw: start_refine(
        raw, base, f"{base}/progress", AS_OF, "off", available_now=True).awaitTermination())
    return flush_batches(spark, base).select("batch_id", "rows", (F.col("seconds") > 0).alias("timed"))


def late_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every later file lies all over the time of the first one."""
    base = scratch_path(spark, "rates")
    at = F.col("received_at").cast("timestamp")
    _arriving(spark, sf_dir, F.col("event_id") % 3, (2, 0, 1), lambda raw: stream_rates(
        raw.withColumn("received_at", at), "received_at", f"{base}/slots", f"{base}/progress", ["source"], available_now=True).awaitTermination())
    return read_rates(spark, f"{base}/slots", ["source"])


def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that go on over micro-batches: three thirds of the events in order, the stream started anew for each."""
    base = scratch_path(spark, "stream")
    last = spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.max("event_id")).first()[0]
    piece = F.expr(f"event_id * 3 DIV {(last or 0) + 1}")
    _arriving(spark, sf_dir, piece, (0, 1, 2), lambda raw: start_refine(
        raw, base, f"{base}/progress", AS_OF, "first", available_now=True, batch_shape=STREAM_SHAPE).awaitTermination())
    return read_members(spark, f"{base}/members")


def stream_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of refined events after three restarts and a merge, as its readers see it."""
    base = scratch_path(spark, "stream")
    _arriving(spark, sf_dir, F.col("event_id") % 3, (0, 1, 2), lambda raw: start_refine(
        raw, base, f"{base}/progress", AS_OF, "off", available_now=True, levelled=True, fan=2).awaitTermination())
    return read_committed(spark, base, fan=2).select(
        "event_id", "source", us("ingest_timestamp", "ingest_us"), us("event_timestamp", "event_us"), "version",
        F.date_format("ingest_date", "yyyy-MM-dd").alias("ingest_date"),
    )


def stream_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _stream(spark, sf_dir, DedupPolicy("ttl", ttl_seconds=3_600))
    return spark.read.parquet(f"{base}/counts").groupBy("source", "outcome").agg(F.sum("n").alias("n"))


def stream_dedup_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _stream(spark, sf_dir, DedupPolicy("ttl", ttl_seconds=400))
    return spark.read.parquet(f"{base}/classified").select("seq", "event_id", "outcome")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "flagship_outcomes": flagship_outcomes,
    "normalize_all": normalize_all,
    "normalize_orders": normalize_orders,
    "normalize_clicks": normalize_clicks,
    "normalize_custom": normalize_custom,
    "validate_reasons": validate_reasons,
    "validate_rule_counts": validate_rule_counts,
    "kafka_to_raw": kafka_raw,
    "kafka_malformed": kafka_malformed,
    "envelope_accept": envelope_accept,
    "envelope_reject": envelope_reject,
    "dedup_first": dedup(DedupPolicy("first")),
    "dedup_lru_500": dedup(DedupPolicy("lru", capacity=500)),
    "dedup_ttl_400": dedup(DedupPolicy("ttl", ttl_seconds=400)),
    "dedup_ttl_3600": dedup(DedupPolicy("ttl", ttl_seconds=3_600)),
    "dedup_lru_chunks": dedup(DedupPolicy("lru", capacity=500, chunk_rows=1_100)),
    "dedup_lru_short_chunks": dedup(DedupPolicy("lru", capacity=500, chunk_rows=300)),
    "dedup_first_hot": dedup_hot(DedupPolicy("first")),
    "dedup_ttl_chain": dedup_hot(DedupPolicy("ttl", ttl_seconds=400, fold_limit=50)),
    "dedup_lru_hot": dedup_hot(DedupPolicy("lru", capacity=500, chunk_rows=300)),
    "merged_sources_outcomes": merged_outcomes(DedupPolicy("first")),
    "merged_sources_ttl": merged_outcomes(DedupPolicy("ttl", ttl_seconds=400)),
    "merged_sources_lru": merged_outcomes(DedupPolicy("lru", capacity=500)),
    "dlq_with_malformed": dlq_with_malformed,
    "custom_mapping_errors": custom_mapping_errors,
    "batch_members_hot": batch_members_hot,
    "dedup_off": dedup(DedupPolicy("off")),
    "dedup_seen_size": dedup_seen_size,
    "duplicates_dropped": duplicates_dropped,
    "dlq_records": dlq_records,
    "dlq_page": dlq_page,
    "dlq_count": dlq_count,
    "dlq_envelope": dlq_envelope,
    "dlq_by_reason": dlq_by_reason,
    "dlq_by_source": dlq_by_source,
    "dlq_state": dlq_state,
    "dlq_in_memory": dlq_in_memory,
    "events_ingested": events_ingested,
    "events_processed": events_processed,
    "events_failed": events_failed,
    "batches": batches,
    "batches_hourly": batches_hourly,
    "batch_members": batch_members,
    "sink_parquet_roundtrip": sink_parquet_roundtrip,
    "sink_dlq_roundtrip": sink_dlq_roundtrip,
    "sink_insert_if_absent": sink_insert_if_absent,
    "histogram_lag": histogram_lag,
    "histogram_lag_sum": histogram_lag_sum,
    "histogram_batch_size": histogram_batch_size,
    "quantiles_lag": quantiles_lag,
    "quantiles_batch_size": quantiles_batch_size,
    "latency_panel": latency_panel,
    "rate_ingested": rate_ingested,
    "rate_processed": rate_processed,
    "rate_failed": rate_failed,
    "rate_dlq": rate_dlq,
    "load_report": load_summary,
    "stream_outcomes": stream_outcomes,
    "stream_dedup_ttl": stream_dedup_ttl,
    "stream_dedup_restarts": stream_dedup_restarts,
    "stream_rates": late_rates,
    "flush_batches": flush_sizes,
    "stream_batches": stream_batches,
    "stream_table": stream_table,
}


def _configured(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(configure(spark), sf_dir)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _configured(query) for name, query in _QUERIES.items()}
