"""The same questions in DuckDB SQL, written independently of the operators."""

from __future__ import annotations

from siftlake.catalog.fixture import raw_events_sql

AS_OF_US = 1706745600000000
LIMIT_US = AS_OF_US + 300_000_000

_EMPTY = """('null', '""', 'false', '[]', '{}', '0')"""
_DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
_TIME = r"[0-9]{2}:[0-9]{2}:[0-9]{2}"


def _field(name: str) -> str:
    return f"(json_extract(payload::JSON, '$.{name}')::VARCHAR)"


def _or(*fields: str) -> str:
    *early, last = fields
    parts = [f"CASE WHEN {_field(f)} NOT IN {_EMPTY} THEN {_field(f)} END" for f in early]
    return f"coalesce({', '.join([*parts, _field(last)])})"


# raw -> chosen time value -> parsed time -> rule messages -> outcome before dedup
_RAW = f"raw_events AS (SELECT *, false AS malformed FROM ({raw_events_sql('duckdb')}))"
_RAW_HOT = f"raw_events AS (SELECT *, false AS malformed FROM ({raw_events_sql('duckdb', hot=True)}))"
_STEPS = f"""
chosen AS (
  SELECT *, epoch_us(received_at) AS ingest_us,
    CASE source WHEN 'kafka-orders' THEN {_or("created_at", "timestamp")}
                WHEN 'kafka-clicks' THEN {_or("ts", "timestamp")}
                ELSE {_or("timestamp", "event_timestamp", "ts", "created_at")} END AS t
  FROM given
),
typed AS (
  SELECT *, CASE WHEN t LIKE '"%' THEN t[2:-2] END AS s, try_cast(t AS HUGEINT) AS num FROM chosen
),
parsed AS (
  SELECT *,
    CASE WHEN num IS NOT NULL THEN
           CASE WHEN num < 1000000000000 THEN num * 1000000 ELSE num * 1000 END
         WHEN regexp_full_match(s, '{_DATE}T{_TIME}(\\.[0-9]{{1,6}})?(Z|[+-][0-9]{{2}}:[0-9]{{2}})')
           THEN epoch_us(try_cast(s AS TIMESTAMPTZ))
         WHEN regexp_full_match(s, '{_DATE} {_TIME}') THEN epoch_us(try_cast(s || 'Z' AS TIMESTAMPTZ))
    END AS us,
    CASE WHEN s LIKE '%+05:30' THEN 19800000000 ELSE 0 END AS off_us
  FROM typed
),
normalized AS (
  SELECT * EXCLUDE (us),
    coalesce(num IS NOT NULL AND (us < -62135596800000000 OR us >= 253402300800000000), false) AS parse_error,
    us IS NULL AS ts_fallback,
    CASE WHEN us IS NULL OR us >= 253402300800000000 THEN {AS_OF_US} ELSE us END::BIGINT AS event_us
  FROM parsed
),
ruled AS (
  SELECT *, make_timestamp(event_us + off_us) AS shown,
    NOT regexp_matches(event_id, '(?i)^[0-9a-f]{{8}}-?[0-9a-f]{{4}}-?[0-9a-f]{{4}}-?[0-9a-f]{{4}}-?[0-9a-f]{{12}}$') AS bad_id,
    trim(source) = '' AS bad_source,
    event_us > {LIMIT_US} AS bad_time,
    source NOT IN ('kafka-orders', 'kafka-clicks') AND payload = '{{}}' AS bad_payload
  FROM normalized
),
judged AS (
  SELECT *,
    concat_ws('; ',
      CASE WHEN bad_id THEN 'event_id is not a valid UUID: ''' || event_id || '''' END,
      CASE WHEN bad_source THEN 'source is empty' END,
      CASE WHEN bad_time THEN 'event_timestamp is in the future: '
        || strftime(shown, '%Y-%m-%dT%H:%M:%S')
        || CASE WHEN epoch_us(shown) % 1000000 <> 0 THEN strftime(shown, '.%f') ELSE '' END
        || CASE WHEN off_us <> 0 THEN '+05:30' ELSE '+00:00' END END,
      CASE WHEN bad_payload THEN 'payload is empty' END) AS messages,
    bad_id OR bad_source OR bad_time OR bad_payload AS invalid
  FROM ruled
),
open_events AS (SELECT * FROM judged WHERE NOT malformed AND NOT parse_error AND NOT invalid)"""
_CHAIN = f"{_RAW},\ngiven AS (SELECT * FROM raw_events),{_STEPS}"

_FIRST = """
dropped AS (
  SELECT seq FROM (SELECT seq, row_number() OVER (PARTITION BY event_id ORDER BY ingest_us, seq) AS rn FROM open_events)
  WHERE rn > 1
)"""

_LRU_500 = """
placed AS (SELECT seq, event_id, row_number() OVER (ORDER BY ingest_us, seq) AS p FROM open_events),
linked AS (SELECT *, lag(p) OVER (PARTITION BY event_id ORDER BY p) AS prev FROM placed),
dropped AS (
  SELECT a.seq FROM linked a
  LEFT JOIN linked b ON b.p > a.prev AND b.p < a.p AND (b.prev IS NULL OR b.prev < a.prev)
  WHERE a.prev IS NOT NULL GROUP BY a.seq HAVING count(b.p) < 500
)"""


def _ttl(seconds: int) -> str:
    ttl = seconds * 1_000_000
    return f"""
numbered AS (
  SELECT seq, event_id, ingest_us, row_number() OVER (PARTITION BY event_id ORDER BY ingest_us, seq) AS rn
  FROM open_events
),
walked AS (
  SELECT seq, event_id, rn, ingest_us + {ttl} AS expiry, true AS kept FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.seq, n.event_id, n.rn,
    CASE WHEN n.ingest_us >= w.expiry THEN n.ingest_us + {ttl} ELSE w.expiry END,
    n.ingest_us >= w.expiry
  FROM walked w JOIN numbered n ON n.event_id = w.event_id AND n.rn = w.rn + 1
),
dropped AS (SELECT seq FROM walked WHERE NOT kept)"""


_NONE = "\ndropped AS (SELECT seq FROM open_events WHERE false)"

_CLASSIFIED = """
classified AS (
  SELECT j.*,
    CASE WHEN malformed THEN 'malformed' WHEN parse_error THEN 'unhandled_error' WHEN invalid THEN 'validation'
         WHEN d.seq IS NOT NULL THEN 'duplicate' ELSE 'processed' END AS outcome,
    CASE WHEN malformed THEN 'malformed message' WHEN parse_error THEN 'unhandled processing error' WHEN invalid THEN messages END AS error_reason
  FROM judged j LEFT JOIN dropped d ON d.seq = j.seq
),
valid AS (SELECT *, ingest_us - event_us AS lag_us FROM classified WHERE outcome = 'processed'),
dlq AS (SELECT * FROM classified WHERE outcome IN ('validation', 'unhandled_error', 'malformed'))"""


def _normalized(select: str) -> str:
    return f"WITH {_CHAIN}\n{select}"


def _after(select: str, dedup: str = _FIRST, extra: str = "", chain: str = _CHAIN) -> str:
    more = f",{extra}" if extra else ""
    return f"WITH RECURSIVE {chain},{dedup},{_CLASSIFIED}{more}\n{select}"


_DEDUP_COLUMNS = "SELECT seq, event_id, outcome FROM classified"


def _cleaned(name: str, default: str = "NULL") -> str:
    found = f"json_extract_string(payload, '$.{name}')"
    if default == "NULL":
        return found
    return f"CASE WHEN json_extract(payload::JSON, '$.{name}') IS NULL THEN {default} ELSE {found} END"


_MESSAGES = """
messages AS (
  SELECT seq, received_at,
    CASE WHEN source LIKE 'kafka-%' THEN source[7:] ELSE 'misc' END AS topic,
    CASE WHEN seq % 13 = 4 THEN '{"a":'
         WHEN seq % 11 = 3 THEN '[1,2]' WHEN seq % 11 = 5 THEN '42'
         WHEN seq % 17 = 2 THEN '{"event_id":7,"a":1}'
         WHEN seq % 19 = 3 THEN '{"event_id":"","a":1}'
         WHEN seq % 19 = 4 THEN '{"event_id":null}'
         WHEN seq % 19 = 5 THEN '{"a":{"event_id":"inner"}}'
         ELSE '{"event_id":"' || event_id || '"' || CASE payload WHEN '{}' THEN '}' ELSE ',' || payload[2:] END END AS value
  FROM raw_events
),
described AS (
  SELECT *, json_valid(value) AS is_json,
    ((seq * 16384 + seq % 4) * 512 + CASE topic WHEN 'orders' THEN 1 WHEN 'clicks' THEN 2 ELSE 3 END)::BIGINT AS number,
    md5(topic || chr(31) || (seq % 4)::VARCHAR || chr(31) || seq::VARCHAR) AS digest
  FROM messages
),
examined AS (
  SELECT *, CASE WHEN is_json THEN json_type(value) END AS kind,
    CASE WHEN is_json THEN json_type(value, '$.event_id') END AS id_kind,
    CASE WHEN is_json THEN json_extract_string(value, '$.event_id') END AS id_text
  FROM described
),
identified AS (
  SELECT *, coalesce(kind = 'OBJECT', false) AS is_object,
    coalesce(kind = 'OBJECT' AND id_kind <> 'NULL' AND id_text <> '', false) AS has_id
  FROM examined
)"""

_DIGEST_UUID = "digest[1:8] || '-' || digest[9:12] || '-' || digest[13:16] || '-' || digest[17:20] || '-' || digest[21:32]"

_BODIES = """
headed AS (SELECT *, '{"event_id":"' || event_id || '","source":"' || source || '"' AS head FROM raw_events),
bodies AS (
  SELECT seq, event_id, source, payload, received_at,
    CASE seq % 23
      WHEN 1 THEN 'not json' WHEN 2 THEN '[]'
      WHEN 3 THEN '{"event_id":5,"payload":{}}' WHEN 4 THEN '{"source":false,"payload":{}}'
      WHEN 5 THEN head || ',"timestamp":1700000000}' WHEN 6 THEN head || ',"payload":null}'
      WHEN 7 THEN head || ',"payload":[1]}' WHEN 8 THEN '{"source":"","payload":{"a":1}}'
      WHEN 9 THEN '{"event_id":null,"source":null,"extra":1}' WHEN 10 THEN '{"event_id":"","source":"s"}'
      ELSE head || ',"timestamp":"ignored","payload":' || payload || '}' END AS body
  FROM headed
),
numbered AS (
  SELECT *, md5(seq::VARCHAR || chr(31) || epoch_us(received_at)::VARCHAR || chr(31) || body) AS digest FROM bodies
)"""

# Upper bounds of two of the histograms.
_LATENCY = (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5)
_SIZES = (1.0, 10.0, 50.0, 100.0, 250.0, 500.0, 1000.0, 2500.0, 5000.0)


def _bounds(bounds: tuple[float, ...]) -> str:
    rows = [f"({i}, {b!r}::DOUBLE, '{b:g}')" for i, b in enumerate(bounds)]
    rows.append(f"({len(bounds)}, 'Infinity'::DOUBLE, '+Inf')")
    return f"bounds(i, le, label) AS (VALUES {', '.join(rows)})"


def _histogram(source: str, value: str, bounds: tuple[float, ...], by: str = "", weight: str = "1") -> str:
    keys = f"{by}, " if by else ""
    return f"""
{_bounds(bounds)},
hist AS (
  SELECT {keys}i, le, label, sum(CASE WHEN {value} <= le THEN {weight} ELSE 0 END)::BIGINT AS cum
  FROM {source}, bounds GROUP BY {keys}i, le, label
)"""


def _quantile_rows(by: str, qs: dict[str, float], top: float) -> str:
    """Quantiles per group from ``hist(by, i, le, cum)``."""
    keys = f"{by}, " if by else ""
    partition = f"PARTITION BY {by}" if by else ""
    picked = ", ".join(
        f"min_by(CASE WHEN le = 'Infinity'::DOUBLE THEN {top!r}::DOUBLE "
        f"ELSE low + (le - low) * (({q}::DOUBLE * total - below) / (cum - below)) END, i) "
        f"FILTER (WHERE cum >= {q}::DOUBLE * total) AS {name}"
        for name, q in qs.items()
    )
    return f"""
edged AS (
  SELECT *, coalesce(lag(le) OVER w, 0.0::DOUBLE) AS low, coalesce(lag(cum) OVER w, 0) AS below,
    max(cum) OVER ({partition}) AS total
  FROM hist WINDOW w AS ({partition} ORDER BY i)
)
SELECT {keys}{picked} FROM edged {f"GROUP BY {by}" if by else ""}"""


_P3 = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def _rate(source: str, label: str = "") -> str:
    key = f"{label}, " if label else ""
    return f"""
SELECT (slot + k) * 5000000 AS window_end_us, {key}sum(n) / 60.0::DOUBLE AS per_second
FROM (SELECT {key}epoch_us(received_at) // 5000000 AS slot, count(*) AS n FROM {source} GROUP BY ALL),
     (SELECT unnest(range(1, 13)) AS k)
GROUP BY window_end_us{f", {label}" if label else ""}"""


_HOURLY = """
ranked AS (
  SELECT seq, ingest_us // 3600000000 AS tick,
    (row_number() OVER (PARTITION BY ingest_us // 3600000000 ORDER BY ingest_us, seq) - 1) // 4 AS chunk
  FROM valid
),
sized AS (SELECT tick, chunk, count(*) AS size FROM ranked GROUP BY tick, chunk)"""

_VALID_COLUMNS = "event_id, source, ingest_us, event_us, 1 AS version"


# Both sources as one: messages get the even numbers, envelopes the odd ones.
_MERGED_CHAIN = f"""{_RAW},{_MESSAGES},{_BODIES},
topic_events AS (
  SELECT number * 2 AS seq, 'kafka-' || topic AS source, received_at,
    NOT is_json OR (has_id AND id_kind <> 'VARCHAR') AS malformed,
    CASE WHEN NOT has_id THEN {_DIGEST_UUID} WHEN id_kind = 'VARCHAR' THEN id_text ELSE '' END AS event_id,
    CASE WHEN is_object AND NOT (has_id AND id_kind <> 'VARCHAR') THEN value ELSE '{{"raw":1}}' END AS payload, value AS text
  FROM identified
),
landed_events AS (
  SELECT seq * 2 + 1 AS seq,
    CASE WHEN seq % 23 IN (8, 9) THEN 'webhook' WHEN seq % 23 = 10 THEN 's' ELSE source END AS source, received_at,
    false AS malformed, CASE WHEN seq % 23 IN (8, 9, 10) THEN {_DIGEST_UUID} ELSE event_id END AS event_id,
    CASE WHEN seq % 23 IN (9, 10) THEN '{{}}' WHEN seq % 23 = 8 THEN '{{"a":1}}' ELSE payload END AS payload, body AS text
  FROM numbered WHERE seq % 23 NOT IN (1, 2, 3, 4, 5, 6, 7)
),
given AS (SELECT * FROM topic_events UNION ALL BY NAME SELECT * FROM landed_events),{_STEPS}"""
_HOT_CHAIN = f"{_RAW_HOT},\ngiven AS (SELECT * FROM raw_events),{_STEPS}"
# A failed mapping is an unhandled error; else it replaces the time parsing, and its payload is never empty.
_STRICT_CHAIN = _CHAIN.replace(
    "open_events AS (SELECT * FROM judged",
    """mapped AS (
  SELECT *, TRY_CAST(json_extract_string(payload, '$.props.k') AS BIGINT) AS k FROM judged
),
remapped AS (
  SELECT * REPLACE (
    CASE WHEN source = 'webhook-signup' THEN k IS NULL OR k > 50 ELSE parse_error END AS parse_error,
    CASE WHEN source = 'webhook-signup' THEN bad_id ELSE invalid END AS invalid) FROM mapped
),
open_events AS (SELECT * FROM remapped""",
)


def all_oracles() -> dict[str, str]:
    lag_seconds = "(lag_us / 1000000.0::DOUBLE)"
    lag_histogram = _histogram("valid", lag_seconds, _LATENCY, "source")
    size_histogram = _histogram("sized", "size", _SIZES)
    outcome_counts = "SELECT source, outcome, count(*) AS n FROM classified GROUP BY source, outcome"
    return {
        "flagship_outcomes": _after(outcome_counts),
        "normalize_all": _normalized(
            "SELECT seq, source, event_us, ingest_us, 1 AS version, ts_fallback, parse_error FROM normalized"
        ),
        "normalize_orders": _normalized(
            f"SELECT seq, {_cleaned('order_id')} AS order_id, {_cleaned('amount')}::DOUBLE AS amount, "
            f"""{_cleaned('currency', "'USD'")} AS currency, {_cleaned('customer_id')} AS customer_id, 4 AS n_fields """
            "FROM normalized WHERE source = 'kafka-orders'"
        ),
        "normalize_clicks": _normalized(
            f"SELECT seq, {_cleaned('click_id')} AS click_id, {_cleaned('url')} AS url, "
            f"{_cleaned('user_id')} AS user_id, {_cleaned('referrer')} AS referrer "
            "FROM normalized WHERE source = 'kafka-clicks'"
        ),
        "normalize_custom": _normalized(
            f"SELECT seq, coalesce((1700000000 + {_cleaned('props.k')}::BIGINT) * 1000000, {AS_OF_US}) AS event_us, "
            f"{_cleaned('value')}::DOUBLE AS value, {_cleaned('props.k')}::BIGINT AS k "
            "FROM raw_events WHERE source = 'webhook-signup'"
        ),
        "validate_reasons": _normalized(
            "SELECT seq, messages AS error_reason FROM judged WHERE invalid AND NOT parse_error"
        ),
        "validate_rule_counts": _normalized(
            "SELECT rule, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN bad_id THEN 'event_id' END, "
            "CASE WHEN bad_source THEN 'source' END, CASE WHEN bad_time THEN 'event_timestamp' END, "
            "CASE WHEN bad_payload THEN 'payload' END], lambda r: r IS NOT NULL)) AS rule "
            "FROM judged WHERE NOT parse_error) GROUP BY rule"
        ),
        "kafka_to_raw": _normalized("").rstrip() + f""",{_MESSAGES}
SELECT number AS seq, 'kafka-' || topic AS source,
  CASE WHEN NOT has_id THEN {_DIGEST_UUID} WHEN id_kind = 'VARCHAR' THEN id_text END AS event_id,
  has_id, is_object, NOT is_json OR (has_id AND id_kind <> 'VARCHAR') AS malformed,
  CASE WHEN is_json AND NOT is_object THEN value END AS raw_value, epoch_us(received_at) AS received_us
FROM identified""",
        "kafka_malformed": _normalized("").rstrip() + f""",{_MESSAGES}
SELECT number AS seq, 'kafka-' || topic AS source, value AS raw_payload, 'malformed message' AS error_reason
FROM identified WHERE NOT is_json OR (has_id AND id_kind <> 'VARCHAR')""",
        "envelope_accept": _normalized("").rstrip() + f""",{_BODIES}
SELECT seq,
  CASE WHEN seq % 23 IN (8, 9) THEN 'webhook' WHEN seq % 23 = 10 THEN 's' ELSE source END AS source,
  CASE WHEN seq % 23 IN (8, 9, 10) THEN {_DIGEST_UUID} ELSE event_id END AS event_id,
  CASE WHEN seq % 23 IN (9, 10) THEN true WHEN seq % 23 = 8 THEN false ELSE payload = '{{}}' END AS no_payload
FROM numbered WHERE seq % 23 NOT IN (1, 2, 3, 4, 5, 6, 7)""",
        "envelope_reject": _normalized("").rstrip() + f""",{_BODIES}
SELECT seq,
  CASE WHEN NOT json_valid(body) THEN 'body is not valid JSON'
       WHEN json_type(body) <> 'OBJECT' THEN 'body is not an object'
       WHEN json_type(body, '$.event_id') NOT IN ('VARCHAR', 'NULL') THEN 'event_id is not a string'
       WHEN json_type(body, '$.source') NOT IN ('VARCHAR', 'NULL') THEN 'source is not a string'
       WHEN json_type(body, '$.timestamp') NOT IN ('VARCHAR', 'NULL') THEN 'timestamp is not a string'
       ELSE 'payload is not an object' END AS reason
FROM bodies WHERE NOT json_valid(body) OR json_type(body) <> 'OBJECT'
  OR json_type(body, '$.event_id') NOT IN ('VARCHAR', 'NULL') OR json_type(body, '$.source') NOT IN ('VARCHAR', 'NULL')
  OR json_type(body, '$.timestamp') NOT IN ('VARCHAR', 'NULL') OR json_type(body, '$.payload') <> 'OBJECT'""",
        "dedup_first": _after(_DEDUP_COLUMNS),
        "dedup_lru_500": _after(_DEDUP_COLUMNS, _LRU_500),
        "dedup_ttl_400": _after(_DEDUP_COLUMNS, _ttl(400)),
        "dedup_ttl_3600": _after(_DEDUP_COLUMNS, _ttl(3600)),
        "dedup_lru_chunks": _after(_DEDUP_COLUMNS, _LRU_500),
        "dedup_lru_short_chunks": _after(_DEDUP_COLUMNS, _LRU_500),
        "dedup_first_hot": _after(_DEDUP_COLUMNS, chain=_HOT_CHAIN),
        "dedup_ttl_chain": _after(_DEDUP_COLUMNS, _ttl(400), chain=_HOT_CHAIN),
        "dedup_lru_hot": _after(_DEDUP_COLUMNS, _LRU_500, chain=_HOT_CHAIN),
        "merged_sources_outcomes": _after("SELECT seq, source, outcome FROM classified", chain=_MERGED_CHAIN),
        "merged_sources_ttl": _after(
            "SELECT seq, source, outcome FROM classified", _ttl(400).replace("numbered", "ordered"), chain=_MERGED_CHAIN
        ),
        "merged_sources_lru": _after("SELECT seq, source, outcome FROM classified", _LRU_500, chain=_MERGED_CHAIN),
        "dlq_with_malformed": _after(
            "SELECT seq, source, outcome, error_reason, CASE WHEN outcome = 'malformed' THEN text END AS text FROM dlq",
            chain=_MERGED_CHAIN,
        ),
        "custom_mapping_errors": _after("SELECT seq, source, outcome FROM classified", chain=_STRICT_CHAIN).replace(
            "FROM judged j LEFT JOIN", "FROM remapped j LEFT JOIN"
        ),
        "batch_members_hot": _after(
            "SELECT seq, ingest_us // 864000000000 AS tick, (row_number() OVER (PARTITION BY ingest_us // 864000000000 "
            "ORDER BY ingest_us, seq) - 1) // 100 AS chunk FROM valid"
        ),
        "dedup_off": _after(_DEDUP_COLUMNS, _NONE),
        "dedup_seen_size": _normalized(
            "SELECT count(DISTINCT event_id) AS n, least(count(DISTINCT event_id), 500) AS n_lru_500 FROM open_events"
        ),
        "duplicates_dropped": _after("SELECT seq, event_id FROM classified WHERE outcome = 'duplicate'"),
        "dlq_records": _after(
            "SELECT seq, event_id, source, payload AS raw_payload, error_reason, "
            f"{AS_OF_US} AS first_seen_us FROM dlq"
        ),
        "dlq_page": _after("SELECT seq, event_id, error_reason FROM dlq ORDER BY seq DESC LIMIT 50 OFFSET 7"),
        "dlq_count": _after("SELECT count(*) AS n FROM dlq"),
        "dlq_envelope": _after(
            'SELECT (SELECT count(*) FROM dlq) AS total, 5 AS "offset", 20 AS "limit", count(*) AS n_records, '
            "string_agg(event_id, ',' ORDER BY seq DESC) AS event_ids "
            "FROM (SELECT * FROM dlq ORDER BY seq DESC LIMIT 20 OFFSET 5)"
        ),
        "dlq_by_reason": _after("SELECT outcome AS reason, count(*) AS n FROM dlq GROUP BY outcome"),
        "dlq_by_source": _after("SELECT source, count(*) AS n FROM dlq GROUP BY source"),
        "dlq_state": _after(
            "SELECT n, CASE WHEN n >= 100 THEN 'red' WHEN n >= 10 THEN 'yellow' ELSE 'green' END AS state, "
            "CASE WHEN n >= 9000 THEN 'red' WHEN n >= 5000 THEN 'yellow' ELSE 'green' END AS state_as_queue "
            "FROM (SELECT count(*) AS n FROM dlq)"
        ),
        "dlq_in_memory": _after("SELECT seq, error_reason FROM dlq"),
        "events_ingested": _normalized("SELECT source, count(*) AS n FROM raw_events GROUP BY source"),
        "events_processed": _after("SELECT count(*) AS n FROM valid"),
        "events_failed": _after(
            "SELECT outcome AS reason, count(*) AS n FROM classified WHERE outcome <> 'processed' GROUP BY outcome"
        ),
        "batches": _after(
            "SELECT tick, chunk, count(*) AS n FROM (SELECT ingest_us // 10000000 AS tick, "
            "(row_number() OVER (PARTITION BY ingest_us // 10000000 ORDER BY ingest_us, seq) - 1) // 1000 AS chunk "
            "FROM valid) GROUP BY tick, chunk"
        ),
        "batches_hourly": _after("SELECT tick, chunk, size AS n FROM sized", extra=_HOURLY),
        "batch_members": _after("SELECT seq, tick, chunk FROM ranked", extra=_HOURLY),
        "sink_parquet_roundtrip": _after(
            f"SELECT {_VALID_COLUMNS}, strftime(received_at, '%Y-%m-%d') AS ingest_date, "
            f"CASE WHEN source <> 'kafka-clicks' THEN {_cleaned('order_id')} END AS order_id, "
            f"CASE WHEN source <> 'kafka-orders' THEN {_cleaned('url')} END AS url, "
            f"""CASE WHEN source = 'kafka-orders' THEN {_cleaned('currency', "'USD'")}
                     WHEN source <> 'kafka-clicks' THEN {_cleaned('currency')} END AS currency FROM valid"""
        ),
        "sink_dlq_roundtrip": _after(
            f"SELECT seq, event_id, source, error_reason, {AS_OF_US} AS first_seen_us, "
            f"{_cleaned('order_id')} AS order_id, {_cleaned('url')} AS url FROM dlq"
        ),
        "sink_insert_if_absent": _after(
            f"SELECT {_VALID_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY event_id "
            "ORDER BY CASE WHEN source LIKE 'kafka-%' THEN 0 ELSE 1 END, ingest_us, seq) AS rn FROM valid) WHERE rn = 1",
            _NONE,
        ),
        "histogram_lag": _after(
            "SELECT source, label AS le, cum AS cumulative_n FROM hist", extra=lag_histogram
        ),
        "histogram_lag_sum": _after(
            "SELECT source, sum(lag_us)::BIGINT AS total, count(*) AS n FROM valid GROUP BY source"
        ),
        "histogram_batch_size": _after(
            "SELECT label AS le, cum AS cumulative_n FROM hist", extra=f"{_HOURLY},{size_histogram}"
        ),
        "quantiles_lag": _after("", extra=lag_histogram).rstrip() + "," + _quantile_rows("source", _P3, 2.5),
        "quantiles_batch_size": _after("", extra=f"{_HOURLY},{size_histogram}").rstrip()
        + "," + _quantile_rows("", {"p50": 0.5}, 5000.0),
        "latency_panel": _after(
            "", extra=f"""
slid AS (
  SELECT (ingest_us // 5000000 + k) * 5000000 AS window_end_us, lag_us
  FROM valid, (SELECT unnest(range(1, 13)) AS k)
),{_histogram("slid", lag_seconds, _LATENCY, "window_end_us")}"""
        ).rstrip() + "," + _quantile_rows("window_end_us", _P3, 2.5),
        "rate_ingested": _normalized(_rate("raw_events", "source")),
        "rate_processed": _after(_rate("valid")),
        "rate_failed": _after(
            _rate("failed", "reason"),
            extra="\nfailed AS (SELECT *, outcome AS reason FROM classified WHERE outcome <> 'processed')",
        ),
        "rate_dlq": _after(_rate("dlq", "source")),
        "load_report": """
WITH results AS (
  SELECT CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 429 ELSE 202 END AS status, value / 1000 AS latency
  FROM events
),
good AS (
  SELECT latency, row_number() OVER (ORDER BY latency) - 1 AS i, count(*) OVER () AS n FROM results WHERE status = 202
)
SELECT count(*) AS total, count_if(status = 202) AS success,
  100 * count_if(status = 202) / greatest(count(*), 1)::DOUBLE AS success_pct,
  count_if(status = 429) AS rejected,
  100 * count_if(status = 429) / greatest(count(*), 1)::DOUBLE AS rejected_pct,
  count_if(status NOT IN (202, 429)) AS errors,
  count(*) / 2592000.0::DOUBLE AS throughput,
  (SELECT (max(latency) FILTER (WHERE i = (n - 1) // 2) + max(latency) FILTER (WHERE i = n // 2)) / 2 * 1000 FROM good) AS p50_ms,
  (SELECT max(latency) FILTER (WHERE i = floor(n * 0.95::DOUBLE)) * 1000 FROM good) AS p95_ms,
  (SELECT max(latency) FILTER (WHERE i = floor(n * 0.99::DOUBLE)) * 1000 FROM good) AS p99_ms
FROM results""",
        "stream_outcomes": _after(outcome_counts, _ttl(3600)),
        "stream_dedup_ttl": _after(_DEDUP_COLUMNS, _ttl(400)),
        "stream_dedup_restarts": _after(_DEDUP_COLUMNS, _ttl(400)),
        "stream_rates": _normalized(_rate("raw_events", "source")),
        "stream_batches": _after(
            "SELECT seq, ingest_us // 864000000000 AS tick, (row_number() OVER (PARTITION BY ingest_us // 864000000000 "
            "ORDER BY ingest_us, seq) - 1) // 100 AS chunk FROM valid"
        ),
        "stream_table": _after(
            f"SELECT {_VALID_COLUMNS}, strftime(received_at, '%Y-%m-%d') AS ingest_date FROM valid", _NONE
        ),
        "flush_batches": _after(
            "SELECT seq % 3 AS batch_id, count(*) AS rows, true AS timed FROM valid GROUP BY seq % 3", _NONE
        ),
    }
