"""``raw_events``: heterogeneous, dirty events derived from the ``events`` table.

The same query text serves Spark and DuckDB; only the spellings in
``_DIALECTS`` differ. ``events`` itself is clean, so rules on ``event_id`` put
in reused ids, malformed ids, blank sources, empty payloads, future and
out-of-range times and seven timestamp styles. Every event is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siftlake.functions.plan import spread

AS_OF = "2024-02-01T00:00:00Z"

_DIALECTS = {
    "spark": {
        "TEXT": "STRING",
        "ISO_MICROS": """date_format({0}, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")""",
        "ISO_SECONDS": """date_format({0}, "yyyy-MM-dd'T'HH:mm:ss")""",
        "MILLIS": "(unix_micros(CAST({0} AS TIMESTAMP)) DIV 1000)",
        "SECONDS": "((unix_micros(CAST({0} AS TIMESTAMP)) DIV 1000) DIV 1000)",
    },
    "duckdb": {
        "TEXT": "VARCHAR",
        "ISO_MICROS": "strftime({0}, '%Y-%m-%dT%H:%M:%S.%f')",
        "ISO_SECONDS": "strftime({0}, '%Y-%m-%dT%H:%M:%S')",
        "MILLIS": "(epoch_us({0}) // 1000)",
        "SECONDS": "((epoch_us({0}) // 1000) // 1000)",
    },
}

_UUID_OF_M = (
    "substr(m,1,8) || '-' || substr(m,9,4) || '-' || substr(m,13,4) || '-' || substr(m,17,4) || '-' || substr(m,21,12)"
)

_HOT = "WHEN event_id % 3 = 0 THEN -1 WHEN event_id % 6 = 2 THEN event_id - 1"


def raw_events_sql(dialect: str, events: str = "events", hot: bool = False) -> str:
    """The derivation as one query over the relation ``events``.

    With ``hot`` a third of the events share one id and another third come in pairs.
    """
    d = _DIALECTS[dialect]
    text = d["TEXT"]

    def as_text(expression: str) -> str:
        return f"CAST({expression} AS {text})"

    return f"""
SELECT i AS seq,
  CASE WHEN i % 61 = 9 THEN '   ' ELSE src END AS source,
  CASE WHEN i % 50 = 3 THEN 'bad-' || {as_text("i")}
       WHEN i % 30 = 4 THEN m
       WHEN i % 30 = 8 THEN upper({_UUID_OF_M})
       ELSE {_UUID_OF_M} END AS event_id,
  CASE WHEN i % 71 = 11 THEN '{{}}'
       WHEN src = 'kafka-orders' THEN
         '{{"order_id":"ORD-' || {as_text("i")} || '","created_at":' || x || ',"amount":' || {as_text("value")}
         || ',"customer_id":"CUST-' || {as_text("user_id")} || '"'
         || CASE i % 3 WHEN 0 THEN ',"currency":"EUR"' WHEN 1 THEN ',"currency":null' ELSE '' END
         || ',"items":' || {as_text("i % 10")} || '}}'
       WHEN src = 'kafka-clicks' THEN
         '{{"click_id":"CK-' || {as_text("i")} || '","url":"/p/' || {as_text("user_id % 20")}
         || '","user_id":"U-' || {as_text("user_id")} || '","ts":' || x || ',"device":"mobile"}}'
       ELSE '{{"value":' || {as_text("value")} || ',"props":' || props || ',"timestamp":' || x || '}}' END AS payload,
  ts AS received_at
FROM (
  SELECT *, md5({as_text("k")}) AS m,
    CASE WHEN i % 101 = 17 THEN '999999999999'
         WHEN i % 7 = 0 THEN '"' || {d["ISO_MICROS"].format("ets")} || 'Z"'
         WHEN i % 7 = 1 THEN '"' || {d["ISO_SECONDS"].format("ets")} || 'Z"'
         WHEN i % 7 = 2 THEN '"' || {d["ISO_MICROS"].format("ets + INTERVAL 330 MINUTE")} || '+05:30"'
         WHEN i % 7 = 3 THEN '"' || replace({d["ISO_SECONDS"].format("ets")}, 'T', ' ') || '"'
         WHEN i % 7 = 4 THEN {as_text(d["MILLIS"].format("ets"))}
         WHEN i % 7 = 5 THEN {as_text(d["SECONDS"].format("ets"))}
         ELSE 'null' END AS x
  FROM (
    SELECT event_id AS i, ts, user_id, value, props,
      CASE {_HOT if hot else ""} WHEN event_id % 20 IN (7, 8) THEN event_id - (event_id % 20 - 6)
           WHEN event_id >= 600 AND event_id % 97 = 5 THEN event_id - 600
           ELSE event_id END AS k,
      CASE event_type WHEN 'purchase' THEN 'kafka-orders' WHEN 'click' THEN 'kafka-clicks'
           WHEN 'view' THEN 'kafka-clicks' ELSE 'webhook-' || event_type END AS src,
      CASE WHEN event_id % 83 = 13 THEN ts + INTERVAL 400 DAY ELSE ts END AS ets
    FROM {events}
  ) AS b
) AS h"""


def raw_from_events(events: DataFrame, hot: bool = False) -> DataFrame:
    """``raw_events`` over a given ``events`` frame, batch or streaming."""
    spread(events, "event_id", "ts").createOrReplaceTempView("siftlake_events")
    return events.sparkSession.sql(raw_events_sql("spark", "siftlake_events", hot))


def raw_events(spark: SparkSession, sf_dir: str, hot: bool = False) -> DataFrame:
    return raw_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"), hot)
