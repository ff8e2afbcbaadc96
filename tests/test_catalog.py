import sys
from pathlib import Path

import duckdb
import pytest
from conftest import TESTDATA

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT / "tools"))

import __spark_entry__ as spark_entry  # noqa: E402
from check import rows  # noqa: E402

from siftlake.catalog.oracles import all_oracles  # noqa: E402
from siftlake.catalog.queries import all_queries  # noqa: E402

SAMPLE = [
    "flagship_outcomes", "normalize_all", "validate_reasons", "kafka_to_raw", "envelope_accept", "dedup_ttl_400",
    "dlq_page", "dedup_first_hot", "dedup_ttl_chain", "dedup_lru_chunks", "merged_sources_ttl", "dlq_with_malformed",
    "custom_mapping_errors", "stream_rates", "batch_members", "sink_parquet_roundtrip", "histogram_lag", "quantiles_lag", "rate_failed", "load_report",
]


def test_every_query_has_its_sql():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(spark_entry.queries())
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW events AS SELECT * FROM '{TESTDATA}/events.parquet'")
    frame = spark_entry.queries()[name](spark, TESTDATA)
    result = duck.execute(spark_entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert rows(frame.columns, [tuple(r) for r in frame.collect()]) == rows(names, result.fetchall())


def test_entry(spark):
    assert spark_entry.entry(spark).columns == ["source", "outcome", "n"]
