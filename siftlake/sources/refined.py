"""Reading what the sinks wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftlake.schema import CANONICAL_EVENT, DLQ_RECORD


DATED_EVENT = T.StructType([*CANONICAL_EVENT.fields, T.StructField("ingest_date", T.DateType())])


def between_days(events: DataFrame, first_day: str | None, last_day: str | None) -> DataFrame:
    if first_day is not None:
        events = events.filter(F.col("ingest_date") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        events = events.filter(F.col("ingest_date") <= F.lit(last_day).cast("date"))
    return events


def read_refined(
    spark: SparkSession, path: str, first_day: str | None = None, last_day: str | None = None
) -> DataFrame:
    """The date-partitioned table; the days prune whole directories."""
    events = spark.read.schema(DATED_EVENT).option("recursiveFileLookup", "false").parquet(path)
    return between_days(events, first_day, last_day)


def read_dlq(spark: SparkSession, path: str) -> DataFrame:
    """Dead letters from their JSON lines; the raw payload comes back as JSON text."""
    schema = T.StructType(
        [
            T.StructField(f.name, T.VariantType() if f.name == "raw_payload" else f.dataType)
            for f in DLQ_RECORD.fields
        ]
    )
    return spark.read.schema(schema).json(path).withColumn("raw_payload", F.to_json("raw_payload"))
