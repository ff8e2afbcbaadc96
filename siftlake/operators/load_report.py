"""Report over request results: ``status`` (int) and ``latency`` (seconds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlake.functions.plan import one_row
from siftlake.operators.ordering import with_position

ACCEPTED, REFUSED = 202, 429


def load_report(results: DataFrame, duration: float, key: str = "seq") -> DataFrame:
    """One row of totals, shares, throughput and latency percentiles.

    p50 is the median (mean of the middle two); p95 and p99 are the sorted
    latencies at index ``floor(n * q)``. They are exact: accepted latencies get
    dense positions by a range sort, and five of them are looked up.
    """
    counts = results.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == ACCEPTED).alias("success"),
        F.count_if(F.col("status") == REFUSED).alias("rejected"),
        F.count_if(~F.col("status").isin(ACCEPTED, REFUSED)).alias("errors"),
    )
    accepted = results.filter(F.col("status") == ACCEPTED).select("latency", key)
    placed, n = with_position(accepted, ["latency", key])
    spots = {
        "low": (n - 1) // 2 if n else -1,
        "high": n // 2 if n else -1,
        "p95": int(n * 0.95),
        "p99": int(n * 0.99),
    }
    picked = placed.filter(F.col("position").isin(*set(spots.values()))).agg(
        *[F.max(F.when(F.col("position") == spot, F.col("latency"))).alias(f"_{name}") for name, spot in spots.items()]
    )
    share = F.greatest(F.col("total"), F.lit(1))
    return one_row(counts, picked).select(
        "total",
        "success",
        (F.lit(100) * F.col("success") / share).alias("success_pct"),
        "rejected",
        (F.lit(100) * F.col("rejected") / share).alias("rejected_pct"),
        "errors",
        (F.col("total") / F.lit(max(float(duration), 0.001))).alias("throughput"),
        ((F.col("_low") + F.col("_high")) / 2 * 1000).alias("p50_ms"),
        (F.col("_p95") * 1000).alias("p95_ms"),
        (F.col("_p99") * 1000).alias("p99_ms"),
    )
