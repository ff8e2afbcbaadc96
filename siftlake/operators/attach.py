"""Joining rows to facts about their key when some keys are very frequent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(
    rows: DataFrame, facts: DataFrame, key: str, weight: str, unique: str = "seq", parts: int | None = None
) -> DataFrame:
    """Left join of ``facts`` (one row per ``key``, with its row count in ``weight``).

    A key is hot if it has more than one of ``parts`` equal shares of all rows
    in ``facts``; ``parts`` is the number of shuffle partitions, so no other key
    fills more than an average task, and fewer than ``parts`` rows are broadcast.
    Rows of hot keys stay out of the shuffle join's key space: they carry their
    own hash as a salt, which matches nothing and spreads them over all tasks.
    The adaptive skew join does not do this here, because it needs a plain
    shuffle on both sides and the facts come from an aggregation on the key.

    Read ``facts`` from a checkpoint or a table, it is used three times. Its columns
    other than ``key`` and ``weight`` are added to the rows.
    """
    names = [name for name in facts.columns if name not in (key, weight)]
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = facts.agg(F.sum(weight)).first()[0] or 0
    hot = facts.filter(F.col(weight) * F.lit(parts) > F.lit(total)).select(
        F.col(key).alias("_hot_key"), *[F.col(name).alias(f"_hot_{name}") for name in names]
    )
    # Always 0, but not a literal: a literal would be folded out of the join keys.
    no_salt = F.pmod(F.col(weight), F.lit(1)).cast("bigint")
    rest = facts.select(
        F.col(key).alias("_rest_key"), no_salt.alias("_rest_salt"),
        *[F.col(name).alias(f"_rest_{name}") for name in names],
    )
    settled = F.col("_hot_key").isNotNull()
    salt = F.when(settled, F.xxhash64(unique).bitwiseOR(F.lit(1))).otherwise(F.lit(0).cast("bigint"))
    joined = (
        rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
        .withColumn("_salt", salt)
        .join(rest, (F.col(key) == F.col("_rest_key")) & (F.col("_salt") == F.col("_rest_salt")), "left")
    )
    return joined.select(
        *[F.col(f"`{name}`") for name in rows.columns],
        *[
            F.when(settled, F.col(f"_hot_{name}")).otherwise(F.col(f"_rest_{name}")).alias(name)
            for name in names
        ],
    )
