"""Counting, for every row, the rows that are lower in two orders at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_DIGIT_BITS = 4


def with_lower(df: DataFrame, group: str, place: str, value: str, length: int) -> DataFrame:
    """Add ``lower``: how many rows of the group have a smaller ``place`` and a smaller ``value``.

    Both are distinct within a group; ``0 <= place < length``. Of two places,
    written with digits to base sixteen, the smaller one has the smaller digit
    where they first differ. So for every digit the rows that agree in all
    digits above it are gone through by value, and each row counts those passed
    with a smaller digit. That is one sort per digit and no pair of rows; the
    rows are shuffled once, by group, as every window partitions by group first.
    """
    df = df.withColumn("lower", F.lit(0).cast("bigint"))
    base = 1 << _DIGIT_BITS
    digit = F.col("_digit")
    for shift in range(0, max(1, (length - 1).bit_length()), _DIGIT_BITS):
        passed = (
            Window.partitionBy(group, "_above").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
        )
        smaller = F.lit(0).cast("bigint")
        for d in range(1, base):
            smaller = F.when(digit == d, F.count_if(digit < d).over(passed)).otherwise(smaller)
        df = (
            df.withColumn("_digit", F.shiftright(place, shift).bitwiseAND(F.lit(base - 1)))
            .withColumn("_above", F.shiftright(place, shift + _DIGIT_BITS))
            .withColumn("lower", F.col("lower") + smaller)
            .drop("_digit", "_above")
        )
    return df
