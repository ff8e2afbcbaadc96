"""Steps and fences that keep Catalyst from copying expressions into their users."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PARTS = 3


def step(df: DataFrame, **columns: Column) -> DataFrame:
    """Add ``columns`` in one projection; they may build on the existing ones."""
    kept = [F.col(f"`{name}`") for name in df.columns if name not in columns]
    return df.select(*kept, *[column.alias(name) for name, column in columns.items()])


def fence(df: DataFrame, *names: str) -> DataFrame:
    """Hand the named columns on as finished values.

    A filter on a derived column is moved below the projection that derives it,
    the expression substituted into it; through a long chain of dependent
    columns the plan grows until it no longer fits in memory, and everything is
    computed twice. Filters on the output of a generator stay above it, and a
    generator over a one-element array yields exactly the row it was given. Only
    finished columns pass through the generator, so the expressions themselves
    stay in generated code.
    """
    kept = [F.col(f"`{name}`") for name in df.columns if name not in names]
    row = F.struct(*[F.col(f"`{name}`") for name in names])
    return df.select(*kept, F.inline(F.array(row)))


def one_row(*parts: DataFrame) -> DataFrame:
    """Frames of one row each as one row, without a join."""
    merged = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)
    return merged.agg(*[F.any_value(F.col(name), F.lit(True)).alias(name) for name in merged.columns])


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` dealt out over all tasks by ``columns``, before work that costs far more per row than a shuffle.

    A file is read by as many tasks as it has row groups, and what is written
    from there keeps that shape; parsing would run in these few tasks alone.
    Several parts a core, so that no core waits long for the last ones; the
    number is given, as adaptive execution would merge them by their small size.
    """
    session = df.sparkSession
    parts = max(_PARTS * session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(parts, *columns)
