"""Raw events of several sources as one frame, for one dedup over all of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlake.schema import RAW_EVENT

_LARGEST = (1 << 63) - 1


def merge_sources(*raws: DataFrame) -> DataFrame:
    """``seq, event_id, source, payload, received_at, malformed`` of all ``raws``, batch or streaming.

    Each source numbers its events by itself, so numbers of two sources clash,
    while order and decisions rest on unique ones. Here they interleave: event
    ``n`` of the source in place ``p`` gets ``n * sources + p``. A negative number,
    or one too large for that, fails the read. Sources without ``malformed``
    have no such events.
    """
    if not raws:
        raise ValueError("no source given")

    def renumbered(raw: DataFrame, place: int) -> DataFrame:
        fits = F.col("seq").between(0, _LARGEST // len(raws) - 1)
        outside = F.raise_error(F.concat(F.lit("event number out of range: "), F.coalesce(F.col("seq").cast("string"), F.lit("null"))))
        number = F.when(fits, F.col("seq")).otherwise(outside.cast("bigint")) * F.lit(len(raws)) + F.lit(place)
        malformed = F.col("malformed") if "malformed" in raw.columns else F.lit(False)
        names = [name for name in RAW_EVENT.fieldNames() if name != "seq"]
        return raw.select(number.alias("seq"), *names, malformed.alias("malformed"))

    parts = [renumbered(raw, place) for place, raw in enumerate(raws)]
    return reduce(lambda left, right: left.unionByName(right), parts)
