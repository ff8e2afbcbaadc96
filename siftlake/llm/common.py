"""Helpers shared by the training-data operators."""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator
from itertools import filterfalse, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siftlake.session import ship_package

#: Characters of text that a Python task holds at once beside its Arrow batch.
SLICE_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, **kinds: str) -> DataFrame:
    """The named columns in the named types and nothing else, so that no other column can clash."""
    return df.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in kinds.items()])


def in_arrow(df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` whose tasks find this package wherever they run, and leave their worker no Arrow memory that is free."""
    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in task(batches):
            yield batch
            pa.default_memory_pool().release_unused()
        pa.default_memory_pool().release_unused()

    ship_package(df.sparkSession)
    return df.mapInArrow(lean, schema)


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Runs of a batch's rows with about ``limit`` bytes of text each, one row at least."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def arrow_uri(uri: str) -> str:
    """A folder's address with the scheme that Arrow knows it by: Spark calls the same store s3a or s3n."""
    scheme, mark, rest = uri.partition("://")
    return f"s3://{rest}" if mark and scheme.lower() in ("s3a", "s3n") else uri


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder, and the path in it."""
    return pafs.FileSystem.from_uri(arrow_uri(uri))


def in_order(documents: DataFrame) -> DataFrame:
    """doc_id and text in ascending order of doc_id over the partitions and in them.

    Rows of one id, null among them, are dealt on by their text and place, so that they do not fill a task.
    """
    rows = only(documents, doc_id="long", text="string").select("*", F.xxhash64("text").alias("salt"), F.monotonically_increasing_id().alias("place"))
    order = ("doc_id", "salt", "place")
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")


def first_by_hash(rows: DataFrame, group: str, key: str, k: int) -> DataFrame:
    """The ``k`` rows of each of a few groups whose key has the smallest hash. ``rows``: one per key, from a checkpoint.

    Hashes spread evenly, so the first ``2 k + 200`` or so of a group lie below a bound that its size gives; only
    those meet in the group's task, however large it is.
    """
    place = F.xxhash64(key).cast("double") / 2.0**64 + 0.5
    sizes = rows.groupBy(group).agg(F.count("*").alias("_size"))
    near = rows.join(F.broadcast(sizes), group).filter(place * F.col("_size") <= 2 * k + 200).drop("_size")
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.xxhash64(key), key))
    return near.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


#: Numbers of characters beyond what there is, which the library would take digit by digit.
_TOO_LARGE = re.compile(r"&#0*+[0-9]{8,}+;?")


def decoded(text: str) -> str:
    """A page's text with its character references resolved."""
    return html.unescape(_TOO_LARGE.sub("\ufffd", text)) if "&" in text else text


class Known(dict):
    """A bounded cache of a Python worker. Once more than ``most`` entries are in it, it keeps half as many at most: those asked
    for again since it was last full. Most words of a text occur nowhere else; they would push out the ones that go on coming."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.again = most, set()

    def missing(self, keys: list) -> list:
        """Those of the distinct ``keys`` that are not known; entries of the others stay until the next call."""
        self.again.update(filter(self.__contains__, keys))
        if len(self) > self.most:
            kept = {key: self[key] for key in islice(self.again, self.most // 2)}
            self.clear()
            self.update(kept)
            self.again.clear()
        return [*filterfalse(self.__contains__, keys)]


class Chunks:
    """The blank-separated chunks of texts (null: one empty chunk), each distinct one once.

    ``distinct`` are the chunks after a blank; ``leading`` the first chunks of the texts, numbered behind them.
    """

    def __init__(self, texts: pa.Array):
        lists = pc.split_pattern(pc.fill_null(texts, "").cast(pa.large_string()), " ")
        self.bounds = np.asarray(lists.offsets).astype(np.int64) - lists.offsets[0].as_py()
        coded = lists.flatten().dictionary_encode()
        self.distinct = coded.dictionary.to_pylist()
        self.numbers = np.array(coded.indices, np.int64)
        first = self.numbers[self.bounds[:-1]]
        kinds, place = np.unique(first, return_inverse=True)
        self.leading = [self.distinct[i] for i in kinds.tolist()]
        self.numbers[self.bounds[:-1]] = len(self.distinct) + place

    def rows_with(self, flags: list[bool]) -> list[int]:
        """Texts with a flagged chunk; a flag for each of ``distinct``, then of ``leading``."""
        if not any(flags) or len(self.bounds) < 2:
            return []
        return np.flatnonzero(np.logical_or.reduceat(np.array(flags)[self.numbers], self.bounds[:-1])).tolist()

    def join(self, values: list[bytes]) -> list[bytes]:
        """Per text, its chunks' values one after another; a value for each of ``distinct``, then of ``leading``."""
        taken = pa.array(values, pa.large_binary()).take(pa.array(self.numbers))
        _, offsets, data = taken.buffers()
        if data is None:
            return [b""] * (len(self.bounds) - 1)
        ends = np.frombuffer(offsets, np.int64)[:len(taken) + 1][self.bounds].tolist()
        view = memoryview(data)
        return [bytes(view[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
