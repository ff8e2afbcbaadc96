"""A table that grows by one delta per micro-batch and is read in few parts.

``FAN`` deltas are merged into one table of the next level, ``FAN`` of those
into one of the level above, and so on, so the tables to read grow with the
logarithm of the batch number. Which ones these are follows from that number alone.

A batch reads only what batches before it have left. Running it again replaces
its delta. A merge happens before a batch, over batches that are final by then;
its inputs go at a later merge, and one that did not finish is made anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import types as T

from siftlake.session import list_folders, path_exists, remove_path

FAN = 16


def parts_before(batch_id: int, fan: int = FAN) -> list[tuple[int, int]]:
    """``(level, first batch)`` of the tables that hold batches ``0 .. batch_id - 1``."""
    parts, start, size, level = [], 0, 1, 0
    while size * fan <= batch_id:
        size, level = size * fan, level + 1
    while size:
        while start + size <= batch_id:
            parts.append((level, start))
            start += size
        size, level = size // fan, level - 1
    return parts


class LevelledTable:
    """Deltas under ``folder``; ``merge`` makes one table of several, ``order`` sorts the files of each."""

    def __init__(
        self, spark: SparkSession, folder: str, merge: Callable[[DataFrame], DataFrame], order: list[str],
        schema: str | T.StructType | None = None, fan: int = FAN,
    ) -> None:
        self._spark, self._folder, self._fan = spark, folder.rstrip("/"), fan
        self._merged, self._order, self._schema = merge, order, schema

    def path(self, level: int, start: int) -> str:
        return f"{self._folder}/level={level}/from={start}"

    def _reader(self) -> DataFrameReader:
        return self._spark.read if self._schema is None else self._spark.read.schema(self._schema)

    def _tables(self, parts: list[tuple[int, int]]) -> DataFrame:
        if not parts and self._schema is not None:
            return self._spark.createDataFrame([], self._schema)
        return self._reader().parquet(*[self.path(*part) for part in parts])

    def _write(self, rows: DataFrame, level: int, start: int) -> None:
        rows.sortWithinPartitions(*self._order).write.mode("overwrite").parquet(self.path(level, start))

    def _whole(self, level: int, start: int) -> bool:
        return path_exists(self._spark, f"{self.path(level, start)}/_SUCCESS")

    def tidy(self, batch_id: int) -> None:
        """Merge what is complete before this batch; remove the inputs of merges that the batch before has read past."""
        level, size = 1, self._fan
        while batch_id and batch_id % size == 0:
            start = batch_id - size
            if not self._whole(level, start):
                inputs = [(level - 1, start + i * size // self._fan) for i in range(self._fan)]
                self._write(self._merged(self._tables(inputs)), level, start)
            level, size = level + 1, size * self._fan
        level, size = 1, self._fan
        while (batch_id - 1) % size == 0 and batch_id > size:
            for i in range(self._fan):
                remove_path(self._spark, self.path(level - 1, batch_id - 1 - size + i * size // self._fan))
            level, size = level + 1, size * self._fan

    def before(self, batch_id: int) -> DataFrame | None:
        """What the batches before this one have left, a key in several rows; None for the first batch."""
        if batch_id == 0:
            return None
        self.tidy(batch_id)
        return self._tables(parts_before(batch_id, self._fan))

    def leave(self, batch_id: int, rows: DataFrame) -> None:
        self._write(rows, 0, batch_id)

    def parts(self, upto: int | None = None) -> list[tuple[int, int]]:
        """The tables that hold all batches so far (the first ``upto``), from what lies in the folder:
        the largest one at every place."""
        whole: dict[int, int] = {}
        for level_folder in list_folders(self._spark, self._folder):
            level = int(level_folder.rsplit("=", 1)[1])
            for table in list_folders(self._spark, level_folder):
                start = int(table.rsplit("=", 1)[1])
                if upto is not None and start + self._fan**level > upto:
                    continue
                if level > whole.get(start, -1) and self._whole(level, start):
                    whole[start] = level
        parts, start = [], 0
        while start in whole:
            parts.append((whole[start], start))
            start += self._fan ** whole[start]
        return parts

    def latest(self, upto: int | None = None) -> DataFrame:
        """All batches so far (the first ``upto``), for readers beside the stream; without a schema it fails if there is none.
        ``LookupError``: the stream has gone on and merged batches beyond ``upto`` with earlier ones.

        Tables go only one batch after a merge has replaced them, so a read that
        takes longer than two batches may have to be started again.
        """
        parts = self.parts(upto)
        if upto is not None and sum(self._fan**level for level, _ in parts) != upto:
            raise LookupError(f"the first {upto} batches are no longer apart from later ones")
        return self._tables(parts)
