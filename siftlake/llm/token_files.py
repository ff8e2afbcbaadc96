"""Token ids as Arrow stream files of equal-length sequences and masks (operator 1).

A file holds record batches of fixed-size lists: ``tokens``, ``attention_mask`` (padding is false) and
``end_mask`` (the last token of a document is true), with ``doc_ids``, the documents that end in the sequence.
Documents follow one another without gaps; only a file's last sequence is padded. A reader maps a file and
gets each sequence and mask as a view of it, without a copy.

Each partition of the documents' order writes one file under a name of its own, which only a committed task's
row in the manifest makes part of the result, so a repeated task does no harm. Null texts are empty documents;
an empty table gives no file and no rows; null ids come first; repeated ids are documents of their own.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftlake.llm.common import filesystem, in_arrow, in_order, slices
from siftlake.llm.word_cache import encoder
from siftlake.session import scratch_path

SEQUENCE = 2048
#: Sequences in a record batch at most.
BATCH = 256
MANIFEST = "ordinal int, file string, documents long, tokens long, sequences long"
DOCUMENTS = "ordinal int, doc_id long, start long, n_tokens long, ids_crc32 long"


def file_schema(length: int = SEQUENCE, token: pa.DataType = pa.uint16()) -> pa.Schema:
    return pa.schema([
        ("tokens", pa.list_(token, length)), ("attention_mask", pa.list_(pa.bool_(), length)),
        ("end_mask", pa.list_(pa.bool_(), length)), ("doc_ids", pa.list_(pa.int64())),
    ])


def _record_batch(tokens: np.ndarray, ends: np.ndarray, doc_ids: list, used: int, schema: pa.Schema) -> pa.RecordBatch:
    """Whole sequences; ``ends`` are the places of the last tokens of ``doc_ids``, the first ``used`` tokens count."""
    length = schema.field("tokens").type.list_size
    attention, end = np.arange(len(tokens)) < used, np.zeros(len(tokens), bool)
    end[ends] = True
    starts = np.searchsorted(ends // length, np.arange(len(tokens) // length + 1)).astype(np.int32)
    lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), length) for x in (tokens, attention, end)]
    return pa.record_batch([*lists, pa.ListArray.from_arrays(pa.array(starts), pa.array(doc_ids, pa.int64()))], schema=schema)


class TokenWriter:
    """Writes documents one after another; holds less than one record batch and the documents just given."""

    def __init__(self, sink, length: int = SEQUENCE, token: pa.DataType = pa.uint16()):
        self.schema, self.length = file_schema(length, token), length
        self.kind = token.to_pandas_dtype()
        self.out = pa.ipc.new_stream(sink, self.schema)
        self.held, self.ends, self.ids = np.empty(0, self.kind), np.empty(0, np.int64), []
        self.documents = self.tokens = self.sequences = 0

    def add(self, doc_ids: list, parts: list[bytes]) -> None:
        """Documents with their ids as little-endian unsigned 32-bit integers; none may be empty."""
        new = np.frombuffer(b"".join(parts), "<u4").astype(self.kind)
        ends = np.cumsum([len(x) // 4 for x in parts]) - 1 + len(self.held)
        self.held, self.ends = np.concatenate([self.held, new]), np.concatenate([self.ends, ends])
        self.ids = [*self.ids, *doc_ids]
        self.documents, self.tokens = self.documents + len(parts), self.tokens + len(new)
        self._emit(len(self.held) // self.length * self.length)

    def _emit(self, upto: int, used: int | None = None) -> None:
        step, done = BATCH * self.length, 0
        for start in range(0, upto, step):
            stop = min(start + step, upto)
            last = int(np.searchsorted(self.ends, stop))
            self.out.write_batch(_record_batch(
                self.held[start:stop], self.ends[done:last] - start, self.ids[done:last],
                (upto if used is None else used) - start, self.schema))
            self.sequences, done = self.sequences + (stop - start) // self.length, last
        self.held, self.ends, self.ids = self.held[upto:].copy(), self.ends[done:] - upto, self.ids[done:]

    def close(self) -> None:
        if used := len(self.held):
            self.held = np.pad(self.held, (0, self.length - used))
            self._emit(self.length, used)
        self.out.close()


class TokenFile:
    """A file's sequences and masks by number. A local file is mapped: tokens are views of it, without a copy."""

    def __init__(self, uri: str):
        fs, path = filesystem(uri)
        source = pa.memory_map(path) if fs.type_name == "local" else fs.open_input_file(path)
        self.batches = list(pa.ipc.open_stream(source))
        self.starts = np.cumsum([0, *[b.num_rows for b in self.batches]])

    def __len__(self) -> int:
        return int(self.starts[-1])

    def _list(self, name: str, i: int) -> pa.Array:
        at = int(np.searchsorted(self.starts, i, "right")) - 1
        column = self.batches[at].column(name)
        size, row = column.type.list_size, i - int(self.starts[at])
        return column.values.slice((column.offset + row) * size, size)

    def tokens(self, i: int) -> np.ndarray:
        return self._list("tokens", i).to_numpy(zero_copy_only=True)

    def masks(self, i: int) -> tuple[pa.Array, pa.Array]:
        """Attention and document-end mask as Arrow arrays over the file's bits."""
        return self._list("attention_mask", i), self._list("end_mask", i)


def write_token_files(documents: DataFrame, folder: str, vocabulary: str, end_id: int, length: int = SEQUENCE) -> DataFrame:
    """Write the documents in ascending order of doc_id; the manifest, one row per file in their order."""
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary, True)
        token = pa.uint16() if max(words.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else pa.uint32()
        ordinal, fs, sink, writer, name = TaskContext.get().partitionId(), None, None, None, ""
        for batch in batches:
            for part in slices(batch):
                if writer is None:
                    name = f"tokens-{ordinal:06d}-{uuid.uuid4().hex}.arrows"
                    fs, path = filesystem(f"{folder}/{name}")
                    sink = fs.open_output_stream(path)
                    writer = TokenWriter(sink, length, token)
                writer.add(part.column("doc_id").to_pylist(), [ids + end for ids in words.encode(part.column("text"))])
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({
                "ordinal": pa.array([ordinal], pa.int32()), "file": [name], "documents": [writer.documents],
                "tokens": [writer.tokens], "sequences": [writer.sequences]})

    spark = documents.sparkSession
    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)
    in_arrow(in_order(documents), write, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files alone: its id, place in the whole stream, tokens and checksum of its ids."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from read_file(f"{folder}/{row['file']}", row["ordinal"], row["before"])

    # one row per file: the frame is as long as the list of files
    before = F.sum("tokens").over(Window.orderBy("ordinal")) - F.col("tokens")
    files = manifest.select("ordinal", "file", before.alias("before"))
    return in_arrow(files.repartition(max(1, manifest.count())), read, DOCUMENTS)


def read_file(uri: str, ordinal: int, before: int) -> Iterator[pa.RecordBatch]:
    """The documents of one file, a record batch of sequences at a time."""
    fs, path = filesystem(uri)
    crc = size = 0
    with fs.open_input_stream(path) as source:
        for batch in pa.ipc.open_stream(source):
            used = np.asarray(batch.column("attention_mask").flatten())
            tokens = np.asarray(batch.column("tokens").flatten())[used].astype("<u4")
            ends = np.flatnonzero(np.asarray(batch.column("end_mask").flatten()))
            starts, sizes, crcs, at = [], [], [], 0
            for end in ends + 1:
                sizes.append(size + int(end) - at)
                crcs.append(zlib.crc32(tokens[at:end].tobytes(), crc))
                starts.append(before)
                before, at, crc, size = before + sizes[-1], int(end), 0, 0
            crc, size = zlib.crc32(tokens[at:].tobytes(), crc), size + len(tokens) - at
            yield pa.RecordBatch.from_pydict({
                "ordinal": pa.array([ordinal] * len(ends), pa.int32()), "doc_id": batch.column("doc_ids").flatten(),
                "start": pa.array(starts, pa.int64()), "n_tokens": pa.array(sizes, pa.int64()),
                "ids_crc32": pa.array(crcs, pa.int64())})


def token_digests(documents: DataFrame, vocabulary: str, end_id: int, length: int = SEQUENCE) -> DataFrame:
    """Write the files under the shared folder and read them back."""
    folder = scratch_path(documents.sparkSession, "tokens")
    manifest = write_token_files(documents, folder, vocabulary, end_id, length)
    return read_token_files(manifest, folder).select("doc_id", "start", "n_tokens", "ids_crc32")
