"""Alignment of two tokenizers' tokens by galloping intersection of their byte ends (operator 11).

Both tokenizers cover the same bytes, so a text is two ascending lists of token ends. The shorter list drives an
exponential and then binary search into the longer one, each search starting where the run before it ended. Ends
found in both are common: they cut the text into groups. The difference of neighbouring ranks is the range of
tokens that a token overlaps: its links.

One pass writes, per slice of documents, the documents' figures with their links as places in the slice's list
of id pairs, and that list with its counts. The lists are added up over the corpus by pair; what a pair got goes
back to its slices by a join, and slices, which are bounded in bytes, meet their documents in one task each. The
best count per id of the second tokenizer has one row per id of its vocabulary and is broadcast.

Texts that are null, empty or not given back byte for byte by both tokenizers (U+2581 itself is one case) have
no tokens and all zeros. Null ids are kept; repeated rows are rows of their own and all count; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlake.llm.common import Chunks, in_arrow, only, slices
from siftlake.llm.word_cache import byte_letters, plain_encoder
from siftlake.session import scratch_path, ship_package

#: Ends of the shorter list in a run; runs are searched side by side.
STEPS = 128
#: Distinct chunks that a worker keeps the ids of; some 300 bytes each.
CHUNKS = 300_000
#: Bytes of text in a slice.
SLICE_BYTES = 2_000_000
ALIGNED = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, places binary, "
           "pairs array<long>, counts array<long>")
REPORT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
GROUPS = "doc_id long, a_ids array<int>, b_ids array<int>, groups array<struct<a_end:int,b_end:int>>"
#: A pair is its first id shifted by so many bits, and its second id.
SHIFT = 32


def gallop(short: np.ndarray, long: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """For each value of ``short`` the number of values of ``long`` below it. Both ascend; ``long`` ends no lower.

    ``short`` is cut into runs of ``steps`` values that advance side by side, each from where its last search ended.
    """
    runs = -(-len(short) // steps)
    padded = np.concatenate([short, np.full(runs * steps - len(short), long[-1])])
    ranks, high = np.empty((steps, runs), np.int64), np.zeros(runs, np.int64)
    for at, wanted in enumerate(np.ascontiguousarray(padded.reshape(runs, steps).T)):
        low, step = high.copy(), 1
        behind = np.flatnonzero(long[high] < wanted)
        while len(behind):
            low[behind] = high[behind] + 1
            high[behind] = np.minimum(high[behind] + step, len(long) - 1)
            behind, step = behind[long[high[behind]] < wanted[behind]], step * 2
        between = np.flatnonzero(low < high)
        while len(between):
            middle = (low[between] + high[between]) // 2
            below = long[middle] < wanted[between]
            low[between[below]] = middle[below] + 1
            high[between[~below]] = middle[~below]
            between = between[low[between] < high[between]]
        ranks[at] = high
    return ranks.T.reshape(-1)[:len(short)]


@dataclass
class Overlaps:
    """``a``, ``b``: indices of tokens that end together. Links: token ``i`` of a side with tokens ``j`` of the other."""

    a: np.ndarray
    b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> Overlaps:
    """Common ends and overlapping tokens of two tokenizations of the same bytes; tokens have a byte at least."""
    if not len(a_ends):
        return Overlaps(*[np.empty(0, np.int64)] * 4)
    turned = len(b_ends) < len(a_ends)
    short, long = (b_ends, a_ends) if turned else (a_ends, b_ends)
    ranks = gallop(short, long)
    common = long[ranks] == short
    first = np.concatenate([[0], ranks[:-1] + common[:-1]])
    sizes = ranks - first + 1
    before = np.cumsum(sizes) - sizes
    one = np.repeat(np.arange(len(short)), sizes)
    other = np.arange(len(one)) + np.repeat(first - before, sizes)
    ends = np.flatnonzero(common), ranks[common]
    return Overlaps(*(ends[::-1] if turned else ends), *((other, one) if turned else (one, other)))


class PairedEncoder:
    """Ids of blank + text by a byte-level vocabulary, and of text by a piece model that adds the blank."""

    def __init__(self, vocabulary: str, model: str):
        from sentencepiece import SentencePieceProcessor

        self.a, self.b = plain_encoder(vocabulary), SentencePieceProcessor(model_file=model)
        letters = {letter: byte for byte, letter in byte_letters().items()}
        with open(vocabulary, encoding="utf-8") as source:
            known = json.load(source)["model"]["vocab"]
        self.a_bytes = [b""] * (max(known.values()) + 1)
        for piece, number in known.items():
            self.a_bytes[number] = bytes(letters[x] for x in piece) if all(x in letters for x in piece) else b""
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_pieces, self.b_pieces = (pa.array(x, pa.large_binary()) for x in (self.a_bytes, self.b_bytes))
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in xs], np.int64) for xs in (self.a_bytes, self.b_bytes))
        self.chunks: dict[str, tuple[bytes, bytes] | None] = {}
        self.printed = pa.array([b"%d%s" % (i, mark) for size, marks in ((len(self.a_bytes), (b",", b"|")), (len(self.b_bytes), (b",", b";")))
                                 for mark in marks for i in range(size)], pa.large_binary())

    def _piece(self, number: int) -> bytes:
        if self.b.is_byte(number):
            return bytes([int(self.b.id_to_piece(number)[3:-1], 16)])
        if self.b.is_control(number) or self.b.is_unknown(number):
            return b""
        return self.b.id_to_piece(number).replace("▁", " ").encode()

    def whole(self, text: str) -> tuple[bytes, bytes]:
        """Ids by the two libraries alone; none for a text that has no tokens."""
        spaced = " " + text
        a, b = self.a.whole(spaced), np.array(self.b.encode(text), "<u4").tobytes()
        return (a, b) if text and self._given_back([spaced], [a], [b])[0] else (b"", b"")

    def _given_back(self, texts: list[str], *sides: list[bytes]) -> np.ndarray:
        """Whether the ids of every side have a text's bytes, for each text."""
        wanted = pa.array(texts, pa.large_string()).cast(pa.large_binary())
        fine = np.ones(len(texts), bool)
        for ids, pieces in zip(sides, (self.a_pieces, self.b_pieces), strict=True):
            flat = pa.array(np.frombuffer(b"".join(ids), "<u4"))
            cuts = np.cumsum([0, *[len(x) // 4 for x in ids]])
            _, offsets, data = pieces.take(flat).buffers()
            ends = pa.array(np.frombuffer(offsets, np.int64)[:len(flat) + 1][cuts])
            given = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, ends.buffers()[1], data if data is not None else pa.py_buffer(b"")])
            fine &= pc.equal(given, wanted).to_numpy(zero_copy_only=False)
        return fine

    def _learn(self, chunks: list[str]) -> None:
        b = self.b.encode(chunks)
        flat = np.fromiter(chain.from_iterable(b), "<u4").tobytes()
        cuts = np.cumsum([0, *[4 * len(x) for x in b]]).tolist()
        b = [flat[i:j] for i, j in pairwise(cuts)]
        a = [self.a.chunk(chunk, " ") for chunk in chunks]
        fine = self._given_back([" " + x for x in chunks], [x or b"" for x in a], b).tolist()
        self.chunks.update((c, (x, y) if ok and x is not None else None) for c, x, y, ok in zip(chunks, a, b, fine, strict=True))

    def encode(self, texts: pa.Array) -> tuple[list[bytes], list[bytes]]:
        """Per text the ids of both. Neither tokenizer joins a blank to what is before it: chunks are cut there."""
        chunks = Chunks(texts)
        every = [*chunks.distinct, *chunks.leading]
        if len(self.chunks) > CHUNKS:
            self.chunks.clear()
        known = self.chunks
        if new := [c for c in dict.fromkeys(every) if c not in known]:
            self._learn(new)
        ids = [known[c] for c in every]
        sides = [chunks.join([x[i] if x else b"" for x in ids]) for i in (0, 1)]
        for row in chunks.rows_with([x is None for x in ids]):
            sides[0][row], sides[1][row] = self.whole(texts[row].as_py() or "")
        return sides[0], sides[1]


_ENCODERS: dict[tuple[str, str], PairedEncoder] = {}


def paired_encoder(vocabulary: str, model: str) -> PairedEncoder:
    if (vocabulary, model) not in _ENCODERS:
        _ENCODERS[vocabulary, model] = PairedEncoder(vocabulary, model)
    return _ENCODERS[vocabulary, model]


class Aligned:
    """The tokens of some texts one after another, with their common ends and links.

    ``a_cuts``, ``b_cuts``, ``group_cuts`` and ``link_cuts`` are where each text begins, and the total.
    """

    def __init__(self, encoder: PairedEncoder, texts: pa.Array):
        a, b = encoder.encode(texts)
        self.a, self.b = (np.frombuffer(b"".join(x), "<u4").astype(np.int64) for x in (a, b))
        self.a_cuts, self.b_cuts = (np.cumsum([0, *[len(x) // 4 for x in xs]]) for xs in (a, b))
        # A text has equally many bytes on both sides, so ends count on over all of them.
        self.found = overlaps(np.cumsum(encoder.a_sizes[self.a]), np.cumsum(encoder.b_sizes[self.b]))
        self.group_cuts = np.searchsorted(self.found.a, self.a_cuts)
        self.link_cuts = np.searchsorted(self.found.link_a, self.a_cuts)
        self.printed, self.a_known, self.b_known = encoder.printed, len(encoder.a_bytes), len(encoder.b_bytes)

    def digests(self) -> list[str]:
        """Per text the SHA-256 of its groups in print; empty without tokens."""
        sides = []
        for numbers, last in ((self.a, self.found.a), (self.b, self.found.b)):
            ends = np.zeros(len(numbers), bool)
            ends[last] = True
            sides.append((ends, np.cumsum(ends) - ends))
        (a_last, a_group), (b_last, b_group) = sides
        begins = np.concatenate([[0], self.found.b + 1])[a_group]  # tokens of b before a token of a
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + begins] = self.a + a_last * self.a_known
        if len(self.b):
            codes[np.arange(len(self.b)) + self.found.a[b_group] + 1] = 2 * self.a_known + self.b + b_last * self.b_known
        _, offsets, data = self.printed.take(pa.array(codes)).buffers()
        cuts = np.frombuffer(offsets, np.int64)[:len(codes) + 1][self.a_cuts + self.b_cuts].tolist()
        view = memoryview(data) if data is not None else memoryview(b"")
        return [hashlib.sha256(view[x:y - 1]).hexdigest() if y > x else "" for x, y in pairwise(cuts)]

    def pairs(self) -> np.ndarray:
        return self.a[self.found.link_a] << SHIFT | self.b[self.found.link_b]


def place_type(pairs: int) -> str:
    """How a place in a list of so many pairs is written."""
    return "<u2" if pairs <= 1 << 16 else "<u4"


def align(documents: DataFrame, vocabulary: str, model: str) -> DataFrame:
    """Per document its ids by both tokenizers and its groups, each by the token numbers after its last ones."""
    kind = pa.struct([("a_end", pa.int32()), ("b_end", pa.int32())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = paired_encoder(vocabulary, model)
        for batch in batches:
            for part in slices(batch):
                x = Aligned(encoder, part.column("text"))
                texts = np.repeat(np.arange(part.num_rows), np.diff(x.group_cuts))
                ends = [pa.array((at + 1 - cuts[texts]).astype(np.int32)) for at, cuts in ((x.found.a, x.a_cuts), (x.found.b, x.b_cuts))]
                groups = pa.StructArray.from_arrays(ends, fields=list(kind))
                lists = [pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), values) for cuts, values in (
                    (x.a_cuts, pa.array(x.a.astype(np.int32))), (x.b_cuts, pa.array(x.b.astype(np.int32))), (x.group_cuts, groups))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *lists], names=["doc_id", "a_ids", "b_ids", "groups"])

    return in_arrow(only(documents, doc_id="long", text="string"), task, GROUPS)


def _written(documents: DataFrame, vocabulary: str, model: str) -> DataFrame:
    """A table of the documents and, in rows of their own, the pairs of each slice."""
    schema = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), *[(x, pa.int64()) for x in ("n_a", "n_b", "n_groups", "n_links")],
                        ("groups_sha256", pa.string()), ("places", pa.binary()), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, block = paired_encoder(vocabulary, model), TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                x = Aligned(encoder, part.column("text"))
                pairs, places, counts = np.unique(x.pairs(), return_inverse=True, return_counts=True)
                places, rows = places.astype(place_type(len(pairs))), part.num_rows
                figures = [pa.array(np.diff(cuts)) for cuts in (x.a_cuts, x.b_cuts, x.group_cuts, x.link_cuts)]
                own = [places[i:j].tobytes() for i, j in pairwise(x.link_cuts.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(rows, block)), part.column("doc_id"), *figures, pa.array(x.digests()), pa.array(own, pa.binary()),
                    pa.nulls(rows, pa.list_(pa.int64())), pa.nulls(rows, pa.list_(pa.int64()))], schema=schema)
                yield pa.RecordBatch.from_pydict({**{name: [None] for name in schema.names}, "block": [block], "pairs": [pairs], "counts": [counts]}, schema=schema)
                block += 1

    spark, folder = documents.sparkSession, scratch_path(documents.sparkSession, "aligned")
    in_arrow(only(documents, doc_id="long", text="string"), task, ALIGNED).write.parquet(folder)
    return spark.read.schema(ALIGNED).parquet(folder)


def alignment_report(documents: DataFrame, vocabulary: str, model: str) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    aligned = _written(documents, vocabulary, model)
    texts = aligned.filter("pairs IS NULL").drop("pairs", "counts")
    lists = aligned.filter("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "x"))
    lists = lists.select("block", "place", F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n"))
    totals = lists.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1)))
    best = F.broadcast(totals.groupBy("b").agg(F.max("count").alias("highest")))  # one row per id of the vocabulary at most
    totals = totals.join(best, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    facts = lists.select("block", "place", "pair").join(totals, "pair").select(F.col("block").alias("slice"), "place", "count", "best")

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        kind = place_type(right.num_rows)
        every, sums = np.frombuffer(b"".join(left.column("places").to_pylist()), kind).astype(np.int64), []
        cuts = np.concatenate([[0], np.cumsum(left.column("n_links").to_numpy())])
        for name in ("best", "count"):
            values = np.empty(right.num_rows, np.int64)
            if right.num_rows:  # else no text of the slice has a link
                values[right.column("place").to_numpy()] = right.column(name).to_numpy().astype(np.int64)
            running = np.concatenate([[0], np.cumsum(values[every])])
            sums.append(pa.array(running[cuts[1:]] - running[cuts[:-1]]))
        figures = [left.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
        return pa.table([*figures, *sums, left.column("groups_sha256")], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    ship_package(documents.sparkSession)
    return texts.groupBy("block").cogroup(facts.groupBy("slice")).applyInArrow(judge, REPORT)
