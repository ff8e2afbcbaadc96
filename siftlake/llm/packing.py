"""Order-preserving packing by dynamic programming (operator 2).

The documents of a partition, in ascending order of doc_id, form one stream of ids. Windows of at most
``length`` ids cover it without gaps. A window costs its padding (none where its ids are a power of two), a
price per sequence, and a penalty where its end cuts a document: a small one after a sentence, a larger one
inside. With b the places where a cut is allowed and f the least cost up to a place,

    f[j] = penalty[j] + price + min(length - b[j] + min{f[i] + b[i] : b[j] - b[i] <= length},
                                    min{f[i] : b[j] - b[i] a power of two <= length})

The inner minimum over a sliding range comes from a monotone queue, the second from at most twelve places.
Cuts inside a sentence are allowed only where a sentence is longer than a window, every ``length`` ids of it.
The stream is cut in blocks of about ``BLOCK`` ids at document ends, which bounds memory; a document is held
whole. Null texts are empty documents of one id; null ids come first; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from siftlake.llm.common import in_arrow, in_order, slices
from siftlake.llm.word_cache import encoder

LENGTH = 2048
BLOCK = 1 << 19
#: Penalties for a window that ends after a sentence, inside one; price of a sequence.
SENTENCE, INSIDE, PRICE = 4, 64, 16
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_tokens long")


def cut_places(ids: np.ndarray, doc_ends: np.ndarray, sentence_ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a window may end, 0 first, and the penalty of each. ``sentence_ends``: true by id."""
    penalty = np.full(len(ids) + 1, -1, np.int64)
    penalty[1:][sentence_ends[ids]] = SENTENCE
    penalty[doc_ends] = 0
    penalty[0] = 0
    places = np.flatnonzero(penalty >= 0)
    gaps = np.diff(places)
    for i in np.flatnonzero(gaps > length):
        penalty[places[i] + length:places[i + 1]:length] = INSIDE
    places = np.flatnonzero(penalty >= 0)
    return places, penalty[places]


def best_cuts(places: np.ndarray, penalty: np.ndarray, length: int) -> list[int]:
    """Numbers of the places that end a window in the cheapest cover, ascending; the last place is one."""
    n = len(places)
    powers = 1 << np.arange(int(length).bit_length())
    powers = powers[powers <= length]
    # The number of each place, or -1 where none is; ``length`` in front, as far back as a power reaches.
    number = np.full(int(places[-1]) + length + 1, -1, np.int64)
    number[places + length] = np.arange(n)
    found = number[places[:, None] + (length - powers)]
    jumps: dict[int, list[int]] = {}
    for j, i in zip(np.nonzero(found >= 0)[0].tolist(), found[found >= 0].tolist(), strict=True):
        jumps.setdefault(j, []).append(i)
    at, extra = places.tolist(), (penalty + PRICE).tolist()
    cost, back = [0] * n, [0] * n
    # What waits in the queue: numbers, the places they are, cost + place; these ascend.
    numbers, queued, costs = deque([0]), deque([0]), deque([0])
    for j in range(1, n):
        place = at[j]
        least = place - length
        while queued[0] < least:
            queued.popleft()
            numbers.popleft()
            costs.popleft()
        best, origin = costs[0] - least, numbers[0]
        if j in jumps:
            for i in jumps[j]:
                if cost[i] < best:
                    best, origin = cost[i], i
        best += extra[j]
        cost[j], back[j] = best, origin
        best += place
        while costs and costs[-1] >= best:
            costs.pop()
            numbers.pop()
            queued.pop()
        costs.append(best)
        numbers.append(j)
        queued.append(place)
    cuts, j = [], n - 1
    while j > 0:
        cuts.append(j)
        j = back[j]
    return cuts[::-1]


def pack_block(doc_ids: list, parts: list[bytes], sentence_ends: np.ndarray, length: int, first: int) -> tuple[pa.RecordBatch, int]:
    """The pieces of whole documents, and the number of sequences. ``first``: the first sequence's id."""
    ids = np.frombuffer(b"".join(parts), "<u4")
    sizes = np.array([len(x) // 4 for x in parts])
    ends = np.cumsum(sizes)
    places, penalty = cut_places(ids, ends, sentence_ends, length)
    windows = places[best_cuts(places, penalty, length)]
    stops = np.union1d(windows, ends)
    starts = np.concatenate([[0], stops[:-1]])
    doc, window = np.searchsorted(ends, starts, "right"), np.searchsorted(windows, starts, "right")
    window_start = np.concatenate([[0], windows[:-1]])
    data = memoryview(ids.tobytes())
    crcs = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array([doc_ids[i] for i in doc.tolist()], pa.int64()),
        "start": pa.array(starts - (ends - sizes)[doc], pa.int64()), "length": pa.array(stops - starts, pa.int64()),
        "ids_crc32": pa.array(crcs, pa.int64()), "doc_tokens": pa.array(sizes[doc], pa.int64()),
        "sequence_id": pa.array(first + window, pa.int64()), "offset": pa.array(starts - window_start[window], pa.int64()),
        "sequence_tokens": pa.array((windows - window_start)[window], pa.int64())}), len(windows)


def pack(documents: DataFrame, vocabulary: str, end_id: int, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """One row per piece of a document: where it lies in the document and in its sequence."""
    end = np.array([end_id], "<u4").tobytes()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary, False)
        vocab = words.tokenizer.get_vocab()
        sentence_ends = np.zeros(max([end_id, *vocab.values()]) + 1, bool)
        sentence_ends[[i for word, i in vocab.items() if word.removesuffix("</w>")[-1:] in (".", "!", "?")]] = True
        first = TaskContext.get().partitionId() << 40
        doc_ids, parts, held = [], [], 0
        for batch in batches:
            for rows in slices(batch):
                for doc_id, ids in zip(rows.column("doc_id").to_pylist(), words.encode(rows.column("text")), strict=True):
                    doc_ids.append(doc_id)
                    parts.append(ids + end)
                    held += len(parts[-1]) // 4
                    if held >= block:
                        out, n = pack_block(doc_ids, parts, sentence_ends, length, first)
                        yield out
                        first, doc_ids, parts, held = first + n, [], [], 0
        if parts:
            yield pack_block(doc_ids, parts, sentence_ends, length, first)[0]

    return in_arrow(in_order(documents), task, PIECES)
