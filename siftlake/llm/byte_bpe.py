"""Byte-level BPE in DuckDB inside each Spark partition (operator 3).

The distinct words of some megabytes of text become token-position rows of bytes. A recursive query joins them
with the merge table and contracts each word's leftmost pair of least rank, until no word has a pair left.
Decoding joins ids with the vocabulary and puts their bytes together in order with an ordered aggregation.
Texts are their words' ids in a row; words and blank-separated chunks seen before come from the Python worker's
bounded cache. A word of over ``LONG`` bytes would take as many rounds as it has contractions, each over all its
rows, so it is contracted by the same rule on a heap.

A null text is an empty one: no tokens, digests of nothing. Repeated rows are rows of their own; an empty table
gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siftlake.llm.common import Chunks, Known, in_arrow, only, slices

#: Bytes of a word from which the heap takes over; words in one recursive query; entries of a worker's caches.
LONG, WORDS, CACHE = 400, 40_000, 500_000
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

#: A row: a token, its right neighbour and that one's position (-1 at the word's end).
ENCODE = """
WITH RECURSIVE step(word, pos, tok, rgt, nxt, round) AS (
  SELECT word, pos, tok, rgt, nxt, 0 FROM seed
  UNION ALL
  (WITH best AS (
     SELECT s.word, min((m.rank::BIGINT << 32) | s.pos) AS pair, arg_min(s.nxt, (m.rank::BIGINT << 32) | s.pos) AS gone
     FROM step s JOIN merges m ON ((s.tok::BIGINT << 32) | s.rgt) = m.pair WHERE s.rgt >= 0 GROUP BY s.word),
   hit AS (
     SELECT b.word, (b.pair & 4294967295)::INT AS pos, (b.pair >> 32)::INT AS merged, b.gone, r.rgt, r.nxt
     FROM best b JOIN step r ON r.word = b.word AND r.pos = b.gone)
   SELECT s.word, s.pos, CASE WHEN s.pos = h.pos THEN h.merged ELSE s.tok END,
     CASE WHEN s.pos = h.pos THEN h.rgt WHEN s.nxt = h.pos THEN h.merged ELSE s.rgt END,
     CASE WHEN s.pos = h.pos THEN h.nxt ELSE s.nxt END, s.round + 1
   FROM step s JOIN hit h ON s.word = h.word WHERE s.pos <> h.gone))
SELECT s.word, s.tok FROM step s JOIN (SELECT word, max(round) AS round FROM step GROUP BY word) USING (word, round)
ORDER BY s.word, s.pos
"""
DECODE = """
SELECT unhex(coalesce(string_agg(v.hex, '' ORDER BY i.pos), '')) AS bytes
FROM ids i JOIN vocabulary v USING (tok) GROUP BY i.run ORDER BY i.run
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def contract(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The leftmost pair of least rank, again and again, with a heap of pairs."""
    parts: list[bytes | None] = [word[i:i + 1] for i in range(len(word))]
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap = [(ranks[word[i:i + 2]], i, word[i:i + 2]) for i in range(len(word) - 1) if word[i:i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, joined = heapq.heappop(heap)
        j = after[i]
        if parts[i] is None or j >= len(parts) or parts[i] + parts[j] != joined:
            continue
        parts[i], parts[j], after[i] = joined, None, after[j]
        if after[j] < len(parts):
            before[after[j]] = i
        for a in (before[i], i):
            if a >= 0 and after[a] < len(parts):
                pair = parts[a] + parts[after[a]]
                if pair in ranks:
                    heapq.heappush(heap, (ranks[pair], a, pair))
    return [ranks[part] for part in parts if part is not None]


class DuckBpe:
    """A DuckDB connection with the merge table and the vocabulary, and the caches of a Python worker."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        self.ranks, self.pattern = read_ranks(path), regex.compile(pattern)
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        # Ids of words and chunks, and the bytes decoded from them; None for a chunk that is not safe to cut out.
        self.words: dict[str, tuple[bytes, bytes]] = Known(CACHE)
        self.chunks: dict[str, tuple[bytes, bytes] | None] = Known(CACHE)
        self.con = duckdb.connect()
        self.con.execute("SET threads = 1")
        left, right, rank = [], [], []
        for token, r in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), rank.append(r)
        self.con.register("pairs", pa.table({"pair": (np.array(left, np.int64) << 32) | np.array(right, np.int64), "rank": pa.array(rank, pa.int32())}))
        self.con.execute("CREATE TABLE merges AS SELECT * FROM pairs")
        self.con.register("tokens", pa.table({"tok": pa.array(self.ranks.values(), pa.int32()), "hex": [x.hex() for x in self.ranks]}))
        self.con.execute("CREATE TABLE vocabulary AS SELECT * FROM tokens")
        self.con.unregister("pairs")
        self.con.unregister("tokens")

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words that are not empty."""
        out: list[np.ndarray | None] = [None] * len(words)
        for i, word in enumerate(words):
            if len(word) > LONG:
                out[i] = np.array(contract(word, self.ranks), "<u4")
        short = [i for i, ids in enumerate(out) if ids is None]
        for start in range(0, len(short), WORDS):
            group = short[start:start + WORDS]
            sizes = np.array([len(words[i]) for i in group])
            data = np.frombuffer(b"".join([words[i] for i in group]), np.uint8)
            first, tok = np.cumsum(sizes) - sizes, self.byte[data]
            pos = np.arange(len(data)) - np.repeat(first, sizes)
            last = pos + 1 == np.repeat(sizes, sizes)
            self.con.register("seed", pa.table({
                "word": np.repeat(np.arange(len(group), dtype=np.int32), sizes), "pos": pos.astype(np.int32), "tok": tok,
                "rgt": np.where(last, -1, np.roll(tok, -1)).astype(np.int32), "nxt": np.where(last, -1, pos + 1).astype(np.int32)}))
            rows = self.con.execute(ENCODE).fetchnumpy()
            ids, cuts = np.asarray(rows["tok"]).astype("<u4"), np.searchsorted(rows["word"], np.arange(len(group) + 1)).tolist()
            for i, a, b in zip(group, cuts, cuts[1:], strict=False):
                out[i] = ids[a:b]
        return out

    def decode(self, runs: list[bytes]) -> list[bytes]:
        """The bytes of runs of ids (little-endian unsigned 32-bit integers), in order."""
        decoded, new = {b"": b""}, [run for run in dict.fromkeys(runs) if run]
        for start in range(0, len(new), WORDS):
            group = new[start:start + WORDS]
            sizes = np.array([len(run) // 4 for run in group])
            pos = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            self.con.register("ids", pa.table({
                "run": np.repeat(np.arange(len(group), dtype=np.int32), sizes), "pos": pos.astype(np.int32),
                "tok": np.frombuffer(b"".join(group), "<u4").astype(np.int32)}))
            decoded.update(zip(group, [x for x, in self.con.execute(DECODE).fetchall()], strict=True))
        return [decoded[run] for run in runs]

    def _learn(self, words: set[str]) -> None:
        new = self.words.missing([*words])
        ids = [x.tobytes() for x in self.encode_words([w.encode() for w in new])]
        self.words.update(zip(new, zip(ids, self.decode(ids), strict=True), strict=True))

    def _joined(self, words: list[str]) -> tuple[bytes, bytes]:
        """Ids of words in a row, and the bytes decoded from them."""
        if len(words) == 1:
            return self.words[words[0]]
        found = [self.words[word] for word in words]
        return b"".join([x for x, _ in found]), b"".join([x for _, x in found])

    def _learn_chunks(self, chunks: list[str], before: str, known: dict[str, tuple[bytes, bytes] | None]) -> None:
        """``known`` gets new chunks with ``before`` in front; a chunk of nothing or with white space at an end gets None."""
        findall = self.pattern.findall
        matches = [findall(before + x) if x and not x[0].isspace() and not x[-1].isspace() else None for x in chunks]
        self._learn({word for found in matches if found for word in found})
        words = self.words
        known.update(zip(chunks, [
            None if found is None else words[found[0]] if len(found) == 1 else self._joined(found) for found in matches], strict=True))

    def encode(self, texts: pa.Array) -> tuple[list[bytes], list[bytes]]:
        """Each text's ids as little-endian unsigned 32-bit integers, and the bytes decoded from them.

        A blank between two characters that are no white space always starts a match of the pattern, so the
        chunks before and after it are matched by themselves; any other text is matched as a whole.
        """
        chunks, known = Chunks(texts), self.chunks
        self._learn_chunks(known.missing(chunks.distinct), " ", known)
        first: dict[str, tuple[bytes, bytes] | None] = {}
        self._learn_chunks(chunks.leading, "", first)
        runs = [*map(known.__getitem__, chunks.distinct), *map(first.__getitem__, chunks.leading)]
        rows = {}
        if None in runs:
            rows = {row: self.pattern.findall(texts[row].as_py() or "") for row in chunks.rows_with([x is None for x in runs])}
            runs = [x or (b"", b"") for x in runs]
        ids, back = ([*map(chunks.join, zip(*runs, strict=True))] if runs else ([], []))
        self._learn({word for found in rows.values() for word in found})
        for row, found in rows.items():
            ids[row], back[row] = self._joined(found)
        return ids, back


_ENGINES: dict[tuple[str, str], DuckBpe] = {}


def engine(path: str, pattern: str) -> DuckBpe:
    """The Python worker's engine for a rank file."""
    if (path, pattern) not in _ENGINES:
        _ENGINES[path, pattern] = DuckBpe(path, pattern)
    return _ENGINES[path, pattern]


def encode_documents(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids of every whole text."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = engine(path, pattern)
        for batch in batches:
            for rows in slices(batch):
                ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in bpe.encode(rows.column("text"))[0]]
                yield pa.RecordBatch.from_pydict({"doc_id": rows.column("doc_id"), "ids": pa.array(ids, pa.list_(pa.int32()))})

    return in_arrow(only(documents, doc_id="long", text="string"), task, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the bytes of every list of ids (null: none)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = engine(path, pattern)
        for batch in batches:
            runs = [np.asarray(ids or [], "<u4").tobytes() for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "bytes": pa.array(bpe.decode(runs), pa.binary())})

    return in_arrow(only(encoded, doc_id="long", ids="array<int>"), task, "doc_id long, bytes binary")


def bpe_digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the bytes decoded from them."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = engine(path, pattern)
        for batch in batches:
            for rows in slices(batch):
                ids, back = bpe.encode(rows.column("text"))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": rows.column("doc_id"), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    "decoded_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in back], pa.string())})

    return in_arrow(only(documents, doc_id="long", text="string"), task, DIGESTS)
