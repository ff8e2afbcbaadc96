"""Nearest neighbours by largest inner product from a permutation index (operator 4).

Vectors are represented by their ``prefix`` nearest pivots in order of nearness. Inner products become distances
by one more coordinate, sqrt(M^2 - |v|^2) with M the largest norm (0 for a query), so that the nearest pivots
follow the ranking asked for. Every vector of a block is posted in its pivots' inverted files with the pivot's
place in its order; a query walks the files of its own pivots and adds up what the footrule distance of the two
orders saves for each posting. The best ``share`` of a block (``least`` at least) is reranked by inner products
in double precision of the original vectors.

Pivots are a bounded sample (the ``pivots`` distinct vectors whose ids have the smallest hash). Every vector is
posted. Vectors and queries are dealt into blocks of bounded size by a hash of their id; each pair of a query
block and a vector block is one group, so no group grows with the data or with equal vectors.

Equal vectors of a block are posted once, with the ``k + 1`` smallest of their ids, so that copies neither fill the
reranked share nor are lost from a result.

Null vectors, zero vectors, those with null or non-finite components, and null ids take no part. Vectors of
different lengths are never compared: every length has pivots, files and blocks of its own. Repeated ids are
rows of their own; a query leaves out all rows of its own id; queries that repeat an id and vector are one query,
and an id with several vectors asks with the one that sorts first. Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftlake.llm.common import in_arrow

PIVOTS, PREFIX, SHARE, LEAST = 1024, 64, 0.08, 400
#: Vectors and queries in a block, about.
BLOCK, QUERIES = 16_384, 4_096
FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (array of doubles) of the vectors that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & fine & F.exists("embedding", lambda x: x != 0.0))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column whose lists are equally long, as rows."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def orders(vectors: np.ndarray, extra: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The nearest pivots of each vector, nearest first. ``pivots`` have the extra coordinate last."""
    near = vectors @ pivots[:, :-1].T + extra[:, None] * pivots[:, -1] - 0.5 * (pivots ** 2).sum(axis=1)
    prefix = min(prefix, len(pivots))
    first = np.argpartition(-near, prefix - 1, axis=1)[:, :prefix]
    return np.take_along_axis(first, np.argsort(-np.take_along_axis(near, first, 1), axis=1, kind="stable"), 1)


def inverted_files(order: np.ndarray, pivots: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per pivot, the rows that hold it and its place in each row's order."""
    flat = order.ravel()
    by = np.argsort(flat, kind="stable")
    cuts = np.searchsorted(flat[by], np.arange(1, pivots))
    return list(zip(np.split(by // order.shape[1], cuts), np.split(by % order.shape[1], cuts), strict=True))


def distinct(ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of ids in ascending order: the first place of each distinct vector, and for each place kept the number of its vector.

    A vector keeps its ``k`` smallest ids; the other places have -1.
    """
    plain = np.ascontiguousarray(rows + 0.0)  # -0.0 is 0.0
    _, first, number = np.unique(plain.view(f"V{plain.shape[1] * 8}").ravel(), return_index=True, return_inverse=True)
    order = np.argsort(number, kind="stable")
    place = np.empty(len(ids), np.int64)
    starts = np.searchsorted(number[order], np.arange(len(first)))
    place[order] = np.arange(len(ids)) - starts[number[order]]
    return first, np.where(place < k, number, -1)


def search_block(queries: tuple, vectors: tuple, pivots: int, k: int, share: float, least: int) -> Iterator[tuple]:
    """(query id, ids, scores) of the best ``k`` of a block. Both sides: ids, vectors, orders."""
    q_ids, q_vectors, q_orders = queries
    by_id = np.argsort(vectors[0], kind="stable")
    ids, rows, order = (x[by_id] for x in vectors)
    first, number = distinct(ids, rows, k + 1)
    kept = np.flatnonzero(number >= 0)
    kept = kept[np.argsort(number[kept], kind="stable")]
    starts = np.searchsorted(number[kept], np.arange(len(first) + 1))
    rows, order = rows[first], order[first]
    files, prefix = inverted_files(order, pivots), order.shape[1]
    wanted = min(len(first), max(least, int(np.ceil(share * len(first)))))
    for q_id, q_vector, q_order in zip(q_ids.tolist(), q_vectors, q_orders, strict=True):
        # Footrule with absent pivots in place `prefix` is a constant less twice this sum over shared pivots.
        saved = np.zeros(len(first), np.int32)
        for place, pivot in enumerate(q_order.tolist()):
            at, places = files[pivot]
            saved[at] += prefix - np.maximum(places, place).astype(np.int32)
        if wanted < len(first):
            found = np.argpartition(-saved, wanted - 1)[:wanted]
            least_saved = saved[found].min()
            found = np.concatenate([np.flatnonzero(saved > least_saved), np.flatnonzero(saved == least_saved)])[:wanted]
        else:
            found = np.arange(len(first))
        scores = (rows[found] * q_vector).sum(axis=1)
        sizes = starts[found + 1] - starts[found]
        each = np.repeat(starts[found] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        found, scores = ids[kept[each]], np.repeat(scores, sizes)
        others = found != q_id
        found, scores = found[others], scores[others]
        best = np.lexsort((found, -scores))[:k]
        yield q_id, found[best], scores[best]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, pivots: int = PIVOTS, prefix: int = PREFIX,
            share: float = SHARE, least: int = LEAST, block: int = BLOCK, query_block: int = QUERIES) -> DataFrame:
    """The ``k`` nearest found for each query: query_id, rank, vec_id, score. Both frames: vec_id, embedding."""
    vectors = usable(vectors)
    queries = usable(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    square, size = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x), F.size("embedding")
    sizes = vectors.agg(F.count("*"), F.max(square)).first()
    n_queries, longest = queries.count(), sizes[1] or 0.0
    by_hash = F.row_number().over(Window.partitionBy("width").orderBy(F.xxhash64("vec_id"), "vec_id"))
    sample = vectors.withColumn("width", size).withColumn("place", by_hash).filter(F.col("place") <= 2 * pivots).orderBy("width", "place").select("embedding").collect()
    chosen: dict[int, np.ndarray] = {}
    for row in dict.fromkeys(tuple(row[0]) for row in sample):
        chosen.setdefault(len(row), []).append(row)
    for width, rows in chosen.items():
        x = np.array(rows[:pivots], np.float64)
        chosen[width] = np.column_stack([x, np.sqrt(np.maximum(0, longest - (x ** 2).sum(axis=1)))])
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(chosen)  # at most `pivots` rows a length
    blocks, query_blocks = max(1, -(-sizes[0] // block)), max(1, -(-n_queries // query_block))

    kind = "vec_id long, embedding array<double>, near array<int>"

    def order(is_query: bool):
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                widths = pc.list_value_length(batch.column("embedding")).to_numpy()
                for width in np.unique(widths).tolist():
                    part = batch.filter(pa.array(widths == width))
                    if width not in shared.value:
                        continue  # a query without a vector of its length
                    rows = matrix(part.column("embedding"))
                    extra = np.zeros(len(rows)) if is_query else np.sqrt(np.maximum(0, longest - (rows ** 2).sum(axis=1)))
                    near = orders(rows, extra, shared.value[width], prefix).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(list(near), pa.list_(pa.int32()))], names=["vec_id", "embedding", "near"])

        return task

    def dealt(df: DataFrame, is_query: bool, own: int, others: int) -> DataFrame:
        mine = F.pmod(F.xxhash64("vec_id"), F.lit(own)).cast("int")
        theirs = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        names = ("query_block", "block") if is_query else ("block", "query_block")
        return in_arrow(df, order(is_query), kind).withColumn("width", size).withColumn(names[0], mine).withColumn(names[1], theirs)

    def side(t: pa.Table) -> tuple:
        t = t.combine_chunks()
        ids = t.column("vec_id").to_numpy()
        return ids, *[matrix(t.column(c).chunk(0) if t.num_rows else pa.array([], pa.list_(pa.float64()))) for c in ("embedding", "near")]

    def search(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        both = left.num_rows and right.num_rows
        out = list(search_block(side(left), side(right), len(chosen[key[0].as_py()]), k, share, least)) if both else []
        return pa.table({
            "query_id": pa.array(np.repeat(np.array([q for q, _, _ in out], np.int64), [len(i) for _, i, _ in out])),
            "vec_id": pa.array(np.concatenate([i for _, i, _ in out]) if out else [], pa.int64()),
            "score": pa.array(np.concatenate([s for _, _, s in out]) if out else [], pa.float64())})

    left = dealt(queries, True, query_blocks, blocks).groupBy("width", "block", "query_block")
    right = dealt(vectors, False, blocks, query_blocks).groupBy("width", "block", "query_block")
    found = left.cogroup(right).applyInArrow(search, FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
