"""Hard negatives by exact integer inner products from residue number systems (operator 12).

Components are scaled and rounded down to whole numbers. Blocks of rows meet blocks of anchors: both sides become
matrices modulo several small primes, whose products in float32 are exact; the residues of a product are put
together by Chinese remaindering (mixed radix with balanced digits) into the exact signed score. A first pass
scores anchors against rows of their own label and keeps the first ``positives``; a second one scores them
against all other labels and keeps, for each positive, the first ``negatives`` within the window of its score.

Every row is scored, in blocks of bounded size dealt by a hash of a row number, so that no label, vector or id
makes a block large. What a block keeps for an anchor is bounded, and windows merge the blocks.

Rows with a null id, label, vector or component, or a non-finite component, take no part, nor do rows with a
sum of squares of 2^62 or more after scaling, whose scores might not fit a long. Vectors of different lengths are
never compared; two empty ones score zero. Repeated rows and ids are rows of their own, each an anchor if marked.
Ties go to the smaller id. An empty table, or one without anchors, gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftlake.session import checkpointed, ship_package

#: Primes whose balanced residues, at most 510, give exact float32 sums over 64 products.
PRIMES = (1021, 1019, 1013, 1009, 997, 991, 983)
#: The longest sum of such products below 2^24.
EXACT = 64
#: Rows and anchors in a block at most, about; anchors scored at once.
ROWS, ANCHORS, TILE = 8_192, 16_384, 64
#: Fixed values of the window: a negative has at least 80 and at most 100 hundredths of the positive's score.
LOW, HIGH = 80, 100
FOUND = "anchor long, positive_score long, uid long, vec_id long, score long"


def primes_for(bound: int) -> tuple[int, ...]:
    """The first primes whose product exceeds twice ``bound``, two at least."""
    product, count = 1, 0
    while count < 2 or product <= 2 * bound + 1:
        product, count = product * PRIMES[count], count + 1
    return PRIMES[:count]


def balanced(values: np.ndarray, prime: int) -> np.ndarray:
    """Residues between -(prime // 2) and prime // 2."""
    rest = values % prime
    return rest - prime * (rest > prime // 2)


def residues(values: np.ndarray, primes: tuple[int, ...]) -> list[np.ndarray]:
    return [balanced(values, p).astype(np.float32) for p in primes]


def exact_products(left: list[np.ndarray], right: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """All inner products of the rows of two sides given as residues."""
    found, modulus = np.zeros((len(left[0]), len(right[0])), np.int64), 1
    for a, b, p in zip(left, right, primes, strict=True):
        part = np.zeros(found.shape, np.int64)
        for at in range(0, a.shape[1], EXACT):
            part += (a[:, at:at + EXACT] @ b[:, at:at + EXACT].T).astype(np.int64)
        # Only the last of seven digits can leave 64 bits, where it wraps to the right sum.
        digit = balanced((part - found) % p * pow(modulus % p, -1, p), p) if modulus > 1 else balanced(part, p)
        with np.errstate(over="ignore"):
            found += digit * np.uint64(modulus % (1 << 64)).astype(np.int64)
        modulus *= p
    return found


def first_of(scores: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores among the given places (ascending), ties to the smaller place."""
    if len(among) > k:
        own = scores[among]
        least = np.partition(own, len(own) - k)[len(own) - k]
        above = among[own > least]
        among = np.concatenate([above, among[own == least][:k - len(above)]])
    return among[np.argsort(-scores[among], kind="stable")]


class Side:
    """Rows of one length in the order of their ids."""

    def __init__(self, table: pa.Table, width: int):
        table = table.sort_by([("vec_id", "ascending"), ("uid", "ascending")]).combine_chunks()
        self.uid, self.vec_id, self.label = (table.column(c).to_numpy() for c in ("uid", "vec_id", "label"))
        flat = table.column("vector").chunk(0).flatten()
        self.vector = flat.to_numpy(zero_copy_only=False).astype(np.int64).reshape(table.num_rows, width)
        self.wanted = table.column("wanted").to_pylist() if "wanted" in table.column_names else None


Hit = tuple[int, int, np.ndarray, np.ndarray]


def same_label(anchors: Side, rows: Side, primes: tuple[int, ...], k: int) -> Iterator[Hit]:
    """(anchor, 0, places of rows, scores): the first ``k`` other rows of an anchor's label."""
    for label in np.unique(anchors.label):
        at, among = np.flatnonzero(anchors.label == label), np.flatnonzero(rows.label == label)
        right = residues(rows.vector[among], primes)
        for start in range(0, len(at) if len(among) else 0, TILE):
            tile = at[start:start + TILE]
            scores = exact_products(residues(anchors.vector[tile], primes), right, primes)
            for i, score in zip(tile.tolist(), scores, strict=True):
                best = first_of(score, np.flatnonzero(rows.uid[among] != anchors.uid[i]), k)
                yield i, 0, among[best], score[best]


def other_labels(anchors: Side, rows: Side, primes: tuple[int, ...], k: int, low: int, high: int) -> Iterator[Hit]:
    """(anchor, positive score, places of rows, scores): the first ``k`` rows of other labels in each window."""
    right = residues(rows.vector, primes)
    for start in range(0, len(anchors.uid), TILE):
        scores = exact_products(residues(anchors.vector[start:start + TILE], primes), right, primes)
        for i, score in enumerate(scores, start):
            others = np.flatnonzero(rows.label != anchors.label[i])
            own = score[others]
            for positive in anchors.wanted[i]:
                inside = others[(own >= -(-low * positive // 100)) & (own <= high * positive // 100)]
                if len(inside):
                    best = first_of(score, inside, k)
                    yield i, positive, best, score[best]


def _dealt(df: DataFrame, mine: str, own: int, theirs: str, others: int) -> DataFrame:
    block = F.pmod(F.xxhash64("uid"), F.lit(own)).cast("int")
    # New columns under the old names: both sides come from one frame.
    return df.select(*[F.col(c).alias(c) for c in df.columns], block.alias(mine), F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(theirs))


def _searched(anchors: DataFrame, rows: DataFrame, blocks: tuple[int, int], search: Callable[[Side, Side], Iterator[Hit]]) -> DataFrame:
    """What ``search`` finds in each pair of a block of anchors and a block of rows of one length."""
    def task(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.schema([(x, pa.int64()) for x in ("anchor", "positive_score", "uid", "vec_id", "score")]).empty_table()
        width = key[0].as_py()
        own, others = Side(left, width), Side(right, width)
        hits = list(search(own, others))
        places = np.concatenate([at for _, _, at, _ in hits]) if hits else np.empty(0, np.int64)
        sizes = [len(at) for _, _, at, _ in hits]
        return pa.table({
            "anchor": pa.array(np.repeat(own.uid[[i for i, *_ in hits]] if hits else np.empty(0, np.int64), sizes), pa.int64()),
            "positive_score": pa.array(np.repeat(np.array([p for _, p, *_ in hits], np.int64), sizes)),
            "uid": pa.array(others.uid[places], pa.int64()), "vec_id": pa.array(others.vec_id[places], pa.int64()),
            "score": pa.array(np.concatenate([s for *_, s in hits]) if hits else [], pa.int64())})

    ship_package(rows.sparkSession)
    keys = ("width", "block", "anchor_block")
    left = _dealt(anchors, "anchor_block", blocks[1], "block", blocks[0]).groupBy(*keys)
    right = _dealt(rows, "block", blocks[0], "anchor_block", blocks[1]).groupBy(*keys)
    return left.cogroup(right).applyInArrow(task, FOUND)


def _first(found: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id", "uid")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)


def usable(vectors: DataFrame, anchor: Column, label: Column, scale: int) -> DataFrame:
    """uid, vec_id, label, anchor, width, vector (whole numbers), square of the rows that take part."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.transform(F.col("embedding").cast("array<double>"), lambda x: x * scale).alias("scaled"))
    fine = F.forall("scaled", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(2.0 ** 31)))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("scaled").isNotNull() & fine)
    rows = rows.withColumn("whole", F.transform("scaled", lambda x: F.floor(x)))
    square = F.aggregate("whole", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows = rows.withColumn("square", square).filter(F.col("square") < F.lit(2.0 ** 62) * F.lit(1 - 2.0 ** -40))
    return rows.select(F.monotonically_increasing_id().alias("uid"), "vec_id", "label", "anchor", F.size("whole").alias("width"),
                       F.col("whole").cast("array<int>").alias("vector"), "square")


def hard_negatives(vectors: DataFrame, anchor: Column, label: Column | None = None, scale: int = 256, positives: int = 5, negatives: int = 5,
                   low: int = LOW, high: int = HIGH, block: int = ROWS, anchor_block: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors``: vec_id, embedding, and the columns that ``anchor`` (true for anchors) and ``label`` are made of.
    """
    rows = checkpointed(usable(vectors, anchor, F.col("label") if label is None else label, scale))  # row numbers stay as they are
    anchors = rows.filter("anchor")
    facts = rows.agg(F.count("*"), F.count_if("anchor"), F.max("square")).first()
    blocks = max(1, -(-facts[0] // block)), max(1, -(-facts[1] // anchor_block))
    primes = primes_for(int((facts[2] or 0.0) * (1 + 2.0 ** -40)) + 1)
    rows, own = rows.select("width", "uid", "vec_id", "label", "vector"), ("width", "uid", "vec_id", "label", "vector")

    found = _searched(anchors.select(*own), rows, blocks, lambda a, r: same_label(a, r, primes, positives))
    first = checkpointed(_first(found, positives, "anchor").select("anchor", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    # Bounded lists: an anchor has ``positives`` scores at most.
    wanted = first.groupBy(F.col("anchor").alias("uid")).agg(F.collect_set("positive_score").alias("wanted"))
    asking = anchors.select(*own).join(wanted, "uid")
    found = _searched(asking, rows, blocks, lambda a, r: other_labels(a, r, primes, negatives, low, high))
    best = _first(found, negatives, "anchor", "positive_score").select("anchor", "positive_score", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = anchors.select(F.col("uid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return best.join(first, ["anchor", "positive_score"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
