"""SimHash near-duplicates by pigeonring filtering (operator 8).

A fingerprint's 64 bits are ``SEGMENTS`` segments on a ring. If two fingerprints differ in at most d bits, some
segment starts a chain whose first l segments differ in at most l * d / SEGMENTS bits together, for every l up
to the whole ring. The first segments of that chain have to be equal, so fingerprints are posted under each run
of equal-by-necessity segments (``arc``); pairs that meet there are checked along the rest of the chain, and only
those that pass it get the full Hamming check.

Equal fingerprints are one row before any pairing. An arc value shared by more than ``CROWD`` fingerprints is
not paired within: each member posts its bits outside the arc unchanged and with each single bit flipped, and
is linked to the least member of each such posting. Two fingerprints within two bits always share one, and two
that share one are within two bits, so the links join the same classes with a number of rows that grows with
the members, not with their pairs. (This holds for the bit distance of two; other distances are refused.)

Classes come from least labels passed along links with pointer jumping, written out every round.
Null texts have no words and fingerprint zero; texts below the shingle length are one shingle; null ids have
no say in a component's id; repeated rows are rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftlake.llm.common import in_arrow, only, slices
from siftlake.session import checkpointed, scratch_path

SEGMENTS, DISTANCE, SHINGLE, CROWD = 8, 2, 3, 64
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit majority of the shingles' hashes, as a signed integer."""
    import xxhash

    words = _WORDS.findall((text or "").encode().lower())  # bytes: A-Z alone
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    stops = ends[shingle - 1:].tolist() or [len(joined)]
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(64, np.int64), len(stops)
    for at in range(0, n, 1 << 16):
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts[at:at + (1 << 16)], stops[at:at + (1 << 16)], strict=False)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def with_fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash (of the text), fp."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                fps = [fingerprint(x, shingle) for x in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), pa.array(fps, pa.int64())], names=["doc_id", "text_hash", "fp"])

    rows = only(documents, doc_id="long", text="string").withColumn("text_hash", F.xxhash64("text"))
    return in_arrow(rows, task, "doc_id long, text_hash long, fp long")


def budgets(segments: int = SEGMENTS, distance: int = DISTANCE) -> list[int]:
    """Bits that the first l segments of a chain may differ in, for l from 1."""
    return [length * distance // segments for length in range(1, segments + 1)]


def _turned(fp: Column, first: int, segments: int) -> Column:
    """The ring turned so that segment ``first`` is lowest."""
    by = first * (64 // segments)
    return fp if by == 0 else F.shiftrightunsigned(fp, by).bitwiseOR(F.shiftleft(fp, 64 - by))


def postings(fps: DataFrame, segments: int = SEGMENTS, distance: int = DISTANCE) -> DataFrame:
    """fp, ring (first segment of the arc), turned (the ring from there), arc (its value)."""
    equal = sum(b == 0 for b in budgets(segments, distance))
    mask = (1 << (equal * (64 // segments))) - 1
    rings = F.array(*[F.struct(F.lit(i).alias("ring"), _turned(F.col("fp"), i, segments).alias("turned")) for i in range(segments)])
    rows = fps.select("fp", F.inline(rings))
    return rows.select("fp", "ring", "turned", F.col("turned").bitwiseAND(F.lit(mask)).alias("arc"))


def links(fps: DataFrame, segments: int = SEGMENTS, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """Pairs a < b of distinct fingerprints whose classes are those of all pairs within the distance."""
    if distance != 2 or 64 % segments:
        raise ValueError("bit distance 2, and segments that divide 64")
    step, most = 64 // segments, budgets(segments, distance)
    equal = sum(b == 0 for b in most)
    posted = postings(fps, segments, distance)
    # Only 1/segments of a crowd's posting is kept apart; sizes are combined before the shuffle.
    sizes = posted.groupBy("ring", "arc").agg(F.count("*").alias("members")).filter("members > 1")
    met = checkpointed(posted.join(sizes, ["ring", "arc"]))

    small = met.filter(F.col("members") <= crowd)
    a = small.select("ring", "arc", F.col("fp").alias("a"), F.col("turned").alias("ta"))
    b = small.select("ring", "arc", F.col("fp").alias("b"), F.col("turned").alias("tb"))
    pairs = a.join(b, ["ring", "arc"]).filter("a < b")
    differ = F.col("ta").bitwiseXOR(F.col("tb"))
    viable = F.lit(True)
    for length in range(equal + 1, segments + 1):  # chains up to each length
        kept = differ if length == segments else differ.bitwiseAND(F.lit((1 << (length * step)) - 1))
        viable = viable & (F.bit_count(kept) <= most[length - 1])
    near = pairs.filter(viable).filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance).select("a", "b")

    crowds = met.filter(F.col("members") > crowd)
    flips = F.array(F.lit(0).cast("long"), *[F.shiftleft(F.lit(1).cast("long"), i) for i in range(equal * step, 64)])
    variants = crowds.select("ring", "fp", F.explode(flips).alias("flip"), "turned").select(
        "ring", "fp", F.col("turned").bitwiseXOR(F.col("flip")).alias("variant"))
    least = variants.groupBy("ring", "variant").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1")
    star = variants.join(least, ["ring", "variant"]).filter("fp > a").select("a", F.col("fp").alias("b"))
    return near.unionByName(star).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """node, root (the least node reachable) of every node in a pair."""
    both = pairs.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("node"), F.col("a").alias("other")))
    both = checkpointed(both)
    labels = checkpointed(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root")))
    while True:
        theirs = labels.select(F.col("node").alias("other"), F.col("root").alias("theirs"))
        passed = both.join(theirs, "other").groupBy("node").agg(F.min("theirs").alias("theirs"))
        merged = labels.join(passed, "node").select("node", F.least("root", "theirs").alias("next"), F.col("root").alias("before"))
        jump = labels.select(F.col("node").alias("next"), F.col("root").alias("far"))
        new = checkpointed(merged.join(jump, "next").select("node", F.least("next", "far").alias("root"), "before"))
        if new.filter("root <> before").isEmpty():
            return new.select("node", "root")
        labels = new.select("node", "root")


def classes(documents: DataFrame, shingle: int = SHINGLE, segments: int = SEGMENTS, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """Per document: doc_id, text_hash, fp, root (the least fingerprint of its class), component_id (the class's least doc_id).

    Only the root tells classes apart: ids can be null in all of a class, or lie in several classes.
    """
    spark = documents.sparkSession
    folder = scratch_path(spark, "simhash")
    with_fingerprints(documents, shingle).write.parquet(f"{folder}/documents")
    docs = spark.read.parquet(f"{folder}/documents")
    docs.groupBy("fp").agg(F.min("doc_id").alias("least")).write.parquet(f"{folder}/distinct")
    distinct = spark.read.parquet(f"{folder}/distinct")
    roots = components(links(distinct.select("fp"), segments, distance, crowd))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return docs.join(rooted.select("fp", "root").join(ids, "root"), "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id."""
    return classes(documents).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(documents: DataFrame) -> DataFrame:
    """The documents, one of each class: its least doc_id, of equal ids the least text hash, of equal rows one."""
    rows = classes(documents)
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("kept"))
    first = first.select(F.col("kept.doc_id").alias("_kept_id"), F.col("kept.text_hash").alias("_kept_hash")).distinct()
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    own = documents.select(whole.alias("_row"), F.col("doc_id").cast("long").alias("_kept_id"), F.xxhash64(F.col("text").cast("string")).alias("_kept_hash"))
    on = own["_kept_id"].eqNullSafe(first["_kept_id"]) & (own["_kept_hash"] == first["_kept_hash"])
    place = F.row_number().over(Window.partitionBy("_kept_id", "_kept_hash").orderBy("_kept_id"))
    return own.join(first, on, "left_semi").withColumn("_place", place).filter("_place = 1").select("_row.*")
