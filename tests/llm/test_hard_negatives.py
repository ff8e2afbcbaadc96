"""Hard negatives against plain loops over all scores."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftlake.llm import queries
from siftlake.llm.hard_negatives import PRIMES, exact_products, first_of, hard_negatives, primes_for, residues

SCHEMA = "vec_id long, embedding array<double>, label int, uid string, rank int, anchor int, width int"


def brute(rows, scale=256, anchors=lambda i: i % 100 == 0, label=lambda i, y: y):
    used = []
    for i, v, y in rows:
        if i is None or y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(scale * x) for x in v]
        if sum(x * x for x in w) < 2 ** 62:
            used.append((i, w, label(i, y)))
    out = []
    for at, (i, v, y) in enumerate(used):
        if not anchors(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, k, z) for k, (j, w, z) in enumerate(used) if k != at and len(w) == len(v))
        others = [(-s, j) for s, j, _, z in scored if z != y]
        for s, j in [(-s, j) for s, j, _, z in scored if z == y][:5]:
            inside = [(n, m) for n, m in others if 80 * s <= 100 * n <= 100 * s][:5]
            out += [(i, j, r, m, s, n) for r, (n, m) in enumerate(inside, 1)]
    return sorted(out)


def mined(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA)
    got = hard_negatives(df, F.col("vec_id") % 100 == 0, **more)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("blocks", [(8192, 16384), (50, 3)])
@pytest.mark.parametrize("width", [1, 5, 70, 150])
def test_against_all_scores(spark, blocks, width):
    rng = np.random.default_rng(width)
    centre = rng.normal(size=(4, width))
    rows = []
    for i in range(700):
        y = int(rng.integers(4))
        rows.append((i, (centre[rng.integers(4)] + rng.normal(size=width)).tolist(), y))
    got = mined(spark, rows, block=blocks[0], anchor_block=blocks[1])
    assert got == brute(rows) and len(got) > 10


def test_odd_rows(spark):
    rng = np.random.default_rng(9)
    good = [(i, rng.uniform(0.2, 1, 3).tolist(), i % 2) for i in range(60)]
    hot = [(1000 + i, [0.5, 0.5, 0.5], 1) for i in range(80)]
    odd = [(None, [1.0, 1.0, 1.0], 0), (300, None, 0), (400, [1.0, None, 1.0], 1), (500, [1.0, math.inf, 1.0], 1), (600, [math.nan, 1.0, 1.0], 1), (700, [1.0, 1.0, 1.0], None),
           (800, [], 0), (801, [], 1), (802, [], 0), (900, [1.0], 1), (901, [2.0], 1), (902, [1.5], 0), (0, [0.3, 0.9, 0.3], 0), (0, [0.3, 0.9, 0.3], 0), (100, [1e30, 0.0, 0.0], 0),
           (-100, [0.4, 0.1, 0.9], 1), (1, [0.5, 0.5, 0.5], 1), (1100, [0.0, 0.0, 0.0], 0), (1200, [-1.0, -1.0, -1.0], 0), (1300, [3e4, 2e4, 1e4], 1), (1301, [3e4, 2e4, 1e4], 1), (1302, [3e4, 2e4, 9e3], 0)]
    rows = good + hot + odd
    assert mined(spark, rows, block=40) == brute(rows)
    assert mined(spark, [x for x in rows if x[0] is None or x[0] % 100]) == []
    assert mined(spark, []) == []


def test_the_query_on_the_given_vectors(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = sorted(map(tuple, queries.op12_hard_negatives(spark, folder).collect()))
    assert got == brute(rows, label=lambda i, y: (y + 1) % 10 if i % 7 == 0 else y) and got


def test_products_are_exact():
    rng = np.random.default_rng(4)
    for largest in (1, 300, 2 ** 15, 2 ** 27):
        for width in (1, 7, 64, 65, 130):
            m = min(largest, int(math.sqrt(2 ** 61 / width)))
            a, b = rng.integers(-m, m + 1, (9, width)), rng.integers(-m, m + 1, (11, width))
            a[0] = b[0] = m
            b[1] = -m
            used = primes_for(m * m * width)
            got = exact_products(residues(a, used), residues(b, used), used)
            assert got.tolist() == [[sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for s in b] for r in a]
    assert primes_for(2 ** 62) == PRIMES and math.prod(PRIMES) > 2 ** 63 and (max(PRIMES) // 2) ** 2 * 64 < 2 ** 24


def test_first_of_breaks_ties_by_place():
    scores = np.array([3, 5, 5, 1, 5, 3])
    assert first_of(scores, np.arange(6), 2).tolist() == [1, 2]
    assert first_of(scores, np.arange(6), 4).tolist() == [1, 2, 4, 0]
    assert first_of(scores, np.array([3, 5]), 4).tolist() == [5, 3]
