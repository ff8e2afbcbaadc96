"""Quality of documents by attention-based multiple-instance learning (operator 10).

A document is a bag of passages, every ``PASSAGE`` bytes of its text. A passage is encoded from the square roots
of its hashed byte-trigram shares by a tanh layer; gated attention, softmax(w (tanh(V h) * sigmoid(U h))) over
the passages of the document, weighs the encodings; a logistic layer scores their weighted sum. All layers learn
together from document labels alone, in numpy by backpropagation with Adam, on a bounded sample: ``DOCS`` labelled
ids a class, those with the smallest hash, with one text each, the one of the smallest hash, and ``BAG`` passages
spread over the whole of it. An id with both labels is not learnt from.

A null or empty text is one empty passage. Without documents of both classes to learn from, every score is 0.5.
Null ids are scored and never learnt from; repeated rows are rows of their own; an empty table gives no rows.
No input but text enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlake.llm.common import first_by_hash, in_arrow, only, slices
from siftlake.session import checkpointed

PASSAGE, BUCKETS, ENCODING, ATTENTION = 512, 512, 24, 12
DOCS, BAG = 1500, 32
EPOCHS, BATCH, RATE, SEED = 12, 128, 0.01, 11
CUT = 0.7


def bags(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes in a row, the start of each passage, the document of each passage; an empty text has one passage."""
    starts, docs, at = [], [], 0
    for i, text in enumerate(texts):
        own = range(at, at + max(1, len(text)), PASSAGE)
        starts += own
        docs += [i] * len(own)
        at += len(text)
    return np.frombuffer(b"".join(texts), np.uint8), np.array(starts, np.int64), np.array(docs, np.int64)


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per passage, square roots of its trigrams' shares by bucket."""
    n = len(starts)
    out = np.zeros((n, BUCKETS), np.float32)
    if len(data) < 3:
        return out
    wide = data.astype(np.uint32)
    hashed = ((wide[:-2] * 65536 + wide[1:-1] * 256 + wide[2:]) * np.uint32(2654435761)) >> np.uint32(23)
    sizes = np.maximum(0, ends - starts - 2)
    where = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    cells = np.repeat(np.arange(n) * BUCKETS, sizes) + hashed[where]
    out += np.bincount(cells, minlength=n * BUCKETS).reshape(n, BUCKETS)
    out /= np.maximum(1, sizes)[:, None].astype(np.float32)
    return np.sqrt(out, out=out)


def passage_ends(starts: np.ndarray, docs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The end of each passage: the next ``PASSAGE`` bytes or its document's end."""
    return np.minimum(starts + PASSAGE, np.cumsum(sizes)[docs])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def new_weights(seed: int = SEED) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    return {"enc": rng.normal(0, 0.3, (BUCKETS, ENCODING)), "enc0": np.zeros(ENCODING), "v": rng.normal(0, 0.3, (ENCODING, ATTENTION)),
            "u": rng.normal(0, 0.3, (ENCODING, ATTENTION)), "w": rng.normal(0, 0.3, ATTENTION), "out": rng.normal(0, 0.3, ENCODING), "out0": np.zeros(1)}


def forward(w: dict, x: np.ndarray, first: np.ndarray) -> tuple:
    """Probabilities of bags and what the way back needs. ``first``: each bag's first passage; bags lie in a row."""
    h = np.tanh(x @ w["enc"] + w["enc0"])
    t, s = np.tanh(h @ w["v"]), _sigmoid(h @ w["u"])
    e = (t * s) @ w["w"]
    size = np.diff([*first.tolist(), len(x)])
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, first), size))
    a = e / np.repeat(np.add.reduceat(e, first), size)
    z = np.add.reduceat(a[:, None] * h, first, axis=0)
    return _sigmoid(z @ w["out"] + w["out0"]), (h, t, s, a, z, size)


def loss_and_gradients(w: dict, x: np.ndarray, first: np.ndarray, labels: np.ndarray) -> tuple[float, dict]:
    """Mean cross-entropy over bags and its gradients."""
    p, (h, t, s, a, z, size) = forward(w, x, first)
    loss = -float(np.mean(labels * np.log(p + 1e-9) + (1 - labels) * np.log(1 - p + 1e-9)))
    d = (p - labels) / len(labels)
    dz = np.repeat(d[:, None] * w["out"], size, axis=0)
    da = (dz * h).sum(axis=1)
    de = a * (da - np.repeat(np.add.reduceat(a * da, first), size))
    dt, ds = de[:, None] * w["w"] * s, de[:, None] * w["w"] * t
    dtv, dsu = dt * (1 - t * t), ds * s * (1 - s)
    dh = a[:, None] * dz + dtv @ w["v"].T + dsu @ w["u"].T
    dx = dh * (1 - h * h)
    return loss, {"enc": x.T @ dx, "enc0": dx.sum(axis=0), "v": h.T @ dtv, "u": h.T @ dsu, "w": (t * s).T @ de, "out": z.T @ d, "out0": np.array([d.sum()])}


def train(x: np.ndarray, docs: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """``docs``: the bag of each passage, ascending from 0; ``labels`` by bag."""
    w, rng = new_weights(), np.random.default_rng(SEED)
    m, v, step = {k: np.zeros_like(y) for k, y in w.items()}, {k: np.zeros_like(y) for k, y in w.items()}, 0
    first = np.searchsorted(docs, np.arange(len(labels) + 1))
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for start in range(0, len(order), BATCH):
            chosen = order[start:start + BATCH]
            rows = np.concatenate([np.arange(first[i], first[i + 1]) for i in chosen])
            sizes = first[chosen + 1] - first[chosen]
            _, g = loss_and_gradients(w, x[rows].astype(np.float64), np.cumsum(sizes) - sizes, labels[chosen])
            step += 1
            for k in w:
                grad = g[k] + 1e-4 * w[k]
                m[k], v[k] = 0.9 * m[k] + 0.1 * grad, 0.999 * v[k] + 0.001 * grad * grad
                w[k] = w[k] - RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return w


def score(w: dict | None, texts: list[str | None]) -> list[float]:
    """Probability of label 1 of each whole text."""
    if w is None or not texts:
        return [0.5] * len(texts)
    data = [(x or "").encode() for x in texts]
    flat, starts, docs = bags(data)
    ends = passage_ends(starts, docs, np.array([len(x) for x in data]))
    x = features(flat, starts, ends)
    p, _ = forward(w, x, np.searchsorted(docs, np.arange(len(texts))))
    return np.clip(p, 0, 1).tolist()


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2


def sample(documents: DataFrame, labels: DataFrame, docs: int = DOCS, bag: int = BAG) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages' features, the bag of each, and labels by bag, from labelled documents that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).filter("quality = other")
    known = checkpointed(known.select("doc_id", "quality"))
    chosen = {r["doc_id"]: r["quality"] for r in first_by_hash(known, "quality", "doc_id", docs).collect()}
    if len(set(chosen.values())) < 2:
        return np.empty((0, BUCKETS), np.float32), np.empty(0, np.int64), np.empty(0)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = []
                for doc_id, text in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    data = (text or "").encode()
                    places = list(range(0, max(1, len(data)), PASSAGE))
                    spread = np.unique(np.linspace(0, len(places) - 1, min(bag, len(places))).astype(int)).tolist()
                    out += [(doc_id, i, data[places[i]:places[i] + PASSAGE]) for i in spread]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.binary())], names=["doc_id", "place", "passage"])

    rows = only(documents, doc_id="long", text="string").filter(F.col("doc_id").isin(list(chosen)))
    rows = rows.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))  # one text an id, however many rows hold it
    found = in_arrow(rows, cut, "doc_id long, place int, passage binary").orderBy("doc_id", "place").toArrow()
    if not found.num_rows:
        return np.empty((0, BUCKETS), np.float32), np.empty(0, np.int64), np.empty(0)
    passages = found["passage"].to_pylist()
    sizes = np.array([len(x) for x in passages])
    ends = np.cumsum(sizes)
    x = features(np.frombuffer(b"".join(passages), np.uint8), ends - sizes, ends)
    ids, bag_of = np.unique(found["doc_id"].to_numpy(), return_inverse=True)
    return x, bag_of, np.array([chosen[i] for i in ids.tolist()], np.float64)


def fit(documents: DataFrame, labels: DataFrame) -> dict[str, np.ndarray] | None:
    x, docs, y = sample(documents, labels)
    return train(x, docs, y) if len(set(y.tolist())) == 2 else None


def quality_scores(documents: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """Learn and score: doc_id, held_out, score, predicted."""
    weights = fit(documents, labels)
    shared = documents.sparkSession.sparkContext.broadcast(weights)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = score(shared.value, part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"])

    rows = in_arrow(only(documents, doc_id="long", text="string"), task, "doc_id long, score double")
    return rows.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
