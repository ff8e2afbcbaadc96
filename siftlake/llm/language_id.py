"""Language of every text from a bidirectional gated recurrent network over bytes (operator 7).

A text's UTF-8 bytes are cut into windows of ``WINDOW`` that cover all of it; windows of many texts run side by
side. One recurrent layer reads each window forwards and one backwards, a softmax over both states labels every
byte, and a text's probabilities are the mean over all its bytes. Training is numpy backpropagation through
time on a bounded sample: ``DOCS`` ids a language, those with the smallest hash, with one text each, the one of
the smallest hash (for at most ``LANGUAGES`` languages, the most frequent ones), and ``WINDOWS`` windows spread
over the whole of each. An id whose rows name several languages is not learnt from.

A null text or one without a letter is ``und`` with score 0, as is every text if there was nothing to learn from;
an empty table gives no rows; repeated rows are rows of their own; equal probabilities go to the language first
in alphabetical order. No input but text enters a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from siftlake.llm.common import first_by_hash, in_arrow, only, slices
from siftlake.session import checkpointed

WINDOW, HIDDEN = 64, 10
DOCS, WINDOWS, LANGUAGES = 250, 12, 64
EPOCHS, BATCH, RATE, SEED = 4, 256, 0.02, 7
#: Windows that run side by side.
SIDE = 2048
PAD = 256


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.tanh(np.multiply(x, 0.5, out=x), out=x)
    x *= 0.5
    x += 0.5
    return x


def new_weights(classes: int, hidden: int = HIDDEN, seed: int = SEED) -> dict[str, np.ndarray]:
    """Per direction: a row of three gates' inputs for each byte (and for padding), recurrent weights; the output layer."""
    rng = np.random.default_rng(seed)
    w = {}
    for d in ("f", "b"):
        w["x" + d] = rng.normal(0, 0.5, (257, 3 * hidden)).astype(np.float32)
        w["u" + d] = rng.normal(0, hidden ** -0.5, (hidden, 2 * hidden)).astype(np.float32)
        w["c" + d] = rng.normal(0, hidden ** -0.5, (hidden, hidden)).astype(np.float32)
    w["out"] = rng.normal(0, 0.1, (2 * hidden, classes)).astype(np.float32)
    w["bias"] = np.zeros(classes, np.float32)
    return w


def _states(w: dict, d: str, codes: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (step, window, unit) of one direction; codes are (step, window). ``keep`` collects what the way back needs."""
    x, u, c = w["x" + d], w["u" + d], w["c" + d]
    steps, n, hidden = len(codes), codes.shape[1], c.shape[0]
    out = np.empty((steps, n, hidden), np.float32)
    h = np.zeros((n, hidden), np.float32)
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        given = x.take(codes[t], axis=0)
        gates = h @ u
        gates += given[:, :2 * hidden]
        gates = _sigmoid(gates)
        z, r = gates[:, :hidden], gates[:, hidden:]
        reset = r * h
        cand = reset @ c
        cand += given[:, 2 * hidden:]
        np.tanh(cand, out=cand)
        if keep is not None:
            keep.append((t, h, z, r, reset, cand))
        h = h + z * (cand - h)
        out[t] = h
    return out


def byte_probabilities(w: dict, codes: np.ndarray) -> np.ndarray:
    """Probabilities (step, window, class) of every byte's label."""
    steps, n = codes.shape
    hidden = w["cf"].shape[0]
    logits = _states(w, "f", codes).reshape(-1, hidden) @ w["out"][:hidden]
    logits += _states(w, "b", codes).reshape(-1, hidden) @ w["out"][hidden:]
    logits += w["bias"]
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits.reshape(steps, n, -1)


def loss_and_gradients(w: dict, codes: np.ndarray, labels: np.ndarray) -> tuple[float, dict]:
    """Mean cross-entropy over the bytes that are no padding, and its gradients by backpropagation through time."""
    steps, n = codes.shape
    hidden = w["cf"].shape[0]
    real = (codes != PAD).astype(np.float32)
    total = max(1.0, float(real.sum()))
    kept: dict[str, list] = {"f": [], "b": []}
    both = np.concatenate([_states(w, d, codes, kept[d]) for d in ("f", "b")], axis=2)
    logits = both @ w["out"] + w["bias"]
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    at = np.arange(n)
    loss = float(-(np.log(p[:, at, labels] + 1e-9) * real).sum() / total)
    p[:, at, labels] -= 1
    p *= (real / total)[:, :, None]
    flat = p.reshape(steps * n, -1)
    g = {k: np.zeros_like(v) for k, v in w.items()}
    g["out"] = both.reshape(steps * n, -1).T @ flat
    g["bias"] = flat.sum(axis=0)
    back = (flat @ w["out"].T).reshape(steps, n, 2 * hidden)
    for k, d in enumerate(("f", "b")):
        u, c = w["u" + d], w["c" + d]
        dh = np.zeros((n, hidden), np.float32)
        for t, h, z, r, reset, cand in reversed(kept[d]):
            dh = dh + back[t][:, k * hidden:(k + 1) * hidden]
            dcand = dh * z * (1 - cand * cand)
            dz = dh * (cand - h) * z * (1 - z)
            dreset = dcand @ c.T
            dr = dreset * h * r * (1 - r)
            gates = np.concatenate([dz, dr], axis=1)
            g["c" + d] += reset.T @ dcand
            g["u" + d] += h.T @ gates
            np.add.at(g["x" + d], codes[t], np.concatenate([gates, dcand], axis=1))
            dh = dh * (1 - z) + dreset * r + gates @ u.T
    return loss, g


def train(codes: np.ndarray, labels: np.ndarray, classes: int, epochs: int = EPOCHS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Weights after Adam over shuffled batches; codes are (window, step)."""
    w = new_weights(classes, seed=seed)
    rng = np.random.default_rng(seed)
    m, v, step = {k: np.zeros_like(x) for k, x in w.items()}, {k: np.zeros_like(x) for k, x in w.items()}, 0
    for _ in range(epochs):
        order = rng.permutation(len(codes))
        for start in range(0, len(order), BATCH):
            rows = order[start:start + BATCH]
            _, g = loss_and_gradients(w, codes[rows].T, labels[rows])
            step += 1
            norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            for k in w:
                x = g[k] * min(1.0, 1.0 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * x
                v[k] = 0.999 * v[k] + 0.001 * x * x
                w[k] -= RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return {k: x.astype(np.float32) for k, x in w.items()}


def windows(data: bytes, size: int = WINDOW) -> np.ndarray:
    """All bytes in rows of ``size``, the last one padded."""
    rows = -(-len(data) // size)
    codes = np.full(rows * size, PAD, np.int16)
    codes[:len(data)] = np.frombuffer(data, np.uint8)
    return codes.reshape(rows, size)


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0


def sample(documents: DataFrame, docs: int = DOCS, per_doc: int = WINDOWS) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Windows, their label numbers and the labels, from rows that are not held out."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    names = [r["lang"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()]
    # One row an id, however many rows hold it; an id under several languages names none and is left out.
    ids = rows.groupBy("doc_id").agg(F.min("lang").alias("lang"), F.max("lang").alias("other"), F.min(F.xxhash64("text")).alias("text_hash"))
    ids = ids.filter((F.col("lang") == F.col("other")) & F.col("lang").isin(names))
    ids = checkpointed(ids.select("doc_id", "lang", "text_hash"))
    chosen = [(r["doc_id"], r["text_hash"]) for r in first_by_hash(ids, "lang", "doc_id", docs).collect()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = []
                for doc_id, lang, text in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    codes = windows(text.encode())
                    at = np.unique(np.linspace(0, len(codes) - 1, min(per_doc, len(codes))).astype(int)) if len(codes) else []
                    out += [(doc_id, lang, int(i), codes[i].tolist()) for i in at]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([x[0] for x in out], pa.int64()), "lang": pa.array([x[1] for x in out], pa.string()),
                    "place": pa.array([x[2] for x in out], pa.int32()), "codes": pa.array([x[3] for x in out], pa.list_(pa.int16()))})

    # One text an id: that of the smallest hash. Equal rows are taken once, before their text is cut.
    picked = rows.filter(F.col("doc_id").isin([i for i, _ in chosen]) & F.xxhash64("text").isin([h for _, h in chosen])) if chosen else rows.limit(0)
    picked = picked.withColumn("text_hash", F.xxhash64("text")).groupBy("doc_id").agg(F.min_by(F.struct("lang", "text"), "text_hash").alias("x")).select("doc_id", "x.*")
    found = in_arrow(picked, cut, "doc_id long, lang string, place int, codes array<smallint>").orderBy("doc_id", "place").toArrow()
    names = sorted(names)
    codes = np.array(found["codes"].to_pylist(), np.int16).reshape(-1, WINDOW)
    return codes, np.array([names.index(x) for x in found["lang"].to_pylist()], np.int64), names


class LanguageModel:
    def __init__(self, weights: dict[str, np.ndarray] | None, names: list[str]):
        self.weights, self.names = weights, names

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and probability of each whole text."""
        data = [(x or "").encode() if x and any(map(str.isalpha, x)) else b"" for x in texts]
        rows = np.array([-(-len(x) // WINDOW) for x in data])
        total = int(rows.sum())
        if self.weights is None or not total:
            return ["und"] * len(texts), [0.0] * len(texts)
        codes = np.concatenate([windows(x) for x in data if x])
        order = np.repeat(np.arange(len(data)), rows)
        sums = np.zeros((len(data), len(self.names)))
        for start in range(0, total, SIDE):
            part = np.ascontiguousarray(codes[start:start + SIDE].T)
            p = byte_probabilities(self.weights, part)
            p[part == PAD] = 0
            np.add.at(sums, order[start:start + SIDE], p.sum(axis=0, dtype=np.float64))
        mean = sums / np.maximum(1, [len(x) for x in data])[:, None]
        best = mean.argmax(axis=1)
        found = [(self.names[k], min(1.0, float(m[k]))) if n else ("und", 0.0) for k, m, n in zip(best.tolist(), mean, rows, strict=True)]
        return [x for x, _ in found], [s for _, s in found]


def fit(documents: DataFrame, docs: int = DOCS) -> LanguageModel:
    """Learn from a bounded sample of the labelled documents that are not held out."""
    codes, labels, names = sample(documents, docs)
    return LanguageModel(train(codes, labels, len(names)), names) if len(codes) else LanguageModel(None, [])


def with_language(documents: DataFrame, model: LanguageModel, pred: str = "lang_pred", score: str = "score", keep: bool = True) -> DataFrame:
    """The documents (or doc_id alone) with the predicted language and its probability."""
    base = documents if keep else documents.select("doc_id", "text")
    shared = documents.sparkSession.sparkContext.broadcast((model.weights, model.names))
    passed = [f for f in base.schema.fields if keep or f.name != "text"]
    names = [f.name for f in passed]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = LanguageModel(*shared.value)
        for batch in batches:
            for part in slices(batch):
                langs, scores = own.predict(part.column("text").to_pylist())
                found = [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays([*[part.column(name) for name in names], *found], names=[*names, pred, score])

    out = StructType([*passed, StructField(pred, StringType()), StructField(score, DoubleType())])
    return in_arrow(base, task, out)


def predict_languages(documents: DataFrame) -> DataFrame:
    """Learn and predict: doc_id, held_out, lang_pred, score."""
    model = fit(documents)
    found = with_language(only(documents, doc_id="long", text="string"), model, keep=False)
    return found.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")
