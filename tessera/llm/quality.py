"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of 64 words. Every passage is encoded (counts of byte kinds, word shapes,
repetition and hashed words, then a learned layer); learned gated attention weighs the passages; the
weighted sum is scored. Only documents carry labels: attention finds the passages that decide.
The text alone is read: no id, language, source or label enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, text_slices

PASSAGE, HASHED, HIDDEN, ATTEND = 64, 16, 24, 12
_MARKS = b"!.,|#$%&*?:;-()\n"
_KINDS = np.full(256, 5, np.uint8)
_KINDS[65:91], _KINDS[97:123], _KINDS[48:58], _KINDS[128:] = 0, 1, 2, 3
_KINDS[[9, 11, 12, 13, 32]] = 4
for _i, _c in enumerate(_MARKS):
    _KINDS[_c] = 6 + _i
N_KINDS = 6 + len(_MARKS)
N_FEATURES = N_KINDS + 8 + HASHED


def passages(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of each passage, and each text's range of passages; a text without words has one passage of zeros."""
    w = Words(data, off)
    texts = len(w.n)
    per = np.maximum(1, -(-w.n // PASSAGE))
    span = np.concatenate([[0], np.cumsum(per)])
    x = np.zeros((span[-1], N_FEATURES), np.float32)
    if not len(w.start):
        return x, span
    inside = np.arange(len(w.start)) - np.repeat(w.first[:-1], w.n)
    passage = np.repeat(span[:-1], w.n) + inside // PASSAGE
    begin = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
    at = passage[begin]
    words = np.diff(np.append(begin, len(passage))).astype(np.float32)
    # bytes of a passage: from its first word to the next passage's first word, or its text's end
    owner = np.searchsorted(span, at, "right") - 1
    stop = np.append(w.start[begin[1:]], len(data))
    stop = np.minimum(stop, off[owner + 1])
    kinds = _KINDS[data]
    n_bytes = (stop - w.start[begin]).astype(np.float32)
    for k in range(N_KINDS):
        total = np.concatenate([[0], np.cumsum(kinds == k, dtype=np.int32)])
        x[at, k] = (total[stop] - total[w.start[begin]]) / n_bytes
    add = lambda v: np.add.reduceat(v.astype(np.float32), begin) / words
    length = w.end - w.start
    same = [np.concatenate([np.zeros(min(lag, len(inside)), bool), (w.hash[lag:] == w.hash[:-lag]) & (inside[lag:] >= lag)]) for lag in (1, 2, 3)]
    shape = [np.log1p(words) / 5, add(length) / 10, add(length == 1), add(length > 20), *(add(s) for s in same), add(_KINDS[data[w.start]] == 0)]
    for k, v in enumerate(shape):
        x[at, N_KINDS + k] = v
    slot, sign = (w.hash >> np.uint64(5)) % np.uint64(HASHED), 1 - 2 * (w.hash & np.uint64(1)).astype(np.float32)
    flat = np.bincount(passage * HASHED + slot.astype(np.int64), weights=sign, minlength=len(x) * HASHED).reshape(len(x), HASHED)
    x[at, N_KINDS + 8 :] = flat[at] / words[:, None]
    return x, span


class AttentionModel:
    """h = tanh(x W); attention = softmax over a bag of (tanh(h V) * sigmoid(h U)) w; score = sigmoid(sum(attention * h) c)."""

    def __init__(self, base: float = 0.5, seed: int = 5):
        r = np.random.default_rng(seed)
        draw = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.mean, self.scale = np.zeros(N_FEATURES, np.float32), np.ones(N_FEATURES, np.float32)
        self.p = {"W": draw(N_FEATURES, HIDDEN), "b": np.zeros(HIDDEN, np.float32), "V": draw(HIDDEN, ATTEND), "U": draw(HIDDEN, ATTEND), "w": draw(ATTEND), "c": np.zeros(HIDDEN, np.float32), "d": np.array([np.log(base / (1 - base))], np.float32)}

    def forward(self, x: np.ndarray, span: np.ndarray) -> dict:
        p, begin, n = self.p, span[:-1], np.diff(span)
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(z @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * g) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, begin), n))
        a = e / np.repeat(np.add.reduceat(e, begin), n)
        bag = np.add.reduceat(h * a[:, None], begin)
        return {"z": z, "h": h, "t": t, "g": g, "a": a, "bag": bag, "y": 1 / (1 + np.exp(-(bag @ p["c"] + p["d"][0])))}

    def gradient(self, x: np.ndarray, span: np.ndarray, y: np.ndarray) -> dict:
        """Of the mean log loss, by parameter."""
        p, n, begin = self.p, np.diff(span), span[:-1]
        f = self.forward(x, span)
        dy = (f["y"] - y) / len(y)
        dbag = np.repeat(dy[:, None] * p["c"], n, axis=0)
        da = (dbag * f["h"]).sum(1)
        de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, begin), n))
        dt, dg = de[:, None] * p["w"] * f["g"] * (1 - f["t"] ** 2), de[:, None] * p["w"] * f["t"] * f["g"] * (1 - f["g"])
        dh = (dbag * f["a"][:, None] + dt @ p["V"].T + dg @ p["U"].T) * (1 - f["h"] ** 2)
        return {
            "W": f["z"].T @ dh, "b": dh.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ dg,
            "w": (f["t"] * f["g"]).T @ de, "c": f["bag"].T @ dy, "d": dy.sum(keepdims=True),
        }

    def fit(self, x: np.ndarray, span: np.ndarray, y: np.ndarray, steps: int = 200, rate: float = 0.02, decay: float = 1e-4) -> AttentionModel:
        """Full-batch Adam on the log loss."""
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        m, v = ({k: np.zeros_like(q) for k, q in self.p.items()} for _ in range(2))
        for step in range(1, steps + 1):
            grad = self.gradient(x, span, y)
            for k, q in self.p.items():
                d = grad[k] + decay * q
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.99 * v[k] + 0.01 * d * d
                q -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text is a multiple of 5; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, max_docs: int = 4000) -> AttentionModel:
    """Fit on at most ``max_docs`` labelled documents (those with the smallest hash of the id), held-out ids excluded.

    Labels that are null, or ids with both labels, are left out; of rows that repeat an id, the smallest text counts. Without both classes every score is the
    share of label 1 (0.5 without labels).
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("y2")).where("y = y2")
    # bounded by max_docs, hence safe to broadcast
    sample = known.select("doc_id", "y").orderBy(F.xxhash64(F.lit(3), "doc_id"), "doc_id").limit(max_docs)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, off in text_slices(batch, "t"):
                x, span = passages(data, off)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array([x[span[i] : span[i + 1]].tobytes() for i in range(b - a)], pa.binary())], names=["id", "y", "x"]
                )

    rows = docs.select(F.col("text").alias("t"), F.col("doc_id").cast("long").alias("id")).join(F.broadcast(sample.withColumnRenamed("doc_id", "id")), "id")
    # an id that documents repeat counts once, by its smallest text, so the driver gets max_docs rows at most
    rows = rows.groupBy("id").agg(F.min(F.struct("t", "y")).alias("r")).select("id", "r.t", "r.y")
    got = rows.select("t", "id", F.col("y").cast("int").alias("y")).mapInArrow(encode, "id long, y int, x binary").toArrow().to_pylist()
    got.sort(key=lambda r: (r["id"], r["x"]))
    y = np.array([r["y"] for r in got], np.float32)
    if len(set(y.tolist())) < 2:
        return AttentionModel(min(0.99, max(0.01, float(y.mean()))) if len(y) else 0.5)
    x = [np.frombuffer(r["x"], np.float32).reshape(-1, N_FEATURES) for r in got]
    return AttentionModel(float(y.mean())).fit(np.concatenate(x), np.concatenate([[0], np.cumsum([len(v) for v in x])]), y)


def score_quality(docs: DataFrame, model: AttentionModel, score_col: str = "score", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its ``keep`` columns) with a score (0 to 1, higher: label 1 likelier) for each row, over the whole text.

    Null and empty texts are one passage without words and get that passage's score. The score column
    replaces one of the same name; all other columns pass through. An empty table stays empty.
    """
    cols = [c for c in (keep or docs.columns) if c != score_col]
    packed = docs.select(F.col("text").alias("t"), F.struct(*[F.col(c) for c in cols]).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, off in text_slices(batch, "t"):
                y = model.forward(*passages(data, off))["y"].astype(np.float64)
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(a, b - a), pa.array(y, pa.float64())], names=["row", "score"])

    kind = packed.schema["row"].dataType.simpleString()
    scored = packed.mapInArrow(run, f"row {kind}, score double")
    return scored.select(*[F.col("row").getField(c).alias(c) for c in cols], F.col("score").alias(score_col))


def op9_quality(spark, sf_dir: str) -> DataFrame:
    """All documents scored for quality; labels are learned from ids whose crc32 isn't a multiple of 5."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_quality(docs, model, keep=["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
