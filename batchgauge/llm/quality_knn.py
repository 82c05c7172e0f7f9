"""Text quality by the votes of the nearest labelled documents in a latent-semantic space.

A text's terms are its hashed byte trigrams (log counts, weighted by rarity over all
documents) and a few terms for its shape: how often words repeat, at once or anywhere, and the shares of
symbols and capitals, in steps. A truncated singular value decomposition of the labelled vectors
gives the latent space. Every document is compared with every labelled vector by cosine, in
blocks, exactly; its score is the mean label of the nearest ones, weighted by similarity.

Learned from at most `per_label` documents of each label (a documented bound), none of them
held out; their vectors, a few hundred kB, are what is broadcast. The rarity of terms is
counted over all documents.

Defined results: null and empty texts are scored like any other by their shape. Without any
labelled document the score is 0.5. Of a document's labels the more frequent one counts
(1 on a tie).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from batchgauge.llm.common import bounded_sample, held_out
from batchgauge.llm.spans import text_blocks

PER_LABEL = 1500
BUCKETS = 4096
STEPS = 12
DIMENSIONS = 48
NEIGHBOURS = 15
SHARPNESS = 4.0
SHAPES = 4
SHAPE_WEIGHT = 0.6
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>!{}[]=~^_@\\", dtype=np.uint8))
CAPITALS = np.isin(np.arange(256), np.arange(65, 91))
LETTERS = np.isin(np.arange(256), np.concatenate((np.arange(65, 91), np.arange(97, 123), np.arange(128, 256))))


def trigrams(text: bytes) -> np.ndarray:
    """Counts of the hashed byte trigrams of a text."""
    b = np.frombuffer(text, dtype=np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(BUCKETS, dtype=np.int64)
    code = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(2654435761)
    return np.bincount(code >> np.uint32(20), minlength=BUCKETS)


def shape(text: bytes) -> np.ndarray:
    """Four blocks of soft steps: words like the one before, repeated words, symbols, capitals."""
    words = text.split()
    counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    letters = max(1, int(counts[LETTERS].sum()))
    repeated = (1.0 - len(set(words)) / len(words)) * min(1.0, len(words) / 50.0) if words else 0.0
    twice = min(1.0, 2.0 * sum(map(eq, words, words[1:])) / max(1, len(words) - 1))
    shares = (twice, repeated ** 2, min(1.0, 4.0 * counts[SYMBOLS].sum() / max(1, len(text))), counts[CAPITALS].sum() / letters)
    out = np.zeros(SHAPES * STEPS, dtype=np.float32)
    for k, share in enumerate(shares):
        spot = share * (STEPS - 1)
        low = min(int(spot), STEPS - 2)
        out[k * STEPS + low] = 1.0 - (spot - low)
        out[k * STEPS + low + 1] = spot - low
    return out


def vectors(texts: list[bytes], rarity: np.ndarray) -> np.ndarray:
    """One weighted vector per text, of length 1."""
    out = np.zeros((len(texts), BUCKETS + SHAPES * STEPS), dtype=np.float32)
    for i, text in enumerate(texts):
        out[i, :BUCKETS] = np.log1p(trigrams(text)) * rarity
        out[i, BUCKETS:] = shape(text) * SHAPE_WEIGHT
    norm = np.linalg.norm(out[:, :BUCKETS], axis=1, keepdims=True)
    out[:, :BUCKETS] /= np.maximum(norm, 1e-12)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


@dataclass
class Model:
    rarity: np.ndarray
    axes: np.ndarray
    points: np.ndarray
    labels: np.ndarray

    def latent(self, texts: list[bytes]) -> np.ndarray:
        x = vectors(texts, self.rarity) @ self.axes
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def scores(self, texts: list[bytes], block: int = 256) -> np.ndarray:
        out = np.full(len(texts), 0.5)
        if not len(self.labels):
            return out
        k = min(NEIGHBOURS, len(self.labels))
        for a in range(0, len(texts), block):
            near = self.latent(texts[a : a + block]) @ self.points.T
            top = np.argpartition(-near, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(near, top, axis=1), 1e-6).astype(np.float64) ** SHARPNESS
            out[a : a + block] = (weight * self.labels[top]).sum(axis=1) / weight.sum(axis=1)
        return np.clip(out, 0.0, 1.0)


def rarity_of(docs: DataFrame) -> np.ndarray:
    """The log inverse document frequency of each bucket, over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                n += trigrams(text.encode("utf-8", "surrogatepass")) > 0
                total += 1
        yield pa.record_batch({
            "bucket": np.arange(-1, BUCKETS, dtype=np.int64), "n": np.concatenate(([total], n)),
        })

    rows = docs.select("text").filter("text is not null").mapInArrow(count, "bucket long, n long")
    found = {r["bucket"]: r["n"] for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    total = found.get(-1, 0)
    n = np.array([found.get(i, 0) for i in range(BUCKETS)])
    return np.log((1.0 + total) / (1.0 + n)).astype(np.float32) + np.float32(0.1)


def fit(sample: list[tuple[bytes, int]], rarity: np.ndarray, dimensions: int = DIMENSIONS) -> Model:
    """The latent space of the labelled texts, by a randomised decomposition with a fixed seed."""
    width = BUCKETS + SHAPES * STEPS
    if not sample:
        return Model(rarity, np.zeros((width, 0), np.float32), np.zeros((0, 0), np.float32), np.zeros(0))
    x = vectors([t for t, _ in sample], rarity)
    probe = np.random.default_rng(7).standard_normal((width, dimensions + 16)).astype(np.float32)
    y = x @ probe
    for _ in range(3):
        y = x @ (x.T @ np.linalg.qr(y)[0])
    base = np.linalg.qr(y)[0]
    axes = np.linalg.svd(base.T @ x, full_matrices=False)[2][:dimensions].T
    model = Model(rarity, np.ascontiguousarray(axes), np.zeros((0, 0), np.float32), np.array([q for _, q in sample], float))
    model.points = model.latent([t for t, _ in sample])
    return model


def trained(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Model:
    """A model from labelled documents that are not held out."""
    voted = (
        labels.filter("quality is not null and doc_id is not null").groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    )
    picked = F.broadcast(bounded_sample(voted.filter(~held_out()), "doc_id", "label", per_label, 2))
    rows = docs.select("doc_id", "text").join(picked, "doc_id").select("doc_id", "text", "label").collect()
    rows = sorted({(r["doc_id"], r["text"] or "", r["label"]) for r in rows})
    return fit([(t.encode("utf-8", "surrogatepass"), q) for _, t, q in rows], rarity_of(docs))


def scored(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, columns: list[str] | None = None) -> DataFrame:
    """`columns` (default: all) of every document plus quality_score. An input column of that name is replaced."""
    names = [c for c in (docs.columns if columns is None else columns) if c != "quality_score"]
    fields = {f.name: f for f in docs.schema.fields}
    schema = StructType([fields[n] for n in names] + [StructField("quality_score", DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(trained(docs, labels, per_label))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_blocks(batch):
                get = lambda n: part.column(part.schema.get_field_index(n))  # noqa: B023, E731
                yield pa.record_batch({**{n: get(n) for n in names}, "quality_score": shared.value.scores(texts)})

    return docs.select(*dict.fromkeys([*names, "text"])).mapInArrow(run, schema)
