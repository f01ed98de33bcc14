"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into overlapping chunks that cover all its bytes. Learned filters
slide over a chunk's bytes (a filter is a weight per byte value and offset), a
rectifier and the maximum over the chunk follow, then a dense layer gives the
chunk's logit; the mean logit of all chunks becomes one probability.

Learning is bounded: at most ``SAMPLE`` rows of each label, chosen by hash, and
``CHUNKS`` chunks of each, spread over the text. Classes are sampled evenly and
the bias is then moved to the labels' real shares.

Defined results: null and empty texts are one chunk of padding. Labels other
than 0 and 1 and null keys are not learned from. If only one label can be
learned, every score is that label's. Repeated rows get the same score; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .words import slices, starts_of

CHUNK, OVERLAP = 512, 64
FILTERS, WIDTH = 12, 4
SAMPLE, CHUNKS, EPOCHS = 900, 4, 14
PAD = 256


def chunks_of(text: bytes) -> np.ndarray:
    """All bytes of a text as overlapping rows of ``CHUNK``, padded at the end."""
    step = CHUNK - OVERLAP
    rows = max(1, -(-(len(text) - OVERLAP) // step))
    flat = np.full(step * (rows - 1) + CHUNK, PAD, np.int16)
    flat[:len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(flat, CHUNK)[::step]


class Network:
    """filters[offset, byte, filter], their bias, and a dense layer on the maxima."""

    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.filters = draw.normal(0, 0.25, (WIDTH, PAD + 1, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.dense = draw.normal(0, 0.5, FILTERS).astype(np.float32)
        self.out = np.zeros(1, np.float32)
        self.constant: float | None = None

    def maxima(self, chunks: np.ndarray, where: bool = False):
        """Largest rectified response of each filter in each chunk, and its place if asked for."""
        places = chunks.shape[1] - WIDTH + 1
        response = self.filters[0][chunks[:, :places]]
        for offset in range(1, WIDTH):
            response += self.filters[offset][chunks[:, offset:offset + places]]
        if not where:
            return np.maximum(response.max(axis=1) + self.bias, 0)
        at = response.argmax(axis=1)
        top = np.take_along_axis(response, at[:, None, :], axis=1)[:, 0]
        return np.maximum(top + self.bias, 0), at

    def logits(self, chunks: np.ndarray) -> np.ndarray:
        return np.concatenate([self.maxima(chunks[i:i + 64]) @ self.dense for i in range(0, len(chunks), 64)]) + self.out

    def learn(self, chunks: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, seed: int = 11) -> None:
        """Adam on the logistic loss; the gradient goes to the bytes under each filter's maximum."""
        draw = np.random.default_rng(seed)
        weights = [self.filters, self.bias, self.dense, self.out]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        step = 0
        for _ in range(epochs):
            order = draw.permutation(len(chunks))
            for i in range(0, len(order), 64):
                rows = order[i:i + 64]
                x, y = chunks[rows], labels[rows]
                top, at = self.maxima(x, where=True)
                wrong = (1 / (1 + np.exp(-(top @ self.dense + self.out))) - y).astype(np.float32) / len(rows)
                back = wrong[:, None] * self.dense * (top > 0)
                moves = np.zeros_like(self.filters)
                for offset in range(WIDTH):
                    under = np.take_along_axis(x, at + offset, axis=1)
                    np.add.at(moves[offset], (under, np.arange(FILTERS)), back)
                step += 1
                for n, (w, g) in enumerate(zip(weights, [moves, back.sum(axis=0), wrong @ top, wrong.sum(keepdims=True)])):
                    first[n] += 0.1 * (g - first[n])
                    second[n] += 0.001 * (g * g - second[n])
                    w -= rate * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Probability of label 1 for each whole text."""
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        parts = [chunks_of(text) for text in texts]
        counts = np.array([len(p) for p in parts])
        mean = np.add.reduceat(self.logits(np.concatenate(parts)).astype(np.float64), starts_of(counts)) / counts
        return 1 / (1 + np.exp(-mean))


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Network:
    """A network learned from a bounded sample of the labelled rows."""
    rows = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where("key is not null and label in (0, 1)")
    share = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    network = Network()
    if len(share) < 2:
        network.constant = float(next(iter(share), 0))
        return network
    chosen = None
    for value in (0, 1):
        part = rows.where(F.col("label") == value).distinct().orderBy(F.xxhash64("key"), "key").limit(SAMPLE)
        chosen = part if chosen is None else chosen.union(part)
    texts = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, run in slices(batch, 2):
                for row, content in enumerate(run, start):
                    parts = chunks_of(content)
                    take = np.unique(np.linspace(0, len(parts) - 1, CHUNKS).astype(int))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([batch.column(0)[row].as_py()] * len(take), pa.int64()), pa.array([batch.column(1)[row].as_py()] * len(take), pa.int32()),
                         pa.array([parts[i].tobytes() for i in take], pa.binary())], names=["key", "label", "chunk"])

    found = (texts.join(F.broadcast(chosen), "key").select(F.col("key").cast("bigint"), "label", "text")
             .mapInArrow(pick, "key bigint, label int, chunk binary").collect())
    found.sort(key=lambda r: (r["key"], r["label"], bytes(r["chunk"])))
    if len({r["label"] for r in found}) < 2:
        network.constant = float(found[0]["label"]) if found else 0.0
        return network
    chunks = np.frombuffer(b"".join(bytes(r["chunk"]) for r in found), np.int16).reshape(-1, CHUNK)
    target = np.array([r["label"] for r in found], np.float32)
    network.learn(chunks, target)
    ones = target.mean()
    network.out += np.log(share[1] / share[0]) - np.log(ones / (1 - ones))
    return network


def score(docs: DataFrame, network: Network, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and the probability of label 1 for every row, from its whole text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(network)
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in slices(batch, 1):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), pa.array(shared.value.scores(texts), pa.float64())], names=["key", "score"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, score double").withColumnRenamed("key", key)
