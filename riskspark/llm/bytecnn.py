"""Quality scores from a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks of ``CHUNK`` bytes, one every ``STEP``, that cover all of
it; a last chunk is filled up with a byte of its own. Learned filters of ``WIDTH`` bytes over learned byte
vectors run along every position of a chunk, rectified, and each filter keeps its greatest value in
the chunk. A small hidden layer turns a chunk's maxima into a logit; the mean of the chunks' logits is
the document's, whose logistic is the score. A filter's products with the byte vectors are tabled per
byte, so scoring is sums of table rows.

Learning: at most about ``max_labelled`` labelled documents outside the held-out fold (remainder
``HELD_OUT`` of crc32(id) mod 5), the least by hash of the id, each with up to ``CHUNKS`` chunks drawn from
its whole text, are fitted on the driver by Adam with a fixed seed: at most max_labelled * CHUNKS * CHUNK
bytes. Scoring reads every byte of every text, some chunks at a time, so long texts need no more memory.
Labels, language, source and id are never inputs of a score.

Null and empty texts score 0. A null id belongs to no label and remainder 0, so it counts as held out. Labels
that differ on an id count as 0 if one is. Without labels of both classes every text with a byte has the
score of the one class, 1 when there are no labels at all. Repeated rows get equal scores. Empty tables
give an empty result. Input columns named like a result column are replaced by it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import stored, with_results

CHUNK, STEP, WIDTH, FILTERS, VECTOR, HIDDEN = 256, 224, 6, 24, 8, 16
FILL = 256
CHUNKS = 8
HELD_OUT = 0
AT_ONCE = 32


def remainder(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 5, F.lit(0))


def chunk_count(n: int) -> int:
    return max(1, -(-(n - (CHUNK - STEP)) // STEP))


def chunks_of(raw: bytes, which: np.ndarray) -> np.ndarray:
    """The chunks of these numbers as rows of byte numbers."""
    at = which[:, None] * STEP + np.arange(CHUNK)
    codes = np.frombuffer(raw, np.uint8)
    return np.where(at < len(codes), codes[np.minimum(at, len(codes) - 1)].astype(np.intp), FILL)


@dataclass
class Network:
    vectors: np.ndarray     # byte, VECTOR
    filters: np.ndarray     # WIDTH, VECTOR, FILTERS
    bias: np.ndarray
    inner: np.ndarray       # FILTERS, HIDDEN
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: np.ndarray

    def tables(self) -> np.ndarray:
        """WIDTH, byte, FILTERS: what a byte adds to a filter at an offset."""
        return np.ascontiguousarray(self.vectors @ self.filters)

    def __post_init__(self) -> None:
        self.weights = [self.vectors, self.filters, self.bias, self.inner, self.inner_bias, self.outer, self.outer_bias]


def fresh(seed: int) -> Network:
    rng = np.random.default_rng(seed)

    def normal(scale: float, *shape: int) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    return Network(
        normal(0.5, FILL + 1, VECTOR), normal(1 / math.sqrt(WIDTH * VECTOR), WIDTH, VECTOR, FILTERS), np.zeros(FILTERS, np.float32),
        normal(1 / math.sqrt(FILTERS), FILTERS, HIDDEN), np.zeros(HIDDEN, np.float32), normal(1 / math.sqrt(HIDDEN), HIDDEN), np.zeros(1, np.float32))


def responses(tables: np.ndarray, chunks: np.ndarray) -> np.ndarray:
    """Chunk, position, filter."""
    size = CHUNK - WIDTH + 1
    out = tables[0].take(chunks[:, :size], axis=0)
    for k in range(1, WIDTH):
        out += tables[k].take(chunks[:, k : k + size], axis=0)
    return out


class Scorer:
    def __init__(self, net: Network):
        self.net, self.tables = net, net.tables()

    def logits(self, chunks: np.ndarray) -> np.ndarray:
        net = self.net
        pooled = np.maximum(responses(self.tables, chunks).max(axis=1) + net.bias, 0)
        return np.tanh(pooled @ net.inner + net.inner_bias) @ net.outer + net.outer_bias[0]

    def score(self, text: str | None) -> float:
        raw = text.encode() if text else b""
        if not raw:
            return 0.0
        n = chunk_count(len(raw))
        total = sum(float(self.logits(chunks_of(raw, np.arange(a, min(a + AT_ONCE, n)))).sum()) for a in range(0, n, AT_ONCE))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total / n))))


def gradients(net: Network, tables: np.ndarray, chunks: np.ndarray, doc: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    """Of the mean log loss of the documents whose chunks these are; ``doc`` has each chunk's document."""
    made = responses(tables, chunks)
    at = made.argmax(axis=1)
    top = np.take_along_axis(made, at[:, None, :], axis=1)[:, 0, :] + net.bias
    pooled = np.maximum(top, 0)
    hidden = np.tanh(pooled @ net.inner + net.inner_bias)
    logit = np.bincount(doc, hidden @ net.outer + net.outer_bias[0], len(counts)) / counts
    error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels) / len(labels)
    d_logit = (error / counts)[doc].astype(np.float32)
    d_hidden = d_logit[:, None] * net.outer * (1 - hidden**2)
    d_pooled = (d_hidden @ net.inner.T) * (top > 0)
    held = chunks[np.arange(len(chunks))[:, None, None], at[:, :, None] + np.arange(WIDTH)]  # chunk, filter, offset: bytes at the maximum
    d_filters = np.einsum("mf,mfkv->kvf", d_pooled, net.vectors[held], optimize=True)
    spread = np.einsum("mf,kvf->mfkv", d_pooled, net.filters, optimize=True).reshape(-1, VECTOR)
    flat = held.reshape(-1)
    d_vectors = np.stack([np.bincount(flat, spread[:, v], FILL + 1) for v in range(VECTOR)], axis=1)
    return [d_vectors, d_filters, d_pooled.sum(0), pooled.T @ d_hidden, d_hidden.sum(0), hidden.T @ d_logit, d_logit.sum(keepdims=True)]


def fit(texts: list[np.ndarray], labels: np.ndarray, epochs: int = 10, batch: int = 32, rate: float = 0.01, decay: float = 1e-4, seed: int = 7) -> Network:
    """``texts`` are the chunk rows of each document; Adam with a linearly falling rate."""
    net, rng = fresh(seed), np.random.default_rng(seed)
    first, second = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights]
    steps, done = epochs * -(-len(texts) // batch), 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), batch):
            chosen = order[a : a + batch]
            counts = np.array([len(texts[i]) for i in chosen])
            found = gradients(net, net.tables(), np.concatenate([texts[i] for i in chosen]), np.repeat(np.arange(len(chosen)), counts), counts, labels[chosen])
            done += 1
            speed = rate * (1 - (done - 1) / steps)
            for w, g, m, v in zip(net.weights, found, first, second):
                g = g + decay * w
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= (speed * (m / (1 - 0.9**done)) / (np.sqrt(v / (1 - 0.999**done)) + 1e-8)).astype(np.float32)
    return net


def sampled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_labelled: int) -> DataFrame:
    """label, count, bytes of up to ``CHUNKS`` chunks, of a bounded sample of labelled documents that are not held out."""
    known = stored(
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (remainder(id_col) != HELD_OUT))
        .groupBy(F.col(id_col).alias("__id")).agg(F.min(F.col(label_col).cast("int")).alias("label")), "quality-labels")
    share = min(1.0, max_labelled / max(known.count(), 1))
    chosen = known.where((F.xxhash64("__id") / 2.0**64 + 0.5) <= share)  # about max_labelled rows: bounded
    texts = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{id_col}`").alias("__doc"))
    found = texts.join(F.broadcast(chosen), F.col("__doc") == F.col("__id")).select("text", "label", F.xxhash64("__id").alias("seed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, label, seed in zip(*[batch.column(i) for i in range(3)]):
                raw = (text.as_py() or "").encode()
                if raw:
                    n = chunk_count(len(raw))
                    drawn = np.sort(np.random.default_rng(seed.as_py() & (1 << 63) - 1).permutation(n)[:CHUNKS]) if n > CHUNKS else np.arange(n)
                    out.append((seed.as_py(), label.as_py(), len(drawn), chunks_of(raw, drawn).astype(np.uint16).tobytes()))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.binary()))], names=["seed", "label", "n", "chunks"])

    return found.mapInArrow(run, "seed long, label int, n int, chunks binary")


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
           max_labelled: int = 4_000, threshold: float = 0.3) -> DataFrame:
    """Every column of ``docs``, then held_out, score, predicted."""
    rows = sorted(tuple(r) for r in sampled(docs, labels, id_col, text_col, label_col, max_labelled).collect())  # bounded by max_labelled
    classes = {r[1] for r in rows}
    scorer = None
    if len(classes) == 2:
        texts = [np.frombuffer(r[3], np.uint16).reshape(r[2], CHUNK).astype(np.intp) for r in rows]
        scorer = Scorer(fit(texts, np.array([r[1] for r in rows], float)))
    alone = float(max(classes, default=1))
    known = docs.sparkSession.sparkContext.broadcast(scorer)

    def row(text: str | None) -> tuple:
        score = known.value.score(text) if known.value else (alone if text else 0.0)
        return score, int(score >= threshold)

    return with_results(docs.withColumn("held_out", remainder(id_col) == HELD_OUT), text_col, row, "score double, predicted int")
