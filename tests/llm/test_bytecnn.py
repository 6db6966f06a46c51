"""The byte network: coverage of the text, gradients, plain forward pass, held-out accuracy, edge cases."""

from __future__ import annotations

import math

import numpy as np
import pytest

from riskspark.llm import bytecnn as net
from riskspark.llm import catalog
from tests.llm import brute

SF = "/root/testdata/sf0.01"
PROSE = "The little house by the river was old, and nobody had lived there for years. "


@pytest.mark.parametrize("n", [1, 31, 32, 224, 255, 256, 257, 480, 481, 10_000])
def test_chunks_cover_the_text(n):
    raw = bytes(i % 251 for i in range(n))
    k = net.chunk_count(n)
    rows = net.chunks_of(raw, np.arange(k))
    seen = np.full(k * net.STEP + net.CHUNK, -1)
    for i, row in enumerate(rows):
        at = i * net.STEP + np.arange(net.CHUNK)
        seen[at[row < net.FILL]] = row[row < net.FILL]
    assert bytes(seen[:n].astype(np.uint8)) == raw and (seen[n:] == -1).all()
    assert k == 1 or (k - 1) * net.STEP + net.CHUNK - net.STEP < n  # the last chunk brings bytes of its own


def test_every_filter_position_is_in_a_chunk():
    assert net.CHUNK - net.STEP >= net.WIDTH - 1


def plain_score(made: net.Network, text: str) -> float:
    """Position by position, without tables."""
    raw = text.encode()
    logits = []
    for c in range(net.chunk_count(len(raw))):
        part = list(raw[c * net.STEP : c * net.STEP + net.CHUNK])
        x = made.vectors[np.array(part + [net.FILL] * (net.CHUNK - len(part)))]
        best = np.full(net.FILTERS, -np.inf)
        for p in range(net.CHUNK - net.WIDTH + 1):
            best = np.maximum(best, np.einsum("kv,kvf->f", x[p : p + net.WIDTH], made.filters))
        logits.append(np.tanh(np.maximum(best + made.bias, 0) @ made.inner + made.inner_bias) @ made.outer + made.outer_bias[0])
    return 1 / (1 + math.exp(-float(np.mean(logits))))


def test_score_equals_plain_forward_pass():
    made = net.fresh(3)
    scorer = net.Scorer(made)
    for text in ("a", "é" * 200, PROSE * 5, "x | y " * 2_000):
        assert scorer.score(text) == pytest.approx(plain_score(made, text), abs=1e-5)


def test_gradients_by_differences():
    made = net.fresh(5)
    made.weights[:] = [w.astype(np.float64) for w in made.weights]
    (made.vectors, made.filters, made.bias, made.inner, made.inner_bias, made.outer, made.outer_bias) = made.weights
    chunks = np.concatenate([net.chunks_of((PROSE * k).encode(), np.arange(k)) for k in (1, 2, 3)])
    doc, counts, labels = np.array([0, 1, 1, 2, 2, 2]), np.array([1, 2, 3]), np.array([1.0, 0.0, 1.0])

    def loss() -> float:
        s = net.Scorer(made).logits(chunks)
        z = np.bincount(doc, s) / counts
        return float(np.mean(np.log1p(np.exp(z)) - labels * z))

    found = net.gradients(made, made.tables(), chunks, doc, counts, labels)
    rng = np.random.default_rng(0)
    for w, g in zip(made.weights, found):
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in w.shape)
            was = w[at]
            w[at] = was + 1e-6
            up = loss()
            w[at] = was - 1e-6
            down = loss()
            w[at] = was
            assert (up - down) / 2e-6 == pytest.approx(float(g[at]), abs=2e-4)


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = catalog.op11_quality_network(spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == (brute.crc(r["doc_id"]) % 5 == 0) for r in rows)
    fold = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good, bad = [p for y, p in fold if y == 1], [p for y, p in fold if y == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.4 and len(bad) > 3


def test_junk_in_any_part_counts(spark):
    """Junk over the second half of a long text lowers the score, wherever the text began."""
    rng = np.random.default_rng(2)
    words = PROSE.lower().replace(",", "").replace(".", "").split()
    prose = [" ".join(rng.choice(words, 60)) + "." for _ in range(120)]
    junk = [" | ".join(rng.choice(words, 60)) + " ###" for _ in range(120)]
    made = net.fit([net.chunks_of(t.encode(), np.arange(net.chunk_count(len(t)))) for t in prose + junk], np.array([1.0] * 120 + [0.0] * 120))
    scorer = net.Scorer(made)
    clean, late = " ".join(prose[:100]), " ".join(prose[:20] + junk[:80])
    assert scorer.score(clean) > 0.9 and scorer.score(late) < 0.3 and scorer.score(late + " ") < 0.3


def test_edges(spark):
    schema = "doc_id long, text string, lang string"
    rows = [(1, None, None), (2, "", "en"), (3, " ", "en"), (4, PROSE, "en"), (4, PROSE, "en"), (None, PROSE, None), (5, "é" * 200_000, "en"), (6, "\x00", "en")]
    d = spark.createDataFrame(rows, schema).selectExpr("*", "'x' as score", "2 as predicted", "3 as __text", "true as held_out", "1 as label", "2 as seed")
    empty = spark.createDataFrame([], schema)
    labels = spark.createDataFrame([(1, 1), (4, 1), (4, 0), (5, 1), (None, 1), (6, None), (77, 0)], "doc_id long, quality int")
    got = {(r["doc_id"], r["text"]): r["score"] for r in net.scored(d, labels).collect()}
    assert net.scored(d, labels).count() == len(rows) and got[1, None] == got[2, ""] == 0 and got[4, PROSE] == got[None, PROSE]
    assert all(0 <= s <= 1 for s in got.values())
    assert {r["score"] for r in net.scored(d, labels.limit(0)).where("length(text) > 0").collect()} == {1.0}
    assert {r["score"] for r in net.scored(d, labels.where("doc_id = 5")).where("length(text) > 0").collect()} == {1.0}
    assert net.scored(empty, labels).count() == 0 and "label" in net.scored(d, labels).columns
