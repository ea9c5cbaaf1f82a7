"""The convolution against plain loops, and the trained classifier on held-out rows."""

import os

import numpy as np
import pytest

from tessella.llm import quality
from tessella.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def plainly(net, text):
    """The score by loops over chunks, places and filters."""
    chunks, at = [], 0
    while True:
        chunks.append(text[at : at + quality.CHUNK + quality.WIDTH])
        if at + quality.CHUNK >= len(text):
            break
        at += quality.HOP
    rows = []
    for c in chunks:
        padded = c + bytes(quality.CHUNK + quality.WIDTH - len(c))
        top = [max(sum(float(net.taps[k, padded[p + k], f]) for k in range(quality.WIDTH)) for p in range(0, quality.CHUNK, quality.STRIDE)) + float(net.bias[f]) for f in range(net.taps.shape[2])]
        again = sum(any(p >= lag and padded[p : p + 8] == padded[p - lag : p - lag + 8] and padded[p] for lag in range(1, quality.LAGS + 1)) for p in range(quality.CHUNK - 7))
        rows.append([*(max(t, 0.0) for t in top), 4 * again / max(1, sum(b != 0 for b in padded[: quality.CHUNK]))])
    features = np.hstack([np.mean(rows, axis=0), np.max(rows, axis=0)])
    return 1 / (1 + np.exp(-(features @ net.head + net.offset)))


def test_network_equals_plain_loops():
    rng = np.random.default_rng(0)
    net = quality.ByteCnn(rng.normal(0, 0.3, (quality.WIDTH, 256, 3)).astype(np.float32), rng.normal(0, 0.3, 3).astype(np.float32), rng.normal(0, 0.5, 8).astype(np.float32), 0.3)
    texts = [b"", b"a", b"good words all along", b"ab ab ab ab ab ab ab ab ", "Ünïcödé ".encode() * 40, bytes(rng.integers(1, 256, 1500).astype(np.uint8)), b"x" * 513]
    assert np.allclose(net.score(texts), [plainly(net, t) for t in texts], atol=1e-5)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")
def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = QUERIES["op7_quality"](spark, DATA).filter("held_out").join(labels, "doc_id").filter("quality IS NOT NULL").collect()
    good, bad = ([r.predicted for r in rows if r.quality == y] for y in (1, 0))
    assert len(good) > 60 and sum(good) >= 0.97 * len(good) and sum(bad) <= 0.1 * len(bad)
