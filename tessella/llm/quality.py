"""A byte-level convolutional quality classifier in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh_name
from .sampling import labelled_sample

#: Bytes of a chunk, from one chunk's start to the next, bytes a filter sees, bytes between its places.
CHUNK, HOP, WIDTH, STRIDE = 512, 448, 8, 2
#: How far back a repeated window of bytes is looked for.
LAGS = 24
#: Chunks convolved at once.
AT_ONCE = 512


def chunk_bytes(text: bytes) -> np.ndarray:
    """All chunks of a text, one per row, padded by zeros: together they cover every byte."""
    count = max(1, -(-(len(text) - (CHUNK - HOP)) // HOP)) if len(text) > CHUNK else 1
    padded = np.zeros((count - 1) * HOP + CHUNK + WIDTH, np.uint8)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK + WIDTH)[::HOP]


def repeat_share(chunks: np.ndarray) -> np.ndarray:
    """For each chunk the share of its places whose next 8 bytes stand up to LAGS bytes earlier too."""
    text = chunks[:, :CHUNK]
    again = np.zeros((len(text), CHUNK - 7), bool)
    for lag in range(1, LAGS + 1):
        same = text[:, lag:] == text[:, :-lag]
        same = same[:, :-1] & same[:, 1:]
        same = same[:, :-2] & same[:, 2:]
        same = same[:, :-4] & same[:, 4:]
        again[:, lag:] |= same & (text[:, lag : CHUNK - 7] != 0)
    return again.sum(axis=1, dtype=np.float32) / np.maximum((text != 0).sum(axis=1), 1)


@dataclass
class ByteCnn:
    """Filters as tables: ``taps[k, byte, filter]`` is what a byte at place k adds to a filter."""

    taps: np.ndarray
    bias: np.ndarray
    head: np.ndarray  # weights of the mean and the maximum over chunks of each pooled value
    offset: float

    def places(self, chunks: np.ndarray) -> np.ndarray:
        """Filter responses at each place: (chunks, places, filters)."""
        out = np.take(self.taps[0], chunks[:, 0:CHUNK:STRIDE], axis=0)
        for k in range(1, WIDTH):
            out += np.take(self.taps[k], chunks[:, k : k + CHUNK : STRIDE], axis=0)
        return out

    def pooled(self, chunks: np.ndarray) -> np.ndarray:
        """Maximum of each filter over a chunk, cut at zero, and the chunk's share of repeats."""
        parts = []
        for first in range(0, len(chunks), AT_ONCE):
            some = chunks[first : first + AT_ONCE]
            top = self.places(some).max(axis=1) + self.bias
            parts.append(np.column_stack([np.maximum(top, 0), 4 * repeat_share(some)]))
        return np.concatenate(parts)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """The probability of label 1 for each whole text."""
        features = np.zeros((len(texts), len(self.head)), np.float32)
        held: list[tuple[int, np.ndarray]] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if held:
                values = self.pooled(np.concatenate([c for _, c in held]))
                starts = np.cumsum([0] + [len(c) for _, c in held[:-1]])
                features[[i for i, _ in held]] = combined(values, starts)
            held.clear()
            size = 0

        for i, text in enumerate(texts):
            chunks = chunk_bytes(text)
            if len(chunks) > AT_ONCE:  # a very long text goes alone, a block of chunks at a time
                features[i] = combined(self.pooled(chunks), np.array([0]))
                continue
            held.append((i, chunks))
            size += len(chunks)
            if size >= AT_ONCE:
                flush()
        flush()
        return 1 / (1 + np.exp(-np.clip(features @ self.head + self.offset, -30, 30).astype(np.float64)))


def combined(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Mean and maximum over each document's chunks, side by side."""
    count = np.diff(np.append(starts, len(values)))[:, None]
    return np.hstack([np.add.reduceat(values, starts) / count, np.maximum.reduceat(values, starts)])


def train(sample: list[tuple[str, int]], filters: int = 16, epochs: int = 8, chunks_per_doc: int = 6, seed: int = 7, rate: float = 0.02) -> ByteCnn:
    """Fit filters and head together by Adam on the logistic loss; both classes weigh the same.

    A training step sees up to ``chunks_per_doc`` chunks of a document, spread over all of it. With
    no rows of one class the classifier says 0.5 + 0.5 * (the other class is 1) less a little.
    """
    rng = np.random.default_rng(seed)
    net = ByteCnn(rng.normal(0, 0.1, (WIDTH, 256, filters)).astype(np.float32), np.zeros(filters, np.float32), rng.normal(0, 0.1, 2 * (filters + 1)).astype(np.float32), 0.0)
    labels = np.array([y for _, y in sample], np.float32)
    if len(set(labels.tolist())) < 2:
        net.head[:] = 0
        net.offset = 0.0 if not len(labels) else (2.0 if labels[0] else -2.0)
        return net
    docs = []
    for text, _ in sample:
        chunks = chunk_bytes(text.encode("utf-8"))
        docs.append(chunks[np.unique(np.linspace(0, len(chunks) - 1, min(chunks_per_doc, len(chunks))).astype(int))].copy())
    weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-6), 0.5 / max(1 - labels.mean(), 1e-6))
    params = {"taps": net.taps, "bias": net.bias, "head": net.head, "offset": np.zeros(1, np.float32)}
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    step, ks, fs = 0, np.arange(WIDTH), np.arange(filters)
    for epoch in range(epochs):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), 32):
            rows = order[at : at + 32]
            chunks = np.concatenate([docs[i] for i in rows])
            starts = np.cumsum([0] + [len(docs[i]) for i in rows[:-1]])
            owner = np.repeat(np.arange(len(rows)), [len(docs[i]) for i in rows])
            raw = net.places(chunks)
            where = raw.argmax(axis=1)
            top = np.maximum(np.take_along_axis(raw, where[:, None], 1)[:, 0] + net.bias, 0)
            values = np.column_stack([top, 4 * repeat_share(chunks)])
            features = combined(values, starts)
            p = 1 / (1 + np.exp(-np.clip(features @ net.head + params["offset"][0], -30, 30)))
            err = (weight[rows] * (p - labels[rows]) / len(rows)).astype(np.float32)
            width = filters + 1
            is_top = values[:, :filters] >= features[owner][:, width : width + filters]
            back = err[owner, None] * (net.head[:filters] / np.bincount(owner)[owner, None] + net.head[width : width + filters] * is_top) * (top > 0)
            grads = {"head": features.T @ err + 1e-4 * net.head, "offset": err.sum(keepdims=True), "bias": back.sum(axis=0)}
            taps = 1e-5 * net.taps
            seen = chunks[np.arange(len(chunks))[:, None, None], STRIDE * where[:, :, None] + ks]
            np.add.at(taps, (ks[None, None, :], seen, fs[None, :, None]), np.broadcast_to(back[:, :, None], seen.shape))
            grads["taps"] = taps
            step += 1
            for k, v in params.items():
                first[k] += 0.1 * (grads[k] - first[k])
                second[k] += 0.001 * (grads[k] ** 2 - second[k])
                v -= rate * (1 - epoch / epochs) * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    net.offset = float(params["offset"][0])
    return net


def quality_scores(docs: DataFrame, net: ByteCnn, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``(<keep or id>, score)`` per row: the probability that the whole text is good; null counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    names = keep if keep is not None else [id_col]
    columns = list(dict.fromkeys([*names, text_col]))
    score_name = fresh_name(columns, "score")

    def run(batches):
        for batch in batches:
            texts = batch.column(columns.index(text_col))
            scores = np.concatenate([shared.value.score([(t.as_py() or "").encode("utf-8") for t in texts[i : i + 256]]) for i in range(0, len(texts), 256)] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([*(batch.column(columns.index(n)) for n in names), pa.array(scores)], names=[*names, score_name])

    schema = T.StructType([*(docs.schema[n] for n in names), T.StructField(score_name, T.DoubleType())])
    return docs.select(*columns).mapInArrow(run, schema)


def fit_quality(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1, rows_per_class: int = 1000, max_chars: int = 12_000) -> ByteCnn:
    """Train on a sample bounded by ``rows_per_class`` and ``max_chars``, without the held-out fold."""
    sample, _ = labelled_sample(docs, labels, "quality", modulus, held_out, rows_per_class, max_chars)
    return train(sample)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the classifier gives ``threshold`` or more.

    Repeated rows share one fate; an empty table stays empty; without labels nothing is rejected.
    """
    net = fit_quality(docs, labels)
    scored = quality_scores(docs, net, keep=docs.columns)
    return scored.filter(F.col(scored.columns[-1]) >= threshold).select(*docs.columns)
