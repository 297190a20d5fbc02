"""Operator 5: toxicity by FTRL-proximal logistic regression.

Features are hashed words, word pairs (2-grams) and pairs with one word between
(skip-grams), present or not. FTRL-proximal keeps a rate for each coordinate and
an L1 penalty, so nearly all weights are exactly zero; the model that travels to
the executors is a sorted list of the few that are not. Hashes have 64 bits:
sparse weights need no table of that size, and no two features share a weight.

The fit runs on the driver over at most ``sample_rows`` labelled documents (half
of them toxic, where there are so many), whose feature hashes executors make; scoring is one pass without a shuffle.

Defined results: null and empty texts have the bias alone; without labelled
rows, or with one class only, every score is the share of toxic labels (0
where there are none); repeated rows score alike; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, text_batches
from .labelled import training_rows

SAMPLE_ROWS = 5000
ALPHA, BETA, L1, L2 = 2.0, 1.0, 12.0, 0.1
EPOCHS = 5
#: A toxic row counts so many times the number of other rows for each toxic one.
POSITIVE_SHARE = 0.9
#: Places of the tables that bound how far a feature's z can go.
TABLE_BITS = 22
PAIR, SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
TRIM = ".,;:!?\"'()[]"


def word_hashes(text: str | None) -> np.ndarray:
    from xxhash import xxh64_intdigest
    words = [w.strip(TRIM) for w in (text or "").lower().split()]
    return np.fromiter((xxh64_intdigest(w) for w in words if w), np.uint64)


def features(text: str | None) -> np.ndarray:
    """Hashes of the words, neighbouring pairs and pairs over one word (with repeats)."""
    h = word_hashes(text)
    return np.concatenate([h, h[:-1] * PAIR + (h[1:] ^ (h[1:] >> np.uint64(29))), h[:-2] * SKIP + (h[2:] ^ (h[2:] >> np.uint64(31)))])


def reachable(rows: list[np.ndarray], y: np.ndarray, balance: float) -> list[np.ndarray]:
    """The features of each row without those whose weight must stay zero; the fit is the same with and without them.

    A weight is zero while |z| <= L1, and until then z is the sum of its gradients: each toxic row adds between
    -``balance`` and 0 an epoch, each other row between 0 and 1. A feature whose rows cannot carry z over L1 either way
    never gets a weight. Sums are kept by the low bits of the hash, so features that share a place are kept, not lost.
    """
    low = np.uint64((1 << TABLE_BITS) - 1)
    most = np.zeros((2, 1 << TABLE_BITS), np.float32)
    for r, toxic in zip(rows, y):
        np.add.at(most[int(toxic > 0)], r & low, np.float32(1.001 * EPOCHS * (balance if toxic else 1.0)))  # rounded up
    far = np.maximum(most[0], most[1]) > L1
    return [r[far[r & low]] for r in rows]


class FTRL:
    """Sorted feature hashes with weights that are not zero, and the bias."""

    def __init__(self):
        self.keys, self.weights, self.bias = np.empty(0, np.uint64), np.empty(0), None
        self.share = 0.0
        self._index()

    def _index(self) -> None:
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[self.keys & np.uint64(0xFFFF)] = True

    def fit(self, rows: list[np.ndarray], y: np.ndarray) -> "FTRL":
        """rows: distinct feature hashes of each document."""
        if not len(y) or y.min() == y.max():
            self.share = float(y.mean()) if len(y) else 0.0
            return self
        balance = POSITIVE_SHARE * (len(y) - y.sum()) / y.sum()
        rows = reachable(rows, y, balance)
        names, flat = np.unique(np.concatenate(rows), return_inverse=True)
        ends = np.cumsum([len(r) for r in rows])
        z, n = np.zeros(len(names) + 1), np.zeros(len(names) + 1)  # the last is the bias, which has no L1

        def solve(at: np.ndarray) -> np.ndarray:
            zi = z[at]
            l1 = np.where(at == len(names), 0.0, L1)
            return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

        order = np.random.default_rng(7).permutation(len(rows))
        for _ in range(EPOCHS):
            for i in order.tolist():
                at = np.append(flat[ends[i] - len(rows[i]):ends[i]], len(names))
                w = solve(at)
                g = (1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y[i]) * (balance if y[i] else 1.0)
                sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
                z[at] += g - sigma * w
                n[at] += g * g
        w = solve(np.arange(len(names) + 1))
        live = np.flatnonzero(w[:-1])
        self.keys, self.weights, self.bias = names[live], w[live], float(w[-1])
        self._index()
        return self

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.bias is None:
            return np.full(len(texts), self.share)
        out = np.full(len(texts), self.bias)
        for i, text in enumerate(texts):
            f = features(text)
            f = np.unique(f[self.maybe[f & np.uint64(0xFFFF)]])
            if len(f) and len(self.keys):
                at = np.minimum(np.searchsorted(self.keys, f), len(self.keys) - 1)
                out[i] += self.weights[at][self.keys[at] == f].sum()
        return 1 / (1 + np.exp(-np.clip(out, -35, 35)))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> FTRL:
    """Fit on at most ``sample_rows`` labelled documents outside the held-out fold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array([y], pa.int32()), pa.array([np.unique(features(text)).tobytes()], pa.binary())], names=["y", "f"])

    # Arrow keeps the features in flat buffers on the driver, instead of a row object each
    got = training_rows(docs, labels, "toxic", sample_rows, each=True).mapInArrow(run, "y int, f binary").toArrow()
    rows = [(y, f) for y, f in zip(got["y"].to_pylist(), (f for chunk in got["f"].chunks for f in chunk))]
    rows.sort(key=lambda r: (r[0], bytes(memoryview(r[1].as_buffer())[:64])))  # the same fit whatever the order of tasks
    return FTRL().fit([np.frombuffer(f.as_buffer(), np.uint64) for _, f in rows], np.array([y for y, _ in rows], float))


def score(docs: DataFrame, model: FTRL, name: str = "toxic_score") -> DataFrame:
    """All columns of ``docs`` and the score (replacing a column of that name)."""
    kept = [c for c in docs.columns if c.lower() != name]
    text, = fresh(docs, "text_")
    fed = text_batches(docs).select(*kept, F.coalesce(F.col("text"), F.lit("")).alias(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = model.score(batch.column(len(kept)).to_pylist())
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(kept))], pa.array(got, pa.float64())], names=[*kept, name])

    return fed.mapInArrow(run, fed.select(*kept, F.lit(0.0).alias(name)).schema)
