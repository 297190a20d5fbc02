"""Operator 2: document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its potential comes from its own features and those
of its neighbours (shares of letters, digits and marks, word counts and
lengths, repeated words, ending, repeated lines), each cut into bins with a weight of their
own; a 2 x 2 table weighs the step from line to line. Forward and backward
sums give each line's marginal, and the mean of the marginals, weighted by line
length, is the document's quality.

The weights are fitted on the driver by gradient ascent of the conditional
likelihood, every line taking its document's label, over at most
``sample_rows`` labelled documents; executors turn those into bin numbers, so
the driver sees a few bytes a line. Scoring is one pass without a shuffle.

Defined results: null and empty texts are one empty line; without labelled
rows, or with one class only, every score is the share of good labels (0.5
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

SAMPLE_ROWS = 6000
#: Documents scored together; bounds a worker's memory.
TEXTS = 200
EPOCHS = 120
RATE = 0.15
PENALTY = 2e-4

SHARES = np.array([0.0, 0.01, 0.03, 0.06, 0.1, 0.16, 0.25, 0.4, 0.6])
COUNTS = np.array([0, 1, 2, 4, 8, 16, 32, 64, 128])
WORD_LENGTHS = np.array([0.5, 2, 3, 4, 5, 6, 8, 11, 16])
#: Bin edges by feature; a value's bin is the number of edges below it.
EDGES = [COUNTS, WORD_LENGTHS, *[SHARES] * 9, np.array([0.5]), np.array([0.5]), np.array([0.5])]
BINS = 10


def _classes() -> list[np.ndarray]:
    """Byte classes whose share of a line is a feature."""
    has = lambda chars: np.isin(np.arange(256), np.frombuffer(chars, np.uint8)).astype(np.uint8)
    return [has(bytes(range(65, 91))), has(bytes(range(48, 58))), has(b".,;:"), has(b"!?"), has(b"|<>{}[]\\/="), has(b"&%$#*@~^+_"),
            has(bytes(range(128, 256))), has(b"bcdfghjklmnpqrstvwxz")]


def line_bins(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins of each line's features (lines x features), line lengths, lines of each text."""
    lines = [line for t in texts for line in (t or "").split("\n")]
    per_text = np.array([(t or "").count("\n") + 1 for t in texts], np.int64)
    data = np.frombuffer("\n".join(lines).encode("utf-8", "replace") + b"\n", np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.append(0, ends[:-1] + 1)
    size = ends - starts  # the line feed itself is of no class
    words = np.empty(len(lines))
    fresh = np.empty(len(lines))
    again = np.array([False] + [a == b for a, b in zip(lines, lines[1:])])
    for i, line in enumerate(lines):
        w = line.split()
        words[i] = len(w)
        fresh[i] = len(set(w))
    blanks = np.add.reduceat((data == 32).view(np.uint8), starts, dtype=np.int64)
    full = np.maximum(size, 1)
    shares = [np.add.reduceat(c[data], starts, dtype=np.int64) / full for c in _classes()]
    last = data[np.maximum(ends - 1, 0)]
    values = [words, (size - blanks) / np.maximum(words, 1), *shares, 1 - fresh / np.maximum(words, 1),
              np.isin(last, np.frombuffer(b".!?:", np.uint8)) & (size > 0), size == 0, again]
    bins = np.stack([np.searchsorted(e, v, side="left") for e, v in zip(EDGES, values)], axis=1).astype(np.uint8)
    return bins, size + 1, per_text


class LineCRF:
    """Weights: own, previous and next line's bins for 'good'; step[a, b] from state a to b (0 bad, 1 good)."""

    def __init__(self, share: float = 0.5):
        self.tables = np.zeros((3, len(EDGES), BINS))
        self.step = np.zeros((2, 2))
        self.bias, self.share, self.fitted = 0.0, share, False

    @staticmethod
    def _neighbours(bins: np.ndarray, per_text: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(rows, bins) of own, previous and next lines."""
        first = np.zeros(len(bins), bool)
        first[np.cumsum(per_text) - per_text] = True
        has_prev = np.flatnonzero(~first)
        return [(np.arange(len(bins)), bins), (has_prev, bins[has_prev - 1]), (has_prev - 1, bins[has_prev])]

    def potentials(self, near: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
        out = np.full(n, self.bias)
        for table, (rows, bins) in zip(self.tables, near):
            got = np.zeros(len(rows))
            for k in range(len(EDGES)):
                got += table[k][bins[:, k]]
            out[rows] += got
        return out

    def marginals(self, good: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(good) of each line, and the expected counts of the four steps."""
        order = np.argsort(-per_text, kind="stable")
        starts = (np.cumsum(per_text) - per_text)[order]
        sizes = per_text[order]
        emit = np.stack([np.zeros(len(good)), good], axis=1)
        fore, back = np.empty_like(emit), np.zeros_like(emit)
        fore[starts] = emit[starts]
        alive = [int(np.searchsorted(-sizes, -t, side="left")) for t in range(int(sizes.max()))]  # texts with more than t lines
        for t in range(1, len(alive)):
            at = starts[:alive[t]] + t
            p = fore[at - 1]
            fore[at] = emit[at] + np.logaddexp(p[:, :1] + self.step[0], p[:, 1:] + self.step[1])
        for t in range(len(alive) - 1, 0, -1):
            at = starts[:alive[t]] + t
            q = emit[at] + back[at]
            back[at - 1] = np.logaddexp(self.step[:, 0] + q[:, :1], self.step[:, 1] + q[:, 1:])
        both = fore + back
        norm = np.logaddexp(both[:, 0], both[:, 1])
        p = np.exp(both[:, 1] - norm)
        inner = np.ones(len(good), bool)
        inner[np.cumsum(per_text) - per_text] = False
        at = np.flatnonzero(inner)
        pair = fore[at - 1][:, :, None] + self.step[None] + (emit[at] + back[at])[:, None, :] - norm[at][:, None, None]
        return p, np.exp(pair).sum(axis=0)

    def fit(self, bins: np.ndarray, per_text: np.ndarray, y: np.ndarray) -> "LineCRF":
        """Adam on the mean conditional log likelihood of documents, with an L2 penalty."""
        if not len(y) or y.min() == y.max():
            self.share = float(y.mean()) if len(y) else 0.5
            return self
        near, truth = self._neighbours(bins, per_text), np.repeat(y, per_text).astype(float)
        inner = per_text - 1
        seen = np.diag([inner[y == 0].sum(), inner[y == 1].sum()]).astype(float)
        weights = np.zeros(1 + 4 + self.tables.size)
        m, v = np.zeros_like(weights), np.zeros_like(weights)
        for epoch in range(1, EPOCHS + 1):
            self.bias, self.step, self.tables = weights[0], weights[1:5].reshape(2, 2), weights[5:].reshape(self.tables.shape)
            p, steps = self.marginals(self.potentials(near, len(bins)), per_text)
            err = truth - p
            grad = [np.array([err.sum()]), (seen - steps).ravel()]
            for rows, own in near:
                grad += [np.bincount(own[:, k], weights=err[rows], minlength=BINS) for k in range(len(EDGES))]
            g = np.concatenate(grad) / len(y) - PENALTY * weights
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            weights = weights + RATE * (m / (1 - 0.9 ** epoch)) / (np.sqrt(v / (1 - 0.999 ** epoch)) + 1e-8)
        self.bias, self.step, self.tables = weights[0], weights[1:5].reshape(2, 2), weights[5:].reshape(self.tables.shape)
        self.fitted = True
        return self

    def quality(self, texts: list[str | None]) -> np.ndarray:
        """Length-weighted mean marginal of every text."""
        if not self.fitted or not texts:
            return np.full(len(texts), self.share)
        bins, size, per_text = line_bins(texts)
        p, _ = self.marginals(self.potentials(self._neighbours(bins, per_text), len(bins)), per_text)
        at = np.cumsum(per_text) - per_text
        return np.clip(np.add.reduceat(p * size, at) / np.add.reduceat(size, at), 0.0, 1.0)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LineCRF:
    """Fit on at most ``sample_rows`` labelled documents outside the held-out fold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                bins, _, _ = line_bins([text])
                out.append((y, len(bins), bins.tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.binary()))], names=["y", "n", "bins"])

    rows = training_rows(docs, labels, "quality", sample_rows).mapInArrow(run, "y int, n long, bins binary").collect()
    rows.sort(key=lambda r: (r["y"], r["n"], bytes(r["bins"])))  # the same fit whatever the order of tasks
    y, per_text = np.array([r["y"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64)
    bins = np.frombuffer(b"".join(r["bins"] for r in rows), np.uint8).reshape(-1, len(EDGES))
    return LineCRF().fit(bins, per_text, y)


def score(docs: DataFrame, model: LineCRF, name: str = "quality_score") -> DataFrame:
    """All columns of ``docs`` and the score (replacing a column of that name)."""
    kept = [c for c in docs.columns if c.lower() != name]
    text, = fresh(docs, "text_")
    fed = text_batches(docs).select(*kept, F.coalesce(F.col("text"), F.lit("")).alias(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(kept))
            got = np.concatenate([np.zeros(0), *[model.quality(texts.slice(a, TEXTS).to_pylist()) for a in range(0, len(texts), TEXTS)]])
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(kept))], pa.array(got, pa.float64())], names=[*kept, name])

    return fed.mapInArrow(run, fed.select(*kept, F.lit(0.0).alias(name)).schema)
