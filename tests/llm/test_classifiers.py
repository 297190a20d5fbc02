"""Operators 2 and 5: held-out accuracy, exact sums against enumeration, defined results at the edges."""

import collections
import itertools
import zlib

import numpy as np
import pytest

from fathom.llm import crf, toxicity
from fathom.llm import queries as Q

from conftest_llm import CLASHES

SF01 = "/root/testdata/sf0.1"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.mark.parametrize("query,label,bar", [(Q.op2_crf_quality, "quality", 0.97), (Q.op5_ftrl_toxicity, "toxic", 0.95)])
def test_held_out_accuracy(spark, query, label, bar):
    got = {r.doc_id: r for r in query(spark, SF01).collect()}
    assert len(got) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    labels = [(r.doc_id, r[label]) for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()]
    right = [got[d].predicted == y for d, y in labels if held(d)]
    assert np.mean(right) >= bar
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in got.values())


def test_labels_of_the_held_out_fold_are_not_learned(spark, read):
    """Flipping them changes no score."""
    docs, labels = read("documents"), read("labels")
    from pyspark.sql import functions as F
    from fathom.llm.labelled import held_out
    flipped = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted((r.doc_id, r.quality_score) for r in crf.score(docs, crf.train(docs, x)).select("doc_id", "quality_score").collect()) for x in (labels, flipped))
    assert a == b


def test_marginals_are_sums_over_all_paths():
    rng = np.random.default_rng(1)
    model = crf.LineCRF()
    model.step = rng.normal(size=(2, 2))
    per_text = np.array([1, 4, 2, 5])
    good = rng.normal(size=12)
    p, steps = model.marginals(good, per_text)
    at, want_steps = 0, np.zeros((2, 2))
    for n in per_text:
        paths = list(itertools.product((0, 1), repeat=int(n)))
        w = np.array([np.exp(sum(good[at + i] * s for i, s in enumerate(path)) + sum(model.step[a, b] for a, b in zip(path, path[1:]))) for path in paths])
        w /= w.sum()
        for i in range(n):
            assert p[at + i] == pytest.approx(sum(x for x, path in zip(w, paths) if path[i]))
        for x, path in zip(w, paths):
            for a, b in zip(path, path[1:]):
                want_steps[a, b] += x
        at += n
    assert steps == pytest.approx(want_steps)


@pytest.mark.parametrize("module,label,name", [(crf, "quality", "quality_score"), (toxicity, "toxic", "toxic_score")])
def test_edges(spark, edge, empty, read, module, label, name):
    labels = read("labels")
    model = module.train(read("documents"), labels)
    rows = module.score(edge, model).collect()
    assert len(rows) == 13 and all(0 <= r[name] <= 1 for r in rows)
    by_text = {}
    for r in rows:
        by_text.setdefault(r.text or "", set()).add(r[name])
    assert all(len(s) == 1 for s in by_text.values())
    assert set(CLASHES) <= set(module.score(edge, model).columns)
    assert module.score(empty, model).count() == 0
    none = module.train(read("documents"), labels.limit(0))
    assert {r[name] for r in module.score(edge, none).collect()} == {0.5 if module is crf else 0.0}
    one = module.train(read("documents"), labels.where(f"{label} = 1"))
    assert {r[name] for r in module.score(edge, one).collect()} == {1.0}


def test_weights_are_sparse(spark, read):
    model = toxicity.train(read("documents"), read("labels"))
    assert len(model.keys) < 5000


def _plain_ftrl(rows, y):
    """FTRL-proximal one coordinate at a time, in dictionaries, with every feature."""
    z, n = collections.Counter(), collections.Counter()

    def weight(k):
        l1 = 0.0 if k is None else toxicity.L1
        if abs(z[k]) <= l1:
            return 0.0
        return -(z[k] - np.sign(z[k]) * l1) / ((toxicity.BETA + n[k] ** 0.5) / toxicity.ALPHA + toxicity.L2)

    balance = toxicity.POSITIVE_SHARE * (len(y) - sum(y)) / sum(y)
    order = np.random.default_rng(7).permutation(len(rows))
    for _ in range(toxicity.EPOCHS):
        for i in order:
            keys = [*rows[i].tolist(), None]
            w = {k: weight(k) for k in keys}
            p = 1 / (1 + np.exp(-np.clip(sum(w.values()), -35, 35)))
            g = (p - y[i]) * (balance if y[i] else 1.0)
            for k in keys:
                sigma = ((n[k] + g * g) ** 0.5 - n[k] ** 0.5) / toxicity.ALPHA
                z[k] += g - sigma * w[k]
                n[k] += g * g
    return {k: weight(k) for k in z if k is not None and weight(k)}, weight(None)


@pytest.mark.parametrize("toxic", [5, 60])
def test_fit_is_plain_ftrl_over_every_feature(toxic):
    """Few toxic rows weigh much each: features of one or two rows get weights too, as without leaving any out."""
    rng = np.random.default_rng(toxic)
    y = np.array([1.0] * toxic + [0.0] * (150 - toxic))
    rows = [np.unique(np.concatenate([rng.integers(0, 40, 6), rng.integers(1000, 1400, 6), [7000 + int(t)] if rng.random() < 0.7 else []]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for t in y]
    model = toxicity.FTRL().fit(rows, y)
    weights, bias = _plain_ftrl(rows, y)
    assert dict(zip(model.keys.tolist(), model.weights)) == pytest.approx(weights)
    assert model.bias == pytest.approx(bias)
    seen = collections.Counter(k for r in rows for k in r.tolist())
    if toxic == 5:
        assert any(seen[k] < 3 for k in weights)
