"""Operator 13: against scores of all documents by brute force, with small trees and blocks, and on odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from fathom.llm import lexical

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, top=10):
    known = [(i, Counter(terms(t))) for i, t in docs]
    known = [(i, c, sum(c.values())) for i, c in known if c]
    n_docs, length = len(known), sum(n for _, _, n in known)
    df = Counter(t for _, c, _ in known for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in set(items):
        found = []
        for i, c, n in known:
            m = 25 + (75 * n * n_docs) // length
            score = sum(w[t] * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if score > 0:
                found.append((-score, i is not None, i or 0, i))
        out += [(item, k, i, -s) for k, (s, _, _, i) in enumerate(sorted(found, key=lambda f: f[:3])[:top], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_given_tables(spark, docs, read):
    items = read("benchmark")
    found = lexical.search(docs, items)
    assert got(found) == brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])


@pytest.mark.parametrize("chunk, leaf, block_bytes", [(20_000, 96, 4 << 20), (40, 4, 150)])
def test_small_trees_and_blocks(spark, monkeypatch, chunk, leaf, block_bytes):
    monkeypatch.setattr(lexical, "CHUNK_DOCS", chunk)
    monkeypatch.setattr(lexical.BallTree.__init__, "__defaults__", (leaf,))
    rng = random.Random(5)
    words = [f"w{k}" for k in range(60)] + ["É", "naïve", "日本"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(400)]
    docs += [(1000 + i, "w1 w2 w3") for i in range(50)] + [(7, "w1 w2 w3")]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(25)] + [(99, "w1 w1 w2"), (98, "absent")]
    found = lexical.search(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), block_bytes=block_bytes)
    assert got(found) == brute(docs, items)


def test_bounds_hold_and_prune():
    """Every document's score lies under the bounds of all balls that hold it, and most leaves go unvisited."""
    rng = np.random.default_rng(3)
    groups, width = 40, 400
    rows = [np.unique(np.append(10 * (k % groups) + rng.integers(0, 10, 6), rng.integers(0, width, 2))) for k in range(4000)]
    ptr = np.append(0, np.cumsum([len(r) for r in rows]))
    terms_, values = np.concatenate(rows), rng.integers(1, 8_000_000_000, int(ptr[-1]))
    counts = [{int(t): int(rng.integers(1, 3)) for t in 10 * (g % groups) + rng.permutation(10)[:5]} for g in range(8)]
    queries = lexical.Queries(counts)
    tree = lexical.BallTree(ptr, terms_, values, width, queries, leaf=32)
    dense = np.zeros((len(counts), width), np.int64)
    for q, c in enumerate(counts):
        dense[q, list(c)] = list(c.values())
    for q in range(len(counts)):
        exact = tree.scores(0, 4000, dense[q])
        for (lo, hi), bound in zip(tree.spans, tree.bounds):
            assert exact[lo:hi].max() <= bound[q]
        best, visited = lexical.Best(10), 0
        for lo, hi in tree.leaves(q, best.floor):
            visited += 1
            best.add(tree.scores(lo, hi, dense[q]), [int(i) for i in tree.order[lo:hi]])
        assert best.floor[0] == np.sort(exact)[-10]
        assert visited < sum(c is None for c in tree.children) / 2


def test_odd_rows(spark, edge, empty):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    items = [(1, "One two FIFTEEN sixteen"), (1, "One two FIFTEEN sixteen"), (1, "five"), (None, "é ß 日本 inst"), (2, None), (3, ""), (4, "..."), (5, "word word end")]
    asked = spark.createDataFrame(items, ITEMS).selectExpr("*", "'own' AS rank", "'own' AS score", "1 AS block", "2 AS item")
    assert got(lexical.search(edge, asked)) == brute(rows, [(i, t) for i, t in items if t is not None])
    assert lexical.search(empty, asked).count() == 0
    assert lexical.search(edge, asked.limit(0)).count() == 0
    assert lexical.search(edge.limit(0), asked).schema == lexical.search(edge, asked).schema


def test_session_setting_comes_back(spark, docs, read):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    lexical.search(docs, read("benchmark"))
    assert spark.conf.get(key) == before
