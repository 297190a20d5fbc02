"""Operators 4 and 9 against brute force."""

import hashlib
import re

import numpy as np
import pytest
import xxhash

from fathom.llm import components, neardup, substring
from fathom.llm import queries as Q

from conftest_llm import CLASHES, SF, edge_rows


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_cut(rows, window=13):
    """For each row: (n_words, n_removed, digest); a null doc_id is larger than others."""
    key = lambda d: float("inf") if d is None else d
    first = {}
    for d, t in rows:
        w = words(t)
        for k in range(len(w) - window + 1):
            g = tuple(w[k:k + window])
            first[g] = min(first.get(g, float("inf")), key(d))
    out = []
    for d, t in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < key(d):
                gone.update(range(k, k + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def as_rows(df):
    return order((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize("sizes", [{}, {"group_windows": 500, "bucket_windows": 1000}])
def test_cut(docs, sizes):
    assert as_rows(substring.drop_repeats(docs, **sizes)) == order(brute_cut([(r.doc_id, r.text) for r in docs.collect()]))


def test_cut_edges(edge):
    got = substring.drop_repeats(edge, prefix="cut_")
    assert set(CLASHES) <= set(got.columns)
    assert all(r.kept == "own kept" for r in got.collect())
    plain = substring.drop_repeats(edge)
    assert as_rows(plain) == order(brute_cut([r[:2] for r in edge_rows()]))


def test_empty(empty):
    assert substring.drop_repeats(empty).count() == 0
    assert neardup.near_duplicates(empty).count() == 0
    assert neardup.keep_first(empty).count() == 0


def test_rolling_is_the_polynomial():
    h = np.random.default_rng(0).integers(0, 1 << 63, 40).astype(np.uint64)
    got = substring.rolling(h, 5)
    for i in range(36):
        assert int(got[i]) == sum(int(h[i + j]) * substring.BASE ** j for j in range(5)) % (1 << 64)


def brute_simhash(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    """[(doc_id, fingerprint, component)]; rows without an id give none."""
    fps = [brute_simhash(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return order((d, f"{fps[i]:016x}", least.get(root(i))) for i, (d, _) in enumerate(rows))


def test_near_duplicate_query(spark, docs):
    got = order((r.doc_id, r.fingerprint, r.component_id) for r in Q.op9_simhash_bktree(spark, SF).collect())
    assert got == brute_components([(r.doc_id, r.text) for r in docs.collect()])


def test_near_duplicate_edges(edge):
    got = order((r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in neardup.near_duplicates(edge).collect())
    assert got == brute_components([r[:2] for r in edge_rows()])


def test_keep_first_keeps_one_row_a_component(edge):
    kept = neardup.keep_first(edge)
    assert kept.columns == edge.columns
    want = {c for _, _, c in brute_components([r[:2] for r in edge_rows()])}
    ids = [r.doc_id for r in kept.collect()]
    assert set(ids) - {None} == want - {None}
    assert sorted(i for i in ids if i is not None) == [1, 3, 6, 7, 8, 8]  # 8: two texts that are not alike


@pytest.mark.parametrize("tree_rows", [4096, 7])
def test_links_of_a_dense_ball(spark, tree_rows):
    """Fingerprints around a few centres: hot shards are cut into sub-trees without losing a link."""
    rng = np.random.default_rng(5)
    fps = set()
    for centre in rng.integers(0, 1 << 62, 4):
        for _ in range(60):
            f = int(centre)
            for b in rng.integers(0, 64, 3):
                f ^= 1 << int(b)
            fps.add(f)
    fps |= {int(x) for x in rng.integers(0, 1 << 62, 100)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {r.node: r.root for r in components.components(neardup.links(df, tree_rows=tree_rows)).collect()}
    up = {f: f for f in signed}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    for i, a in enumerate(signed):
        for b in signed[:i]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4:
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    assert {f: got.get(f, f) for f in signed} == {f: root(f) for f in signed}


def test_tree_edges_are_distances():
    fps = np.unique(np.random.default_rng(2).integers(0, 1 << 63, 300).astype(np.uint64))
    tree = neardup.BKTree(fps)
    for i, kids in enumerate(tree.children):
        for e, c in kids:
            assert (int(fps[i]) ^ int(fps[c])).bit_count() == e
        assert len({e for e, _ in kids}) == len(kids)
    found = {(n, int(q)) for n, near in tree.within(fps, 20) for q in near}
    assert found == {(i, j) for i in range(len(fps)) for j in range(len(fps)) if (int(fps[i]) ^ int(fps[j])).bit_count() <= 20}


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(200, 260)] + [(5, 5), (7, 3), (3, 7)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 1 for i in [1, *range(200, 260)]}, 7: 3, 3: 3}
