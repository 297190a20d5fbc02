"""Each stage against its operator's brute force on its own input; oracles; the entry point."""

import __spark_entry__ as entry
import corpus_pipeline
from oracle_util import compare, duck

from conftest_llm import SF
from test_dedup import brute_components, words
from test_native import brute_leaks

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, read):
    docs = read("documents")
    benchmark = [(r.item_id, r.text) for r in read("benchmark").collect()]
    labels = {r.doc_id: r.quality for r in read("labels").collect()}
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        out = stage(spark, docs, SF)
        if name == "packing":
            assert {r.doc_id for r in out.collect()} == {d for d, _ in before}
            break
        assert out.columns == COLUMNS
        after = {r.doc_id: r.text for r in out.collect()}
        if name == "quality classifier":
            good = [d for d, _ in before if labels.get(d) == 1]
            bad = [d for d, _ in before if labels.get(d) == 0]
            assert sum(d in after for d in good) >= 0.95 * len(good) and sum(d in after for d in bad) <= 0.2 * max(1, len(bad))
        if name == "simhash near-dedup":
            assert set(after) == {c for _, _, c in brute_components(before)}
        if name == "substring dedup":
            first = {}
            for d, t in sorted(after.items()):
                w = words(t)
                for k in range(len(w) - 12):
                    assert first.setdefault(tuple(w[k:k + 13]), d) == d or t != dict(before)[d]
            assert all(t == dict(before)[d] or set(words(t)) <= set(words(dict(before)[d])) for d, t in after.items())
        if name == "benchmark decontamination":
            assert set(after) == {d for d, _ in before} - {d for d, _ in brute_leaks(before, benchmark)}
        seen.append(len(after))
        docs = corpus_pipeline.materialize(out, "test")
    assert seen == sorted(seen, reverse=True)


def test_run_and_edges(spark, edge, empty):
    assert corpus_pipeline.run(spark, SF).count() > 0
    for docs in (edge, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            docs = corpus_pipeline.materialize(out, "test")
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).count()


def test_oracles(spark):
    con = duck(SF)
    names = [n for n in entry.oracle_sql() if n.startswith("op")]
    assert len(names) == 3
    for n in names:
        assert compare(entry.queries()[n](spark, SF), con, entry.oracle_sql()[n]) is None, n


def test_registered():
    found = set(entry.queries())
    assert "pipeline" in found and all(any(n.startswith(f"op{k}_") for n in found) for k in range(1, 11))
