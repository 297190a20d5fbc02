"""Operator 12: targets by plain resharing, whole spans, an even schedule, and odd rows."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fathom.llm import mixing

DOCS = "doc_id long, source string, text string"


def plain_targets(sizes: dict) -> dict:
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    full: set = set()
    while True:
        free = sum(weight[s] for s in names if s not in full)
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        now = {s: 3.0 * sizes[s] if s in full else weight[s] * left / free for s in names}
        over = {s for s in names if s not in full and now[s] > 3 * sizes[s]}
        if not over:
            return now
        full |= over


def given(rows):
    sizes = Counter()
    for _, source, text in rows:
        sizes[source] += len((text or "").split())
    return sizes


def check(spark, df, rows, block=mixing.BLOCK_WORDS):
    out = mixing.taken(df, block).collect()
    assert len(out) == len(rows)
    sizes, want = given(rows), plain_targets(given(rows))
    size_of = defaultdict(Counter)
    for doc_id, source, text in rows:
        size_of[doc_id][len((text or "").split()), sizes[source], round(want[source], 6)] += 1
    assert size_of == {i: Counter((r.size, r.source_size, round(r.target, 6)) for r in out if r.doc_id == i) for i in size_of}
    assert all(0 <= r.taken <= 3 * r.size for r in out)
    by_target = Counter()
    for r in out:
        by_target[r.target, r.source_size] += r.taken
    expect = Counter()
    for s, t in want.items():
        expect[round(t, 6), sizes[s]] += int(t + 0.5)
    assert {(round(t, 6), s): v for (t, s), v in by_target.items()} == expect
    return out


def test_given_documents(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "source", "text").collect()]
    rows = [(i, s, " ".join(w for w in __import__("re").split(r"[\x20\x09-\x0D]+", t or "") if w).replace("\x1c", "-").replace("\x85", "-").replace("\xa0", "-")) for i, s, t in rows]
    df = spark.createDataFrame(rows, DOCS)
    first = check(spark, df, rows, 256)
    assert sorted(first) == sorted(mixing.taken(df.repartition(7), 256).collect())


@pytest.mark.parametrize("block", [1, 7, 64])
def test_spans_follow_the_streams(spark, block):
    rows = [(i, ("a", "b", "c", None, "d")[i % 5], "w " * (i * 13 % 40)) for i in range(120)] + [(500, "d", "long " * 900)]
    df = spark.createDataFrame(rows, DOCS)
    check(spark, df, rows, block)
    spans = sorted(mixing.mix(df, block).collect(), key=lambda r: (r.slot, r.offset))
    slots = defaultdict(list)
    for r in spans:
        slots[r.slot].append(r)
    last = {}
    for slot, its in slots.items():
        assert len({r.no for r in its}) == 1
        assert [r.offset for r in its] == [sum(x.length for x in its[:k]) for k in range(len(its))]
        assert all(r.length > 0 and r.start + r.length <= r.size for r in its)
        length = sum(r.length for r in its)
        assert length <= block
        assert last.get(its[0].no, block) == block  # only the last block of a source may be short
        last[its[0].no] = length
    # an epoch of a source begins only when the one before has been taken whole
    for no in {r.no for r in spans}:
        its = [r for r in spans if r.no == no]
        assert [r.epoch for r in its] == sorted(r.epoch for r in its)
        for e in range(max(r.epoch for r in its)):
            assert sum(r.length for r in its if r.epoch == e) == its[0].source_size


def test_schedule_is_even(spark):
    """Any stretch from the start of the schedule holds each source close to its share."""
    blocks = {0: 900, 1: 60, 2: 40, 3: 1, 4: 2000}
    df = spark.createDataFrame(list(blocks.items()), "no long, blocks long")
    out = sorted(mixing.slots(df).collect(), key=lambda r: r.slot)
    total = sum(blocks.values())
    assert len({r.slot for r in out}) == len(out) == total
    seen = Counter()
    for k, r in enumerate(out, 1):
        assert r["rank"] == seen[r.no]
        seen[r.no] += 1
        assert all(abs(seen[s] - k * n / total) < 2 + k.bit_length() for s, n in blocks.items())


def test_running_totals_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 16)
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", "w " * (1 + i % 9)) for i in range(400)]
    check(spark, spark.createDataFrame(rows, DOCS), rows, 5)


def test_odd_rows(spark, empty):
    base = [(1, "a", "one two"), (1, "a", "one two"), (1, "b", "one two"), (None, None, "x y z"), (None, None, "x y z"), (None, "a", None), (2, "", ""), (3, "é", " \t\n"),
            (4, "b", "word " * 30_000), (5, "z", None)]
    df = spark.createDataFrame(base, DOCS)
    out = check(spark, df, base)
    wide = df.selectExpr("*", *[f"'own' AS {c}" for c in ("size", "hash", "copies", "no", "target", "at", "rank", "slot", "copy", "blocks", "_c", "_key")])
    assert sorted(map(str, mixing.taken(wide).collect())) == sorted(map(str, out))
    assert mixing.taken(empty).count() == 0 and mixing.mix(empty).count() == 0
    blank = spark.createDataFrame([(1, "a", ""), (2, None, None)], DOCS)
    assert [(r.size, r.source_size, r.target, r.taken) for r in mixing.taken(blank).collect()] == [(0, 0, 0.0, 0)] * 2


def test_no_single_task_holds_a_source(spark, docs):
    """Windows over documents are partitioned by (source, chunk)."""
    plan = mixing.lay_out(docs)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert docs.select(F.count("*")).first()[0] > 0
