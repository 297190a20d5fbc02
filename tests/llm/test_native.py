"""Operators 6, 7, 8 and 10 against brute force; none of them runs Python in its plan."""

import collections
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from fathom.llm import chat, decontam, iblt, licenses
from fathom.llm import queries as Q

from conftest_llm import SF, edge_rows


def no_python(df):
    plan = df._jdf.queryExecution().toString()
    assert not re.search(r"Python|Pandas|Arrow", plan)
    return df


# 6 -----------------------------------------------------------------------------------------------------------------


def pieces(text):
    return collections.Counter(p for p in text.replace(". ", ".\n").split("\n") if p)


def alike(x, y):
    a, b = pieces(x), pieces(y)
    return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0


def brute_edits(rows):
    rows = sorted(rows, key=lambda r: -r[0])
    for k, (d, x) in enumerate(rows):
        x, y = x or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(x) // 2
        e = x[:len(x) - half] + y[:half]
        yield d, len(x), hashlib.sha256(e.encode()).hexdigest(), alike(x, e), alike(x, y)


@pytest.mark.parametrize("range_rows", [2000, 30])
def test_edits(docs, range_rows):
    got = {r.doc_id: r for r in no_python(iblt.fingerprint_edits(docs, range_rows)).collect()}
    assert len(got) == docs.count()
    for d, n, digest, near_edited, near_next in brute_edits([(r.doc_id, r.text) for r in docs.collect()]):
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (n, digest)
        assert r.near_edited == pytest.approx(near_edited) and r.near_next == pytest.approx(near_next)


def test_small_sketches_are_retried(docs, monkeypatch):
    monkeypatch.setattr(iblt, "ROOM", 0.3)
    monkeypatch.setattr(iblt, "LEAST_CELLS", 1)
    test_edits(docs, 2000)


def test_edit_edges(spark, edge, empty):
    rows = iblt.fingerprint_edits(edge).collect()
    assert len(rows) == 13
    prints = collections.defaultdict(set)
    for r, in zip(rows):
        prints[r.doc_id, r.n_chars].add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert iblt.fingerprint_edits(empty).count() == 0
    one = iblt.fingerprint_edits(edge.where("doc_id = 7")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def paragraph_digests(spark, texts):
    """Per text its elements, by the library's own hash, and their number by plain counting."""
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    rows = {r.i: set(r.e) for r in df.select("i", iblt.elements(F.col("text")).alias("e")).collect()}
    assert [len(rows[i]) for i in range(len(texts))] == [sum(pieces(t).values()) for t in texts]
    return [rows[i] for i in range(len(texts))]


def test_recovered_digests_name_what_differs(spark, docs):
    """Every digest on its side, against the elements of both texts."""
    given = sorted(((r.doc_id, r.text) for r in docs.limit(60).collect()), key=lambda r: -r[0])
    nexts = [given[(k + 1) % len(given)][1] for k in range(len(given))]
    a = paragraph_digests(spark, [t for _, t in given])
    n = paragraph_digests(spark, nexts)
    e = paragraph_digests(spark, [t[:len(t) - len(t) // 2] + y[:len(t) // 2] for (_, t), y in zip(given, nexts)])
    want = set()
    for k, (d, _) in enumerate(given):
        for version, other in (("edited", e[k]), ("next", n[k])):
            want |= {(d, version, 1, x) for x in a[k] - other} | {(d, version, -1, x) for x in other - a[k]}
    df = spark.createDataFrame(given, "doc_id long, text string").withColumn("side", F.lit("own"))
    rows = [tuple(r) for r in no_python(iblt.recovered(df)).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_stored_fingerprints_subtract(spark):
    base = [f"Paragraph {k} of the text." for k in range(40)]
    pairs = [(1, base, base), (2, base, base[:-2]), (3, base, base[:10] + ["New one."] + base[11:]), (4, base, []), (5, base, [f"Other {k}." for k in range(40)]), (None, ["a"], ["b"])]
    texts = [("\n".join(x), "\n".join(y)) for _, x, y in pairs]
    own = paragraph_digests(spark, [t for xy in texts for t in xy])
    df = spark.createDataFrame([(i, *xy) for (i, _, _), xy in zip(pairs, texts)], "id long, x string, y string")
    prints = df.select("id", iblt.print_of(iblt.elements(F.col("x"))).alias("a"), iblt.print_of(iblt.elements(F.col("y"))).alias("b"))
    got = {r.id: r for r in no_python(iblt.compare_prints(prints, "a", "b", ["id"])).collect()}
    assert set(got) == {i for i, _, _ in pairs}
    for k, (i, _, _) in enumerate(pairs):
        left, right = own[2 * k], own[2 * k + 1]
        if i in (1, 2, 3, None):
            assert got[i].decoded and set(got[i].only_a) == left - right and set(got[i].only_b) == right - left
        else:  # far more than 24 cells can tell apart: said so, and what is named is right
            assert not got[i].decoded
        assert set(got[i].only_a) <= left - right and set(got[i].only_b) <= right - left


# 7 -----------------------------------------------------------------------------------------------------------------


def brute_leaks(docs, items, near=0.8):
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
    bag = lambda w: collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))
    want = {}
    for i, it in items:
        iw = split(it)
        if not iw:
            continue
        a = bag(iw)
        for d, t in docs:
            w = split(t)
            if not w or not (len(iw) < 5 or set(a) & set(bag(w))):
                continue
            best = max((sum((a & b).values()) / sum((a | b).values()) for s in range(max(1, len(w) - len(iw) + 1)) for b in [bag(w[s:s + len(iw)])]))
            if best >= near:
                want[d, i] = max(best, want.get((d, i), 0))
    return want


def leaks(df):
    return {(r.doc_id, r.item_id): r.similarity for r in df.collect()}


def test_leaks(spark, docs, read):
    want = brute_leaks([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in read("benchmark").collect()])
    got = leaks(no_python(Q.op7_benchmark_decontamination(spark, SF)))
    assert got == pytest.approx(want)


def test_edited_leaks_and_edges(spark, edge, empty, monkeypatch):
    item = " ".join(f"w{i}" for i in range(50))
    changed = item.replace("w20", "other")  # 5 of 46 shingles differ: 41 / 51
    longer = item.replace("w3 ", "w3 more ")
    items = spark.createDataFrame([(1, item, "x"), (1, item, "x"), (2, None, "x"), (3, "", "x"), (4, "a b", "x"), (5, "lone", "x")], "item_id long, text string, fp string")
    rows = [(1, f"before it {item} after it"), (2, f"x {changed} y"), (3, f"x {longer} y"), (4, "A  B"), (5, "a b c d e f"), (6, None), (7, item.upper())]
    docs = spark.createDataFrame([(d, t, "own") for d, t in rows], "doc_id long, text string, th string")
    got = leaks(decontam.contaminated(docs, items))
    want = brute_leaks([r for r in rows if len((r[1] or "").split()) > 3], [(1, item)]) | {(4, 4): 1.0}
    assert got == pytest.approx(want)
    # more seeds than a block holds change nothing
    assert leaks(decontam.contaminated(docs, items, seed_block=3)) == pytest.approx(want)
    # nor does the way that a large benchmark takes
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    assert leaks(decontam.contaminated(docs, items)) == pytest.approx(want)
    monkeypatch.undo()
    kept = decontam.drop_contaminated(docs, items)
    assert sorted(r.doc_id for r in kept.collect()) == [5, 6] and kept.columns == docs.columns
    assert decontam.contaminated(empty, items).count() == 0
    assert decontam.contaminated(edge, items.limit(0)).count() == 0
    assert decontam.drop_contaminated(edge, items).count() == 13


def test_items_cut_at_the_ends(spark):
    words = [f"w{i}" for i in range(100)]
    docs = [(100 * front + back, " ".join(words[front:100 - back])) for front in range(0, 25, 4) for back in range(0, 25, 4)]
    docs += [(10_000 + d, f"before it {t} after it") for d, t in docs if d % 100 < 9 and d < 900]
    items = [(1, " ".join(words)), (2, " ".join(words[:15]))]
    want = brute_leaks(docs, items)
    assert (1600, 1) in want and (8, 1) in want and (808, 1) in want and (2400, 1) not in want
    frame = lambda rows, names: spark.createDataFrame(rows, names)
    got = leaks(decontam.contaminated(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string")))
    assert got == pytest.approx(want)


def test_reordered_passages(spark, monkeypatch):
    words = [f"w{i}" for i in range(100)]
    twice = [f"t{i % 20}" for i in range(60)]  # shingles that repeat within the item
    moved = [words[-cut:] + words[:-cut] for cut in (5, 20, 40, 60, 80, 95)] + [words[:30] + words[60:] + words[30:60], words[::-1]]
    moved += [twice, twice[30:] + twice[:30], twice[7:] + twice, words[:15] + twice + words[15:]]
    docs = [(d, " ".join(w)) for d, w in enumerate(moved)] + [(100 + d, " ".join(["x", "y", "z"] * 40 + w + ["x", "y", "z"] * 40)) for d, w in enumerate(moved)]
    items = [(1, " ".join(words)), (2, " ".join(twice)), (3, " ".join(words[:40]))]
    want = brute_leaks(docs, items)
    assert {(101, 1), (102, 1), (106, 1), (109, 2)} <= set(want) and (107, 1) not in want
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    assert leaks(decontam.contaminated(docs, items)) == pytest.approx(want)
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    assert leaks(decontam.contaminated(docs, items)) == pytest.approx(want)


def test_blocks_miss_nothing_within_the_radius(spark):
    import random
    rnd = random.Random(4)
    pairs = []
    for _ in range(200):
        a = rnd.getrandbits(64)
        b = a
        for bit in rnd.sample(range(64), rnd.randint(0, decontam.RADIUS)):
            b ^= 1 << bit
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    df = spark.createDataFrame(pairs, "a long, b long")
    hit = F.size(F.array_intersect(decontam.blocks(F.col("a")), decontam.blocks(F.col("b")))) > 0
    assert df.where(hit).count() == len(pairs)


# 8 -----------------------------------------------------------------------------------------------------------------


def test_every_known_sentence_is_recognised(spark):
    rows = [(i, f"Some text. {text}\nmore", name) for i, (name, text) in enumerate(licenses.SENTENCES.items())]
    df = spark.createDataFrame(rows, "doc_id long, text string, name string")
    assert all(r.ids == [r.name] for r in df.select("name", licenses.recognised(F.col("text")).alias("ids")).collect())


def test_rules_in_order(spark, edge, empty):
    s = licenses.SENTENCES
    mit = "\n".join([s["mit-grant"], "unknown line", s["mit-notice"], s["mit-asis"]])
    rows = [(1, mit), (2, "\n".join([s["mit-notice"], s["mit-grant"], s["mit-asis"]])), (3, "ALL RIGHTS   reserved!\nAll rights reserved"),
            (4, "\n".join([s["bsd-redistribution"], s["bsd-source"], s["bsd-binary"], s["bsd-names"]])), (5, None),
            (6, "\n".join([s["bsd-redistribution"], s["bsd-source"], s["bsd-binary"]]))]
    df = no_python(licenses.scan(spark.createDataFrame([(*r, "own") for r in rows], "doc_id long, text string, rule string")))
    assert sorted((r.doc_id, r.rule, r.n_matches, r.n_sentences) for r in df.collect()) == [
        (1, "mit-text", 1, 3), (3, "reserved", 2, 2), (4, "bsd3-text", 1, 4), (6, "bsd2-text", 1, 3)]
    assert licenses.scan(edge).count() == 0 and licenses.scan(empty).count() == 0


def test_wrapped_and_commented_licences(spark):
    import textwrap
    s = licenses.SENTENCES
    mit = [s["mit-grant"], s["mit-notice"], s["mit-asis"] + " IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM."]
    apache = [s["apache-may-not"] + " " + s["apache-copy"], s["apache-url"], s["apache-asis"] + "  See the License for the language."]
    gpl = [s["gpl-free"], s["gpl-hope"] + "  See the GNU General Public License for more details."]
    bsd2 = [s["bsd-redistribution"], "1. " + s["bsd-source"], "2. " + s["bsd-binary"]]
    bsd3 = bsd2 + ["3. " + s["bsd-names"], "THIS SOFTWARE IS PROVIDED AS IT IS."]
    want = {"mit-text": (mit, 3), "apache-header": (apache, 4), "gpl3-header": (gpl, 2), "bsd2-text": (bsd2, 3), "bsd3-text": (bsd3, 4)}
    rows, expected = [], set()
    for rule, (paragraphs, n) in want.items():
        for width in (40, 72, 79):
            for first, mark, last in (("", "", ""), ("/*\n", " * ", "\n */\n"), ("#!/bin/sh\n", "# ", ""), ("", "// ", "\n"), ("<!--\r\n", "  ", "-->")):
                # the address stands in a line of its own, as it is published
                lines = [line for p in paragraphs for line in [*textwrap.wrap(p.replace(s["apache-copy"], ""), width),
                                                               *([s["apache-copy"]] if s["apache-copy"] in p else []), ""]]
                text = first + "\n".join((mark + line).rstrip() for line in ["Copyright (c) 2020 Someone", "", *lines]) + last + "\ncode = 1"
                rows.append((len(rows), text))
                expected.add((len(rows) - 1, rule, 1, n))
    # no blank line round the address, a sentence that goes on, and one broken by a blank line
    tight = "\n".join("# " + line for p in (apache[0], apache[1], apache[2]) for line in textwrap.wrap(p, 90))
    rows += [(1000, tight.replace("You may obtain", "\n# You may obtain").replace("of\n# the License at", "of the License at")),
             (1001, "All rights\nreserved to nobody"), (1002, "All rights\n\nreserved"), (1003, " * All\n * rights\n * reserved."),
             (1004, "Licensed under the Apache License,\nVersion 2.0")]
    expected |= {(1000, "apache-header", 1, 4), (1003, "reserved", 1, 1), (1004, "apache-licence-line", 1, 1)}
    df = no_python(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {(r.doc_id, r.rule, r.n_matches, r.n_sentences) for r in df.collect()} == expected


# 10 ----------------------------------------------------------------------------------------------------------------

HARD = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]"), (-2, 0, "tool", "a\\b<\\s><</s"),
        (-2, 1, "x<<TEXT>>y\\", "<s><<TEXT>>z"), (-2, 2, None, None), (-2, 3, "assistant", ""), (-2, 4, "system", "q"),
        (-2, 5, "assistant", "[\\INST] \\\\[[INST]/INST] \n\n<"), (-2, 5, "assistant", "[\\INST] \\\\[[INST]/INST] \n\n<"), (-3, None, "user", "no turn"),
        (None, 1, "assistant", "no conversation"), (-4, 0, "user", "long " * 20_000), (-4, 1, "assistant", "é日本 <<SYS>> " * 300)]


@pytest.mark.parametrize("budget,history", [(512, 128), (60, 30), (1, 0), (5, 50)])
def test_chat_reads_back(spark, read, budget, history):
    turns = read("conversations").select("conv_id", "turn", "role", "text").union(spark.createDataFrame(HARD, "conv_id long, turn long, role string, text string"))
    turns = turns.withColumn("win", F.lit("own")).withColumn("sys", F.lit(1))
    windows = chat.format_windows(turns, budget, history)
    got = {r.conv_id: r for r in no_python(chat.digests(windows)).collect()}
    convs = collections.defaultdict(list)
    for r in turns.collect():
        convs[r.conv_id].append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    assert set(got) == set(convs)
    for c, rows in convs.items():
        rows.sort()
        said = "".join(f"{r[2]}\n{r[3]}\n" for r in rows)
        goal = "".join(r[3] for r in rows if r[2] == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (
            len(rows), hashlib.sha256(said.encode()).hexdigest(), len(goal), hashlib.sha256(goal.encode()).hexdigest())


def test_windows_keep_the_system_turn(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, i, "user" if i % 2 else "assistant", "w " * 9) for i in range(1, 21)]
    windows = chat.format_windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), 40, 15).orderBy("window").collect()
    assert all(w.text.startswith("<<SYS>>be kind<</SYS>>") for w in windows)
    assert all(w.n_repeated == 2 for w in windows[1:]) and sum(len(w.loss) for w in windows) == 10


@pytest.mark.parametrize("budget,history", [(512, 128), (300, 64), (90, 20)])
def test_windows_fit_the_budget(spark, read, budget, history):
    """System turn, history and new turns together stay within the budget, but for turns that leave no room by themselves."""
    rows = [(10_000, 0, "system", "s " * 30)] + [(10_000, i, "user" if i % 2 else "assistant", "w " * (i * 37 % 60)) for i in range(1, 400)]
    turns = read("conversations").select("conv_id", "turn", "role", "text").union(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    placed = chat.window_turns(turns, budget, history).collect()
    system = {r.conv_id: r.tokens for r in sorted(placed, key=lambda r: -r.no) if r.role == "system"}
    members = collections.Counter((r.conv_id, r.win) for r in placed)
    longest = collections.Counter()
    for r in placed:
        longest[r.conv_id, r.win] = max(longest[r.conv_id, r.win], r.tokens)
    windows = chat.format_windows(turns, budget, history).collect()
    assert {(w.conv_id, w.window) for w in windows} == set(members)
    for w in windows:
        room = budget - history - system.get(w.conv_id, 0)
        assert w.n_tokens <= budget or members[w.conv_id, w.window] == 1 and longest[w.conv_id, w.window] > room
    # turns lie in one window each, next to each other, and several share a window where they fit
    for (conv, win), n in members.items():
        assert sorted(r.no for r in placed if (r.conv_id, r.win) == (conv, win)) == list(range(win, win + n))
    if budget == 512:
        assert all(w.n_tokens <= budget for w in windows) and max(members.values()) > 4


def test_a_long_conversation_is_spread_by_its_windows(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", f"turn {i} " * 8) for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = chat.format_windows(df, 200, 50)
    assert windows.count() > 300 and windows.selectExpr("max(length(text))").first()[0] < 5000


def test_chat_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_windows(none)).count() == 0
