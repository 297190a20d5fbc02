"""Operator 11: against all repairs by brute force, over blocks of any size, and on odd rows."""

import hashlib
import itertools
import zlib

import pytest

from fathom.llm import structure

TURNS = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
        out += [(conv_id, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def cheapest(rows):
    """Least (cost, initials, repaired rows) by plain search over positions and grammar states."""
    goes = {("0", "s"): "1", ("0", "u"): "2", ("1", "u"): "2", ("2", "a"): "3", ("3", "u"): "2"}
    memo = {}

    def best(at, state, inserted=0):
        key = at, state, inserted
        if key not in memo:
            found = []
            if at == len(rows):
                if state in "03":
                    found.append((0, "", ()))
            else:
                role, text, must, broken = rows[at]
                c, a, r = best(at + 1, state)
                found.append((c + 4, "D" + a, r))
                if not must:
                    if (state, role[:1]) in goes:
                        c, a, r = best(at + 1, goes[state, role[:1]])
                        found.append((c + 3 * broken, "K" + a, (f"{role}:{text}",) + r))
                    for new in ("user", "assistant"):
                        if (state, new[0]) in goes:
                            c, a, r = best(at + 1, goes[state, new[0]])
                            found.append((c + 3 + 3 * broken, "R" + a, (f"{new}:{text}",) + r))
            if inserted < 3:
                for new in ("user", "assistant"):
                    if (state, new[0]) in goes:
                        c, a, r = best(at, goes[state, new[0]], inserted + 1)
                        found.append((c + 3, "I" + a, (f"{new}:",) + r))
            memo[key] = min(found, key=lambda f: f[:2], default=(10 ** 9, "", ()))
        return memo[key]

    for at in range(len(rows), -1, -1):  # from the end, so that long conversations need no deep recursion
        for inserted, state in itertools.product((3, 2, 1, 0), "0123"):
            best(at, state, inserted)
    return best(0, "0")


def expected(rows, originals):
    out = {}
    for conv_id in {r[0] for r in originals}:
        its = sorted((r for r in rows if r[0] == conv_id), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, faults, judged = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, []
        for _, _, role, text in its:
            said = text.strip(BLANK)
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            judged.append((role, text, fault in ("blank", "duplicate"), said[-1:] not in (".", "!", "?")))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(its, its[1:]))
        turns = {r[1] for r in its if r[1] is not None}
        cost, audit, repaired = cheapest(judged)
        out[conv_id] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *faults.values(), illegal, cost, audit,
                        hashlib.sha256("\n".join(repaired).encode()).hexdigest())
    return out


def got(df):
    rows = df.collect()
    out = {r[0]: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_given_conversations(spark, read):
    df = read("conversations")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert got(structure.summaries(structure.damage(df))) == expected(damaged(rows), rows)


def odd_rows():
    rows = [(1, t, r, x) for t, (r, x) in enumerate([("system", "Be kind."), ("user", "Hi?"), ("user", "Hi?"), ("assistant", "Yes"), ("tool", "3."), ("", "x.")])]
    rows += [(2, 0, None, None), (2, None, "user", "No turn."), (2, None, "user", "No turn."), (2, 5, "assistant", None)]
    rows += [(None, 0, "user", "No conversation."), (None, 1, "assistant", " \t")]
    rows += [(3, 0, "assistant", "b" * 70 + "."), (3, 0, "assistant", "a" * 70 + "."), (3, 0, "user", "long " * 50_000 + "end.")]
    rows += [(4, t, r, f"Turn {t}.") for t, r in enumerate("user assistant system assistant user user assistant system".split())]
    rows += [(5, None, None, None)] * 4
    rows += [(6, t, ("system", "user", "assistant", "tool")[(t * 7 + t // 5) % 4], f"Say {t % 60}" + "." * (t % 3)) for t in range(300)]
    return rows


@pytest.mark.parametrize("block", [1, 3, 16, 4096])
def test_blocks_of_any_size_give_the_same(spark, block):
    rows = odd_rows()
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert got(structure.summaries(df, block)) == expected(plain, rows)


def test_ties_beyond_the_head_are_stable(spark):
    """Texts of one turn and role that share their first 64 characters: in the order of a hash, the same however the rows lie."""
    rows = [(1, 0, "user", "a" * 64 + f"{k}.") for k in range(20)] + [(1, 1, "assistant", "Yes.")]
    one = got(structure.summaries(spark.createDataFrame(rows, TURNS).repartition(1)))
    assert one == got(structure.summaries(spark.createDataFrame(rows[::-1], TURNS).repartition(7), 3))
    assert one[1][:6] == expected(rows, rows)[1][:6]


def test_one_conversation_over_many_partitions(spark):
    """A conversation with nearly all rows is cut where partitions end; identical rows are counted, not sorted."""
    rows = [(9, t, ("user", "assistant", "user", "system")[t % 4], f"Say {t % 1500}.") for t in range(4000)] + [(9, 77, "user", "Same.")] * 3000 + [(8, 0, "user", "Alone.")]
    df = spark.createDataFrame(rows, TURNS)
    narrow = structure._narrow(structure._rows(df))
    assert narrow.where("head = 'Same.'").count() == 2
    blocks = structure._blocks(narrow, 500)
    assert blocks.where("conv_id = 9").count() > 10
    assert blocks.selectExpr("max(length(letters))").first()[0] <= 500
    assert got(structure.summaries(df, 500)) == expected(rows, rows)


def test_repaired_turns_are_legal(spark, read):
    df = structure.damage(read("conversations"))
    out = structure.repair(df).collect()
    by = {}
    for r in sorted(out, key=lambda r: (r.conv_id, r.no)):
        by.setdefault(r.conv_id, []).append(r)
    digests = got(structure.summaries(df))
    import re
    for conv_id, its in by.items():
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in its))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in its).encode()).hexdigest() == digests[conv_id][-1]
        assert "".join(r.edit for r in its) == digests[conv_id][-2].replace("D", "")


def test_suffixes_are_shared():
    tree = structure.Suffixes(structure.END)
    for signature in sorted(["uauaua", "suaua", "aua", "uaua", "xua"], key=lambda s: s[::-1]):
        tree.add(signature)
    endings = {s[i:] for s in ["uauaua", "suaua", "aua", "uaua", "xua"] for i in range(len(s))}
    assert tree.made == len(endings)


def test_empty_table_and_clashing_columns(spark):
    assert structure.summaries(structure.damage(spark.createDataFrame([], TURNS))).count() == 0
    assert structure.repair(spark.createDataFrame([], TURNS)).count() == 0
    rows = odd_rows()
    extra = ["seq", "kind", "head", "letters", "audits", "mark", "initial", "fault", "whole", "c", "s"]
    df = spark.createDataFrame(rows, TURNS)
    wide = df.selectExpr("*", *[f"'own' AS {c}" for c in extra])
    assert got(structure.summaries(structure.damage(wide))) == got(structure.summaries(structure.damage(df))) == expected(damaged(rows), rows)
