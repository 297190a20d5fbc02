"""Operator 11: conversations repaired to ``(system? (user assistant)+)?`` at the least cost, by a suffix-shared automaton.

A row's signature letter says all that its repair depends on: ``d`` must go (blank
text, or role and text seen earlier in the conversation); otherwise the initial of its
role (``x`` for any but s, u, a), as a capital if the text breaks off before a full
stop. Edits: Delete 4; Keep 0; Rerole to user or assistant 3; Insert an empty turn 3; a
broken-off row that stays adds 3. In every grammar state (start, after system, after
user, after assistant) at most one role may be inserted or given, and the edits'
initials differ, so of the cheapest edits the ASCII-least text is that with the least
initial at each step. A node therefore needs per state only a cost to go, a first
initial and a link to the next node; the best audit suffix is read along the links.

Automaton: signatures are sorted by their reversed text over range partitions, so
those that share an ending are neighbours. The nodes of the last signature, from its end
backwards, stay on a stack, and the next one adds nodes only beyond the ending both
share: each ending of any conversation is one node, and equal signatures (however many)
cost nothing more. Nodes with equal letters and equal costs to go share one computed step.

Long conversations: signatures are cut into blocks where a range partition ends or at
``BLOCK`` letters. A block that is not a whole conversation is first solved for each state
in which it may end; these 4 x 4 costs, folded from the last block to the first, say what
each block's end is worth. So a conversation that holds a third of all rows is ordered and
solved in many tasks. Only the last pass, which puts its edits to its rows in order (a
digest is one value over all of them), streams it through one task, a row at a time.

Rows are in the order of turn (null first), role, the first 64 characters of the text and
a 128-bit hash of the text, which also tells repeated texts. Identical rows are counted,
not sorted one by one.

Defined results: null role and text read as one space, so such a text is blank; null
conv_id is a conversation of its own; a conversation left without rows needs no
edits and has zeros; very long texts are read whole; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

KEEP, REROLE, INSERT, DELETE, BROKEN = 0, 3, 3, 4, 3
BLOCK = 4096
_FAR = 1 << 40

#: Grammar states: 0 start, 1 after system, 2 after user, 3 after assistant. The conversation may end in 0 or 3.
_NEXT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "x": (None,) * 4}
#: The one state that an inserted or re-roled turn leads to, and its role.
_PUT, _ROLE = (2, 2, 3, 2), ("user", "user", "assistant", "user")
#: Cost to go and first initial at the end of a conversation, by state.
END = (0, 2 * INSERT, INSERT, 0)
_END_EDIT = ("", "I", "I", "")
_LEGAL = ("su", "ua", "au")


# -- the automaton -----------------------------------------------------------------------
@cache
def _step(letter: str, after: tuple[int, ...]) -> tuple[tuple[int, ...], str]:
    """(cost to go, first initial) by state of a node whose letter leads to a node with the costs ``after``."""
    broken = BROKEN if letter.isupper() else 0
    options: list[list[tuple[int, str]]] = []
    for q in range(4):
        found = [(after[q] + DELETE, "D")]
        if letter != "d":
            kept = _NEXT[letter.lower()][q]
            if kept is not None:
                found.append((after[kept] + KEEP + broken, "K"))
            found.append((after[_PUT[q]] + REROLE + broken, "R"))
        options.append(found)
    cost = [min(c for c, _ in found) for found in options]
    for _ in range(3):  # an inserted turn leads on to another state of the same node
        cost = [min(cost[q], INSERT + cost[_PUT[q]]) for q in range(4)]
    first = [min(e for c, e in options[q] + [(INSERT + cost[_PUT[q]], "I")] if c == cost[q]) for q in range(4)]
    return tuple(min(c, _FAR) for c in cost), "".join(first)


class Suffixes:
    """Nodes of the signature added last, from its end; adding one that shares its ending reuses its nodes."""

    def __init__(self, end: tuple[int, ...]):
        self.letters: list[str] = []
        self.nodes: list[tuple[tuple[int, ...], int, str]] = [(end, 0, "")]
        self.made = 0

    def add(self, signature: str) -> None:
        back = signature[::-1]
        same = 0
        for x, y in zip(self.letters, back):
            if x != y:
                break
            same += 1
        del self.letters[same:], self.nodes[same + 1:]
        for letter in back[same:]:
            costs, base, _ = self.nodes[-1]
            costs, edits = _step(letter, costs)
            low = min(costs)  # kept apart, so that equal steps are found again
            self.nodes.append((tuple(c - low if c < _FAR else _FAR for c in costs), base + low, edits))
            self.letters.append(letter)
            self.made += 1

    def cost(self, state: int) -> int:
        costs, base, _ = self.nodes[-1]
        return costs[state] + base if costs[state] < _FAR else _FAR

    def audit(self, state: int, last: bool) -> tuple[str, int]:
        """The best edits' initials from ``state`` on, and the state they lead to; with ``last``, to the end of the conversation."""
        out, at = [], len(self.letters)
        while at:
            edit = self.nodes[at][2][state]
            out.append(edit)
            letter = self.letters[at - 1]
            if edit == "K":
                state = _NEXT[letter.lower()][state]
            elif edit != "D":
                state = _PUT[state]
            at -= edit != "I"
        while last and _END_EDIT[state]:
            out.append("I")
            state = _PUT[state]
        return "".join(out), state


# -- rows --------------------------------------------------------------------------------
_BLANKS = " \t\n\x0b\x0c\r"


def _spaced(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(" "))


def damage(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: rows damaged by the crc32 of ``conv_id:turn`` modulo 20 (copies 0: dropped, 2: repeated)."""
    kind = F.crc32(F.concat(_spaced("conv_id"), F.lit(":"), _spaced("turn")).cast("binary")) % 20
    text = _spaced("text")
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(_spaced("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"))


_ORDER = ["conv_id", "turn", "role", "head", "h1", "h2"]


def _rows(turns: DataFrame) -> DataFrame:
    """Turns with the columns that order them and tell repeated texts; ``copies`` is 1 where there is no such column."""
    text = _spaced("text")
    copies = F.col("copies").cast("long") if "copies" in turns.columns else F.lit(1).cast("long")
    return turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), _spaced("role").alias("role"),
                        F.substring(text, 1, 64).alias("head"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"),
                        text.alias("text"), copies.alias("copies"))


def _narrow(rows: DataFrame) -> DataFrame:
    """A row per group of identical rows (mark 1), and before it a row (mark 0) where a role and text is first seen."""
    trimmed = F.rtrim("text", F.lit(_BLANKS))
    initial = F.substring("role", 1, 1)
    fault = F.when(trimmed == "", "blank").when(F.substring(trimmed, -1, 1).isin(".", "!", "?"), "").otherwise("truncated")
    same = rows.select(*_ORDER, F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"), fault.alias("fault"), "copies")
    same = same.groupBy(*_ORDER, "initial", "fault").agg(F.sum("copies").alias("copies"))
    text = ["conv_id", "role", "head", "h1", "h2", "initial", "fault"]
    first = same.where("copies > 0").groupBy(*text).agg(F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("none"))
    first = first.withColumn("turn", F.when(~F.col("none"), F.col("least")))
    cols = [*_ORDER, "initial", "fault"]
    return first.select(*cols, F.lit(0).cast("long").alias("copies"), F.lit(0).alias("mark")).unionByName(same.select(*cols, "copies", F.lit(1).alias("mark")))


_BLOCKS = ("conv_id long, seq long, whole boolean, letters string, head string, tail string, blank long, duplicate long, truncated long, "
           "illegal long, low long, high long, distinct long")


class _Block:
    """Letters and counts of a stretch of one conversation, in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.parts, self.size = conv_id, [], 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.head = self.tail = ""
        self.illegal = self.distinct = 0
        self.low = self.high = None

    def add(self, turn: int | None, initial: str, letter: str, fault: str, n: int) -> None:
        self.illegal += (n - 1) + (self.tail != "" and self.tail + initial not in _LEGAL)
        self.head = self.head or initial
        self.tail = initial
        self.parts.append(letter * n)
        self.size += n
        if fault:
            self.faults[fault] += n
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.distinct += 1

    def row(self, seq: int, whole: bool) -> tuple:
        return (self.conv_id, seq, whole, "".join(self.parts), self.head, self.tail, *self.faults.values(), self.illegal, self.low, self.high, self.distinct)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "int": pa.int32(), "array<string>": pa.list_(pa.string()),
             "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
    fields = [f.split(" ") for f in schema.split(", ")]
    cols = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[kind]) for c, (_, kind) in zip(cols, fields)], names=[n for n, _ in fields])


def _batched(rows: Iterator[tuple], schema: str, size: int = 500) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _each(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, 1000).columns))


def _blocks(narrow: DataFrame, block: int) -> DataFrame:
    """The conversations' signatures in blocks; ``whole`` where a block is surely all of its conversation."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        base, made = TaskContext.get().partitionId() << 32, 0
        now: _Block | None = None
        begun = False  # the conversation began in this partition, after another one
        fresh = None
        for conv_id, turn, role, head, h1, h2, initial, fault, copies, mark in _each(batches):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    yield now.row(base + made, begun)
                    made += 1
                begun, now = now is not None, _Block(conv_id)
            if mark == 0:
                fresh = (turn, role, h1, h2, head)
                continue
            if fresh == (turn, role, h1, h2, head) and copies:
                if fault == "blank":
                    now.add(turn, initial, "d", "blank", 1)
                else:
                    now.add(turn, initial, initial.upper() if fault else initial, fault, 1)
                copies -= 1
            fresh = None
            while copies:
                if now.size >= block:
                    yield now.row(base + made, False)
                    made, begun, now = made + 1, False, _Block(conv_id)
                n = min(copies, block - now.size)
                now.add(turn, initial, "d", "blank" if fault == "blank" else "duplicate", n)
                copies -= n
            if now.size >= block:
                yield now.row(base + made, False)
                made, begun, now = made + 1, False, _Block(conv_id)
        if now is not None:
            yield now.row(base + made, False)

    ordered = narrow.select(*_ORDER, "initial", "fault", "copies", "mark").repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER, "mark")
    return ordered.mapInArrow(lambda batches: _batched(cut(batches), _BLOCKS), _BLOCKS)


# -- solving the blocks --------------------------------------------------------------------
_COSTS = "conv_id long, seq long, letters string, costs array<long>"
_ENDS = "conv_id long, seq long, letters string, first boolean, last boolean, end array<long>"
_SOLVED = "conv_id long, seq long, audits array<string>, leads array<int>"


def _ends(parts: DataFrame) -> DataFrame:
    """What the end of every block is worth by state, for the conversations that have several blocks."""

    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        stacks = [Suffixes(tuple(0 if q == end else _FAR for q in range(4))) for end in range(4)]
        for conv_id, seq, letters in _each(batches):
            for stack in stacks:
                stack.add(letters)
            yield conv_id, seq, letters, [stack.cost(start) for start in range(4) for stack in stacks]

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        held = None  # the block read last: it is the first of its conversation if another one follows
        end = END
        for conv_id, seq, letters, costs in _each(batches):
            if held is not None and held[0] != conv_id:
                yield (*held[:3], True, *held[3:])
            elif held is not None:
                yield (*held[:3], False, *held[3:])
            last = held is None or held[0] != conv_id
            end = END if last else end
            held = (conv_id, seq, letters, last, list(end))
            worth = [min(costs[4 * start + q] + end[q] for q in range(4)) for start in range(4)]
            end = tuple(min(w - min(worth), _FAR) for w in worth)
        if held is not None:
            yield (*held[:3], True, *held[3:])

    back = F.reverse("letters")
    costs = parts.select("conv_id", "seq", "letters").repartitionByRange(back, "conv_id", "seq").sortWithinPartitions(back)
    costs = costs.mapInArrow(lambda batches: _batched(solve(batches), _COSTS), _COSTS)
    ordered = costs.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("seq"))
    return ordered.mapInArrow(lambda batches: _batched(fold(batches), _ENDS), _ENDS)


def _solved(blocks: DataFrame) -> DataFrame:
    """conv_id, seq, audits and leads: by the state a block begins in (only state 0 for a first one), its edits and the state after it."""

    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        stack, key, known = None, None, None
        for conv_id, seq, letters, first, last, end in _each(batches):
            if stack is None or key != (last, end):
                stack, key, known = Suffixes(tuple(end)), (last, end), None
            if known is None or known[0] != (letters, first):
                stack.add(letters)
                found = [stack.audit(q, last) for q in range(1 if first else 4)]
                known = ((letters, first), [a for a, _ in found], [q for _, q in found])
            yield conv_id, seq, known[1], known[2]

    whole = blocks.where("whole").select("conv_id", "seq", "letters", F.lit(True).alias("first"), F.lit(True).alias("last"),
                                         F.array(*[F.lit(c).cast("long") for c in END]).alias("end"))
    all_blocks = whole.unionByName(_ends(blocks.where("NOT whole")))
    keys = [F.col("last"), F.col("end"), F.reverse("letters")]
    ordered = all_blocks.repartitionByRange(*keys, "conv_id", "seq").sortWithinPartitions(*keys, "first")
    return ordered.mapInArrow(lambda batches: _batched(solve(batches), _SOLVED), _SOLVED)


# -- edits put to the rows -----------------------------------------------------------------
_FACTS = ["letters", "head", "tail", "blank", "duplicate", "truncated", "illegal", "low", "high", "distinct"]


class _Plan:
    """Counts and edits of one conversation, from its blocks in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.state, self.audit = conv_id, 0, []
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.tail, self.low, self.high = "", None, None

    def add(self, audits: list[str], leads: list[int], facts: tuple) -> None:
        _, head, tail, blank, duplicate, truncated, illegal, low, high, distinct = facts
        self.audit.append(audits[self.state])
        self.state = leads[self.state]
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated
        self.illegal += illegal + (self.tail != "" and head != "" and self.tail + head not in _LEGAL)
        self.tail = tail or self.tail
        self.distinct += distinct - (low is not None and low == self.high)
        self.low = low if self.low is None else self.low
        self.high = high if high is not None else self.high

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.distinct


def _edited(rows: Iterator[tuple]) -> Iterator[tuple[_Plan, Iterator[tuple[str, str, str, int]]]]:
    """For each conversation of a sorted stream: its plan, and its repaired turns (edit, role, text, cost) in order, deleted ones as D."""

    def turns(plan: _Plan, its: Iterator[tuple]) -> Iterator[tuple[str, str, str, int]]:
        audit, at, state = "".join(plan.audit), 0, 0
        for _, _, _, _, _, _, _, _, role, text, copies, broken, *_ in its:
            for _ in range(copies):
                while audit[at] == "I":
                    yield "I", _ROLE[state], "", INSERT
                    state, at = _PUT[state], at + 1
                edit = audit[at]
                at += 1
                if edit == "D":
                    yield "D", role, text, DELETE
                elif edit == "K":
                    yield "K", role, text, BROKEN * broken
                    state = _NEXT[role[:1]][state]
                else:
                    yield "R", _ROLE[state], text, REROLE + BROKEN * broken
                    state = _PUT[state]
        for _ in audit[at:]:
            yield "I", _ROLE[state], "", INSERT
            state = _PUT[state]

    for conv_id, its in itertools.groupby(rows, key=lambda r: r[0]):
        plan, first = _Plan(conv_id), None
        for row in its:
            if row[1] == 1:
                first = row
                break
            plan.add(row[12], row[13], row[14:])
        yield plan, turns(plan, itertools.chain([first], its) if first is not None else iter(()))


def _planned(turns: DataFrame, block: int) -> DataFrame:
    """Blocks with their edits (kind 0), then rows (kind 1), by conversation and in order."""
    rows = _rows(turns)
    blocks = materialize(_blocks(_narrow(rows), block), "signatures")
    solved = _solved(blocks).withColumnRenamed("seq", "s").withColumnRenamed("conv_id", "c")
    plans = blocks.join(solved, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("seq") == F.col("s")))
    place = ["conv_id", "kind", "seq", "turn", "role", "head", "h1", "h2"]
    trimmed = F.rtrim("text", F.lit(_BLANKS))
    broken = (trimmed != "") & ~F.substring(trimmed, -1, 1).isin(".", "!", "?")
    kinds = dict(letters="string", head="string", tail="string", blank="long", duplicate="long", truncated="long", illegal="long", low="long", high="long", distinct="long")
    none = lambda kind: F.lit(None).cast(kind)
    first = plans.select("conv_id", F.lit(0).alias("kind"), "seq", none("long").alias("turn"), none("string").alias("role"), none("string").alias("top"),
                         none("long").alias("h1"), none("long").alias("h2"), none("string").alias("said"), none("string").alias("text"), F.lit(0).cast("long").alias("copies"),
                         F.lit(False).alias("broken"), "audits", "leads", *[(F.lit("") if c == "letters" else F.col(c)).alias(f"b_{c}") for c in _FACTS])
    then = rows.select("conv_id", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("seq"), "turn", "role", F.col("head").alias("top"), "h1", "h2",
                       F.col("role").alias("said"), "text", "copies", broken.alias("broken"), none("array<string>").alias("audits"), none("array<int>").alias("leads"),
                       *[none(kinds[c]).alias(f"b_{c}") for c in _FACTS])
    place[place.index("head")] = "top"
    return first.unionByName(then).repartition("conv_id").sortWithinPartitions(*place)


_REPAIRED = "conv_id long, no long, edit string, role string, text string"
_SUMMARY = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def repair(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, no, edit, role, text: the repaired turns, in the order ``no`` of each conversation; ``copies`` of ``turns`` repeats a row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for plan, edited in _edited(_each(batches)):
            kept = (e for e in edited if e[0] != "D")
            for no, (edit, role, text, _) in enumerate(kept):
                yield plan.conv_id, no, edit, role, text

    return _planned(turns, block).mapInArrow(lambda batches: _batched(run(batches), _REPAIRED), _REPAIRED)


def summaries(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row per conversation: its faults, the cost and initials of its edits, and a digest of its repaired turns."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for plan, edited in _edited(_each(batches)):
            digest, cost, begun = hashlib.sha256(), 0, False
            for edit, role, text, price in edited:
                cost += price
                if edit != "D":
                    digest.update(("\n" if begun else "").encode() + f"{role}:{text}".encode())
                    begun = True
            yield (plan.conv_id, plan.gaps, plan.blank, plan.duplicate, plan.truncated, plan.illegal, cost, "".join(plan.audit), digest.hexdigest())

    return _planned(turns, block).mapInArrow(lambda batches: _batched(run(batches), _SUMMARY), _SUMMARY)
