"""Operator 10: conversations as budgeted training windows (DataFrame functions only).

Every turn is written between marks of its role, with the control strings
escaped inside texts in a way that can be undone. Prefix sums of the turns'
tokens cut a conversation into windows at turns. What a window may newly hold is its
room: ``budget`` less the system turn and ``history``. Turns of more than half a room
have windows of their own; a run of other turns is cut into cells as long as the room
less the run's longest turn, and a window is made of the turns that start in the same
cell. So the last of them still ends inside the room: system turn, history and new
turns together stay within ``budget`` unless a single turn (or the system turn) leaves no room. A window after the first
repeats the system turn and the turns that start within the last ``history`` tokens
before it; their text is masked, so that each assistant text is a target exactly once.

Escaping: every backslash is doubled, then a backslash is put after the first
character of each control string. A run of one backslash therefore occurs only
inside a control string, and both steps can be undone; no text can hold a
control string, and the first closing mark after an opening one ends its turn.

A token is a word plus one for the mark. A turn is never cut. Windows are made from
turn rows: each goes to its own window and to the few whose history begins after it,
so a long conversation is spread by its windows. Only ``digests``, one value over a
whole conversation, gathers its turns in one row.

Defined results: null role and text are empty; turns are ordered by (turn, role,
text), nulls first, so repeated rows are repeated turns; rows without conv_id
form one conversation; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, words_of

BUDGET = 512
HISTORY = 128

#: The template's control strings.
CONTROLS = ["<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "<<ROLE>>", "<<TEXT>>", "<</ROLE>>"]
#: Opening and closing mark by role; any other role is written out between marks of its own.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROLS:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    out = text
    for c in CONTROLS:
        out = F.replace(out, F.lit(c[0] + "\\" + c[1:]), F.lit(c))
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


def _opening(role: Column) -> Column:
    out = F.concat(F.lit("<<ROLE>>"), escape(role), F.lit("<<TEXT>>"))
    for name, (a, _) in MARKS.items():
        out = F.when(role == name, a).otherwise(out)
    return out


def _closing(role: Column) -> Column:
    out = F.lit("<</ROLE>>")
    for name, (_, b) in MARKS.items():
        out = F.when(role == name, b).otherwise(out)
    return out


def window_turns(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Turns with conv_id, no (from 1), at (tokens of the conversation before), tokens, win (no of the first turn of its window), and
    first (``at`` of that turn)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("tokens", (F.size(words_of(F.col("text"))) + 1).cast("long"))
    rows = rows.withColumn("at", F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("long")).withColumn("no", F.row_number().over(order))
    whole, by_no = Window.partitionBy("conv_id"), Window.partitionBy("conv_id").orderBy("no")
    system = F.coalesce(F.min_by("tokens", F.when(F.col("role") == "system", F.col("no"))).over(whole), F.lit(0))
    rows = rows.withColumn("room", F.greatest(F.lit(budget - history) - system, F.lit(2)))
    big = F.col("tokens") * 2 > F.col("room")
    # a run begins with each big turn and after it; its first turn and its cells tell its windows apart
    begins = big | F.coalesce(F.lag(big).over(by_no), F.lit(True))
    rows = rows.withColumn("run", F.max(F.when(begins, F.col("at"))).over(by_no))
    rows = rows.withColumn("cell", F.greatest(F.col("room") - F.max("tokens").over(Window.partitionBy("conv_id", "run")), F.lit(1)))
    window = Window.partitionBy("conv_id", "run", "cell")
    rows = rows.withColumn("cell", F.floor((F.col("at") - F.col("run")) / F.col("cell")))
    return rows.select("conv_id", "no", "at", "tokens", "role", "text", F.min("no").over(window).alias("win"), F.min("at").over(window).alias("first"))


def format_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window, n_repeated (turns at its start that earlier windows had), n_tokens, text, loss (start, length of targets in text)."""
    rows = window_turns(turns, budget, history)
    key = F.col("conv_id").isNull().alias("none"), F.coalesce("conv_id", F.lit(0)).alias("conv")  # null is a conversation like any other
    rows = rows.select(*key, "no", "at", "tokens", "role", _opening(F.col("role")).alias("open"), escape(F.col("text")).alias("body"),
                       _closing(F.col("role")).alias("close"), "win", "first")
    of = ["none", "conv"]
    turn = ["no", "tokens", "role", "open", "body", "close"]
    windows = rows.where("no = win").select(*of, F.col("win").alias("w"), F.col("first").alias("start"))
    # history: a turn at ``at`` is repeated by later windows that start by at + history; both sides meet in stretches of ``history`` tokens
    stretch = F.floor(F.col("start") / history) if history else F.lit(0)
    starts = windows.withColumn("stretch", stretch)
    near = F.array_distinct(F.array(F.floor(F.col("at") / max(history, 1)), F.floor((F.col("at") + history) / max(history, 1))))
    told = rows.select(*of, *turn, "at", "win", F.explode(near).alias("stretch")).join(starts, [*of, "stretch"])
    told = told.where((F.col("w") > F.col("win")) & (F.col("at") >= F.col("start") - history))
    system = rows.where("role = 'system'").groupBy(*of).agg(F.min("no").alias("sys"))
    system = rows.join(system.withColumnRenamed("sys", "no"), [*of, "no"]).select(*of, *turn, "win")
    led = system.join(windows, of).where(F.col("w") > F.col("win"))
    same = F.struct("no", "tokens", "role", "open", "body", "close", F.lit(False).alias("goal")).alias("t")
    past = told.select(*of, "w", same).unionByName(led.select(*of, "w", same)).distinct()
    mine = rows.select(*of, F.col("win").alias("w"), F.struct(*turn, (F.col("role") == "assistant").alias("goal")).alias("t"))
    both = mine.withColumn("past", F.lit(0)).unionByName(past.withColumn("past", F.lit(1)))
    windows = both.groupBy(*of, "w").agg(F.array_sort(F.collect_list("t")).alias("turns"), F.sum("past").cast("int").alias("n_repeated"),
                                         F.sum("t.tokens").cast("long").alias("n_tokens"))
    windows = windows.select(F.when(~F.col("none"), F.col("conv")).alias("conv_id"), F.col("w").cast("long").alias("window"), "n_repeated", "n_tokens", "turns")

    spans = "array<struct<start:bigint,length:bigint>>"
    start = F.struct(F.lit(0).cast("long").alias("pos"), F.array().cast(spans).alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        begins = acc["pos"] + F.length(t["open"])
        span = F.array(F.struct(begins.cast("long").alias("start"), F.length(t["body"]).cast("long").alias("length")))
        return F.struct((begins + F.length(t["body"]) + F.length(t["close"])).cast("long").alias("pos"),
                        F.when(t["goal"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return windows.select("conv_id", "window", "n_repeated", "n_tokens",
                          F.array_join(F.transform("turns", lambda t: F.concat(t["open"], t["body"], t["close"])), "").alias("text"),
                          F.aggregate("turns", start, step, lambda acc: acc["spans"]).alias("loss"))


def read_turns(windows: DataFrame) -> DataFrame:
    """conv_id, window, turns (role, text) that are new in the window, targets (texts under the mask), n_chars: from text and mask alone."""
    either = lambda marks: "|".join(re.escape(m).replace("/", "\\/") for m in marks)
    openers, closers = [a for a, _ in MARKS.values()] + ["<<ROLE>>"], [b for _, b in MARKS.values()] + ["<</ROLE>>"]
    pattern = f"(?s)({either(openers)})(.*?)({either(closers)})"
    part = lambda group: F.regexp_extract_all(F.col("text"), F.lit(pattern), F.lit(group))

    def turn(mark: Column, body: Column) -> Column:
        named = F.split(body, re.escape("<<TEXT>>"), 2)
        role, text = unescape(F.get(named, 0)), unescape(F.coalesce(F.get(named, 1), F.lit("")))
        for name, (a, _) in MARKS.items():
            role = F.when(mark == a, name).otherwise(role)
        return F.struct(role.alias("role"), F.when(mark == "<<ROLE>>", text).otherwise(unescape(body)).alias("text"))

    rows = windows.select("conv_id", "window", "n_repeated", "text", "loss", part(1).alias("marks"), part(2).alias("bodies"))
    turns = F.zip_with("marks", "bodies", turn)
    mine = F.slice(turns, F.col("n_repeated") + 1, F.greatest(F.size("marks") - F.col("n_repeated"), F.lit(0)))
    goals = F.transform("loss", lambda g: unescape(F.substring(F.col("text"), (g["start"] + 1).cast("int"), g["length"].cast("int"))))
    return rows.select("conv_id", "window", mine.alias("turns"), goals.alias("targets"), F.length("text").cast("long").alias("n_chars"))


def digests(windows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of every conversation, read back from its windows."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    goals = F.array_join("targets", "")
    rows = read_turns(windows).select("conv_id", F.struct("window", said.alias("said"), goals.alias("goals")).alias("w"),
                                      F.size("turns").alias("n"), "n_chars")
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("ws"), F.sum("n").cast("long").alias("n_turns"),
                                        F.sum("n_chars").cast("long").alias("formatted_chars"))
    whole = lambda name: F.array_join(F.transform("ws", lambda w: w[name]), "")
    return convs.select("conv_id", "n_turns", F.sha2(whole("said"), 256).alias("turns_sha256"),
                        F.length(whole("goals")).cast("long").alias("loss_chars"), F.sha2(whole("goals"), 256).alias("loss_sha256"), "formatted_chars")
