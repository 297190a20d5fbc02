"""Operator 3: best-fit-decreasing packing into fixed windows.

An overlong document is first cut into full windows, each a sequence of its
own; what remains of every document is packed by best fit decreasing: longest
piece first, each into the open window with the least room that still holds
it. A segment tree indexed by remaining capacity (how many open windows have
exactly that much room) finds it in log2(capacity) steps.

Remainders are dealt by hash into groups of about ``group_rows`` pieces that
are packed apart from each other: a group leaves at most a few half-empty
windows, and its size does not grow with the corpus.

Defined results: null text is empty (its document is the end id alone);
repeated doc_ids are documents of their own; an empty table packs to nothing;
extra columns are not read. Sequence ids are group * 2**32 + n.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_batches, whole_text
from .tokens import DEFAULT_TOKENIZER, END_ID, encoder

WINDOW = 4096
GROUP_ROWS = 20_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, salt long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class CapacityTree:
    """Counts of open windows by remaining room, with least-room-that-fits search."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, by: int) -> None:
        i = room + self.leaves
        while i:
            self.count[i] += by
            i >>= 1

    def tightest(self, need: int) -> int:
        """Least room >= need of any open window, -1 if there is none."""
        count, i = self.count, need + self.leaves
        if count[i]:
            return need
        while i > 1:  # up until a right sibling has a window, then down its left edge
            if not i & 1 and count[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if count[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return -1


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each piece; pieces are placed longest first, ties in given order."""
    order = np.argsort(-lengths, kind="stable")
    tree, open_by_room, used = CapacityTree(window), {}, []
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i in order.tolist():
        n = int(lengths[i])
        room = tree.tightest(n)
        if room < 0:
            room, w = window, len(used)
            used.append(0)
        else:
            w = open_by_room[room].pop()
            tree.add(room, -1)
        where[i], offset[i] = w, used[w]
        used[w] += n
        if room > n:
            tree.add(room - n, 1)
            open_by_room.setdefault(room - n, []).append(w)
    return where, offset


def pieces(docs: DataFrame, window: int = WINDOW, tokenizer: str = DEFAULT_TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Full windows and the remainder of every document, with the crc32 of their ids."""
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "salt")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer), np.array([end_id], "<u4")
        for batch in batches:
            out: list[tuple] = []
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), enc.encode_all(batch.column(2).to_pylist()))
            for doc_id, salt, got in rows:
                raw = np.concatenate([got.astype("<u4"), end])
                for a in range(0, len(raw), window):
                    ids = raw[a:a + window]
                    out.append((doc_id, a, len(ids), zlib.crc32(ids.tobytes()), len(raw), salt))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema) if out else pa.RecordBatch.from_pylist([], schema=schema)

    rows = text_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("salt"), whole_text().alias("text"))
    return rows.mapInArrow(run, PIECES)


def pack(docs: DataFrame, window: int = WINDOW, tokenizer: str = DEFAULT_TOKENIZER, group_rows: int = GROUP_ROWS) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    cut = materialize(pieces(docs, window, tokenizer), "pieces")
    groups = max(1, -(-cut.count() // group_rows))
    # rows alike in every column are dealt by number as well, so that copies do not meet in one group
    dealt = cut.withColumn("grp", F.pmod(F.xxhash64("doc_id", "start", "salt", F.monotonically_increasing_id() % 64), F.lit(groups)))
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([(c, "ascending") for c in ("salt", "doc_id", "start")])
        lengths = group["length"].to_numpy()
        full = lengths == window
        seq, off = np.empty(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        where, off[~full] = best_fit_decreasing(lengths[~full], window)
        base = int(where.max()) + 1 if len(where) else 0
        seq[~full] = where
        seq[full] = base + np.arange(int(full.sum()))
        seq += group["grp"][0].as_py() << 32
        return pa.Table.from_arrays([group[n].combine_chunks() for n in schema.names[:5]] + [pa.array(seq), pa.array(off)], schema=schema)

    return dealt.groupBy("grp").applyInArrow(run, PACKED)
