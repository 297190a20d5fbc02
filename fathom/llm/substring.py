"""Operator 4: removal of token windows that an earlier document already has.

A window is ``WINDOW`` consecutive words of one document. Every word covered
by a window that also starts in a document with a smaller doc_id goes.

1. Map: each word becomes an XXH64 value, each window their Rabin-Karp hash
   (polynomial modulo 2**64 with an odd base, from prefix sums). A task works
   on groups of documents: within a group a repeated window is settled at once,
   and only the least document of each window travels. Rows that travel hold
   the sorted hashes of one bucket (a range of hash values) as differences, and
   the documents, both cut into byte planes, about nine bytes a window; a
   window that a third of all documents share is one entry per group.
2. Reduce: per bucket, the least document of each hash; the other documents are
   told which of their windows are repeats, in packed rows per group of documents
   that a second step sorts into one row per document.
3. The answers meet the documents by doc_id; the covered words are the union of
   the repeated windows: maximal removal intervals.

The number of buckets follows from the corpus (about ``bucket_windows`` windows
each). A hash of 64 bits: among n windows, n**2 / 2**65 are expected to be
taken for another.

Defined results: null text has no words; documents shorter than a window keep
all; rows with equal doc_id never remove each other's words; a null doc_id
counts as larger than all others; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize, text_batches, whole_text

WINDOW = 13
#: Windows of a map group: settled together, travelling together.
GROUP_WINDOWS = 1_000_000
#: Windows of a reduce bucket, on average.
BUCKET_WINDOWS = 1_500_000
#: Windows of the documents that are told together what to remove, at most (were all of them repeats).
TOLD_WINDOWS = 16_000_000
#: Characters of a word and its blank, to size buckets only.
WORD_CHARS = 6

BASE = 0x9E3779B97F4A7C15  # odd: invertible modulo 2**64
LAST = (1 << 63) - 1
_BREAK = re.compile(r"[\x20\x09-\x0D]+")


def split_words(text: str | None) -> list[str]:
    return [w for w in _BREAK.split(text) if w] if text else []


def word_hashes(words: list[str]) -> np.ndarray:
    from xxhash import xxh64_intdigest
    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


_POWERS: dict[str, np.ndarray] = {"n": np.zeros(0)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if len(_POWERS["n"]) < n:
        inverse = pow(BASE, -1, 1 << 64)
        size = max(n, 1 << 16)
        for name, b in (("up", BASE), ("down", inverse)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
        _POWERS["n"] = _POWERS["up"]
    return _POWERS["up"][:n], _POWERS["down"][:n]


def rolling(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Rabin-Karp hash of every window of the word hashes."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = _powers(len(hashes))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up, dtype=np.uint64)])
    return (sums[window:] - sums[:-window]) * down[:n]


def planes(values: np.ndarray) -> bytes:
    """Byte planes of int64/uint64 values: planes of zeros compress to nothing."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unplanes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").ravel()


_OUT = pa.schema([("bucket", pa.int32()), ("grp", pa.int32()), ("base", pa.int64()), ("hashes", pa.binary()), ("docs", pa.binary())])
SENT = "bucket int, grp int, base long, hashes binary, docs binary"
_TOLD = pa.schema([("grp", pa.int32()), ("docs", pa.binary()), ("hashes", pa.binary())])
TOLD = "grp int, docs binary, hashes binary"


def _by_group(docs: np.ndarray, hashes: np.ndarray, groups: int) -> list[tuple[int, bytes, bytes]]:
    """(group of documents, documents, hashes): what documents are told, packed by group."""
    with np.errstate(over="ignore"):
        own = ((docs.view(np.uint64) * np.uint64(BASE)) >> np.uint64(32)) % np.uint64(groups)
    order = np.argsort(own, kind="stable")
    own, docs, hashes = own[order], docs[order], hashes[order]
    at = np.append(0, np.flatnonzero(np.diff(own)) + 1)
    ends = np.append(at[1:], len(own)).tolist()
    return [(int(own[a]), docs[a:b].tobytes(), hashes[a:b].tobytes()) for a, b in zip(at.tolist(), ends)]


def _by_doc(group: pa.Table) -> pa.Table:
    """One row per document: all it is told."""
    docs = np.frombuffer(b"".join(group["docs"].to_pylist()), np.int64)
    hashes = np.frombuffer(b"".join(group["hashes"].to_pylist()), np.uint64)
    order = np.argsort(docs, kind="stable")
    docs, hashes = docs[order], hashes[order]
    at = np.append(0, np.flatnonzero(np.diff(docs)) + 1)
    ends = np.append(at[1:], len(docs)).tolist()
    return pa.Table.from_arrays([pa.array(docs[at]), pa.array([hashes[a:b].tobytes() for a, b in zip(at.tolist(), ends)], pa.binary())],
                                names=["doc_id", "hashes"])


def _send(window: int, buckets: int, groups: int, group_windows: int):
    edges = np.array([((i << 64) // buckets) for i in range(1, buckets)], np.uint64)

    def settle(ids: list[int], hashed: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        h = np.concatenate(hashed)
        d = np.repeat(np.array(ids, np.int64), [len(x) for x in hashed])
        order = np.lexsort((d, h))
        h, d = h[order], d[order]
        new = np.append(True, h[1:] != h[:-1])
        least = d[new][np.cumsum(new) - 1]
        again = (d > least) & (new | np.append(True, d[1:] != d[:-1]))
        if again.any():  # settled within the group
            told = _by_group(d[again], h[again], groups)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*[(g % buckets, g, None, x, docs) for g, docs, x in told]), _OUT.types)],
                                             schema=_OUT)
        h, d = h[new], d[new]
        cuts = np.concatenate([[0], np.searchsorted(h, edges), [len(h)]])
        rows = []
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            part, own = h[cuts[b]:cuts[b + 1]], d[cuts[b]:cuts[b + 1]]
            low, base = int(b << 64) // buckets, int(own.min())
            rows.append((b, None, base, planes(np.diff(part, prepend=np.uint64(low))), planes(own - base)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _OUT.types)], schema=_OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hashed, n = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                got = rolling(word_hashes(split_words(text.as_py())), window)
                if len(got):
                    ids.append(doc_id)
                    hashed.append(got)
                    n += len(got)
                    if n >= group_windows:
                        yield from settle(ids, hashed)
                        ids, hashed, n = [], [], 0
        if ids:
            yield from settle(ids, hashed)
    return run


def _answer(buckets: int, groups: int):
    def run(rows: pa.Table) -> pa.Table:
        low = int(rows["bucket"][0].as_py() << 64) // buckets
        settled = rows.filter(rows["base"].is_null()).select(["grp", "docs", "hashes"]).cast(_TOLD)
        rows = rows.filter(rows["base"].is_valid())
        if not rows.num_rows:
            return settled
        h = np.concatenate([np.cumsum(unplanes(x.as_py()), dtype=np.uint64) + np.uint64(low) for x in rows["hashes"]])
        d = np.concatenate([unplanes(x.as_py()).astype(np.int64) + base for x, base in zip(rows["docs"], rows["base"].to_pylist())])
        order = np.argsort(h)
        h, d = h[order], d[order]
        new = np.append(True, h[1:] != h[:-1])
        starts = np.flatnonzero(new)
        least = np.minimum.reduceat(d, starts)[np.cumsum(new) - 1]
        later = d > least
        if not later.any():
            return settled
        told = _by_group(d[later], h[later], groups)
        return pa.concat_tables([settled, pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*told), _TOLD.types)], schema=_TOLD)])
    return run


def repeats(docs: DataFrame, window: int = WINDOW, group_windows: int = GROUP_WINDOWS, bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """doc_id, hashes: the window hashes of a document that start in one with a smaller doc_id (one row per document)."""
    spark = docs.sparkSession
    rows = text_batches(docs).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), whole_text().alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // (WORD_CHARS * bucket_windows)))
    groups = max(min(buckets, 64), -(-chars // (WORD_CHARS * TOLD_WINDOWS)))
    # what a map group has settled itself travels along, in any bucket, so that windows are hashed once
    told = rows.mapInArrow(_send(window, buckets, groups, group_windows), SENT).groupBy("bucket").applyInArrow(_answer(buckets, groups), TOLD)
    return told.groupBy("grp").applyInArrow(_by_doc, "doc_id long, hashes binary")


def drop_repeats(docs: DataFrame, window: int = WINDOW, prefix: str = "", **sizes) -> DataFrame:
    """All columns of ``docs`` and, with the prefix, n_words, n_removed, kept (the words left, joined by one blank) and kept_sha256.

    Columns of ``docs`` that have these names are replaced.
    """
    told = materialize(repeats(docs, window, **sizes), "repeats")
    added = [prefix + c for c in ("n_words", "n_removed", "kept", "kept_sha256")]
    kept_names = [c for c in docs.columns if c.lower() not in added]
    own, key, answers, text = fresh(docs, "own_", "key_", "told_", "text_")
    by_doc = told.select(F.col("doc_id").alias(key), F.col("hashes").alias(answers))
    rows = docs.withColumn(own, F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))).withColumn(text, whole_text())
    fed = rows.join(by_doc, F.col(own) == F.col(key), "left").select(*kept_names, answers, text)
    zero = F.lit(0).cast("long")
    spec = fed.select(*kept_names, zero.alias(added[0]), zero.alias(added[1]), F.lit("").alias(added[2]), F.lit("").alias(added[3])).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told, texts = batch.column(len(kept_names)), batch.column(len(kept_names) + 1)
            n_words, n_removed, kept, digests = [], [], [], []
            for answer, text in zip(told, texts):
                words = split_words(text.as_py())
                left = words
                if answer.is_valid and len(words) >= window:
                    hit = np.isin(rolling(word_hashes(words), window), np.frombuffer(answer.as_py(), "<u8"))
                    mark = np.zeros(len(words) + 1, np.int64)
                    mark[:len(hit)] += hit
                    mark[window:window + len(hit)] -= hit
                    cover = np.cumsum(mark[:-1]) > 0
                    left = [w for w, gone in zip(words, cover.tolist()) if not gone]
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                kept.append(" ".join(left))
                digests.append(hashlib.sha256(kept[-1].encode("utf-8", "surrogatepass")).hexdigest())
            own = [batch.column(i) for i in range(len(kept_names))]
            yield pa.RecordBatch.from_arrays([*own, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()),
                                              pa.array(digests, pa.string())], names=[*kept_names, *added])

    return fed.mapInArrow(run, spec)
