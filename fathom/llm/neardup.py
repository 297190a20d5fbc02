"""Operator 9: SimHash near-duplicates, found with sharded BK-trees.

1. A fingerprint of 64 bits per document from XXH64 hashes of its word
   shingles (numpy inside Arrow batches, no shuffle).
2. Different fingerprints only: copies share one row, with the least doc_id.
3. Shards: the 64 bits are cut into ``radius + k`` blocks; fingerprints within
   the radius agree on some ``k`` of them, so one table for each choice of
   ``k`` blocks, keyed by their bits, holds every link. ``k`` follows from the
   number of fingerprints, so that a shard holds a few of them at any size.
4. A BK-tree per shard: children keyed by their integer Hamming distance to the
   parent; a search follows only edges within the radius of the query's
   distance. A shard with more than ``tree_rows`` fingerprints is cut into
   sub-trees by hash, each sent to every block of the shard's queries, so no
   tree grows with the corpus.
5. A task returns the spokes of the components it sees (never pairs of a
   group); connected components over them, then the least doc_id.

Defined results: null text is empty; documents without words have fingerprint
zero and are linked like others; fewer words than a shingle make one shingle;
repeated rows are documents of their own; null doc_ids count for no component
id unless there is no other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialize, text_batches, text_hash, whole_text
from .components import components

SHINGLE = 4
RADIUS = 4
TREE_ROWS = 4096
#: Shingles whose bits are counted together.
PART = 1 << 15
#: Fingerprints of a shard, on average, at which another block is added to its key.
SHARD_ROWS = 48


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of one text."""
    import xxhash
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = (ends - np.diff(ends, prepend=0)).tolist()
    stops = (ends[shingle - 1:] - 1).tolist()
    ones = np.zeros(64, np.int64)
    for k in range(0, len(stops), PART):  # in parts, so that a very long text needs no memory for all its bits
        cut = [joined[a:b] for a, b in zip(starts[k:k + PART], stops[k:k + PART])]
        h = np.fromiter(map(xxhash.xxh64_intdigest, cut, repeat(42)), np.uint64, len(cut))
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(stops), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, th (hash of the text), fp (the 64 bits as a signed long)."""
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([simhash(t.as_py(), shingle) for t in batch.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())], schema=schema)

    rows = text_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("th"), whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, th long, fp long")


def masks(radius: int, agree: int) -> list[int]:
    """Bit masks of every choice of ``agree`` of ``radius + agree`` blocks."""
    n = radius + agree
    cuts = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(blocks, agree)]


def blocks_for(n: int, radius: int, shard_rows: int = SHARD_ROWS) -> int:
    """Blocks that must agree, two at least, so that a shard of evenly spread fingerprints holds at most ``shard_rows``."""
    agree = 2
    while n / 2 ** (64 * agree // (radius + agree)) > shard_rows and agree < 4:
        agree += 1
    return agree


class BKTree:
    """Distinct uint64 fingerprints; node i is fps[i], children[i] its (distance, node) edges."""

    def __init__(self, fps: np.ndarray):
        self.fps = fps
        self.children: list[list[tuple[int, int]]] = [[] for _ in fps]
        rest = [np.arange(len(fps))] if len(fps) else []
        while rest:  # a node's followers go down the edge of their distance, the first of each distance is the child
            own = rest.pop()
            root, own = int(own[0]), own[1:]
            if not len(own):
                continue
            d = np.bitwise_count(fps[own] ^ fps[root])
            order = np.argsort(d, kind="stable")
            own, d = own[order], d[order]
            at = np.flatnonzero(np.diff(d)) + 1
            for group, e in zip(np.split(own, at), d[np.append(0, at)].tolist()):
                self.children[root].append((e, int(group[0])))
                if len(group) > 1:
                    rest.append(group)

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(node, numbers of the queries within the radius of it), for all queries together."""
        stack = [(0, np.arange(len(queries)))] if len(self.fps) and len(queries) else []
        while stack:
            node, own = stack.pop()
            d = np.bitwise_count(queries[own] ^ self.fps[node]).astype(np.int16)
            near = own[d <= radius]
            if len(near):
                yield node, near
            for e, child in self.children[node]:
                down = own[np.abs(d - e) <= radius]
                if len(down):
                    stack.append((child, down))


def _spokes(tree: np.ndarray, queries: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(least fingerprint, other fingerprint) of the components that links between tree and queries make."""
    nodes = tree if queries is None else np.concatenate([tree, queries])
    shift = 0 if queries is None else len(tree)
    label = np.arange(len(nodes))
    for node, near in BKTree(tree).within(tree if queries is None else queries, radius):
        seen = np.unique(label[np.append(near + shift, node)])
        if len(seen) > 1:
            label[np.isin(label, seen)] = seen[0]
    order = np.argsort(label, kind="stable")
    lab = label[order]
    first = np.flatnonzero(np.append(True, lab[1:] != lab[:-1]))
    head = order[np.repeat(first, np.diff(np.append(first, len(lab))))]
    out = head != order
    return nodes[head[out]], nodes[order[out]]


def _links(radius: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def one(rows: np.ndarray, found: list) -> None:
        i, j, own, fps = rows[2, 0], rows[3, 0], rows[4], rows[5].view(np.uint64)
        found.append(_spokes(fps, None, radius) if i == j else _spokes(fps[own == i], fps[own == j], radius))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((6, 0), np.int64)
        for batch in batches:
            rows = np.concatenate([held, np.stack([batch.column(c).to_numpy() for c in range(6)])], axis=1)
            new = np.flatnonzero((rows[:4, 1:] != rows[:4, :-1]).any(axis=0)) + 1
            starts = np.append(0, new)
            found: list = []
            for k in np.flatnonzero(np.diff(starts) > 1):
                one(rows[:, starts[k]:starts[k + 1]], found)
            held = rows[:, starts[-1]:]
            yield from out(found)
        if held.shape[1] > 1:
            found = []
            one(held, found)
            yield from out(found)

    def out(found: list) -> Iterator[pa.RecordBatch]:
        if found:
            a, b = (np.concatenate([f[i] for f in found]).view(np.int64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)
    return run


def links(distinct: DataFrame, radius: int = RADIUS, tree_rows: int = TREE_ROWS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Spokes (a, b) between different fingerprints ``fp`` whose components are those of all links within the radius."""
    agree = blocks_for(distinct.count(), radius, shard_rows)
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    keys = F.array(*[F.struct(F.lit(t).cast("long").alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m)).cast("long")).alias("k"))
                     for t, m in enumerate(masks(radius, agree))])
    keyed = distinct.select("fp", F.explode(keys).alias("s")).select("s.t", "s.k", "fp")
    hot = keyed.groupBy("t", "k").count().where(F.col("count") > tree_rows).select(
        F.col("t").alias("ht"), F.col("k").alias("hk"), F.ceil(F.col("count") / tree_rows).cast("long").alias("cuts"))
    dealt = keyed.join(hot, (F.col("t") == F.col("ht")) & (F.col("k") == F.col("hk")), "left").withColumn(
        "cuts", F.coalesce("cuts", F.lit(1).cast("long"))).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("cuts"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)))
    shards = dealt.select("t", "k", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "fp")
    return shards.repartition("t", "k", "i", "j").sortWithinPartitions("t", "k", "i", "j", "fp").mapInArrow(
        _links(radius), "a long, b long").distinct()


def _grouped(docs: DataFrame, shingle: int, radius: int, tree_rows: int) -> tuple[DataFrame, DataFrame]:
    """Marked rows (doc_id, th, fp), and fp, head (least doc_id), root (one per component)."""
    marked = materialize(fingerprints(docs, shingle), "simhash")
    heads = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("head")), "simhash-heads", marked.count())
    groups = components(links(heads.select("fp"), radius, tree_rows))
    return marked, heads.join(groups, heads["fp"] == groups["node"], "left").select("fp", "head", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tree_rows: int = TREE_ROWS) -> DataFrame:
    """doc_id, fp, component_id for every row of ``docs``."""
    marked, named = _grouped(docs, shingle, radius, tree_rows)
    least = named.groupBy("root").agg(F.min("head").alias("component_id"))
    return marked.join(named.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tree_rows: int = TREE_ROWS) -> DataFrame:
    """One row of each component, with all its columns: that of the least doc_id (null last), then of the least text hash."""
    marked, named = _grouped(docs, shingle, radius, tree_rows)
    rows = marked.join(named.select("fp", "root"), "fp").groupBy("root", "doc_id", "th").agg(F.count("*").alias("copies"))
    own, text, copies, n = fresh(docs, "own_", "th_", "copies_", "n_")
    chosen = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "copies")).alias("r")).select(
        F.col("r.doc_id").alias(own), F.col("r.th").alias(text), F.col("r.copies").alias(copies))
    chosen = materialize(chosen, "simhash-kept", marked.count())
    found = docs.join(chosen, docs["doc_id"].cast("long").eqNullSafe(F.col(own)) & (text_hash() == F.col(text)))
    if chosen.where(F.col(copies) > 1).isEmpty():
        return found.select(*docs.columns)
    # rows alike in doc_id and text: any one of them
    first = F.row_number().over(Window.partitionBy(own, text).orderBy(F.lit(0)))
    again = found.where(F.col(copies) > 1).withColumn(n, first).where(F.col(n) == 1)
    return found.where(F.col(copies) == 1).select(*docs.columns).union(again.select(*docs.columns))
