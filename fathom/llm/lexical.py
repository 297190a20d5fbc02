"""Operator 13: ranked lexical search by exact inner products, pruned with sparse ball trees.

A document is a sparse vector over the terms that the items ask for: at term t
the integer w(t) * ((10^9 tf) div (1000 tf + 8 m)), with the weight w and the length
factor m of the contract. An item is the vector of its term counts, and a score is
their inner product. Terms that no item has change no score, so they are only counted.

Plan: one scan of the documents counts terms (one small row a document, written
once). N, L and df are aggregates of that table. Then every task cuts its documents
into chunks, builds a ball tree on each (a node's centroid, the radius that holds
all its documents, and that radius term by term) and searches it best first for every
item: a subtree goes unvisited if the lesser of item . centroid + |item| * radius and
item . (centroid + radii by term), rounded up, is under the score of the task's
tenth-best document so far. (On the given tables the radii by term do nearly all of the
pruning: documents share so many terms that one radius is wide.) Leaves are scored in exact integers. A task
returns at most ``top`` rows an item; the best of all tasks are the result. No
document leaves its task, and nothing is shuffled but those rows.

Items are a query set against all rows: they travel to the tasks in blocks of about
``BLOCK_BYTES`` of text, each block with a scan of its own.

Defined results: a null or empty text has no terms and is never returned (it does not
count in N); a null or term-less item has no rows; each row of ``docs`` is a document of
its own, also if it repeats another; rows of ``items`` that repeat both item_id and text
count once, and an item_id with several texts is ranked for each; equal scores go by
ascending doc_id, null first; very long texts are counted whole; either table
empty gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import few_rows_a_batch, materialize

TOP = 10
#: Text of the items that one scan of the documents serves.
BLOCK_BYTES = 4 << 20
#: A chunk of documents that one tree holds: so many documents or so many entries, whichever comes first.
CHUNK_DOCS, CHUNK_ENTRIES = 20_000, 2_000_000
LEAF = 96

#: ASCII letters and digits and all bytes of other characters make terms; A-Z is lower-cased.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

_COUNTED = "doc_id long, n long, terms array<int>, tfs array<int>"
_FOUND = "item int, doc_id long, score long"


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text, in order."""
    return text.translate(_FOLD).split()


def _count_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """A row per document that has terms: how many, and the counts of those in the vocabulary."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.get
        for batch in batches:
            ids, ns, terms, tfs = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                words = terms_of(text.as_py() or b"")
                if not words:
                    continue
                counts = Counter(map(known, words))
                counts.pop(None, None)
                ids.append(doc_id)
                ns.append(len(words))
                terms.append(list(counts))
                tfs.append(list(counts.values()))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                                              pa.array(tfs, pa.list_(pa.int32()))], names=["doc_id", "n", "terms", "tfs"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with few_rows_a_batch(docs.sparkSession):
        return materialize(texts.mapInArrow(run, _COUNTED), "terms")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _gather(ptr: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries of ``rows``, and where each row begins among them."""
    sizes = ptr[rows + 1] - ptr[rows]
    begins = np.cumsum(sizes) - sizes
    return np.repeat(ptr[rows] - begins, sizes) + np.arange(sizes.sum()), begins


class Queries:
    """Items as sparse rows of term counts."""

    def __init__(self, counts: list[dict[int, int]]):
        sizes = [len(c) for c in counts]
        self.begins = np.cumsum(sizes) - sizes
        self.terms = np.array([t for c in counts for t in c], np.int64)
        self.tfs = np.array([v for c in counts for v in c.values()], np.int64)
        self.ends = self.begins + sizes
        self.norms = np.sqrt(np.add.reduceat(self.tfs.astype(float) ** 2, self.begins))

    def dot(self, dense: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.tfs * dense[self.terms], self.begins)


class BallTree:
    """Documents of a chunk in a binary tree of balls; every document has an entry at least."""

    def __init__(self, ptr: np.ndarray, terms: np.ndarray, values: np.ndarray, width: int, queries: Queries, leaf: int = LEAF):
        n, floats = len(ptr) - 1, values.astype(float)
        norms = np.add.reduceat(floats * floats, ptr[:-1])
        order = np.arange(n)
        self.spans: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        self.bounds: list[np.ndarray] = []
        todo: list[tuple[int, int, int]] = [(0, n, -1)]
        while todo:
            lo, hi, parent = todo.pop()
            node = len(self.spans)
            if parent >= 0:
                self.children[parent] = (self.children[parent] or ()) + (node,)
            rows = order[lo:hi]
            places, begins = _gather(ptr, rows)
            its_terms, its = terms[places], floats[places]
            along = lambda dense: np.add.reduceat(its * dense[its_terms], begins)
            centre = np.bincount(its_terms, its, width) / len(rows)
            size = float(centre @ centre)
            apart = norms[rows] - 2 * along(centre) + size
            # safe rounding: room for what the floats may have lost, in the radius and in the bound
            radius = math.sqrt(max(float(apart.max()), 0.0) + 1e-9 * (float(norms[rows].max()) + size))
            reach = np.zeros(width)  # the radius term by term: how far above the centroid a document lies
            np.maximum.at(reach, its_terms, its)
            reach = np.maximum(reach - centre, 0)
            bound = np.minimum(queries.dot(centre) + queries.norms * radius, queries.dot(centre + reach))
            self.bounds.append(bound * (1 + 1e-9) + 1)
            self.spans.append((lo, hi))
            self.children.append(None)
            if hi - lo > leaf:
                one = self._dense(ptr, terms, floats, width, rows[int(apart.argmax())])
                to_one = along(one)
                other = self._dense(ptr, terms, floats, width, rows[int((norms[rows] - 2 * to_one).argmax())])
                mid = (hi - lo) // 2
                order[lo:hi] = rows[np.argpartition(along(other) - to_one, mid)]
                todo += [(lo, lo + mid, node), (lo + mid, hi, node)]
        places, begins = _gather(ptr, order)
        self.order, self.terms, self.values = order, terms[places], values[places]
        self.ptr = np.append(begins, len(places))

    @staticmethod
    def _dense(ptr: np.ndarray, terms: np.ndarray, floats: np.ndarray, width: int, row: int) -> np.ndarray:
        out = np.zeros(width)
        out[terms[ptr[row]:ptr[row + 1]]] = floats[ptr[row]:ptr[row + 1]]
        return out

    def leaves(self, query: int, floor: list[int]) -> Iterator[tuple[int, int]]:
        """Spans of leaves that may hold a score of ``floor[0]`` or more, best bound first; the caller may raise the floor."""
        heap = [(-self.bounds[0][query], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < floor[0]:
                return
            if self.children[node] is None:
                yield self.spans[node]
            else:
                for child in self.children[node]:
                    if self.bounds[child][query] >= floor[0]:
                        heapq.heappush(heap, (-self.bounds[child][query], child))

    def scores(self, lo: int, hi: int, counts: np.ndarray) -> np.ndarray:
        """Exact scores of the documents of a span for an item given as dense term counts."""
        a, b = self.ptr[lo], self.ptr[hi]
        return np.add.reduceat(self.values[a:b] * counts[self.terms[a:b]], self.ptr[lo:hi] - a)


class Best:
    """The ``top`` documents of one item so far, by score and doc_id (null first)."""

    def __init__(self, top: int):
        self.top, self.rows, self.floor = top, [], [1]

    def add(self, scores: np.ndarray, ids: list[int | None]) -> None:
        new = [(-int(s), i is not None, i or 0) for s, i in zip(scores, ids)]
        self.rows = heapq.nsmallest(self.top, self.rows + new)
        if len(self.rows) == self.top:
            self.floor[0] = -self.rows[-1][0]


def _chunks(batches: Iterable[pa.RecordBatch], weights: np.ndarray, n_docs: int, n_terms: int) -> Iterator[tuple]:
    """(doc ids, begins, terms, values) of so many documents as one tree holds; entries of no weight are left out."""
    held: list[tuple] = []
    docs = entries = 0

    def flush() -> tuple:
        ids = [i for part in held for i in part[0]]
        sizes, terms, values = (np.concatenate([part[k] for part in held]) for k in (1, 2, 3))
        return ids, np.append(0, np.cumsum(sizes)), terms, values

    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            ids, lists, tfs = part.column(0), part.column(2), part.column(3).flatten().to_numpy().astype(np.int64)
            sizes = lists.value_lengths().to_numpy().astype(np.int64)
            terms = lists.flatten().to_numpy().astype(np.int64)
            m = 25 + (75 * part.column(1).to_numpy().astype(np.int64) * n_docs) // n_terms
            values = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * np.repeat(m, sizes)))
            row = np.repeat(np.arange(len(sizes)), sizes)[values > 0]
            sizes = np.bincount(row, minlength=len(sizes))
            has = np.flatnonzero(sizes)
            if len(has):
                held.append((ids.take(pa.array(has)).to_pylist(), sizes[has], terms[values > 0], values[values > 0]))
                docs, entries = docs + len(has), entries + len(row)
            if docs >= CHUNK_DOCS or entries >= CHUNK_ENTRIES:
                yield flush()
                held, docs, entries = [], 0, 0
    if held:
        yield flush()


def _search_block(docs: DataFrame, asked: list[Counter], top: int) -> DataFrame:
    """(item, doc_id, score): per task the best documents of every item."""
    spark = docs.sparkSession
    vocabulary = {t: k for k, t in enumerate(sorted(set().union(*asked)))}
    counted = _count_terms(docs, vocabulary)
    n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs:
        return spark.createDataFrame([], _FOUND)
    weights = np.full(len(vocabulary), 0, np.int64)
    for term, df in counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1))).collect():
        weights[term] = weight(n_docs, df)  # a row per term of the items of this block
    counts = [{vocabulary[t]: c for t, c in item.items() if weights[vocabulary[t]]} for item in asked]
    live = [k for k, c in enumerate(counts) if c]
    if not live:
        return spark.createDataFrame([], _FOUND)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = Queries([counts[k] for k in live])
        best = [Best(top) for _ in live]
        dense = np.zeros(len(weights), np.int64)
        for ids, ptr, terms, values in _chunks(batches, weights, n_docs, n_terms):
            tree = BallTree(ptr, terms, values, len(weights), queries)
            for q, b in enumerate(best):
                mine = slice(queries.begins[q], queries.ends[q])
                dense[queries.terms[mine]] = queries.tfs[mine]
                for lo, hi in tree.leaves(q, b.floor):
                    scores = tree.scores(lo, hi, dense)
                    good = np.flatnonzero(scores >= b.floor[0])
                    if len(good):
                        b.add(scores[good], [ids[i] for i in tree.order[lo + good]])
                dense[queries.terms[mine]] = 0
        rows = [(live[q], i if known else None, -score) for q, b in enumerate(best) for score, known, i in b.rows]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64()))], names=["item", "doc_id", "score"])

    return counted.where(F.size("terms") > 0).mapInArrow(run, _FOUND)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of each item by score, then doc_id."""
    spark = docs.sparkSession
    id_type = items.schema["item_id"].dataType
    asked = items.select("item_id", "text").where("text IS NOT NULL").distinct()
    size = asked.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    blocks = -(-size // block_bytes)
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1))))
    out = spark.createDataFrame([], "rank int, doc_id long, score long").select(F.lit(None).cast(id_type).alias("item_id"), "rank", "doc_id", "score")
    for block in range(blocks):
        rows = [(r["item_id"], Counter(terms_of(r["text"].encode()))) for r in asked.where(F.col("block") == block).collect()]
        rows = [r for r in rows if r[1]]
        if not rows:
            continue
        found = _search_block(docs, [c for _, c in rows], top)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        names = spark.createDataFrame([(k, r[0]) for k, r in enumerate(rows)], "item int, item_id " + id_type.simpleString())
        out = out.union(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))  # names: one block's items
    return out
