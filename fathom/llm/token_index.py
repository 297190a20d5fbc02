"""Operator 1: token-id payload files with a minimal perfect hash index.

Layout, all under one folder (Parquet containers, so that Spark's commit
protocol makes a rerun after a lost executor safe):

* ``payload``  one row per block: ``part, block``, the directory of its
  documents in ascending key order (``doc_ids``, ``key64s``, ``lens``, ``offs``:
  ids before each in the block) and ``ids``, the raw little-endian ids of all of them (2 bytes each when the
  vocabulary allows, else 4);
* ``parts``    one row per part: ids and documents in all parts before it;
* ``index``    one row per bucket of keys: a minimal perfect hash (levels of
  bit arrays: a key that is alone at its place of a level sets the bit, the
  others go on to the next, smaller level; the slot is the number of set bits
  before its own) and, by slot, the stored fingerprint of the key, the number of the
  first document that has it (in the order of the files), its part, block and place
  there, its start and length, and the number of documents that share the key.

Parts come from a range partition on (key, hash of the text), so equal keys
lie next to each other and a key with many rows is still spread out. A lookup
reads one bucket, tests a constant expected number of bits and one slot; an
absent key fails the fingerprint (a false hit has a chance of 2**-32). ``fetch``
reads the ids of keys: index, then the blocks that the slots name, then the places in
them. Documents that share a key lie next to each other, so their number and the
first of them give all their places, over several blocks too.

Defined results: null text is empty; every document gets the end id; a null
key is a key like any other; repeated keys share one slot and are all fetched; a
very long text is encoded whole, in a block that it may fill alone; an empty table gives empty files; extra columns are not
read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import shared_scratch
from .common import text_batches, whole_text
from .tokens import DEFAULT_TOKENIZER, END_ID, encoder

#: A block is closed at so many ids or documents.
BLOCK_IDS, BLOCK_DOCS = 1 << 20, 1 << 16
#: Keys of one index bucket, on average.
BUCKET_KEYS = 1 << 15

PAYLOAD = "part int, block int, width int, n_ids long, doc_ids array<bigint>, key64s array<bigint>, lens array<bigint>, offs array<bigint>, ids binary"
#: What a slot holds, as arrays of 8-byte numbers.
SLOT = ("number", "part", "block", "place", "start", "n_tokens", "copies")
INDEX = "bucket int, sizes array<bigint>, levels array<binary>, prints binary, " + ", ".join(f"{c} binary" for c in SLOT)
U64 = np.uint64


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """SplitMix64 finaliser of key + seed, for uint64 arrays."""
    with np.errstate(over="ignore"):
        z = keys + U64(((seed + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> U64(27))) * U64(0x94D049BB133111EB)
        return z ^ (z >> U64(31))


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 977) >> U64(32)).astype("<u4")


def build_mph(keys: np.ndarray, gamma: float = 2.0) -> tuple[list[int], list[bytes]]:
    """Sizes and bit arrays of the levels for distinct uint64 keys."""
    sizes, levels, rest = [], [], keys
    while len(rest):
        size = max(64, int(gamma * len(rest)))
        at = mix(rest, len(sizes)) % U64(size)
        alone = np.bincount(at.astype(np.int64), minlength=size) == 1
        sizes.append(size)
        levels.append(np.packbits(alone, bitorder="little").tobytes())
        rest = rest[~alone[at.astype(np.int64)]]
    return sizes, levels


def slots_of(keys: np.ndarray, sizes: list[int], levels: list[bytes]) -> np.ndarray:
    """Slot of each uint64 key, -1 where no level has its bit."""
    out = np.full(len(keys), -1, np.int64)
    open_, before = np.arange(len(keys)), 0
    for level, (size, raw) in enumerate(zip(sizes, levels)):
        bits = np.unpackbits(np.frombuffer(raw, np.uint8), count=size, bitorder="little")
        ranks = np.cumsum(bits) - bits
        at = (mix(keys[open_], level) % U64(size)).astype(np.int64)
        hit = bits[at] == 1
        out[open_[hit]] = before + ranks[at[hit]]
        open_ = open_[~hit]
        before += int(bits.sum())
    return out


def _encode_blocks(tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, enc, block = TaskContext.get().partitionId(), encoder(tokenizer), 0
        width = enc.dtype.itemsize
        end = np.array([end_id], enc.dtype).tobytes()
        ids, docs, keys, lens, offs, n = [], [], [], [], [], 0

        def close():
            row = {"part": [part], "block": [block], "width": [width], "n_ids": [n], "doc_ids": [docs], "key64s": [keys],
                   "lens": [lens], "offs": [offs], "ids": [b"".join(ids)]}
            return pa.RecordBatch.from_pydict(row, schema=_PAYLOAD_ARROW)

        for batch in batches:
            doc_ids, key64s = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, got in enumerate(enc.encode_all(batch.column(2).to_pylist())):
                ids += [got.tobytes(), end]
                docs.append(doc_ids[i])
                keys.append(key64s[i])
                lens.append(len(got) + 1)
                offs.append(n)
                n += len(got) + 1
                if n >= BLOCK_IDS or len(docs) >= BLOCK_DOCS:
                    yield close()
                    ids, docs, keys, lens, offs, n, block = [], [], [], [], [], 0, block + 1
        if docs:
            yield close()
    return run


_PAYLOAD_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("width", pa.int32()), ("n_ids", pa.int64()),
                            ("doc_ids", pa.list_(pa.int64())), ("key64s", pa.list_(pa.int64())), ("lens", pa.list_(pa.int64())),
                            ("offs", pa.list_(pa.int64())), ("ids", pa.binary())])
_INDEX_ARROW = pa.schema([("bucket", pa.int32()), ("sizes", pa.list_(pa.int64())), ("levels", pa.list_(pa.binary())),
                          ("prints", pa.binary()), *[(c, pa.binary()) for c in SLOT]])
#: (part, block) pairs that may be broadcast to choose blocks; more are joined by a shuffle.
BROADCAST_BLOCKS = 1_000_000
_PARTS = "part int, before long, docs_before long, n_docs long"


def bucket_of(key64, n_buckets: int):
    return F.pmod(F.xxhash64(key64, F.lit("bucket")), F.lit(n_buckets)).cast("int")


def write_tokens(docs: DataFrame, path: str, tokenizer: str = DEFAULT_TOKENIZER, end_id: int = END_ID,
                 bucket_keys: int = BUCKET_KEYS) -> None:
    """Encode every whole text and write payload, parts and index under ``path``."""
    spark = docs.sparkSession
    rows = text_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long")).alias("key64"),
                       whole_text().alias("text"))
    dealt = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    dealt.mapInArrow(_encode_blocks(tokenizer, end_id), PAYLOAD).write.option("compression", "zstd").parquet(f"{path}/payload")

    payload = spark.read.schema(PAYLOAD).parquet(f"{path}/payload")
    # one row per part: as many as write tasks, whatever the data's size
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = payload.groupBy("part").agg(F.sum("n_ids").alias("n_ids"), F.sum(F.size("doc_ids")).alias("n_docs"))
    parts.select("part", *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).cast("long").alias(n) for c, n in (("n_ids", "before"), ("n_docs", "docs_before"))],
                 "n_docs").coalesce(1).write.parquet(f"{path}/parts")

    n_buckets = _buckets(spark, path, bucket_keys)
    first = F.min(F.struct(*SLOT[:-1])).alias("first")
    slots = directory(spark, path).groupBy("key64").agg(first, F.count("*").alias("copies")).select(
        bucket_of(F.col("key64"), n_buckets).alias("bucket"), "key64", "first.*", "copies")

    def build(table: pa.Table) -> pa.Table:
        keys = table["key64"].to_numpy().view(U64)
        sizes, levels = build_mph(keys)
        at = np.empty(len(keys), np.int64)
        at[slots_of(keys, sizes, levels)] = np.arange(len(keys))
        col = lambda name: np.ascontiguousarray(table[name].to_numpy()[at].astype("<i8")).tobytes()
        return pa.Table.from_pydict({
            "bucket": [table["bucket"][0].as_py()], "sizes": [sizes], "levels": [levels], "prints": [fingerprint(keys[at]).tobytes()],
            **{c: [col(c)] for c in SLOT}}, schema=_INDEX_ARROW)

    slots.groupBy("bucket").applyInArrow(build, INDEX).write.option("compression", "zstd").parquet(f"{path}/index")


def _buckets(spark: SparkSession, path: str, bucket_keys: int) -> int:
    n_docs = spark.read.schema(_PARTS).parquet(f"{path}/parts").agg(F.sum("n_docs")).first()[0] or 0
    return max(1, -(-n_docs // bucket_keys))


def directory(spark: SparkSession, path: str) -> DataFrame:
    """A row per stored document from the blocks' directories, without reading the ids."""
    blocks = spark.read.schema(PAYLOAD).parquet(f"{path}/payload")
    rows = blocks.select("part", "block", F.posexplode(F.arrays_zip("doc_ids", "key64s", "lens", "offs")).alias("place", "d"))
    return rows.join(_block_starts(spark, path), ["part", "block"]).select(
        F.col("d.doc_ids").alias("doc_id"), F.col("d.key64s").alias("key64"), (F.col("first") + F.col("place")).alias("number"), "part", "block", "place",
        (F.col("block_start") + F.col("d.offs")).alias("start"), F.col("d.lens").alias("n_tokens"))


def _block_starts(spark: SparkSession, path: str) -> DataFrame:
    """part, block, block_start (ids before the block), first (documents before it), n_docs; a window within each part (its blocks only)."""
    blocks = spark.read.schema(PAYLOAD).parquet(f"{path}/payload").select("part", "block", "n_ids", F.size("doc_ids").cast("long").alias("n_docs"))
    ahead = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = spark.read.schema(_PARTS).parquet(f"{path}/parts").select("part", "before", "docs_before")
    inside = lambda c: F.coalesce(F.sum(c).over(ahead), F.lit(0))
    return blocks.select("part", "block", "n_docs", inside("n_ids").alias("ids"), inside("n_docs").alias("docs")).join(parts, "part").select(
        "part", "block", (F.col("before") + F.col("ids")).alias("block_start"), (F.col("docs_before") + F.col("docs")).alias("first"), "n_docs")


def lookup(spark: SparkSession, path: str, keys: DataFrame, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """``keys`` (doc_id) -> doc_id, what its slot holds (``SLOT``), found; through the index alone.

    Keys are dealt to their buckets and answered by one hash, one slot and one
    fingerprint each. A repeated key is answered once.
    """
    n_buckets = _buckets(spark, path, bucket_keys)
    asked = keys.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("key64", F.xxhash64("doc_id")).withColumn(
        "bucket", bucket_of(F.col("key64"), n_buckets))
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    out = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in SLOT], ("found", pa.bool_())])

    def answer(asked: pa.Table, index: pa.Table) -> pa.Table:
        n = asked.num_rows
        if not n:
            return out.empty_table()
        if not index.num_rows:
            return pa.Table.from_arrays([asked["doc_id"].combine_chunks(), *[pa.nulls(n, pa.int64())] * len(SLOT), pa.array([False] * n)], schema=out)
        row = {c: index[c][0].as_py() for c in index.column_names}
        keys64 = asked["key64"].to_numpy().view(U64)
        slot = slots_of(keys64, row["sizes"], row["levels"])
        found = slot >= 0
        found[found] &= np.frombuffer(row["prints"], "<u4")[slot[found]] == fingerprint(keys64[found])
        take = lambda name: pa.array(np.frombuffer(row[name], "<i8")[np.maximum(slot, 0)], mask=~found)
        return pa.Table.from_arrays([asked["doc_id"].combine_chunks(), *[take(c) for c in SLOT], pa.array(found)], schema=out)

    return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(
        answer, "doc_id long, " + ", ".join(f"{c} long" for c in SLOT) + ", found boolean")


def _places(spark: SparkSession, path: str, found: DataFrame) -> DataFrame:
    """key, number, part, block, place of every document that has a found key.

    The first comes from the slot; those that share its key have the numbers after it, and blocks know the numbers they hold."""
    one = found.select(F.col("doc_id").alias("key"), "number", F.col("part").cast("int").alias("part"), F.col("block").cast("int").alias("block"), "place")
    more = found.where("copies > 1").select(F.col("doc_id").alias("key"), F.explode(F.sequence(F.col("number") + 1, F.col("number") + F.col("copies") - 1)).alias("number"))
    blocks = _block_starts(spark, path)
    stretch = lambda c: F.floor(c / BLOCK_DOCS)
    blocks = blocks.select("part", "block", "first", "n_docs", F.explode(F.sequence(stretch(F.col("first")), stretch(F.col("first") + F.col("n_docs") - 1))).alias("stretch"))
    met = more.withColumn("stretch", stretch(F.col("number"))).join(blocks, "stretch").where("number >= first AND number < first + n_docs")
    return one.unionByName(met.select("key", "number", "part", "block", (F.col("number") - F.col("first")).alias("place")))


def fetch(spark: SparkSession, path: str, keys: DataFrame, with_ids: bool = True, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """The stored documents of ``keys`` (doc_id): doc_id, number, start, n_tokens, ids_crc32 and, ``with_ids``, ids (array of int).

    Index -> places -> blocks: only blocks that hold an asked document are decoded, and of their documents only those
    that the index names come out. Keys that are not stored have no row."""
    found = lookup(spark, path, keys, bucket_keys).where("found")
    places = _places(spark, path, found)
    payload = spark.read.schema(PAYLOAD).parquet(f"{path}/payload").select("part", "block", "width", "lens", "ids")
    asked = places.select("part", "block").distinct()
    n_blocks = spark.read.schema(PAYLOAD).parquet(f"{path}/payload").select("part").count()
    payload = payload.join(F.broadcast(asked) if n_blocks <= BROADCAST_BLOCKS else asked, ["part", "block"], "left_semi")
    spec = "part int, block int, place long, in_block long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("place", pa.int64()), ("in_block", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64())] + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], f"<u{row['width']}").astype("<u4")
                lens = np.array(row["lens"], np.int64)
                ends = np.cumsum(lens)
                starts = ends - lens
                k = len(lens)
                cols = [pa.array(np.full(k, row["part"], np.int32)), pa.array(np.full(k, row["block"], np.int32)), pa.array(np.arange(k)), pa.array(starts), pa.array(lens),
                        pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist())], pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, schema=schema)

    read = payload.select("part", "block", "width", "lens", "ids").mapInArrow(run, spec)
    starts = _block_starts(spark, path).select("part", "block", "block_start")
    return places.join(read, ["part", "block", "place"]).join(starts, ["part", "block"]).select(
        F.col("key").alias("doc_id"), "number", (F.col("block_start") + F.col("in_block")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def encode_and_read(docs: DataFrame, path: str | None = None, tokenizer: str = DEFAULT_TOKENIZER) -> DataFrame:
    """Write all documents and fetch every one of them through the index: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    path = path or shared_scratch(spark, "tokens")
    write_tokens(docs, path, tokenizer)
    return fetch(spark, path, docs.select("doc_id"), with_ids=False).drop("number")
