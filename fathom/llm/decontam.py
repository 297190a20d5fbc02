"""Operator 7: benchmark passages in documents (DataFrame functions only).

Texts are lower-cased and cut into words; a window of a document has as many
words as the benchmark item. A window counts as the item's passage if

* its SimHash (64 bits of its five-word shingles) lies within ``radius`` bits of
  the item's, found by multi-index blocks: the 64 bits are cut into
  ``radius + 1`` blocks, and fingerprints within the radius agree on one; and
* the weighted similarity of the shingles (sum of lesser counts over sum of
  greater counts) is 0.8 or more, computed exactly.

Which windows are fingerprinted: a window of at most the item's length and with
similarity s lacks at most 1 - s of the item's shingles (the bound also holds for
a document shorter than the item), so it holds at least one of any larger part of
them. The first such part of each item are its seeds, and every window that holds
a seed anywhere is put forward: moved sentences do not hide a passage. A seed that
follows its predecessor in the document puts forward only the window that starts
at it, since the predecessor put forward the others. Windows with the same words are
fingerprinted and verified once, however many documents hold them.

Seeds are literals of the plan, at most ``seed_block`` at a time (a benchmark
with more is matched in blocks); documents are read once per block without a
shuffle, and only rows with a hit go on. A benchmark of more than
``BROADCAST_ROWS`` items meets the documents' shingles in a shuffle join instead.

Defined results: null and empty texts and items match nothing; an item of
fewer than five words has one shingle; a document shorter than an item is
compared as a whole; rows alike in doc_id and text count once; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, let, materialize, text_hash, whole_text, words_of

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 20
SEED_BLOCK = 50_000
#: Rows of a benchmark table that may be broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def shingles(words: Column, k: int = SHINGLE) -> Column:
    """Hashes of the k-word shingles of a word array; fewer words make one, none make none."""
    def of(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.greatest(F.size(w) - k, F.lit(0)))
        # a shingle is hashed word by word: null beyond the end leaves the hash as it is
        return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(
            F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)])))
    return let(words, of)


def simhash(hashes: Column) -> Column:
    """Majority of each of the 64 bits over the shingle hashes (a tie is zero)."""
    def of(all_: Column) -> Column:
        def bit(b: Column) -> Column:
            ones = F.aggregate(all_, F.lit(0), lambda a, h: a + F.getbit(h, b))
            return F.when(2 * ones > F.size(all_), F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
        return F.transform(F.sequence(F.lit(0), F.lit(63)), bit)
    bits = let(hashes, of)
    return F.aggregate(F.reverse(bits), F.lit(0).cast("long"), lambda a, b: F.shiftleft(a, 1).bitwiseOR(b))


def blocks(fp: Column, radius: int = RADIUS) -> Column:
    """(block number, its bits) of radius + 1 blocks."""
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    return F.array(*[F.struct(F.lit(i).alias("blk"), F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("bits"))
                     for i, (a, b) in enumerate(zip(cuts, cuts[1:]))])


def items_of(benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """item_id, m (words), hashes, fp, n_seeds (one more than the shingles that a window may lack)."""
    words = words_of(F.lower(whole_text()))
    rows = benchmark.select("item_id", words.alias("w")).where(F.size("w") > 0).select(
        "item_id", F.size("w").alias("m"), shingles(F.col("w")).alias("hashes"))
    n_seeds = F.floor(F.size("hashes") * (1 - similarity) + 1e-9).cast("int") + 1
    return rows.select("item_id", "m", "hashes", simhash(F.col("hashes")).alias("fp"), n_seeds.alias("n_seeds")).distinct()


def seeds_of(items: DataFrame) -> DataFrame:
    """item_id, m, h, before: each seed once an item, with the seeds that precede it in the item."""
    own = F.transform(F.slice("hashes", F.lit(1), F.col("n_seeds")), lambda h, i: F.struct(h.alias("h"), F.get(F.col("hashes"), i - 1).alias("b")))
    return items.select("item_id", "m", F.explode(own).alias("s")).groupBy("item_id", "m", F.col("s.h").alias("h")).agg(
        F.collect_set("s.b").alias("before"))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _windows(docs: DataFrame, seeds: DataFrame, hashes: list[int] | None) -> DataFrame:
    """doc_id, th, item_id, m, start, words of the windows that the given seeds put forward."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("th"), words_of(F.lower(whole_text())).alias("w"))
    # exploded as an expression: a filter on its size would be pushed down and evaluate it twice
    hits = let(shingles(F.col("w")), lambda all_: F.transform(all_, lambda h, i: F.struct(h.alias("h"), i.alias("p"), F.get(all_, i - 1).alias("b"))))
    if hashes is not None:
        hits = F.filter(hits, lambda x: x["h"].isin(hashes))
    found = rows.select("doc_id", "th", "w", F.explode(hits).alias("x")).select("doc_id", "th", "w", "x.*").join(seeds, "h")
    last = F.greatest(F.size("w") - F.col("m"), F.lit(0))
    clip = lambda c: F.least(F.greatest(c, F.lit(0)), last).cast("int")
    follows = F.coalesce(F.array_contains("before", F.col("b")), F.lit(False))
    first = F.when(follows, F.col("p")).otherwise(F.col("p") - F.greatest(F.col("m") - SHINGLE, F.lit(0)))
    # only the words about a hit go on to its windows
    found = found.select("doc_id", "th", "item_id", "m", "w", clip(first).alias("lo"), clip(F.col("p")).alias("hi"))
    found = found.select("doc_id", "th", "item_id", "m", "lo", F.slice("w", F.col("lo") + 1, F.col("hi") - F.col("lo") + F.col("m")).alias("near"),
                         F.explode(F.sequence("lo", "hi")).alias("start"))
    return found.select("doc_id", "th", "item_id", "m", "start", F.slice("near", F.col("start") - F.col("lo") + 1, F.col("m")).alias("words")).withColumn(
        "h1", F.xxhash64("words")).withColumn("h2", F.xxhash64(F.lit(7), "words"))


def contaminated(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY,
                 seed_block: int = SEED_BLOCK) -> DataFrame:
    """doc_id, th (hash of the text), item_id, start, n_words, hamming, similarity: the best window of every document and item that match."""
    items = materialize(items_of(benchmark, similarity), "items")
    n_items = items.count()
    seeds = seeds_of(items)
    if n_items <= BROADCAST_ROWS:
        known = [r[0] for r in seeds.select("h").distinct().orderBy("h").collect()]
        parts = [known[i:i + seed_block] for i in range(0, len(known), seed_block)] or [[]]
        found = reduce(DataFrame.union, [_windows(docs, F.broadcast(seeds.where(F.col("h").isin(part))), part) for part in parts])
    else:  # too many seeds for the plan: every shingle of the documents meets them in a shuffle
        found = _windows(docs, seeds, None)
    windows = materialize(found.distinct(), "windows")

    same = ["item_id", "h1", "h2"]
    once = windows.groupBy(*same).agg(F.first("words").alias("words")).withColumn("hashes", shingles(F.col("words")))
    once = materialize(once.select(*same, "hashes", simhash(F.col("hashes")).alias("fp")), "window-prints")
    theirs = items.select("item_id", F.col("fp").alias("item_fp"), F.explode(blocks(F.col("fp"), radius)).alias("b")).select("item_id", "item_fp", "b.*")
    mine = once.select(*same, "fp", F.explode(blocks(F.col("fp"), radius)).alias("b")).select(*same, "fp", "b.*")
    near = mine.join(_small(theirs, n_items * (radius + 1)), ["item_id", "blk", "bits"]).select(
        *same, F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))).alias("hamming")).where(F.col("hamming") <= radius).distinct()

    counts = lambda df, keys, name: df.select(*keys, F.explode("hashes").alias("g")).groupBy(*keys, "g").agg(F.count("*").alias(name))
    mine = counts(once.join(near.select(*same).distinct(), same, "left_semi"), same, "c1")
    theirs = counts(items, ["item_id"], "c2")
    shared = mine.join(theirs, ["item_id", "g"]).groupBy(*same).agg(F.sum(F.least("c1", "c2")).alias("shared"))
    sizes = once.select(*same, F.size("hashes").alias("n1")).join(_small(items.select("item_id", F.size("hashes").alias("n2")), n_items), "item_id")
    alike = shared.join(sizes, same).withColumn("similarity", F.col("shared") / (F.col("n1") + F.col("n2") - F.col("shared"))).where(
        F.col("similarity") >= similarity - 1e-12)
    good = near.join(alike, same).select(*same, "hamming", "similarity")
    best = F.max(F.struct("similarity", (-F.col("hamming")).alias("d"), (-F.col("start")).alias("s"), F.col("m").alias("m")))
    return windows.join(good, same).groupBy("doc_id", "th", "item_id").agg(best.alias("b")).select(
        "doc_id", "th", "item_id", (-F.col("b.s")).alias("start"), F.col("b.m").alias("n_words"), (-F.col("b.d")).alias("hamming"),
        F.col("b.similarity").alias("similarity"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text holds no benchmark passage."""
    own, text = fresh(docs, "own_", "th_")
    bad = contaminated(docs, benchmark, **settings).select(F.col("doc_id").alias(own), F.col("th").alias(text)).distinct()
    bad = materialize(bad, "leaks")
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(F.col(own)) & (text_hash() == F.col(text)), "left_anti")
