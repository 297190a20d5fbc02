"""Operator 12: a low-discrepancy schedule that mixes sources to target weights.

Targets: sources in code-point order (null last) get the weights in turn and share the
words of all documents; a source's target stops at ``max_epochs`` times its size and
the excess is shared again by weight until none is above.

Stream: a source's documents are put in an order shuffled by a hash and laid end to
end; read round and round, that stream is cut into blocks of ``block_words`` words, and
a source needs as many blocks as its target fills (the last one cut at the target).

Schedule: the van der Corput point of slot i is i with its bits reversed. Points
are mapped through the cumulative block counts of the sources, so that every source gets
exactly its blocks and they lie evenly over the whole schedule. Slots are ranked per
source, and the r-th slot of a source takes the r-th block of its stream.

Plan: running totals (words of a source before a document, slots of a source before a
slot) are taken inside small chunks and shifted by the totals of earlier chunks, so no
source is gathered in a task. Slots are made from the sources' ranges, a chunk at a
time. Pieces of documents meet slots in an equi join on (source, rank), whose keys
each hold at most a block of words.

Defined results: a null text has size 0; documents of size 0 are never taken; rows
that repeat doc_id, source and text lie side by side and are each a document (copy 0,
1, ..); null doc_id and null source are values like others; a very long text spans many blocks;
an empty table gives no rows, as do sources without words in the schedule; extra columns
are not read. The hash makes reruns agree, whatever the partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import dense_key
from .common import materialize, text_hash, whole_text, words_of

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
BLOCK_WORDS = 2048
SEED = "mix"
#: Rows (expected) that one chunk of a running total holds.
CHUNK = 1 << 12


def _before(df: DataFrame, group: list[str], chunk: str, order: list[str], value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows before, by (chunk, order) in each group; one task holds one chunk of one group."""
    totals = df.groupBy(*group, chunk).agg(F.sum(value).alias("_total"))
    by_chunk = Window.partitionBy(*group).orderBy(chunk) if group else Window.orderBy(chunk)
    by_chunk = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    shift = totals.select(*group, chunk, F.coalesce(F.sum("_total").over(by_chunk), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(*group, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return local.join(shift, [*group, chunk]).withColumn(name, (F.col("_shift") + F.col("_local")).cast("long")).drop("_shift", "_local")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> source, source_size, no, target: words that each source is to give."""
    share = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("no") % len(weights) + 1).cast("int"))
    known = dense_key(sizes, [F.asc_nulls_last("source")], "no", start=0).withColumn("weight", share)
    known = known.withColumn("most", F.col("source_size") * max_epochs)
    total, free = known.agg(F.sum("source_size"), F.sum("weight")).first()
    left, full = total or 0, 0
    above = F.lit(False)
    while free:
        above = F.col("most") * F.lit(float(free)) < F.col("weight") * F.lit(float(left))
        taken, new, free_now = known.agg(F.coalesce(F.sum(F.when(above, F.col("most"))), F.lit(0)), F.count_if(above),
                                         F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        if new == full:
            break
        left, free, full = total - taken, free_now, new
    target = F.when(above, F.col("most").cast("double")).otherwise(F.col("weight") * F.lit(float(left)) / F.lit(float(free or 1)))
    return known.select("source", "source_size", "no", target.alias("target"))


def _reversed_bits(value: Column, bits: int) -> Column:
    return F.conv(F.reverse(F.lpad(F.bin(value), bits, "0")), 2, 10).cast("long")


def slots(sources: DataFrame) -> DataFrame:
    """(no, blocks) -> no, rank, slot: every block of every source at its place in the schedule, which counts up with gaps."""
    known = _before(sources.where("blocks > 0").withColumn("_c", F.floor(F.col("no") / CHUNK)), [], "_c", ["no"], "blocks", "first")
    total = known.agg(F.sum("blocks")).first()[0] or 0
    bits = max(int(total - 1).bit_length(), 1) if total else 1
    parts = known.select("no", "first", "blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("blocks") - 1) / CHUNK))).alias("part"))
    parts = parts.repartition("no", "part")
    low = F.col("first") + F.col("part") * CHUNK
    cells = parts.select("no", F.explode(F.sequence(low, F.least(low + CHUNK, F.col("first") + F.col("blocks")) - 1)).alias("cell"))
    placed = cells.select("no", _reversed_bits(F.col("cell"), bits).alias("slot"), F.lit(1).cast("long").alias("one"))
    placed = placed.withColumn("_c", F.floor(F.col("slot") / CHUNK))
    return _before(placed, ["no"], "_c", ["slot"], "one", "rank").select("no", "rank", "slot")


def lay_out(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """Every document (doc_id, hash, copy) with its size, its source's no, size and target, and its place in the source's stream."""
    size = F.size(words_of(whole_text())).cast("long")
    rows = docs.select("doc_id", "source", size.alias("size"), text_hash().alias("hash"))
    rows = materialize(rows.groupBy("doc_id", "source", "size", "hash").agg(F.count(F.lit(1)).alias("copies")), "sizes")
    by_source = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.count(F.lit(1)).alias("rows"))
    known = materialize(by_source, "sources", 0)
    n_rows = known.agg(F.sum("rows")).first()[0] or 0
    known = targets(known.drop("rows"), weights, max_epochs)
    bits = max((n_rows // (CHUNK // 2)).bit_length(), 1)
    key = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 15), 16, 10).cast("long")
    joined = rows.alias("r").join(known.alias("k"), F.col("r.source").eqNullSafe(F.col("k.source"))).select("r.*", "k.source_size", "k.no", "k.target")
    joined = joined.withColumn("_key", key).withColumn("_c", F.shiftright("_key", 60 - bits)).withColumn("_all", F.col("size") * F.col("copies"))
    placed = _before(joined, ["no"], "_c", ["_key", "doc_id", "hash"], "_all", "at")
    each = placed.select(*[c for c in placed.columns if c not in ("_key", "_c", "_all", "copies")],
                         F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
    return each.withColumn("at", F.col("at") + F.col("copy") * F.col("size"))


def schedule(laid: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """slot, offset (words of the slot before), no (source), doc_id, hash, copy, epoch, start, length (words of the document), by ``lay_out``."""
    sources = laid.select("no", "target", "source_size").distinct()
    whole = F.floor(F.col("target") + 0.5).cast("long")
    sources = sources.withColumn("blocks", F.ceil(whole / block_words).cast("long"))
    rounds = laid.where("size > 0").withColumn("words", whole).where("words > 0")
    rounds = rounds.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("words") - 1) / F.col("source_size")).cast("long"))))
    rounds = rounds.withColumn("begin", F.col("epoch") * F.col("source_size") + F.col("at")).where("begin < words")
    rounds = rounds.withColumn("end", F.least(F.col("begin") + F.col("size"), F.col("words")))
    pieces = rounds.withColumn("rank", F.explode(F.sequence(F.floor(F.col("begin") / block_words), F.floor((F.col("end") - 1) / block_words))))
    low = F.greatest(F.col("begin"), F.col("rank") * block_words)
    high = F.least(F.col("end"), (F.col("rank") + 1) * block_words)
    pieces = pieces.withColumn("offset", low - F.col("rank") * block_words).withColumn("start", low - F.col("begin")).withColumn("length", high - low)
    return pieces.join(slots(sources.select("no", "blocks")), ["no", "rank"]).select(
        "slot", "offset", "no", "doc_id", "hash", "copy", "epoch", "start", "length", "size", "source_size", "target")


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix as spans of documents, in the order (slot, offset)."""
    return schedule(materialize(lay_out(docs, weights, max_epochs, seed), "laid"), block_words)


def taken(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row of ``docs``: the words that the spans of the mix take of it."""
    laid = materialize(lay_out(docs), "laid")
    same = ["doc_id", "hash", "copy", "no", "size", "source_size", "target"]
    none = laid.select(*same, F.lit(0).cast("long").alias("length"))
    both = none.unionByName(schedule(laid, block_words).select(*same, "length"))
    return both.groupBy(*same).agg(F.sum("length").alias("taken")).select("doc_id", "size", "source_size", "target", "taken")
