"""Operator 6: document fingerprints as invertible Bloom lookup sketches (DataFrame functions only).

A text's paragraphs are its lines, cut after sentence ends. Each is an element
(hash, its number among equal ones), so texts are sets of elements. A sketch has
three subtables of cells; an element is in one cell of each, where counts add
and element hashes and their check hashes are xor-ed. Subtracting the sketches
of two versions cancels what they share. A cell that holds one element (count
1 or -1, matching check) gives it away; taking it out of its other cells frees
more: peeling. Subtables are peeled in turn, so no element is taken out twice.
If cells remain, the pair is sketched anew with twice the cells and other
hashes, until every pair has been peeled.

Plan: elements of a row are arrays; after one shuffle by row, cells are
exploded and every aggregation of the peeling runs on that partitioning. Cells
of a pair follow from its number of paragraphs and the share expected to
differ, so work is linear in the text.

What peeling gives is kept: ``recovered`` returns the digests that differ, with their
side, and likeness (elements shared by both versions over elements in either) is
counted from them. The fingerprint string is a sketch of fixed size with the same
cells (count, xor of elements, xor of checks), so two stored fingerprints can be
subtracted and peeled as well (``compare_prints``): where few elements differ they are
recovered, else the pair is told as not decoded.

Next documents: rows are cut into ranges of doc_id of about ``range_rows`` rows
(boundaries from approximate percentiles), a window per range finds the next
one, and the last of each range looks at the head of the range below.

Defined results: null text is empty (no elements); two empty texts are alike
(1.0); repeated doc_ids are ordered by the hash of their text, null doc_ids are
the smallest; a single document is its own next one; an empty table gives no
rows; very long texts are read whole; rows that share a doc_id are documents of
their own; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ROWS_PER_FILE, let, materialize, whole_text

RANGE_ROWS = 2000
#: Ranges at most, since their bounds are literals of the plan; beyond that ranges hold more rows (a window that spills).
RANGES = 100_000
#: Cells of a subtable of the fingerprint string.
PRINT_CELLS = 8
#: Cells per element that is expected to differ, and the cells that a subtable has besides: few small sketches fail.
ROOM, LEAST_CELLS = 3.0, 16
#: Documents whose cells are peeled in one task, on average; a task's cells fit its memory.
PEEL_ROWS = 2000
#: Pairs to sketch anew that may be broadcast (three numbers each); more are joined by a shuffle.
BROADCAST_PAIRS = 1_000_000
#: Rounds over one subtable each; what is left then is sketched anew.
ROUNDS = 12


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(F.replace(text, F.lit(". "), F.lit(".\n")), "\n"), lambda p: p != F.lit(""))


def elements(text: Column) -> Column:
    """Array of distinct longs: hash of (paragraph hash, its number among equal paragraphs)."""
    hashes = F.array_sort(F.transform(paragraphs(text), lambda p: F.xxhash64(p)))
    return let(hashes, lambda all_: F.transform(all_, lambda h, i: F.xxhash64(h, i - F.array_position(all_, h))))


def place(key: Column, subtable: int, size: Column, seed: int = 0) -> Column:
    """Cell of an element in one subtable of ``size`` cells."""
    return (F.lit(subtable) * size + F.pmod(F.xxhash64(key, F.lit(3 * seed + subtable)), size)).cast("int")


def check(key: Column) -> Column:
    return F.xxhash64(key, F.lit("check"))


def print_place(key: Column, subtable: int, size: Column | int) -> Column:
    """Cell of an element in one subtable of the fingerprint string: other bits of the element for each."""
    return F.pmod(F.shiftright(key, 20 * subtable), size if isinstance(size, Column) else F.lit(size).cast("long"))


def print_of(keys: Column, cells: int = PRINT_CELLS) -> Column:
    """A sketch of three subtables as text: the number of elements, then ``count:elements:checks`` of each cell."""
    numbers = F.sequence(F.lit(0), F.lit(cells - 1))
    xor = lambda own, name: F.lower(F.hex(F.aggregate(own, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x[name]))))

    def text(rows: Column) -> Column:
        def subtable(s: int) -> Column:
            def cell(j: Column) -> Column:
                return let(F.filter(rows, lambda x: print_place(x["k"], s, cells) == j),
                           lambda own: F.concat_ws(":", F.size(own).cast("string"), xor(own, "k"), xor(own, "h")))
            return F.array_join(F.transform(numbers, cell), " ")
        return F.concat_ws("|", F.size(rows).cast("string"), *[subtable(s) for s in range(3)])

    return let(F.transform(keys, lambda k: F.struct(k.alias("k"), check(k).alias("h"))), text)


def with_next(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, text, next (text of the next document in descending doc_id order, of the first after the last), rng, rn."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    n = rows.count()
    cuts = -(-n // max(range_rows, -(-n // RANGES))) - 1 if n else 0
    bounds = []
    if cuts > 0:
        got = rows.agg(F.percentile_approx("doc_id", [(i + 1) / (cuts + 1) for i in range(cuts)], 10 * (cuts + 1))).first()[0]
        bounds = sorted(set(got or []))
    # two levels, so that a row is compared with about twice the square root of the number of bounds
    step = max(1, int(len(bounds) ** 0.5))
    coarse, fine = bounds[::step], [bounds[i:i + step] for i in range(0, len(bounds), step)]
    below = lambda arr: F.size(F.filter(arr, lambda b: b <= F.col("doc_id")))
    if bounds:
        first = below(F.array(*[F.lit(b).cast("long") for b in coarse]))
        inner = F.array(*[F.array(*[F.lit(b).cast("long") for b in f]) for f in fine])
        rng = F.when(F.col("doc_id").isNull() | (first == 0), F.lit(0)).otherwise(
            (first - 1) * step + F.size(F.filter(F.element_at(inner, F.greatest(first, F.lit(1))), lambda b: b <= F.col("doc_id"))))
    else:
        rng = F.lit(0)
    rows = rows.withColumn("rng", rng.cast("int")).withColumn("h", F.xxhash64("text"))

    # heads: the first row of each range in descending order; as many rows as there are ranges
    tops = rows.select("rng", "doc_id").groupBy("rng").agg(F.max("doc_id").alias("top"))
    heads = rows.alias("r").join(F.broadcast(tops.alias("t")), (F.col("r.rng") == F.col("t.rng")) & F.col("r.doc_id").eqNullSafe(F.col("t.top"))).groupBy(
        F.col("r.rng").alias("rng")).agg(F.max(F.struct("h", "text")).alias("head"))
    order = Window.orderBy("rng")  # over one row per range, without texts
    follow = tops.select(F.col("rng").alias("of"), F.coalesce(F.lag("rng").over(order), F.max("rng").over(Window.partitionBy())).alias("rng"))
    last_next = follow.join(heads, "rng").select(F.col("of").alias("rng"), F.col("head.text").alias("beyond"))

    down = Window.partitionBy("rng").orderBy(F.col("doc_id").desc_nulls_last(), F.col("h").desc())
    inside = rows.withColumn("inner", F.lead("text").over(down)).withColumn("rn", F.row_number().over(down))
    return inside.join(last_next, "rng").select("doc_id", "text", F.coalesce("inner", "beyond").alias("next"), "rng", "rn")


def versions(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """rng, rn, doc_id, n_chars, edited_sha256 and the elements of the text (a), its edit (e) and the next text (n)."""
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = with_next(docs, range_rows).withColumn("n_chars", F.length("text").cast("long"))
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next", F.lit(1), half))
    rows = rows.withColumn("edited", edited)
    return rows.select("rng", "rn", "doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"),
                       elements(F.col("text")).alias("a"), elements(F.col("edited")).alias("e"), elements(F.col("next")).alias("n"))


KEY = ["rng", "rn", "pair"]


def _peel(cells: DataFrame, key: list[str], where: Callable[[Column, int, Column], Column]) -> DataFrame:
    """cells (key, size, cell, c, k, h) -> key, side, digest: an element only on the plus (1) or minus (-1) side, or a cell left (0).

    ``where``: cell of an element in a subtable. A peeled element stays as a row of its own, of the cell -1 or -2."""
    def merged(df: DataFrame) -> DataFrame:
        out = df.groupBy(*key, "size", "cell", "digest").agg(F.sum("c").cast("int").alias("c"), F.bit_xor("k").alias("k"), F.bit_xor("h").alias("h"))
        return out.where("c <> 0 OR k <> 0 OR h <> 0")

    zero = F.lit(0).cast("long")
    cells = merged(cells.withColumn("digest", zero))
    part = lambda cell, digest, c, k, h: F.struct(cell.cast("int").alias("cell"), digest.alias("digest"), c.cast("int").alias("c"), k.alias("k"), h.alias("h"))
    for r in range(ROUNDS):
        own = r % 3
        lone = (F.col("cell") >= own * F.col("size")) & (F.col("cell") < (own + 1) * F.col("size")) & (F.abs("c") == 1) & (
            F.col("h") == check(F.col("k")))
        out = [part(where(F.col("k"), s, F.col("size")), zero, -F.col("c"), F.col("k"), F.col("h")) for s in range(3) if s != own]
        out.append(part(F.when(F.col("c") > 0, -1).otherwise(-2), F.col("k"), F.lit(1), zero, zero))
        stay = F.array(part(F.col("cell"), F.col("digest"), F.col("c"), F.col("k"), F.col("h")))
        cells = merged(cells.select(*key, "size", F.explode(F.when(lone, F.array(*out)).otherwise(stay)).alias("x")).select(*key, "size", "x.*"))
    side = F.when(F.col("cell") == -1, 1).when(F.col("cell") == -2, -1).otherwise(0)
    return cells.select(*key, side.alias("side"), "digest")


def _attempt(pairs: DataFrame, attempt: int) -> DataFrame:
    """pairs (rng, rn, pair, size, plus, minus: arrays of elements) -> KEY, side, digest as ``_peel`` gives them."""
    signed = F.concat(F.transform("plus", lambda k: F.struct(k.alias("k"), F.lit(1).alias("c"))),
                      F.transform("minus", lambda k: F.struct(k.alias("k"), F.lit(-1).alias("c"))))
    rows = pairs.select(*KEY, "size", F.explode(signed).alias("x")).select(*KEY, "size", "x.k", "x.c")
    places = F.array(*[place(F.col("k"), s, F.col("size"), attempt) for s in range(3)])
    rows = rows.select(*KEY, "size", F.explode(places).alias("cell"), "c", "k", check(F.col("k")).alias("h"))
    return _peel(rows, KEY, lambda k, s, size: place(k, s, size, attempt))


def _rounds(pairs: DataFrame, n_pairs: int, digests: bool) -> DataFrame:
    """All pairs peeled, those that fail with larger sketches: digests that differ, or (KEY, only_plus, only_minus) counted from them."""
    attempt, done = 0, None
    while True:
        cells = F.ceil((F.size("plus") + F.size("minus")) * F.col("expect") * (ROOM * 2 ** attempt / 3)) + LEAST_CELLS * 2 ** attempt
        rows = _attempt(pairs.withColumn("size", cells.cast("int")), attempt)
        if digests:
            got = materialize(rows, "peeled")
            failed = got.where("side = 0").select(*KEY).distinct()
        else:
            counts = rows.groupBy(*KEY).agg(*[F.count_if(F.col("side") == s).alias(n) for s, n in ((1, "only_plus"), (-1, "only_minus"), (0, "left"))])
            # a few numbers a pair, dealt to few files
            got = materialize(counts.repartition(max(8, -(-n_pairs // ROWS_PER_FILE))), "peeled")
            failed = got.where("left > 0").select(*KEY)
        n = failed.count()
        failed = F.broadcast(failed) if n <= BROADCAST_PAIRS else failed
        good = got.join(failed, KEY, "left_anti") if digests else got.where("left = 0").drop("left")
        done = good if done is None else done.unionByName(good)
        if not n:
            return done
        pairs = pairs.join(failed, KEY, "left_semi")
        attempt += 1


def differences(pairs: DataFrame, n_pairs: int) -> DataFrame:
    """pairs (rng, rn, pair, plus, minus, expect: share of elements that may differ) -> KEY, only_plus, only_minus.

    Pairs dealt by (rng, rn) beforehand are not shuffled again. Pairs that do not differ at all have no row.
    """
    return _rounds(pairs, n_pairs, False)


def _pairs(rows: DataFrame, n: int) -> DataFrame:
    """Pairs (text, edit) as 0 and (text, next text) as 1 of ``versions``, dealt by row."""
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // PEEL_ROWS))
    return rows.repartition(parts, "rng", "rn").select("rng", "rn", F.explode(F.array(
        F.struct(F.lit(0).alias("pair"), F.lit(0.5).alias("expect"), F.col("a").alias("plus"), F.col("e").alias("minus")),
        F.struct(F.lit(1).alias("pair"), F.lit(1.0).alias("expect"), F.col("a").alias("plus"), F.col("n").alias("minus")))).alias("p")).select("rng", "rn", "p.*")


def recovered(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, version ('edited' or 'next'), side (1: only in the document, -1: only in the version), digest: every paragraph that differs.

    A paragraph is named by ``elements``: the hash of (its hash, its number among equal ones)."""
    rows = materialize(versions(docs, range_rows), "versions")
    n = rows.count()
    found = _rounds(_pairs(rows, n), 2 * n, True)
    return rows.select("rng", "rn", "doc_id").join(found, ["rng", "rn"]).select(
        "doc_id", F.when(F.col("pair") == 0, "edited").otherwise("next").alias("version"), "side", "digest")


def compare_prints(prints: DataFrame, a: str, b: str, key: list[str], cells: int = PRINT_CELLS) -> DataFrame:
    """key, decoded, only_a, only_b (arrays of digests): two stored fingerprints of each row subtracted and peeled.

    Where more elements differ than the sketch can tell apart, ``decoded`` is false and the arrays hold what was peeled."""
    def read(c: str) -> Column:
        # count, elements and checks of the cells of all three subtables, in order
        tables = F.slice(F.split(F.col(c), "[|]"), 2, 3)
        return F.transform(F.flatten(F.transform(tables, lambda t: F.split(t, " "))), lambda x: F.split(x, ":"))

    number = lambda x: F.conv(x, 16, -10).cast("long")
    both = F.zip_with(read(a), read(b), lambda x, y: F.struct(
        (F.get(x, 0).cast("int") - F.get(y, 0).cast("int")).alias("c"), number(F.get(x, 1)).bitwiseXOR(number(F.get(y, 1))).alias("k"),
        number(F.get(x, 2)).bitwiseXOR(number(F.get(y, 2))).alias("h")))
    rows = prints.select(*key, F.lit(cells).alias("size"), F.posexplode(both).alias("cell", "x")).select(*key, "size", "cell", "x.*")
    found = _peel(rows, key, lambda k, s, size: F.lit(s) * size + print_place(k, s, size))
    of = lambda s: F.array_sort(F.collect_list(F.when(F.col("side") == s, F.col("digest"))))
    found = found.groupBy(*key).agg((F.count_if(F.col("side") == 0) == 0).alias("decoded"), of(1).alias("only_a"), of(-1).alias("only_b"))
    none = F.array().cast("array<bigint>")
    found = found.select(*[F.col(k).alias(f"_{k}") for k in key], "decoded", "only_a", "only_b")
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])
    return prints.select(*key).join(found, same, "left").select(*key, F.coalesce("decoded", F.lit(True)).alias("decoded"),
                                                              F.coalesce("only_a", none).alias("only_a"), F.coalesce("only_b", none).alias("only_b"))


def fingerprint_edits(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row."""
    rows = materialize(versions(docs, range_rows), "versions")
    n = rows.count()
    found = differences(_pairs(rows, n), 2 * n)
    by_row = found.groupBy("rng", "rn").agg(*[
        F.max(F.when(F.col("pair") == p, F.col(c))).alias(f"{c}_{p}") for p in (0, 1) for c in ("only_plus", "only_minus")])

    def likeness(p: int) -> Column:
        plus, minus = (F.coalesce(F.col(f"{c}_{p}"), F.lit(0)) for c in ("only_plus", "only_minus"))
        union = F.size("a") + minus
        return F.when(union == 0, F.lit(1.0)).otherwise((F.size("a") - plus) / union)

    return rows.join(by_row, ["rng", "rn"], "left").select(
        "doc_id", "n_chars", "edited_sha256", print_of(F.col("a")).alias("fingerprint"), print_of(F.col("e")).alias("edited_fingerprint"),
        likeness(0).alias("near_edited"), likeness(1).alias("near_next"))
