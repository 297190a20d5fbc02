"""Counting pairs of items that meet in a basket (Q-07, V-08, E8c).

The items of an ordinary basket are paired where they meet, so they are shuffled once and
no pair is. Where pairs are counted by item, each item of a basket is shuffled once more with the
list of the others, and its pairs are made and counted where they arrive. A basket of more than ``bulk`` items has
its items dealt into blocks, and every pair of blocks is a join key of its own, so the
square of one bulk basket is spread over many tasks and no key holds more than the
square of a block. Every pair is counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .topk import top_k

#: Items of a basket that are joined under one key; also the expected size of a block.
BULK = 256


def _dealt(per: DataFrame, basket: str, item: str, bulk: int) -> DataFrame:
    """Rows with ``_blocks`` (1 for ordinary baskets) and ``_block`` of the item."""
    sizes = per.groupBy(basket).agg(F.count(F.lit(1)).alias("_items")).where(F.col("_items") > bulk)
    return _in_blocks(per.join(sizes, basket, "left"), item, bulk)


def _in_blocks(rows: DataFrame, item: str, bulk: int) -> DataFrame:
    blocks = F.coalesce(F.ceil(F.col("_items") / bulk), F.lit(1)).cast("int")
    return rows.withColumn("_blocks", blocks).withColumn("_block", F.pmod(F.xxhash64(item), F.col("_blocks")).cast("int")).drop("_items")


def pairs(per: DataFrame, basket: str, item: str, weight: str, ordered: bool = False, bulk: int = BULK) -> DataFrame:
    """(basket, item, other, weight, other_weight) of every two different items of a basket; (basket, item) is unique.

    ``ordered``: only pairs with item < other."""
    kept = (F.col("_a.i") < F.col("_b.i")) if ordered else (F.col("_a.i") != F.col("_b.i"))
    sized = per.select(basket, item, weight).where(F.col(basket).isNotNull() & F.col(item).isNotNull())
    sized = sized.withColumn("_items", F.count(F.lit(1)).over(Window.partitionBy(basket)))
    ordinary = sized.where(F.col("_items") <= bulk).groupBy(basket).agg(
        F.collect_list(F.struct(F.col(item).alias("i"), F.col(weight).alias("w"))).alias("_all"))  # at most ``bulk`` items
    ordinary = ordinary.select(basket, "_all", F.explode("_all").alias("_a")).select(basket, "_a", F.explode("_all").alias("_b")).where(kept)
    ordinary = ordinary.select(basket, F.col("_a.i").alias(item), F.col("_b.i").alias("other"), F.col("_a.w").alias(weight), F.col("_b.w").alias("other_weight"))
    return ordinary.unionByName(_bulk_pairs(sized.where(F.col("_items") > bulk), basket, item, weight, ordered, bulk))


#: Shares of all rows: an item with more of them is dealt over several tasks.
SHARES = 240


def frequent(rows: DataFrame, item: str, shares: int = SHARES) -> dict[int, int]:
    """Items that hold more than one in ``shares`` of the rows, about, with their number of such shares."""
    top = rows.where(F.col(item).isNotNull()).agg(F.count(item).alias("n"), F.expr(f"approx_top_k({item}, {shares}, {40 * shares})").alias("top")).first()
    return {r["item"]: -(-r["count"] * shares // top.n) for r in top.top or [] if r["count"] * shares > top.n}


def top_partners(lines: DataFrame, basket: str, item: str, k: int, hot: dict[int, int] | None = None, bulky: bool = True, bulk: int = BULK) -> DataFrame:
    """(item, other, together): the ``k`` others that an item meets most (then least first); each two lines of a basket with different
    items are a meeting.

    ``hot``: items that would fill a task of their own, with the number of tasks that their others are dealt over.
    ``bulky``: whether a basket may have more than ``bulk`` lines."""
    here = Window.partitionBy(basket)
    rows = lines.select(basket, item).where(F.col(basket).isNotNull() & F.col(item).isNotNull())
    sized = rows.withColumn("_lines", F.count(F.lit(1)).over(here)) if bulky else rows
    small = sized.where(F.col("_lines") <= bulk) if bulky else rows
    small = small.withColumn("_all", F.collect_list(item).over(here))  # at most ``bulk`` lines
    rows = small.select(item, F.array_remove("_all", F.col(item)).alias("_others"), F.lit(1).cast("long").alias("_n"))
    if bulky:
        per = sized.where(F.col("_lines") > bulk).groupBy(basket, item).agg(F.count(F.lit(1)).alias("_w"))
        met = pairs(per, basket, item, "_w", bulk=bulk)
        rows = rows.unionByName(met.select(item, F.array("other").alias("_others"), (F.col("_w") * F.col("other_weight")).alias("_n")))
    key = [item]
    if hot:
        key = [item, "_part"]
        kind = rows.schema[item].dataType
        dealt = F.create_map(*[c for key_of, n in hot.items() for c in (F.lit(key_of).cast(kind), F.lit(n))])
        parts = F.coalesce(F.element_at(dealt, F.col(item)), F.lit(1))
        rows = rows.withColumn("_parts", parts).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts").cast("int") - 1)))
        mine = F.filter("_others", lambda other: F.pmod(F.xxhash64(other), F.col("_parts")) == F.col("_part"))
        rows = rows.withColumn("_others", F.when(F.col("_parts") > 1, mine).otherwise(F.col("_others"))).drop("_parts")
    met = rows.where(F.size("_others") > 0).repartition(*key).select(*key, F.explode("_others").alias("other"), "_n")
    counted = met.groupBy(*key, "other").agg(F.sum("_n").alias("together"))  # all of a key lies together
    order = [F.col("together").desc(), F.col("other")]
    best = top_k(counted, key, order, k)
    return top_k(best.drop("_part"), [item], order, k) if hot else best


def _bulk_pairs(per: DataFrame, basket: str, item: str, weight: str, ordered: bool, bulk: int) -> DataFrame:
    """Pairs of baskets of more than ``bulk`` items, by blocks; ``per`` has ``_items``, the size of the row's basket."""
    rows = _in_blocks(per, item, bulk)
    every = F.sequence(F.lit(0), F.col("_blocks") - 1)
    left = rows.select(basket, item, weight, F.col("_block").alias("_i"), F.explode(every).alias("_j"))
    right = rows.select(basket, F.col(item).alias("_other"), F.col(weight).alias("_other_weight"), F.explode(every).alias("_i"), F.col("_block").alias("_j"))
    met = left.join(right, [basket, "_i", "_j"])
    met = met.where(F.col(item) < F.col("_other") if ordered else F.col(item) != F.col("_other"))
    return met.select(basket, item, F.col("_other").alias("other"), weight, F.col("_other_weight").alias("other_weight"))
