"""Tree queries of the store's pages, for every key at once.

A node's path to its root is an array; exploding it gives (node, ancestor,
distance) rows, so "all above" and "all below" are equi joins and counts
instead of one recursive query per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.hierarchy import flatten_tree
from .warehouse import Warehouse


def _above(df: DataFrame, id: str, parent: str, label: str) -> DataFrame:
    """node, ancestor_id, depth (0: the node itself) for every node and everything above it."""
    flat = flatten_tree(df, id, parent, label, levels=0)
    x = flat.select(F.col(id).alias("node"), F.posexplode(F.reverse("path_ids")).alias("depth", "ancestor_id"))
    return x.select("node", "ancestor_id", F.col("depth").cast("int").alias("depth"))


def _named(df: DataFrame) -> DataFrame:
    return df.withColumn("name", F.concat_ws(" ", "first_name", "last_name"))


def h05_breadcrumbs(wh: Warehouse) -> DataFrame:
    """Every category's breadcrumb, root first: category_id, position, id, name, slug."""
    c = wh.raw("categories")
    up = _above(c, "id", "parent_id", "name")
    size = up.groupBy("node").agg(F.max("depth").alias("deepest"))
    x = up.join(size, "node").join(c.select(F.col("id").alias("ancestor_id"), "name", "slug"), "ancestor_id")
    return x.select(F.col("node").alias("category_id"), (F.col("deepest") - F.col("depth")).alias("position"),
                    F.col("ancestor_id").alias("id"), "name", "slug")


def h06_products_per_root(wh: Warehouse) -> DataFrame:
    """Top-level categories with their number of active products, those without any included."""
    c = wh.raw("categories")
    roots = c.where(F.col("parent_id").isNull()).select(F.col("id").alias("ancestor_id"), "name", "slug")
    per = wh.raw("products").where("is_active").groupBy(F.col("category_id").alias("node")).agg(F.count(F.lit(1)).alias("n"))
    up = _above(c, "id", "parent_id", "name").join(per, "node").groupBy("ancestor_id").agg(F.sum("n").alias("n"))
    x = roots.join(up, "ancestor_id", "left")
    return x.select("name", "slug", F.coalesce("n", F.lit(0)).cast("bigint").alias("products")).orderBy("name")


def h07_leaf_paths(wh: Warehouse) -> DataFrame:
    """Categories without children and their whole path."""
    flat = flatten_tree(wh.raw("categories"), "id", "parent_id", "name", levels=0)
    return flat.where("is_leaf").select("id", F.col("path_text").alias("path")).orderBy("path")


def h10_manager_chain(wh: Warehouse) -> DataFrame:
    """Every customer's account manager (depth 0) and the managers above, up to the top."""
    e = _named(wh.raw("employees"))
    up = _above(e, "id", "manager_id", "name")
    c = wh.raw("customers").where(F.col("account_manager_id").isNotNull()).select(F.col("id").alias("customer_id"), F.col("account_manager_id").alias("node"))
    who = e.select(F.col("id").alias("ancestor_id"), "name", "title")
    return c.join(up, "node").join(who, "ancestor_id").select("customer_id", "depth", "name", "title")


def h12_referred_by(wh: Warehouse) -> DataFrame:
    """Who referred every customer, who referred them, and so on."""
    c = _named(wh.raw("customers"))
    up = _above(c, "id", "referred_by_customer_id", "name").where("depth > 0")
    return up.join(c.select(F.col("id").alias("ancestor_id"), "name"), "ancestor_id").select(
        F.col("node").alias("customer_id"), "depth", "name")


def h12_referrals_by_depth(wh: Warehouse) -> DataFrame:
    """How many customers each one has referred, directly (1) and indirectly, by depth."""
    up = _above(_named(wh.raw("customers")), "id", "referred_by_customer_id", "name").where("depth > 0")
    return up.groupBy(F.col("ancestor_id").alias("customer_id"), "depth").agg(F.count(F.lit(1)).cast("bigint").alias("count"))


TREES = {k: v for k, v in globals().items() if k[:1] == "h" and k[1:3].isdigit() and callable(v)}
