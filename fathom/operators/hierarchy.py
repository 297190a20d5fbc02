"""Parent-pointer hierarchies: flattened trees, closures and ancestor joins.

``WITH RECURSIVE`` in Spark stops at 100 levels / 1M rows, so the walks here
are DataFrame loops of equi joins: upward parent walks chained in one plan
with a single check per round (``flatten_tree``), or pointer doubling
(``closure``, log2(depth) rounds). Rounds are checkpointed to the shared
checkpoint folder so lineage stays short and a lost executor only recomputes
one round. Nodes that never reach a root
(cycles, dangling parents) are dropped, as a root-down recursion drops them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, written


def flatten_tree(df: DataFrame, id: str, parent: str, label: str, levels: int = 4,
                 extra: list[str] | None = None, guess: int = 4) -> DataFrame:
    """One row per node reachable from a root: id, parent, label, depth (roots = 1), path
    (labels root..node), path_ids, path_text (' > '), level1..levelN, is_leaf; plus ``extra``.

    Every node walks up its parent pointers: ``guess`` equi joins with the node table
    are chained in one plan, then one small action checks whether any node is still
    below an unresolved ancestor; if so, nodes that never reach a root are told apart by
    pointer doubling (``closure``) and the others walk on (doubling the step count, written
    to the shared folder between rounds) until all have arrived, however deep the tree is.
    A shallow tree costs one plan and one check instead of one job per level. Nodes under
    a missing parent or on a cycle are dropped, as a root-down recursion drops them.
    """
    extra = list(extra or [])
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    nodes = df.select(F.col(id).alias("_id"), F.col(parent).alias("_parent"), F.col(label).alias("_label"),
                      *[F.col(c) for c in extra])
    look = nodes.select(F.col("_id").alias("_aid"), F.col("_parent").alias("_apar"), F.col("_label").alias("_alab"))
    cur = nodes.select("_id", F.array(F.struct(F.col("_id").alias("i"), F.col("_label").alias("l"))).alias("_up"),
                       F.col("_parent").alias("_next"), F.lit(False).alias("_broken"))
    done_steps, steps = 0, guess
    while True:
        for _ in range(steps):
            j = cur.join(look, cur["_next"] == look["_aid"], "left")
            step_ok = F.col("_aid").isNotNull()
            cur = j.select(
                "_id",
                F.when(step_ok, F.concat("_up", F.array(F.struct(F.col("_aid").alias("i"), F.col("_alab").alias("l")))))
                .otherwise(F.col("_up")).alias("_up"),
                F.when(step_ok, F.col("_apar")).otherwise(F.lit(None)).alias("_next"),
                (F.col("_broken") | (F.col("_next").isNotNull() & ~step_ok)).alias("_broken"))
        if cur.where(F.col("_next").isNotNull()).isEmpty():
            break
        if not done_steps:
            rooted = closure(nodes, "_id", "_parent").select(F.col("id").alias("_id"))
            cur = cur.join(rooted, "_id", "left_semi")
        done_steps += steps
        cur = written(cur, "tree")
        steps = min(done_steps, 16)
    walked = cur.where(~F.col("_broken") & F.col("_next").isNull()).select(
        "_id", F.reverse("_up").alias("_path"))
    out = nodes.join(walked, "_id")
    parents = nodes.where(F.col("_parent").isNotNull()).select(F.col("_parent").alias("_pp")).distinct()
    flagged = out.join(parents, out["_id"] == parents["_pp"], "left")
    path = F.col("_path.l")
    return flagged.select(
        F.col("_id").alias(id), F.col("_parent").alias(parent), F.col("_label").alias(label), *extra,
        F.size("_path").alias("depth"), path.alias("path"), F.col("_path.i").alias("path_ids"),
        F.array_join(path, " > ").alias("path_text"),
        *[F.get(path, i).alias(f"level{i + 1}") for i in range(levels)],
        F.col("_pp").isNull().alias("is_leaf"))


def closure(df: DataFrame, id: str, parent: str) -> DataFrame:
    """Depth and root of every node by pointer doubling: id, depth (root = 0), root_id."""
    ensure_checkpoint_dir(df.sparkSession)
    state = df.select(
        F.col(id).alias("id"),
        F.coalesce(F.col(parent), F.col(id)).alias("anc"),
        F.when(F.col(parent).isNull(), 0).otherwise(1).cast("bigint").alias("dist"),
        F.col(parent).isNull().alias("done"),
    ).checkpoint(eager=True)
    # a chain of n nodes resolves in ceil(log2 n) doublings; anything still open after
    # that is on or under a cycle and is dropped (bounded loop, no overflow of dist)
    n = state.count()
    rounds = max(1, math.ceil(math.log2(n + 1))) + 1
    for _ in range(rounds):
        todo = state.where(~F.col("done"))
        if todo.isEmpty():
            break
        look = state.select(F.col("id").alias("_tid"), F.col("anc").alias("_tanc"),
                            F.col("dist").alias("_tdist"), F.col("done").alias("_tdone"))
        stepped = todo.join(look, todo["anc"] == look["_tid"], "inner").select(
            "id", F.col("_tanc").alias("anc"), (F.col("dist") + F.col("_tdist")).alias("dist"),
            F.col("_tdone").alias("done"))
        # rows whose ancestor is missing fall out of the inner join (dangling parent)
        state = state.where(F.col("done")).unionByName(stepped).checkpoint(eager=True)
    return state.where(F.col("done")).select("id", F.col("dist").alias("depth"), F.col("anc").alias("root_id"))


def ancestor_pairs(flat: DataFrame, id: str, path_ids: str = "path_ids") -> DataFrame:
    """(ancestor_id, id) for every node and each node on its root path, itself included.

    Exploding the path turns ``list_contains(path, ancestor)`` into an equi join.
    """
    return flat.select(F.explode(path_ids).alias("ancestor_id"), F.col(id))
