"""Connected components of an edge table by randomised contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node of ``edges`` (two long columns); nodes of a component share one root.

    Every round gives the nodes a fresh random order, lets each hook to the first of itself and its
    neighbours, and contracts the edges; the nodes left shrink by a constant factor in expectation, whatever the
    shape of the graph, and each round is one aggregation and two joins on node ids. Rounds are written as
    reliable checkpoints. Self loops and repeated edges are allowed; an empty table gives an empty one.
    """
    todo = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b").distinct().checkpoint()
    hooks, k = [], 0
    while not todo.isEmpty():
        both = todo.unionAll(todo.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = F.struct(F.xxhash64(F.lit(k), "n").alias("h"), F.col("n"))
        hook = (
            both.groupBy("a").agg(F.min(F.struct(F.xxhash64(F.lit(k), "b").alias("h"), F.col("b").alias("n"))).alias("m"))
            .withColumnRenamed("a", "n").select("n", F.least(F.col("m"), rank)["n"].alias("up")).checkpoint()
        )
        hooks.append(hook)
        left = hook.select(F.col("n").alias("a"), F.col("up").alias("ua"))
        right = hook.select(F.col("n").alias("b"), F.col("up").alias("ub"))
        todo = (
            todo.join(left, "a").join(right, "b").where("ua <> ub")
            .select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct().checkpoint()
        )
        k += 1
    if not hooks:
        return todo.select(F.col("a").alias("node"), F.col("b").alias("root"))
    # the last round's hooks point to roots; earlier nodes follow their hook into the next round
    roots = hooks[-1].select("n", F.col("up").alias("root"))
    for hook in reversed(hooks[:-1]):
        later = roots.select(F.col("n").alias("up"), "root")
        mine = hook.join(later, "up", "left").select("n", F.coalesce("root", "up").alias("root"))
        roots = mine
    return roots.withColumnRenamed("n", "node")
