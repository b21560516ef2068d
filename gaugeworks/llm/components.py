"""Connected components of a graph given as a table of edges, by hooking and pointer jumping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.shared import saved


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (u, v): root is the smallest node that it is linked with.

    Each round hangs every node with a smaller neighbour on its smallest one and flattens the trees. What is left
    are the edges between different trees, from root to root. A node that hangs on nothing has neighbours that hang
    on smaller nodes, so it hangs on one of them in the round after: two rounds halve the nodes that have an edge.
    Minima are taken per node with partial sums, so a node of many edges needs no task of its own.
    """
    left = saved(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "edges")
    found = None
    while True:
        hung = saved(left.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("most")), "hung")
        trees = _flattened(hung.select("u", "m"))
        found = trees if found is None else saved(_renamed(found, "root", trees).union(trees), "trees")
        if hung.where("m < most").isEmpty():  # each node's edges are one, so the trees hold them all
            break
        named = _renamed(left.join(trees.toDF("u", "root"), "u").select(F.col("root").alias("u"), "v"), "v", trees)
        left = saved(named.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    return found.union(found.select(F.col("root").alias("node"), "root").distinct())


def _renamed(rows: DataFrame, column: str, trees: DataFrame) -> DataFrame:
    """`rows` with the root in place of a node in `column`; what is no node of `trees` (node, root) stays."""
    roots = trees.toDF("__node", "__root")
    joined = rows.join(roots, F.col(column) == F.col("__node"), "left")
    return joined.select(*[F.coalesce("__root", c).alias(c) if c == column else c for c in rows.columns])


def _flattened(hung: DataFrame) -> DataFrame:
    """(node, root) for each node u of trees (u, m), m < u: every pointer is replaced by its target's until it meets a root."""
    moving, at_root, known = hung, [], hung
    while True:
        target = known.toDF("__u", "__m")
        step = moving.join(target, F.col("m") == F.col("__u"), "left")
        step = saved(step.select("u", F.coalesce("__m", "m").alias("m"), F.col("__u").isNotNull().alias("moved")), "trees")
        at_root.append(step.where("NOT moved").select("u", "m"))
        moving = step.where("moved").select("u", "m")
        if moving.isEmpty():
            return reduce(DataFrame.union, at_root).toDF("node", "root")
        known = reduce(DataFrame.union, [*at_root, moving])
