"""Connected components of an edge table by repeated contraction, as joins and grouped minima."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise

#: Rounds after which something must be wrong: a component of n nodes takes about log n.
MOST_ROUNDS = 60


def grow_components(members: DataFrame, edges: DataFrame) -> DataFrame:
    """members (node, root) of connected_components, with further edges (a, b): only links between different roots are
    contracted, and nodes that members lacks are added. Nulls and self links are ignored."""
    known = members.select(F.col("node").alias("a"), F.col("root").alias("p")), members.select(F.col("node").alias("b"), F.col("root").alias("q"))
    named = edges.filter("a <> b").join(known[0], "a", "left").join(known[1], "b", "left")
    named = materialise(named.select("a", "b", F.coalesce("p", "a").alias("p"), F.coalesce("q", "b").alias("q")), "named")
    added = named.select(F.col("a").alias("node"), F.col("p").alias("root")).union(named.select("b", "q")).distinct().join(members, "node", "left_anti")
    moved = connected_components(named.select(F.col("p").alias("a"), F.col("q").alias("b"))).toDF("root", "_root")
    return materialise(members.union(added).join(moved, "root", "left").select("node", F.coalesce("_root", "root").alias("root")), "members")


def connected_components(edges: DataFrame) -> DataFrame:
    """edges (a long, b long) to (node, root): root is a node of the component, the same for all of it.

    Each round every node points to its least neighbour or itself, pointers are followed once more, and edges are
    replaced by those between the targets; a component of n nodes is done in about log n rounds. Minima combine before
    the shuffle, so a hub costs one row a task; nothing is collected. Nodes without edges do not appear. Nulls are
    ignored; self links and repeated rows do no harm.
    """
    pairs = edges.select("a", "b").filter("a is not null and b is not null and a <> b")
    both = pairs.union(pairs.select("b", "a")).toDF("a", "b").distinct()
    both = materialise(both, "edges")
    members = None
    for turn in itertools.count():
        if both.isEmpty():
            break
        if turn == MOST_ROUNDS:
            raise RuntimeError(f"edges are left after {turn} rounds")
        point = both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("p"))
        point = materialise(point, "point")
        twice = point.alias("x").join(point.alias("y"), F.col("x.p") == F.col("y.a")).select(F.col("x.a").alias("a"), F.col("y.p").alias("p"))
        jump = materialise(twice, "jump")
        old = members
        if members is None:
            members = jump.select(F.col("a").alias("node"), F.col("p").alias("root"))
        else:
            members = members.join(jump.withColumnRenamed("a", "root"), "root", "left").select("node", F.coalesce("p", "root").alias("root"))
        members = materialise(members, "members")
        half = both.join(jump, "a").select(F.col("p").alias("a"), "b")
        moved = half.join(jump.select(F.col("a").alias("b"), F.col("p").alias("q")), "b").select("a", F.col("q").alias("b"))
        edges, both = both, materialise(moved.filter("a <> b").distinct(), "edges")
        # What this round has read is in the tables of the next one.
        discard(edges, point, jump, *([] if old is None else [old]))
    if members is None:
        return both.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return members
