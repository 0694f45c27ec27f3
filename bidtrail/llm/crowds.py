"""Links inside crowded keys without all pairs of their members.

A key that very many nodes share (a family of near copies) is linked through pivots: in each round every key that still
holds several classes names one member, all members of other classes are compared with it, and classes are contracted.
The first pivot is the member that shares most keys with others, in a family the text that all others come from; later ones are the
first such members outside the key's largest class.  A round costs a comparison per member.  What a few rounds leave
apart is returned, with the largest class of each key, for an exact step of the caller's own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .components import components

ROUNDS = 3


def rooted(members: DataFrame, edges: DataFrame) -> DataFrame:
    """members with the root of each node's class."""
    return members.join(components(edges), "node", "left").withColumn("root", F.coalesce("root", "node"))


def link_crowds(members: DataFrame, edges: DataFrame, check: Callable[[DataFrame], DataFrame], rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Edges (a, b) after the rounds, and members (key, node, root, largest) of the keys that still hold several classes.

    members: key, node, n (nodes of the key), and whatever else the caller wants back; check returns those of the pairs
    (a, b), a < b, that are links.
    """
    weights = members.groupBy("node").agg(F.sum("n").alias("weight"))
    members = stored(members.join(weights, "node"))
    for turn in range(rounds + 1):
        placed = stored(rooted(members, edges))
        parts = placed.groupBy("key", "root").agg(F.count("*").alias("size"), F.max(F.struct("weight", "node")).alias("first"))
        # What is joined to members is stored first: only then can Spark split a hot key of that join.
        several = parts.groupBy("key").agg(F.max(F.struct("size", "root")).alias("most"), F.count("*").alias("classes"), F.max(F.struct("first", "root")).alias("p")).where("classes > 1")
        several = stored(several.select("key", F.col("most.root").alias("largest"), F.col("p.first.node").alias("pivot"), F.col("p.root").alias("pivot_root")))
        if turn == rounds or several.isEmpty():
            break
        # All classes may name the pivot in the first round, those outside the largest one later.
        pivots = several.drop("largest")
        if turn:
            named = parts.join(several.select("key", "largest"), "key").where("root <> largest")
            pivots = named.groupBy("key").agg(F.max(F.struct("first", "root")).alias("p"))
            pivots = stored(pivots.select("key", F.col("p.first.node").alias("pivot"), F.col("p.root").alias("pivot_root")))
        # Pivots are a row per key, but may be as many as the keys.
        pairs = placed.join(pivots.hint("merge"), "key").where("root <> pivot_root").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
        edges = stored(edges.unionByName(check(pairs)))
    return edges, placed.join(several.select("key", "largest").hint("merge"), "key")
