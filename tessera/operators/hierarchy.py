"""Depth and path of every node of a forest by pointer doubling.

Each node points to its parent and knows the path down from there. In a round
a node takes over its target's pointer and puts the target's path before its
own, so pointers reach twice as far each round: a chain of n nodes takes about
log2(n) rounds, where a level-by-level recursion takes n. Every round is one
join of the nodes that have not reached a root, and is checkpointed to the
shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def forest(nodes: DataFrame, key: str, parent: str, sep: str = "/") -> tuple[DataFrame, int]:
    """``key, parent, Depth, Path`` of all nodes under a root, and the rounds
    taken. A root has no parent, or one that is no node; its path is its key.
    Nodes on or under a cycle reach no root and are left out."""
    known = nodes.select(F.col(key).alias("_to")).distinct()
    start = nodes.select(key, parent).join(known, F.col(parent) == F.col("_to"), "left")
    done = start.select(key, parent, "_to", F.when(F.col("_to").isNull(), 0).otherwise(1).alias("Depth"),
                        F.col(key).cast("string").alias("Path")).checkpoint()
    most, rounds = int(done.count()).bit_length() + 1, 0
    while rounds < most and not done.where(F.col("_to").isNotNull()).isEmpty():
        far = done.select(F.col(key).alias("_at"), F.col("_to").alias("_next"), F.col("Depth").alias("_depth"), F.col("Path").alias("_path"))
        moved = done.where(F.col("_to").isNotNull()).join(far, F.col("_to") == F.col("_at")).select(
            key, parent, F.col("_next").alias("_to"), (F.col("Depth") + F.col("_depth")).alias("Depth"), F.concat_ws(sep, "_path", "Path").alias("Path"))
        done = done.where(F.col("_to").isNull()).unionByName(moved).checkpoint()
        rounds += 1
    return done.where(F.col("_to").isNull()).drop("_to"), rounds
