"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of a link between two different nodes; the root is the smallest node reachable.

    Works on any orderable key. In a round every node points to the smallest of itself and its neighbours; pointers
    are doubled until they end in nodes that point to themselves; then links are moved to those ends, and what joins a
    node with itself falls out. A component loses at least half its nodes per round. Minima are combined before they
    are shuffled, and the joins' inputs are plain table scans, which Spark splits where one node has most links. All
    steps are tables in the shared folder.
    """
    left = cut(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct())
    roots = None
    while True:
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("low")).select("v", F.least("v", "low").alias("to"))
        to = _ends(cut(to))
        if roots is None:
            roots = to.select(F.col("v").alias("node"), F.col("to").alias("root"))
        else:
            moved = to.select(F.col("v").alias("root"), "to")
            roots = cut(roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root")))
        ends = lambda n: to.select(F.col("v").alias(n), F.col("to").alias(f"{n}_to"))
        half = cut(left.join(ends("a"), "a").select("a_to", "b"))
        low, high = F.least("a_to", "b_to"), F.greatest("a_to", "b_to")
        left = cut(half.join(ends("b"), "b").where("a_to <> b_to").select(low.alias("a"), high.alias("b")).distinct())
        if left.isEmpty():
            return roots


def _ends(to: DataFrame) -> DataFrame:
    """Follow pointers (v, to) to their ends."""
    while True:
        further = to.select(F.col("v").alias("to"), F.col("to").alias("far"))
        to = cut(to.join(further, "to").select("v", F.col("far").alias("to"), (F.col("far") != F.col("to")).alias("moved")))
        if to.where("moved").isEmpty():
            return to.select("v", "to")
        to = to.select("v", "to")
