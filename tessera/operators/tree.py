"""Moves between node groups of one tree (see ``nodes.NodeTree``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.operators.search import top_k


def parents(hits: DataFrame, parent_nodes: DataFrame, key: str = "doc_id") -> DataFrame:
    """Each hit with the node above it. ``hits`` carries ``doc_id`` and ``anc``."""
    up = hits.withColumn("parent_pos", F.element_at("anc", -1))
    above = parent_nodes.select(key, F.col("pos").alias("parent_pos"), F.col("content").alias("parent_content"))
    return up.join(above, [key, "parent_pos"])


def roots(hits: DataFrame, key: str = "doc_id") -> DataFrame:
    return hits.select(key).distinct()


def descendants(hits: DataFrame, lower: DataFrame, depth: int, key: str = "doc_id") -> DataFrame:
    """Nodes of a lower group below the hits; ``depth`` is the level of the hit group (0 = first)."""
    below = lower.withColumn("hit_pos", F.get("anc", F.lit(depth)))
    return below.join(hits.select(key, F.col("pos").alias("hit_pos")).distinct(), [key, "hit_pos"])


def to_target(hits: DataFrame, target_keys: list[str], qid: str = "qid") -> DataFrame:
    """Best score of any hit below a target node; ranks start again at 1."""
    best = hits.groupBy(qid, *target_keys).agg(F.max("score").alias("score"))
    return top_k(best, [qid], 1 << 30, target_keys)
