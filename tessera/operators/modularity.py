"""Communities at several levels by modularity: local moves, refinement, contraction.

A level starts from the graph of the level before, contracted. Nodes move to the neighbouring community that gains most; of two
linked nodes that want to move at once only one does, so gains are worked out against neighbours that stay. Communities are then
split into connected parts, and refined: single nodes join parts of their own community that they are well linked with. The
refined parts are the nodes of the next level, which starts from the communities found.

Everything is joins and sums of tables with a row per link, node or (node, neighbouring community); votes are summed per
(node, community) before a hub's rows meet. Tables are cut in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.operators.communities import connected_components
from tessera.session import cut

EPS = 1e-9


class Graph:
    """``links(src, tgt, w)`` in both directions without loops, ``nodes(node, k, loop)``: k is the weight of all ends."""

    def __init__(self, links: DataFrame, loops: DataFrame):
        self.links = cut(links)
        ends = self.links.groupBy(F.col("src").alias("node")).agg(F.sum("w").alias("out"))
        joined = ends.join(loops, "node", "full")
        out, loop = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("out", "loop"))
        self.nodes = cut(joined.select("node", (out + 2 * loop).alias("k"), loop.alias("loop")))
        row = self.nodes.agg(F.sum("k").alias("ends"), F.sum("loop").alias("loops")).first()
        self.ends, self.loops = row["ends"] or 0.0, row["loops"] or 0.0

    @classmethod
    def of(cls, edges: DataFrame) -> Graph:
        """From ``edges(src, tgt, weight)``; an edge may come in both directions and several times, weights add up."""
        w = F.col("weight").cast("double").alias("w")
        known = edges.filter("src is not null and tgt is not null and weight > 0")
        plain = known.filter("src <> tgt").select("src", "tgt", w)
        both = plain.unionByName(plain.select(F.col("tgt").alias("src"), F.col("src").alias("tgt"), "w"))
        loops = known.filter("src = tgt").groupBy(F.col("src").alias("node")).agg(F.sum("weight").cast("double").alias("loop"))
        return cls(both.groupBy("src", "tgt").agg(F.sum("w").alias("w")), loops)

    def contracted(self, parts: DataFrame) -> Graph:
        """The graph whose nodes are the ``part`` of ``parts(node, part)``."""
        at = lambda c: parts.select(F.col("node").alias(c), F.col("part").alias(f"{c}_part"))
        moved = cut(self.links.join(at("src"), "src").join(at("tgt"), "tgt")
                    .groupBy(F.col("src_part").alias("src"), F.col("tgt_part").alias("tgt")).agg(F.sum("w").alias("w")))
        inner = moved.filter("src = tgt").select(F.col("src").alias("node"), (F.col("w") / 2).alias("loop"))
        own = self.nodes.join(parts, "node").select(F.col("part").alias("node"), "loop")
        loops = inner.unionByName(own).groupBy("node").agg(F.sum("loop").alias("loop"))
        return Graph(moved.filter("src <> tgt"), loops)

    def best(self, labels: DataFrame) -> DataFrame:
        """``node, c, gain, stay, kin, k, total``, a row per node: the neighbouring community that gains most (of equal ones the smallest), what
        staying gains, and for the own community the weight of the links into it and its total.

        Votes bring their community's total along and the own community votes with nothing, so links are summed per (node, community)
        once and those sums meet their node once; only a row per node is written.
        """
        state = self.nodes.join(labels, "node")
        totals = state.groupBy("c").agg(F.sum("k").alias("total"))
        known = cut(state.join(totals, "c").select("node", "c", "k", "total"))
        near = self.links.join(known.select(F.col("node").alias("tgt"), "c", "total"), "tgt").select(F.col("src").alias("node"), "c", "total", "w")
        votes = near.unionByName(known.select("node", "c", "total", F.lit(0.0).alias("w")))
        options = votes.groupBy("node", "c").agg(F.sum("w").alias("kin"), F.first("total").alias("total"))
        rows = options.join(known.select("node", F.col("c").alias("own"), "k"), "node")
        at_home = F.col("c") == F.col("own")
        others = F.col("total") - F.when(at_home, F.col("k")).otherwise(0.0)
        rows = rows.withColumn("gain", F.round(F.col("kin") - F.col("k") * others / F.lit(self.ends), 9))
        mine = lambda c: F.max(F.when(at_home, F.col(c))).alias(c)
        first = F.min(F.struct((-F.col("gain")).alias("loss"), "c")).alias("first")
        found = rows.groupBy("node").agg(first, F.max(F.when(at_home, F.col("gain"))).alias("stay"), mine("kin"), F.max("k").alias("k"), mine("total"))
        return cut(found.select("node", "first.c", (-F.col("first.loss")).alias("gain"), "stay", "kin", "k", "total"))

    def quality(self, labels: DataFrame) -> float:
        """Modularity of ``labels(node, c)``."""
        if not self.ends:
            return 0.0
        at = lambda c: labels.select(F.col("node").alias(c), F.col("c").alias(f"{c}_c"))
        inside = self.links.join(at("src"), "src").join(at("tgt"), "tgt").filter("src_c = tgt_c").agg(F.sum("w")).first()[0] or 0.0
        squares = (self.nodes.join(labels, "node").groupBy("c").agg(F.sum("k").alias("t")).agg(F.sum(F.pow(F.col("t") / self.ends, 2))).first()[0]) or 0.0
        return (inside + 2 * self.loops) / self.ends - squares

    def apart(self, wishes: DataFrame, salt: int) -> DataFrame:
        """Of ``wishes(node, c)`` those that no linked node's wish of smaller hash forbids."""
        wishes = cut(wishes.withColumn("p", F.xxhash64("node", F.lit(salt))))
        rival = self.links.join(wishes.select(F.col("node").alias("tgt"), "p"), "tgt").select(F.col("src").alias("node"), F.struct("p", F.col("tgt").alias("node")).alias("r"))
        first = rival.groupBy("node").agg(F.min("r").alias("r"))  # the smallest wish next to a node, combined before the shuffle
        free = wishes.join(first, "node", "left").filter("r is null or not (r.p < p or (r.p = p and r.node < node))")
        return free.select("node", F.col("c").alias("to"))


def _wishes(best: DataFrame) -> DataFrame:
    """The best community of every node that gains by leaving."""
    return best.filter(F.col("gain") > F.col("stay") + EPS).select("node", "c")


def moved(graph: Graph, labels: DataFrame, rounds: int) -> DataFrame:
    """Local moves until nobody gains, modularity stops rising, or ``rounds`` are over."""
    before, quality = None, None
    for r in range(rounds + 1):
        rows = graph.best(labels)
        # every node's own community gives the modularity: the sum of k times total is that of the totals' squares
        own = rows.agg(F.sum("kin"), F.sum(F.col("k") * F.col("total"))).first()
        now = (own[0] or 0.0) / graph.ends - (own[1] or 0.0) / graph.ends ** 2 if graph.ends else 0.0
        if before is not None and now <= quality + 1e-12:  # nodes apart from each other may still crowd one community
            return before
        if r == rounds:
            break
        moves = cut(graph.apart(_wishes(rows), r))
        if moves.isEmpty():
            break
        before, quality = labels, now
        labels = cut(labels.join(moves, "node", "left").select("node", F.coalesce("to", "c").alias("c")))
    return labels


def split(graph: Graph, labels: DataFrame) -> DataFrame:
    """Communities cut into their connected parts, named by the smallest node. Modularity never falls by this."""
    at = lambda c: labels.select(F.col("node").alias(c), F.col("c").alias(f"{c}_c"))
    inside = graph.links.filter("src < tgt").join(at("src"), "src").join(at("tgt"), "tgt").filter("src_c = tgt_c").select("src", "tgt")
    parts = connected_components(cut(inside))
    return cut(labels.join(parts, "node", "left").select("node", F.coalesce("component", "node").alias("c")))


def refined(graph: Graph, labels: DataFrame, rounds: int = 2) -> DataFrame:
    """node, part: connected parts inside the communities.

    Only nodes that are alone and well linked with their community join a part, and no two linked ones at once, so a part stays connected.
    """
    at = lambda c: labels.select(F.col("node").alias(c), F.col("c").alias(f"{c}_c"))
    inner = cut(graph.links.join(at("src"), "src").join(at("tgt"), "tgt").filter("src_c = tgt_c").select("src", "tgt", "w"))
    inside = Graph.__new__(Graph)
    inside.links, inside.nodes, inside.ends, inside.loops = inner, graph.nodes, graph.ends, graph.loops
    linked = inner.groupBy(F.col("src").alias("node")).agg(F.sum("w").alias("inner"))
    totals = graph.nodes.join(labels, "node").groupBy("c").agg(F.sum("k").alias("total"))
    fit = (graph.nodes.join(labels, "node").join(totals, "c").join(linked, "node")
           .filter(F.col("inner") >= F.col("k") * (F.col("total") - F.col("k")) / F.lit(graph.ends)).select("node"))
    fit = cut(fit)
    parts = labels.select("node", F.col("node").alias("c"))
    for r in range(rounds):
        alone = parts.groupBy("c").agg(F.count("*").alias("n"), F.min("node").alias("node")).filter("n = 1").select("node")
        wishes = _wishes(inside.best(parts)).join(alone.join(fit, "node"), "node", "left_semi")
        moves = cut(inside.apart(wishes, 1000 + r))
        if moves.isEmpty():
            break
        parts = cut(parts.join(moves, "node", "left").select("node", F.coalesce("to", "c").alias("c")))
    return parts.withColumnRenamed("c", "part")


def leveled_communities(edges: DataFrame, levels: int = 3, rounds: int = 12) -> DataFrame:
    """``node, level, community`` of ``edges(src, tgt, weight)``, a row per node and level 1 to ``levels``.

    Communities are connected and named by one of their nodes; each level starts from the one before, so its modularity is not lower. Edges with a null
    end or no weight are left out. A level that changes nothing repeats the one before. No edges give no rows.
    """
    graph = Graph.of(edges)
    first = graph
    home = graph.nodes.select("node", F.col("node").alias("at"))  # where a node is in the contracted graph
    labels = graph.nodes.select("node", F.col("node").alias("c"))
    out, quality = None, None
    for level in range(1, levels + 1):
        found = split(graph, moved(graph, labels, rounds))
        mine = cut(home.join(found.withColumnRenamed("node", "at"), "at").select("node", F.col("c").alias("community")))
        now = first.quality(mine.withColumnRenamed("community", "c"))
        rows = mine.select("node", F.lit(level).alias("level"), "community")
        out = rows if out is None else out.unionByName(rows)
        if level == levels or not graph.ends or (quality is not None and now <= quality + 1e-12):
            for rest in range(level + 1, levels + 1):
                out = out.unionByName(mine.select("node", F.lit(rest).alias("level"), "community"))
            break
        quality = now
        parts = cut(refined(graph, found))
        labels = cut(parts.join(found, "node").groupBy(F.col("part").alias("node")).agg(F.min("c").alias("c")))
        home = cut(home.join(parts.withColumnRenamed("node", "at"), "at").select("node", F.col("part").alias("at")))
        graph = graph.contracted(parts)
    return out
