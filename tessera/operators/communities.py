"""Connected components and communities by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.session import cut


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` (smallest node) for the nodes of ``edges(src, tgt)``.

    Large-star and small-star steps take turns until the edges stay the same; the number of rounds
    grows with the logarithm of the size, not with the length of chains. Every round is cut in
    the shared folder. Minima are combined map-side, and the join that hands them back has one row
    per node on its right side, so AQE can split a hub.
    """
    pairs = cut(edges.filter("src <> tgt").select(F.greatest("src", "tgt").alias("u"), F.least("src", "tgt").alias("v")).distinct())
    nodes = edges.select(F.explode(F.array("src", "tgt")).alias("node")).distinct()
    before = _signature(pairs)
    for _ in range(max_rounds):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        kept = lowest.select("u", F.col("m").alias("v"))
        pairs = cut(linked.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .unionByName(kept).distinct())
        after = _signature(pairs)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return nodes.join(pairs.withColumnRenamed("u", "node"), "node", "left").select(
        "node", F.coalesce("v", "node").alias("component"))


def label_rounds(edges: DataFrame, rounds: int) -> DataFrame:
    """``node, label`` after some rounds of weighted label propagation over ``edges(src, tgt, weight)``.

    A node takes the label with the largest weight among its neighbours and itself (own weight 1);
    ties go to the smallest label. Weights are summed per (node, label) map-side before a
    node's labels meet.
    """
    both = edges.select("src", "tgt", "weight").unionByName(
        edges.select(F.col("tgt").alias("src"), F.col("src").alias("tgt"), "weight"))
    both = cut(both.groupBy("src", "tgt").agg(F.sum("weight").alias("weight")))
    labels = both.select(F.col("src").alias("node"), F.col("src").alias("label")).distinct()
    for _ in range(rounds):
        votes = both.join(labels.withColumnRenamed("node", "tgt"), "tgt").select(F.col("src").alias("node"), "label", "weight")
        own = labels.withColumn("weight", F.lit(1).cast(both.schema["weight"].dataType))
        summed = votes.unionByName(own).groupBy("node", "label").agg(F.sum("weight").alias("w"))
        labels = cut(summed.groupBy("node").agg(F.min(F.struct((-F.col("w")).alias("w"), "label")).alias("b")).select("node", "b.label"))
    return labels


def communities(edges: DataFrame, rounds: int) -> DataFrame:
    """``node, level, community``: level 0 components, level 1 labels inside them."""
    level0 = connected_components(edges).select("node", F.lit(0).alias("level"), F.col("component").alias("community"))
    level1 = label_rounds(edges, rounds).select("node", F.lit(1).alias("level"), F.col("label").alias("community"))
    return cut(level0.unionByName(level1))


def community_relations(members: DataFrame, relations: DataFrame) -> DataFrame:
    """``level, community, src, tgt``: the relations with both ends in one community, a row each."""
    at = lambda c: members.select(F.col("node").alias(c), "level", F.col("community").alias(f"{c}_c"))
    inside = relations.select("src", "tgt").join(at("src"), "src").join(at("tgt"), ["tgt", "level"]).filter("src_c = tgt_c")
    return inside.select("level", F.col("src_c").alias("community"), "src", "tgt")


def community_chunks(members: DataFrame, mentions: DataFrame) -> DataFrame:
    """``level, community, doc_id, pos, n``: the chunks that name a member, with the number of members named."""
    named = mentions.select("name", "doc_id", "pos").distinct().join(members.withColumnRenamed("node", "name"), "name")
    return named.groupBy("level", "community", "doc_id", "pos").agg(F.count("*").alias("n"))


def community_table(members: DataFrame, relations: DataFrame, mentions: DataFrame, degree: DataFrame, top: int) -> DataFrame:
    """Sizes and a summary (top entities by degree) per level and community.

    ``members(node, level, community)``, ``relations(src, tgt)``, ``mentions(name, doc_id, pos)``.
    """
    from tessera.operators.search import top_k

    key = ["level", "community"]
    size = members.groupBy(*key).agg(F.count("*").alias("n_entities"))
    n_relations = community_relations(members, relations).groupBy(*key).agg(F.count("*").alias("n_relations"))
    chunks = community_chunks(members, mentions).groupBy(*key).agg(F.count("*").alias("n_chunks"))
    ranked = top_k(members.withColumnRenamed("node", "name").join(degree, "name"), key, top, ["name"], score="degree")
    names = F.array_sort(F.collect_list(F.struct("rk", "name"))).alias("s")
    summary = ranked.groupBy(*key).agg(names).select(*key, F.array_join("s.name", " ").alias("summary"))
    return (size.join(n_relations, key, "left").join(chunks, key, "left").join(summary, key, "left")
            .select(*key, "n_entities", F.coalesce("n_relations", F.lit(0)).alias("n_relations"),
                    F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"), "summary"))
