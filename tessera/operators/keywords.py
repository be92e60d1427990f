"""Keywords, extractive summaries, question/answer pairs and transforms by the user."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tessera.operators.search import top_k
from tessera.operators.term_groups import idf_of, term_groups, terms_with_idf


def term_idf(nodes: DataFrame, keys: list[str], words: str = "words") -> DataFrame:
    """``term, idf`` with ``ln(N / df)``; distinct words per node are counted map-side.

    The counted terms are dealt out once more: AQE splits a hot term of a join only where both sides come straight from a shuffle of the
    join, not from an aggregate on top of one.
    """
    df = nodes.select(F.explode(F.array_distinct(words)).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    n = nodes.agg(F.count("*").alias("n")).scalar()
    return df.select("term", F.log(n / F.col("df")).alias("idf")).hint("rebalance")


def keywords(nodes: DataFrame, keys: list[str], n: int, words: str = "words") -> DataFrame:
    """The ``n`` terms with the highest tf-idf per node, ties in order of the term."""
    groups = term_groups(nodes, keys, words)
    scored = terms_with_idf(groups, idf_of(groups, nodes)).select(
        *keys, "term", F.round(F.col("tf") * F.col("idf"), 6).alias("score"))
    return top_k(scored, keys, n, ["term"])


def summaries(docs: DataFrame, sentences: DataFrame, n: int, key: str = "doc_id") -> DataFrame:
    """The ``n`` sentences with the highest mean idf of their words, in their old order.

    ``docs(key, words)`` gives the statistics, ``sentences(key, pos, content, words)`` the choice.
    """
    counted = term_groups(sentences, [key, "pos"])
    scored = (terms_with_idf(counted, term_idf(docs, [key])).groupBy(key, "pos")
              .agg(F.round(F.sum(F.col("tf") * F.col("idf")) / F.sum("tf"), 6).alias("score")))
    best = top_k(scored, [key], n, ["pos"]).select(key, "pos").join(sentences.select(key, "pos", "content"), [key, "pos"])
    ordered = F.array_sort(F.collect_list(F.struct("pos", "content"))).alias("s")
    return best.groupBy(key).agg(ordered).select(key, F.array_join("s.content", " ").alias("summary"))


PAIR_BLOCK = 4096  # positions numbered together


def question_answer_pairs(turns: DataFrame, key: str = "conv_id", pos: str = "turn") -> DataFrame:
    """Each user turn with the assistant turn that answers it: the next turn of either role, whatever lies between.

    A question followed by another question has no pair. Positions may have gaps; turns of other roles are passed over. At equal positions
    the assistant comes first, then the smaller text. Neighbours are found inside blocks of positions; across blocks only one row of
    each meets the others, so a long session is many small groups. Rows without key or position are left out.
    """
    both = turns.filter(F.col("role").isin("user", "assistant") & F.col(key).isNotNull() & F.col(pos).isNotNull())
    turn = F.struct(F.col(pos).alias("pos"), "role", "text")
    rows = both.select(key, turn.alias("t"), F.floor(F.col(pos) / PAIR_BLOCK).alias("_block"))
    heads = rows.groupBy(key, "_block").agg(F.min("t").alias("_head"))
    later = heads.select(key, "_block", F.lead("_head").over(W.partitionBy(key).orderBy("_block")).alias("_later"))
    inside = rows.withColumn("_next", F.lead("t").over(W.partitionBy(key, "_block").orderBy("t")))
    answer = inside.join(later, [key, "_block"]).withColumn("_next", F.coalesce("_next", "_later"))
    return (answer.filter((F.col("t.role") == "user") & (F.col("_next.role") == "assistant"))
            .select(key, F.col("t.pos").alias(pos), F.col("t.text").alias("question"), F.col("_next.text").alias("answer")))


@dataclass
class Node:
    """A node as a transform sees it."""

    text: str
    metadata: dict[str, str]


def node_transform(nodes: DataFrame, function: Callable, trans_node: bool = False, content: str = "content", metadata: str = "metadata") -> DataFrame:
    """Nodes made of every node: the other columns, then ``sub`` (from 0), ``content`` and ``metadata``, a row per new node.

    ``function`` takes the text, or a ``Node`` with ``trans_node``, and returns one or many of str and Node, or None for none; a str keeps
    the metadata. It may be a function, a lambda or a callable object. Runs as a table function in Arrow batches, joined to its row;
    as many workers as partitions. Null texts and null metadata come as empty ones.
    """
    class Transform:
        def eval(self, text: str, fields: dict):
            given = Node(text or "", dict(fields or {}))
            made = function(given if trans_node else given.text)
            if made is None:
                return
            for sub, node in enumerate([made] if isinstance(made, (str, Node)) else made):
                # the fields as they came, unless the new node has its own
                yield (sub, node.text, node.metadata) if isinstance(node, Node) else (sub, node, dict(fields or {}))

    table = F.udtf(Transform, returnType="sub int, __text string, __fields map<string,string>")
    given = nodes if metadata in nodes.columns else nodes.withColumn(metadata, F.create_map().cast("map<string,string>"))
    rest = [c for c in given.columns if c not in (content, metadata)]
    joined = given.withColumnsRenamed({content: "__content", metadata: "__metadata"})
    made = joined.lateralJoin(table(F.col("__content").outer(), F.col("__metadata").outer()))
    return made.select(*rest, "sub", F.col("__text").alias(content), F.col("__fields").alias(metadata))


def batch_transform(nodes: DataFrame, function, out: str, data_type: str, column: str = "content") -> DataFrame:
    """Apply a Python function of one text in Arrow batches; as many workers as partitions."""
    @F.pandas_udf(data_type)
    def run(batch: pd.Series) -> pd.Series:
        return batch.map(function)

    return nodes.withColumn(out, run(column))


def column_transform(nodes: DataFrame, function, out: str, column: str = "content") -> DataFrame:
    """Apply a function Column -> Column."""
    value: Column = function(F.col(column))
    return nodes.withColumn(out, value)
