"""Node groups: chunk trees as tables.

A document is one row. All groups of a document, also chained ones, are built from that row
by array expressions, so making a group needs no shuffle. A node is known by
``(doc_id, grp, pos)``; ``anc`` holds the positions of its ancestors, nearest last.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tessera.functions import text as tx

Rule = Callable[[Column], Column]


@dataclass(frozen=True)
class Group:
    name: str
    rule: Rule
    parent: str | None = None


class NodeTree:
    """Rules of the groups of one knowledge base; tables are made only when asked for."""

    def __init__(self, docs: DataFrame, text: str = "text", key: str = "doc_id", keep: tuple[str, ...] = ()):
        self.docs, self.text, self.key, self.keep = docs, text, key, tuple(keep)
        self.groups: dict[str, Group] = {}

    def group(self, name: str, rule: Rule, parent: str | None = None) -> NodeTree:
        """Add a rule from text to an array of texts. Without ``parent`` it works on the document."""
        if parent is not None and parent not in self.groups:
            raise KeyError(f"unknown parent group {parent}")
        self.groups[name] = Group(name, rule, parent)
        return self

    def lineage(self, name: str) -> list[Group]:
        chain = [self.groups[name]]
        while chain[-1].parent is not None:
            chain.append(self.groups[chain[-1].parent])
        return chain[::-1]

    def nodes(self, name: str) -> DataFrame:
        """``doc_id, grp, pos, anc, content``; empty nodes are dropped."""
        level = None
        for group in self.lineage(name):
            level = self._first(group) if level is None else self._next(level, group)
        exploded = self.docs.select(self.key, *self.keep, F.posexplode(level).alias("pos", "node"))
        return exploded.select(self.key, *self.keep, F.lit(name).alias("grp"), "pos",
                               F.col("node.anc").alias("anc"), F.col("node.content").alias("content"))

    def _first(self, group: Group) -> Column:
        none = F.array().cast("array<int>")
        return F.transform(_kept(group.rule(F.col(self.text))),
                           lambda c: F.struct(none.alias("anc"), c.alias("content")))

    @staticmethod
    def _next(level: Column, group: Group) -> Column:
        def below(node: Column, pos: Column) -> Column:
            anc = F.concat(node["anc"], F.array(pos))
            return F.transform(_kept(group.rule(node["content"])),
                               lambda c: F.struct(anc.alias("anc"), c.alias("content")))

        return F.flatten(F.transform(level, below))


def _kept(items: Column) -> Column:
    return F.filter(items, lambda c: c != "")


def explode_nodes(docs: DataFrame, items: Column, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per array item: keys, ``pos``, ``content``."""
    return docs.select(*keys, F.posexplode(_kept(items)).alias("pos", "content"))


def root_nodes(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.select("doc_id", F.lit("root").alias("grp"), F.lit(0).alias("pos"), F.col(text).alias("content"))


def semantic_chunks(items: Column, threshold: float, separator: str = " ",
                    vectors: Callable[[Column], Column] | None = None,
                    similarity: Callable[[Column, Column], Column] = tx.set_cosine) -> Column:
    """Join neighbours while the similarity of their vectors reaches the threshold.

    ``vectors`` gives one vector per item; without it an item stands for its set of words.
    """
    vectors = vectors or (lambda i: F.transform(i, lambda s: F.array_distinct(tx.words(s))))

    def cut(pair: Column) -> Column:
        vecs = pair["vecs"]
        starts = F.filter(tx.positions(vecs), lambda i: (i == 0) | (
            similarity(F.get(vecs, i - 1), F.get(vecs, i)) < threshold))
        return tx.joined_runs(pair["items"], starts, separator)

    return tx.let(items, lambda i: tx.let(F.struct(i.alias("items"), vectors(i).alias("vecs")), cut))


def section_starts(blocks: Column, limit: int = 4096, gap: int = 2) -> Column:
    """Where a section begins in ``array<struct<title:boolean, content:string>>``.

    At every title, and where the text joined with a blank line would reach ``limit`` characters.
    """
    return tx.let(blocks, lambda b: _section_starts(b, limit, gap))


def _section_starts(blocks: Column, limit: int, gap: int) -> Column:
    zero = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).alias("size"))

    def step(acc: Column, i: Column) -> Column:
        block = F.get(blocks, i)
        size = F.length(block["content"])
        grown = acc["size"] + gap + size
        new = block["title"] | (i == 0) | (grown >= limit)
        return F.struct(F.when(new, F.concat(acc["starts"], F.array(i))).otherwise(acc["starts"]).alias("starts"),
                        F.when(new, size).otherwise(grown).alias("size"))

    return F.aggregate(tx.positions(blocks), zero, step, lambda acc: acc["starts"])


def section_runs(blocks: Column, starts: Column) -> Column:
    """The blocks of every section, as ``array<array<struct>>``."""
    return tx.runs(blocks, starts)


def box_union(boxes: Column) -> Column:
    """Union of ``array<struct<left,top,right,bottom>>``.

    Left and right are the largest; top and bottom follow the upper and the lower box.
    """
    def merge(acc: Column, box: Column) -> Column:
        upper_is_acc = acc["top"] <= box["top"]
        return F.struct(F.greatest(acc["left"], box["left"]).alias("left"),
                        F.least(acc["top"], box["top"]).alias("top"),
                        F.greatest(acc["right"], box["right"]).alias("right"),
                        F.when(upper_is_acc, box["bottom"]).otherwise(acc["bottom"]).alias("bottom"))

    rest = F.slice(boxes, 2, F.greatest(F.size(boxes) - 1, F.lit(0)))
    return F.when(F.size(boxes) > 0, F.aggregate(rest, F.get(boxes, F.lit(0)), merge))


def neighbours(items: Column, separator: str = " ") -> Column:
    """Every item with the text before and after it."""
    return tx.let(items, lambda all_: F.transform(all_, lambda c, i: F.concat_ws(
        separator, F.when(i > 0, F.get(all_, i - 1)), c, F.get(all_, i + 1))))


def with_reference(content: Column, metadata: Column, key: str, label: str = "\nreference: ") -> Column:
    """Append the metadata entry when there is one."""
    path = F.try_element_at(metadata, F.lit(key))
    return F.concat_ws("", content, F.when(path.isNotNull(), F.concat(F.lit(label), path)))


def clean_text(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, tx.GAP, " "))


def first_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per distinct cleaned text: smallest key and number of copies.

    Grouped by content hash with map-side combine, so a text copied a billion times costs one
    row per task in the shuffle.
    """
    clean = clean_text(F.col(text))
    return (docs.select(key, F.sha2(clean, 256).alias("hash")).groupBy("hash")
            .agg(F.min(key).alias(key), F.count("*").alias("copies")))


def parse_once(memberships: DataFrame, docs: DataFrame, rule: Rule, text: str = "text") -> DataFrame:
    """Nodes of documents that belong to several groups; equal texts are parsed once.

    ``memberships(grp, doc_id)``. Returns ``hash, pos, content``; join by ``hash``.
    """
    hashed = (docs.join(memberships.select("doc_id").distinct(), "doc_id", "left_semi")
              .select(F.sha2(F.col(text), 256).alias("hash"), F.col(text).alias("text")))
    return hashed.groupBy("hash").agg(F.first("text").alias("text")).select(
        "hash", F.posexplode(_kept(rule(F.col("text")))).alias("pos", "content"))


def with_derived(nodes: DataFrame, derived: DataFrame, on: list[str]) -> DataFrame:
    """The group itself plus one described node for every node ``derived`` has a text for."""
    described = nodes.drop("content").join(derived, on)
    return nodes.unionByName(described.select(nodes.columns))
