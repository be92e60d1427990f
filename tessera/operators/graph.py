"""Knowledge graph: extraction, merging, search and context.

Descriptions, keywords and chunk ids stay in long tables (one row per value). Lists are built only
for the ranked, bounded part that goes into an answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tessera.functions import text as tx
from tessera.operators.search import top_k
from tessera.session import cut

# Fixed marks of the extraction text.
FIELD_MARK, TUPLE_MARK, END_MARK = "<|>", "##", "<|COMPLETE|>"

NAME = r"(\p{Lu}\p{Ll}{2,})"  # capitalised words of any script
CHUNK = ["doc_id", "pos"]


# ---- extraction --------------------------------------------------------------------------------

def parsed_tuples(texts: DataFrame, text: str, keep: tuple[str, ...]) -> DataFrame:
    """``keep, kind, fields`` for every well-formed tuple of the extraction texts."""
    body = F.replace(F.col(text), F.lit(END_MARK), F.lit(""))
    parts = F.transform(F.split(body, f"\\Q{TUPLE_MARK}\\E"), lambda p: F.trim(F.translate(p, "\n", " ")))
    tuples = texts.select(*keep, F.explode(parts).alias("part")).filter(F.col("part").rlike(r"^\(.*\)$"))
    inner = F.expr("substring(part, 2, length(part) - 2)")
    fields = F.transform(F.split(inner, F.lit("<\\|>")), lambda f: F.trim(F.regexp_replace(F.trim(f), '^"|"$', "")))
    return tuples.select(*keep, fields.alias("f")).select(*keep, F.col("f")[0].alias("kind"), F.col("f").alias("fields"))


def parsed_entities(tuples: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    good = tuples.filter((F.col("kind") == "entity") & (F.size("fields") == 4))
    f = F.col("fields")
    return good.select(*keep, f[1].alias("name"), f[2].alias("type"), f[3].alias("description")).filter("name <> ''")


def parsed_relations(tuples: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    good = tuples.filter((F.col("kind") == "relationship") & (F.size("fields") == 6))
    f = F.col("fields")
    rows = good.select(*keep, f[1].alias("src"), f[2].alias("tgt"), f[3].alias("description"), f[4].alias("keywords"),
                       f[5].try_cast("double").alias("weight"))
    return rows.filter("src <> '' AND tgt <> '' AND weight IS NOT NULL")


def names_in(content: Column) -> Column:
    """Distinct capitalised terms in order of their first place."""
    return F.array_distinct(F.regexp_extract_all(content, F.lit(NAME), 1))


def mentions(chunks: DataFrame, keep: tuple[str, ...] = (), content: str = "content") -> DataFrame:
    """One row per chunk and entity."""
    return chunks.select(*CHUNK, *keep, F.explode(names_in(F.col(content))).alias("name"))


def links(chunks: DataFrame, keep: tuple[str, ...] = (), content: str = "content") -> DataFrame:
    """Each entity of a chunk with the next one in reading order: ``src < tgt``.

    The number of links grows with the text, not with the square of the entities of a chunk.
    """
    def pairs(names: Column) -> Column:
        following = F.slice(names, F.lit(2), F.greatest(F.size(names) - 1, F.lit(0)))
        return F.filter(F.zip_with(names, following, lambda a, b: F.struct(
            F.least(a, b).alias("src"), F.greatest(a, b).alias("tgt"), b.isNotNull().alias("whole"))), lambda p: p["whole"])

    rows = chunks.select(*CHUNK, *keep, F.explode(tx.let(names_in(F.col(content)), pairs)).alias("p"))
    return rows.select(*CHUNK, *keep, "p.src", "p.tgt")


# ---- merging -----------------------------------------------------------------------------------

def merged_entities(rows: DataFrame) -> DataFrame:
    """``name, type, n_descriptions, n_chunks`` from ``name, type, description, chunk`` rows.

    The most frequent type wins, ties go to the first in order. Each count is first combined on
    its own values, so a name of a third of all rows is spread by them.
    """
    types = rows.groupBy("name", "type").agg(F.count("*").alias("n"))
    kind = types.groupBy("name").agg(F.min(F.struct((-F.col("n")).alias("n"), "type")).alias("t")).select("name", "t.type")
    descriptions = rows.groupBy("name", "description").count().groupBy("name").agg(F.count("*").alias("n_descriptions"))
    chunks = rows.groupBy("name", "chunk").count().groupBy("name").agg(F.count("*").alias("n_chunks"))
    return kind.join(descriptions, "name").join(chunks, "name")


def entity_descriptions(rows: DataFrame) -> DataFrame:
    """Distinct descriptions of every entity, most frequent first by ``n``."""
    return rows.groupBy("name", "description").agg(F.count("*").alias("n"))


def merged_relations(rows: DataFrame) -> DataFrame:
    """``src, tgt, weight, n_keywords, n_chunks`` from ``src, tgt, weight, keyword, chunk`` rows."""
    part = rows.groupBy("src", "tgt", "keyword", "chunk").agg(F.sum("weight").alias("w"))
    weight = part.groupBy("src", "tgt").agg(F.sum("w").alias("weight"))
    words = part.groupBy("src", "tgt", "keyword").count().groupBy("src", "tgt").agg(F.count("*").alias("n_keywords"))
    chunks = part.groupBy("src", "tgt", "chunk").count().groupBy("src", "tgt").agg(F.count("*").alias("n_chunks"))
    return weight.join(words, ["src", "tgt"]).join(chunks, ["src", "tgt"])


def relation_values(rows: DataFrame, columns: list[str]) -> DataFrame:
    """United keywords or chunk ids of every relation: ``src, tgt, columns, n``, a row per distinct value, with its number of links.

    Links without a value give no row.
    """
    given = rows.dropna(subset=columns, how="all")
    return given.groupBy("src", "tgt", *columns).agg(F.count("*").alias("n"))


def degrees(relations: DataFrame) -> DataFrame:
    ends = relations.select(F.explode(F.array("src", "tgt")).alias("name"))
    return ends.groupBy("name").agg(F.count("*").alias("degree"))


def isolated(entities: DataFrame, relations: DataFrame) -> DataFrame:
    return entities.join(degrees(relations), "name", "left_anti")


# ---- search ------------------------------------------------------------------------------------

def query_entities(queries: DataFrame, entities: DataFrame, text: str = "text", qid: str = "qid") -> DataFrame:
    """Entities named in a query: ``qid, name, at`` (place of the first mention)."""
    named = queries.select(qid, F.posexplode(names_in(F.col(text))).alias("at", "name"))
    return named.join(entities.select("name"), "name", "left_semi")


def low_level(seeds: DataFrame, relations: DataFrame, k: int = 60, qid: str = "qid") -> DataFrame:
    """The ``k`` heaviest relations at the seed entities of every query: ``qid, src, tgt, score, rk``.

    Only the k heaviest relations of an entity can be among them, so an entity is cut to its own
    top k, task by task, before it meets the queries.
    """
    wanted = seeds.select("name").distinct()
    ends = relations.withColumn("name", F.explode(F.array("src", "tgt")))
    near = top_k(ends.join(wanted, "name", "left_semi"), ["name"], k, ["src", "tgt"], score="weight").drop("rk")
    found = seeds.select(qid, "name").join(near, "name").groupBy(qid, "src", "tgt").agg(F.max("weight").alias("score"))
    return top_k(found, [qid], k, ["src", "tgt"])


def ends_of(hits: DataFrame, qid: str = "qid") -> DataFrame:
    """Both ends of ranked relations in first-seen order: ``qid, name, rk``."""
    both = hits.select(qid, "rk", F.posexplode(F.array("src", "tgt")).alias("side", "name"))
    first = both.groupBy(qid, "name").agg(F.min(F.struct("rk", "side")).alias("f"))
    window = W.partitionBy(qid).orderBy("f")
    return first.select(qid, "name", F.row_number().over(window).alias("rk"))


def chunks_of(hits: DataFrame, relation_chunks: DataFrame, k: int, qid: str = "qid") -> DataFrame:
    """The first ``k`` chunks of ranked relations: ``qid, doc_id, pos, rk``; best relation first.

    A relation is cut to its first k chunks, task by task, before it meets the queries.
    """
    window = W.partitionBy("src", "tgt").orderBy(*CHUNK)
    wanted = relation_chunks.join(hits.select("src", "tgt").distinct(), ["src", "tgt"], "left_semi")
    first = wanted.withColumn("_n", F.row_number().over(window)).filter(F.col("_n") <= k).drop("_n")
    found = hits.select(qid, "src", "tgt", "rk").join(first, ["src", "tgt"])
    best = found.groupBy(qid, *CHUNK).agg(F.min("rk").alias("score"))
    return top_k(best, [qid], k, CHUNK, descending=False).select(qid, *CHUNK, "rk")


def within_budget(ranked: DataFrame, tokens: Column, budget: int, qid: str = "qid") -> DataFrame:
    """Rows in rank order while the running number of tokens stays within the budget.

    Meant for top-k rows, of which a query has a bounded number.
    """
    window = W.partitionBy(qid).orderBy("rk").rowsBetween(W.unboundedPreceding, 0)
    return ranked.withColumn("used", F.sum(tokens).over(window)).filter(F.col("used") <= budget)


def json_list(ranked: DataFrame, fields: list[str], out: str, qid: str = "qid") -> DataFrame:
    """Top-k rows of a query as one JSON list in rank order."""
    packed = F.array_sort(F.collect_list(F.struct("rk", F.struct(*fields).alias("item"))))
    return ranked.groupBy(qid).agg(packed.alias("l")).select(qid, F.to_json("l.item").alias(out))


def reached(edges: DataFrame, start: DataFrame, hops: int) -> DataFrame:
    """``node, hop``: nodes within ``hops`` steps of the start nodes (``start(node)``), both ways."""
    both = edges.select("src", "tgt").unionByName(edges.select(F.col("tgt").alias("src"), F.col("src").alias("tgt"))).distinct()
    seen = cut(start.select("node", F.lit(0).alias("hop")).distinct())
    frontier = seen
    for hop in range(1, hops + 1):
        step = both.join(frontier.select(F.col("node").alias("src")), "src", "left_semi").select(F.col("tgt").alias("node")).distinct()
        frontier = cut(step.join(seen, "node", "left_anti").withColumn("hop", F.lit(hop)))
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return seen


# ---- aliases -----------------------------------------------------------------------------------

def alias_edges(names: DataFrame, normal: Column) -> DataFrame:
    """A star per normal form: every name to the smallest one, never all pairs."""
    keyed = names.select("name", normal.alias("_k"))
    smallest = keyed.groupBy("_k").agg(F.min("name").alias("tgt"))
    return keyed.join(smallest, "_k").filter("name <> tgt").select(F.col("name").alias("src"), "tgt")


def renamed(rows: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """Replace names by their key (``keys(name, key)``); names without one stay."""
    for c in columns:
        rows = rows.join(keys.select(F.col("name").alias(c), F.col("key").alias("_key")), c, "left").withColumn(
            c, F.coalesce("_key", c)).drop("_key")
    return rows


def added_links(old: DataFrame, new: DataFrame) -> DataFrame:
    """Merged weights after new chunks: only their links are extracted, then summed per key."""
    fresh = new.groupBy("src", "tgt").agg(F.count("*").alias("weight"))
    return old.unionByName(fresh).groupBy("src", "tgt").agg(F.sum("weight").alias("weight"))


def table_edges(df: DataFrame, src: tuple[str, str], tgt: tuple[str, str]) -> DataFrame:
    """Edges from a foreign key: (label, column) for both ends."""
    end = lambda e: F.concat_ws(":", F.lit(e[0]), F.col(e[1]).cast("string"))
    return df.groupBy(end(src).alias("src"), end(tgt).alias("tgt")).agg(F.count("*").alias("weight"))
