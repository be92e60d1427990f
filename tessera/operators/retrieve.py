"""Filters, routes, merging, second stage, output forms, caching and index upkeep."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tessera.functions.text import word_counts
from tessera.operators.search import top_k
from tessera.session import exists, work_path


def merge_keys(per_key: list[DataFrame], k: int, keys: list[str], qid: str = "qid") -> DataFrame:
    """Hits of several embedding keys: best score per node, one top-k for all keys."""
    union = per_key[0].select(qid, *keys, "score")
    for hits in per_key[1:]:
        union = union.unionByName(hits.select(qid, *keys, "score"))
    best = union.groupBy(qid, *keys).agg(F.max("score").alias("score"))
    return top_k(best, [qid], k, keys)


def with_metadata(nodes: DataFrame, filters: dict[str, list]) -> DataFrame:
    """Keep nodes whose fields hold one of the listed values; fields are ANDed."""
    for field, values in filters.items():
        nodes = nodes.filter(F.col(field).isin(values))
    return nodes


def visible_nodes(nodes: DataFrame, grants: DataFrame, user: int, department: str = "department",
                  level: str = "level") -> DataFrame:
    """Nodes of the departments granted to a user, up to the granted level."""
    mine = grants.filter(F.col("user_id") == user).select(F.col("department").alias("_d"), "max_level")
    return nodes.join(mine, (F.col(department) == F.col("_d")) & (F.col(level) <= F.col("max_level")), "left_semi")


def routes_in_order(routes: dict[str, DataFrame]) -> DataFrame:
    """Result lists one after the other: ``route_no`` and ``route`` keep the order."""
    out = None
    for no, (name, hits) in enumerate(routes.items()):
        tagged = hits.withColumn("route_no", F.lit(no)).withColumn("route", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def merged_routes(routes: DataFrame, keys: list[str], qid: str = "qid") -> DataFrame:
    """One row per query and node: best score and the routes that found it."""
    return routes.groupBy(qid, *keys).agg(
        F.max("score").alias("score"), F.array_join(F.array_sort(F.collect_set("route")), ",").alias("routes"))


def second_stage(hits: DataFrame, nodes: DataFrame, queries: DataFrame, score: Callable[[Column, Column], Column],
                 k: int, keys: list[str], node_col: str = "content", query_col: str = "text",
                 qid: str = "qid") -> DataFrame:
    """Score the candidates again with a costlier function and keep the best k."""
    pairs = (hits.select(qid, *keys).join(nodes.select(*keys, F.col(node_col).alias("_n")), keys)
             .join(queries.select(qid, F.col(query_col).alias("_q")), qid))
    scored = pairs.select(qid, *keys, F.round(score(F.col("_q"), F.col("_n")), 6).alias("score"))
    return top_k(scored, [qid], k, keys)


def joined_output(hits: DataFrame, content: str = "content", separator: str = "", qid: str = "qid") -> DataFrame:
    """Contents of a query's top-k in rank order as one text."""
    ordered = F.array_sort(F.collect_list(F.struct("rk", F.col(content).alias("c"))))
    return hits.groupBy(qid).agg(ordered.alias("o")).select(qid, F.array_join(F.col("o.c"), separator).alias("output"))


def dict_output(hits: DataFrame, fields: list[str]) -> DataFrame:
    """Every hit as a JSON record."""
    return hits.withColumn("output", F.to_json(F.struct(*fields)))


def context_record(hits: DataFrame, queries: DataFrame, content: str = "content", separator: str = "\n",
                   qid: str = "qid", text: str = "text") -> DataFrame:
    """``qid, context_str, query``; a query without hits has an empty context."""
    context = joined_output(hits, content, separator, qid).withColumnRenamed("output", "context_str")
    return queries.select(qid, F.col(text).alias("query")).join(context, qid, "left").select(qid, F.coalesce("context_str", F.lit("")).alias("context_str"), "query")


def numbered_context(hits: DataFrame, queries: DataFrame, floor: float = 0.015, qid: str = "qid",
                     heads: tuple[str, str, str] = ("[question]", "[references]", "[images]")) -> DataFrame:
    """Question, numbered text references and the image paths above ``floor``.

    ``hits(qid, rk, kind, content, score)``: top-k rows; ``content`` of an image is its path. Images are numbered before those
    without a path are left out.
    """
    packed = hits.groupBy(qid).agg(F.array_sort(F.collect_list(
        F.struct("rk", "kind", "content", "score"))).alias("h"))
    both = queries.join(packed, qid)
    refs = F.filter("h", lambda h: h["kind"] == "text")
    images = F.filter("h", lambda h: (h["kind"] == "image") & (h["score"] > floor))
    images = F.filter(F.transform(images, lambda h, i: F.struct((i + 1).alias("no"), F.trim(h["content"]).alias("path"))), lambda h: h["path"] != "")
    ref_text = F.array_join(F.transform(refs, lambda h, i: F.concat(
        F.lit("\nRef"), (i + 1).cast("string"), F.lit(": "), h["content"])), "\n")
    image_text = F.array_join(F.transform(images, lambda h: F.concat(F.lit("("), h["no"].cast("string"), F.lit(") "), h["path"])), "\n")
    part = lambda head, body: F.concat(F.lit(head + "\n"), body, F.lit("\n"))
    return both.select(
        qid, F.concat_ws("\n", part(heads[0], F.col("text")),
                         F.when(F.size(refs) > 0, part(heads[1], ref_text)),
                         F.when(F.size(images) > 0, part(heads[2], image_text))).alias("context_str"),
        F.size(images).alias("n_images"))


def exact_lookup(queries: DataFrame, nodes: DataFrame, query_col: str, content: str = "content") -> DataFrame:
    """Every node whose content equals the query; score and k play no part."""
    return queries.join(nodes, F.col(query_col) == F.col(content)).drop(content)


# ---- term index --------------------------------------------------------------------------------

def postings(nodes: DataFrame, keys: list[str], words: str = "words") -> DataFrame:
    """``keys, term, tf``; a node is one row, so its words are counted there."""
    return nodes.select(*keys, F.inline(word_counts(F.col(words))))


def document_frequency(index: DataFrame) -> DataFrame:
    return index.groupBy("term").agg(F.count("*").alias("df"))


def updated_index(index: DataFrame, df: DataFrame, added: DataFrame, removed: DataFrame,
                  keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """New postings and new document frequencies from the changes alone.

    ``added`` are postings of new nodes, ``removed`` the keys that go. Frequencies are summed
    deltas; the old postings are only filtered.
    """
    gone = index.join(removed.select(*keys).distinct(), keys, "left_semi")
    kept = index.join(removed.select(*keys).distinct(), keys, "left_anti")
    deltas = (df.unionByName(document_frequency(added))
              .unionByName(document_frequency(gone).withColumn("df", -F.col("df"))))
    summed = deltas.groupBy("term").agg(F.sum("df").alias("df")).filter("df > 0")
    return kept.unionByName(added), summed


# ---- result cache ------------------------------------------------------------------------------

class ResultCache:
    """Saved results per query text and index version.

    A new version makes every older entry miss. ``expires`` drops entries by age in seconds.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or work_path(spark, "cache")

    def _hash(self, queries: DataFrame, text: str) -> DataFrame:
        return queries.withColumn("query_hash", F.sha2(F.lower(F.trim(F.col(text))), 256))

    def misses(self, queries: DataFrame, version: str, text: str = "text", qid: str = "qid", expires: int | None = None) -> DataFrame:
        """One row per query text that has no saved result: of equal texts the one with the smallest id."""
        hashed = self._hash(queries, text)
        distinct = hashed.groupBy("query_hash").agg(F.min_by(F.struct(*queries.columns), qid).alias("q")).select("q.*", "query_hash")
        if not exists(self.spark, self.path):
            return distinct
        return distinct.join(self.entries(version, expires).select("query_hash").distinct(), "query_hash", "left_anti")

    def entries(self, version: str, expires: int | None = None) -> DataFrame:
        saved = self.spark.read.parquet(self.path).filter(F.col("version") == version)
        if expires is not None:
            saved = saved.filter(F.col("created_at") >= F.current_timestamp() - F.make_dt_interval(secs=F.lit(expires)))
        newest = saved.groupBy("query_hash").agg(F.max("created_at").alias("created_at"))  # a text searched again replaces its old hits
        return saved.join(newest, ["query_hash", "created_at"])

    def save(self, hits: DataFrame, version: str) -> None:
        """``hits`` carries ``query_hash``."""
        (hits.withColumn("version", F.lit(version)).withColumn("created_at", F.current_timestamp())
         .write.mode("append").parquet(self.path))

    def answer(self, queries: DataFrame, version: str, search: Callable[[DataFrame], DataFrame],
               text: str = "text", qid: str = "qid", expires: int | None = None) -> DataFrame:
        """Search only what is missing, save it, and answer all queries from the table."""
        missing = self.misses(queries, version, text, qid, expires)
        found = search(missing)
        self.save(found.join(missing.select(qid, "query_hash"), qid).drop(qid), version)
        return self._hash(queries, text).select(qid, "query_hash").join(self.entries(version, expires), "query_hash")


# ---- query rewriting ---------------------------------------------------------------------------

def expanded_terms(terms: DataFrame, synonyms: DataFrame, qid: str = "qid") -> DataFrame:
    """The terms of every query plus their synonyms: ``qid, term``."""
    extra = terms.join(synonyms, "term").select(qid, F.col("synonym").alias("term"))
    return terms.select(qid, "term").unionByName(extra).distinct()


def rewritten(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Apply question templates in order: (pattern, replacement)."""
    for pattern, replacement in rules:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def sub_questions(queries: DataFrame, pattern: str, text: str = "text", qid: str = "qid") -> DataFrame:
    """Parts of a query split at a pattern: ``qid, sub, text``."""
    parts = F.filter(F.transform(F.split(text, pattern), lambda p: F.trim(p)), lambda p: p != "")
    return queries.select(qid, F.posexplode(parts).alias("sub", "text"))
