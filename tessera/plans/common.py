"""Inputs and SQL fragments used by several query modules."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.functions import text as tx
from tessera.operators.nodes import NodeTree
from tessera.operators.vectors import mean_vectors

KEYS = ["doc_id", "pos"]


def lines(t, keep: tuple[str, ...] = ()) -> DataFrame:
    """Line nodes of the documents with their words."""
    tree = NodeTree(t.documents, keep=keep).group("line", lambda c: tx.pieces(c, "\n"))
    return tree.nodes("line").drop("grp", "anc")


def line_words(t, keep: tuple[str, ...] = ()) -> DataFrame:
    return lines(t, keep).withColumn("words", tx.words(F.col("content")))


def passages(t) -> DataFrame:
    """The benchmark texts as queries."""
    return t.benchmark.select(F.col("item_id").alias("qid"), "text", tx.words(F.col("text")).alias("words"))


def label_means(t) -> DataFrame:
    """Mean vector of every label: a query set made from the whole table."""
    return mean_vectors(t.embeddings, ["label"], "embedding")


def vector_nodes(t) -> DataFrame:
    return t.embeddings.select("vec_id", "label", F.col("embedding").alias("vec"))


GAP = r"'[ \t\n\r\f]+'"

WORDS = "list_filter(string_split_regex(lower({0}), " + GAP + "), lambda w: w <> '')"

LINES = """ln AS (SELECT doc_id, unnest(range(0, len(ps)))::INTEGER AS pos, unnest(ps) AS content
  FROM (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda p: p <> '') AS ps FROM documents))"""

LINE_WORDS = LINES + f",\nn AS (SELECT doc_id, pos, content, {WORDS.format('content')} AS words FROM ln)"

PASSAGES = f"q AS (SELECT item_id AS qid, text, {WORDS.format('text')} AS words FROM benchmark)"

MEANS = """mv AS (SELECT label, list(m ORDER BY dim) AS vec FROM (
  SELECT label, dim, avg(v) AS m FROM (SELECT label, unnest(range(0, len(embedding))) AS dim,
    unnest(embedding)::DOUBLE AS v FROM embeddings) GROUP BY label, dim) GROUP BY label)"""


def bm25_cte(n: str = "n", q: str = "q", keys: str = "doc_id, pos", k: int = 5, out: str = "hits",
             idf: str = "ln((sn - df + 0.5) / (df + 0.5) + 1)",
             tf: str = "tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))", where: str = "") -> str:
    """Common table expressions that end with ``out(qid, keys, score, rk)``."""
    p = out
    return f"""{p}_tf AS (SELECT {keys}, term, count(*) AS tf FROM (SELECT {keys}, unnest(words) AS term FROM {n}) GROUP BY {keys}, term),
{p}_dl AS (SELECT {keys}, len(words) AS dl FROM {n}),
{p}_st AS (SELECT count(*) AS sn, avg(len(words)) AS avgdl FROM {n}),
{p}_df AS (SELECT term, count(*) AS df FROM {p}_tf GROUP BY term),
{p}_qt AS (SELECT DISTINCT qid, unnest(words) AS term FROM {q}),
{p}_sc AS (SELECT qid, {keys}, round(sum(({idf}) * ({tf})), 6) AS score
  FROM {p}_qt JOIN {p}_df USING (term) JOIN {p}_tf USING (term) JOIN {p}_dl USING ({keys}), {p}_st GROUP BY qid, {keys}),
{p} AS (SELECT qid, {keys}, score, rk FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, {keys})::INTEGER AS rk
  FROM {p}_sc {where}) WHERE rk <= {k})"""


def ranked(scored: str, k: int, by: str = "qid", ties: str = "vec_id", direction: str = "DESC") -> str:
    return (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY score {direction}, {ties})::INTEGER AS rk "
            f"FROM {scored}) WHERE rk <= {k}")
