"""Term statistics and query weights for text search."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.operators.search import Scorer, block_search, char_scorer, term_scorer
from tessera.session import bounded_rows, cut

MAX_CODES = 1_114_112


def query_terms(queries: DataFrame, words: str = "words", qid: str = "qid") -> DataFrame:
    return queries.select(qid, F.explode(F.array_distinct(words)).alias("term"))


MAX_TERMS = 1_000_000  # distinct query terms, and at most 64 MB of them, that travel to all executors
MAX_TERM_BYTES = 64 << 20


def corpus_stats(nodes: DataFrame, terms: DataFrame, words: str = "words", max_terms: int = MAX_TERMS) -> DataFrame:
    """``term, df, total`` for the given terms in one pass over the nodes.

    Each node also emits the empty term once, so that row holds the number of nodes and of words. Up to ``max_terms`` terms (checked) are
    broadcast, and only their occurrences are counted. Beyond that all terms are counted and the given ones kept afterwards. Both ways
    count map-side before anything is shuffled, so a term of a third of all rows is one row per task.
    """
    wanted = terms.select("term").distinct()
    size = wanted.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0)).alias("b")).first()
    small = size["n"] <= max_terms and size["b"] <= MAX_TERM_BYTES
    wanted = wanted.unionByName(nodes.sparkSession.range(1).select(F.lit("").alias("term")))
    marked = nodes.select(F.size(words).alias("n"), F.explode(
        F.array_append(F.array_distinct(words), F.lit(""))).alias("term"))
    if small:
        marked = marked.join(F.broadcast(wanted), "term", "left_semi")
    counted = marked.groupBy("term").agg(F.count("*").alias("df"), F.sum("n").alias("total"))
    return counted if small else counted.join(wanted, "term", "left_semi")


def weighted(terms: DataFrame, stats: DataFrame, idf, qid: str = "qid") -> DataFrame:
    """``qid, terms, weights``: a query's terms that occur in the corpus, weighted by ``idf(df)``."""
    pairs = terms.join(stats.filter("term <> ''"), "term").select(
        qid, F.struct("term", idf(F.col("df")).alias("w")).alias("p"))
    return pairs.groupBy(qid).agg(F.array_sort(F.collect_list("p")).alias("p")).select(
        qid, F.col("p.term").alias("terms"), F.col("p.w").alias("weights"))


def bm25_parts(nodes: DataFrame, queries: DataFrame, k1: float = 1.2, b: float = 0.75,
               words: str = "words", qid: str = "qid") -> tuple[DataFrame, Scorer]:
    """Weighted queries and the scorer; idf is ``ln((N - df + 0.5) / (df + 0.5) + 1)``."""
    terms = query_terms(queries, words, qid)
    stats = cut(corpus_stats(nodes, terms, words))
    whole = stats.filter("term = ''").first()
    n, total = (whole["df"], whole["total"]) if whole else (0, 0)
    weights = weighted(terms, stats, lambda df: F.log((F.lit(n) - df + 0.5) / (df + 0.5) + 1.0), qid)
    return weights, term_scorer("bm25", k1=k1, b=b, avgdl=max(total, 1) / max(n, 1), words=words)


def bm25_search(nodes: DataFrame, queries: DataFrame, k: int, keys: list[str], words: str = "words",
                qid: str = "qid", floor: float | None = None, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    weights, scorer = bm25_parts(nodes, queries, k1, b, words, qid)
    return block_search(nodes, weights, scorer, k, keys, [words], qid, floor)


def tfidf_search(nodes: DataFrame, queries: DataFrame, k: int, keys: list[str], words: str = "words",
                 qid: str = "qid") -> DataFrame:
    """Plain TF-IDF: ``count / total`` times ``ln(N / (1 + df))``, summed over the query's terms."""
    terms = query_terms(queries, words, qid)
    stats = cut(corpus_stats(nodes, terms, words))
    whole = stats.filter("term = ''").first()
    n = whole["df"] if whole else 0
    weights = weighted(terms, stats, lambda df: F.log(F.lit(n) / (1.0 + df)), qid)
    return block_search(nodes, weights, term_scorer("share", words=words), k, keys, [words], qid)


def jaccard_search(nodes: DataFrame, queries: DataFrame, k: int, keys: list[str], words: str = "words",
                   qid: str = "qid") -> DataFrame:
    """Jaccard of the distinct words."""
    nodes = nodes.select(*keys, words, F.size(F.array_distinct(words)).alias("distinct_words"))
    distinct = F.array_distinct(words)
    packed = queries.select(qid, distinct.alias("terms"),
                            F.transform(distinct, lambda t: F.lit(1.0)).alias("weights"))
    scorer = term_scorer("jaccard", words=words, distinct="distinct_words")
    return block_search(nodes, packed, scorer, k, keys, [words, "distinct_words"], qid)


def char_search(nodes: DataFrame, queries: DataFrame, k: int, keys: list[str], mode: str = "corpus",
                packed: str = "packed", qid: str = "qid", floor: float | None = None) -> DataFrame:
    """TF-IDF cosine over characters of the ``packed`` columns (see ``functions.text.packed``)."""
    extra = {}
    if mode == "corpus":
        chars = F.explode(F.array_append(F.array_distinct(F.split(packed, "")), F.lit("#all"))).alias("c")
        df = nodes.select(chars).filter("c <> ''").groupBy("c").agg(F.count("*").alias("df"))
        rows = bounded_rows(df, MAX_CODES + 1)  # Unicode has no more code points than this
        counts = dict(zip(rows["c"].to_pylist(), rows["df"].to_pylist()))
        extra["n"] = counts.pop("#all", 0)
        extra["df"] = {ord(c): n for c, n in counts.items()}
        extra["codes"] = list(extra["df"])
    queries = queries.select(qid, packed)
    return block_search(nodes, queries, char_scorer(mode, packed, **extra), k, keys, [packed], qid, floor)
