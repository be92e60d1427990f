"""Evaluation (E rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as tx, vector as vx
from tessera.functions.passages import holders
from tessera.operators import evaluate as ev, keywords as kw
from tessera.operators.ranking import bm25_search, jaccard_search
from tessera.operators.search import block_search, vector_scorer
from tessera.plans.common import (KEYS, LINE_WORDS, MEANS, PASSAGES, WORDS, bm25_cte, label_means, line_words, passages,
                                  ranked, vector_nodes)
from tessera.plans.node_plans import PAIRS
from tessera.plans.registry import query
from tessera.plans.retrieval_plans import JACC

REF = "ref AS (SELECT item_id AS qid, doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text))"
BASE = f"WITH {LINE_WORDS},\n{PASSAGES},\n"


def _reference(t):
    return holders(t.documents, passages(t))


@query("e1_context_recall", BASE + bm25_cte(k=3) + f""",
{REF}, got AS (SELECT DISTINCT qid, doc_id FROM hits),
c AS (SELECT qid, count(*) AS n_ref, count(got.doc_id) AS n_hit FROM ref LEFT JOIN got USING (qid, doc_id) GROUP BY qid),
ctx AS (SELECT qid, string_agg(content, chr(10) ORDER BY rk) AS context_str FROM hits JOIN n USING (doc_id, pos) GROUP BY qid)
SELECT qid, n_ref, n_hit, round(n_hit / n_ref::DOUBLE, 6) AS recall, coalesce(context_str, '') AS context_str FROM c LEFT JOIN ctx USING (qid)""")
def e1_context_recall(t):
    """Lines, BM25 top 3 per passage, context, and recall of the documents that hold the passage."""
    nodes = line_words(t)
    hits = bm25_search(nodes, passages(t), 3, KEYS).join(nodes.select(*KEYS, "content"), KEYS)
    ordered = F.array_sort(F.collect_list(F.struct("rk", "content"))).alias("o")
    context = hits.groupBy("qid").agg(ordered).select("qid", F.array_join("o.content", "\n").alias("context_str"))
    return ev.context_recall(hits, _reference(t), "doc_id").join(context, "qid", "left").fillna("", ["context_str"])


@query("e1_recall_mean", BASE + bm25_cte(k=3) + f""",
{REF}, got AS (SELECT DISTINCT qid, doc_id FROM hits),
c AS (SELECT qid, count(*) AS n_ref, count(got.doc_id) AS n_hit FROM ref LEFT JOIN got USING (qid, doc_id) GROUP BY qid)
SELECT round(avg(n_hit / n_ref::DOUBLE), 6) AS recall, round(avg(CASE WHEN n_hit > 0 THEN 1.0 ELSE 0.0 END), 6) AS hit_rate, count(*) AS n FROM c""")
def e1_recall_mean(t):
    counts = ev.context_recall(bm25_search(line_words(t), passages(t), 3, KEYS), _reference(t), "doc_id")
    return counts.agg(F.round(F.avg(F.col("n_hit") / F.col("n_ref")), 6).alias("recall"),
                      F.round(F.avg((F.col("n_hit") > 0).cast("double")), 6).alias("hit_rate"), F.count("*").alias("n"))


SENT = "list_filter(list_transform(string_split_regex({0}, '[.\\n]'), lambda p: trim(p)), lambda p: p <> '')"


@query("e2_context_relevance", BASE + bm25_cte(k=3) + f""",
rs AS (SELECT qid, unnest({SENT.format('content')}) AS s FROM hits JOIN n USING (doc_id, pos)),
fs AS (SELECT DISTINCT qid, unnest({SENT.format('text')}) AS s FROM q)
SELECT q.qid, count(rs.s)::BIGINT AS n_sentences, count(fs.s)::BIGINT AS n_related, coalesce(round(count(fs.s) / nullif(count(rs.s), 0)::DOUBLE, 6), 0.0) AS relevance
FROM q LEFT JOIN rs ON q.qid = rs.qid LEFT JOIN fs ON rs.qid = fs.qid AND rs.s = fs.s GROUP BY q.qid""")
def e2_context_relevance(t):
    nodes = line_words(t)
    hits = bm25_search(nodes, passages(t), 3, KEYS).join(nodes.select(*KEYS, "content"), KEYS)
    sentences = lambda df, c: df.select("qid", F.explode(tx.pieces_by_pattern(F.col(c), "[.\n]")).alias("s"))
    return ev.context_relevance(sentences(hits, "content"), sentences(passages(t), "text"), passages(t), "s")


@query("e3_recall_flags", """SELECT count(*) FILTER (quality = 1 AND n_chars > 500) AS tp, count(*) FILTER (quality = 1 AND NOT n_chars > 500) AS fn,
round(count(*) FILTER (quality = 1 AND n_chars > 500) / count(*) FILTER (quality = 1)::DOUBLE, 6) AS recall FROM labels JOIN documents USING (doc_id)""")
def e3_recall_flags(t):
    """Labelled documents: good quality is relevant, long text is returned."""
    docs = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    return ev.recall_of_flags(docs, F.col("quality") == 1, F.col("n_chars") > 500)


@query("e4_reciprocal_rank", BASE + bm25_cte(k=5) + f""",
{REF}, f AS (SELECT qid, min(rk) AS rk FROM hits JOIN (SELECT DISTINCT * FROM ref) r USING (qid, doc_id) GROUP BY qid)
SELECT q.qid, round(coalesce(1.0 / f.rk, 0.0)::DOUBLE, 6) AS rr FROM (SELECT DISTINCT qid FROM ref) q LEFT JOIN f USING (qid)""".replace("1.0 / f.rk", "1::DOUBLE / f.rk"))
def e4_reciprocal_rank(t):
    reference = _reference(t)
    hits = bm25_search(line_words(t), passages(t), 5, KEYS)
    return ev.reciprocal_ranks(hits, reference, reference.select("qid").distinct(), "doc_id")


@query("e5_faithfulness", f"""WITH {PAIRS},
st AS (SELECT conv_id, turn, question, unnest({SENT.format('answer')}) AS s FROM qa),
j AS (SELECT conv_id, list_distinct({WORDS.format('s')}) AS sw, {WORDS.format('question')} AS qw FROM st),
v AS (SELECT conv_id, CASE WHEN len(sw) > 0 THEN len(list_intersect(sw, qw)) / len(sw)::DOUBLE ELSE 0 END >= 0.2 AS ok FROM j)
SELECT conv_id AS qid, count(*) AS n, count(*) FILTER (ok) AS n_supported, round(count(*) FILTER (ok) / count(*)::DOUBLE, 6) AS faithfulness FROM v GROUP BY conv_id""")
def e5_faithfulness(t):
    """Statements of an answer against its question, judged by shared words."""
    pairs = kw.question_answer_pairs(t.conversations)
    statements = pairs.select(F.col("conv_id").alias("qid"), "question", F.explode(
        tx.pieces_by_pattern(F.col("answer"), "[.\n]")).alias("s"))
    judged = statements.withColumn("supported", ev.word_support(F.col("s"), F.col("question")) >= 0.2)
    return ev.faithfulness(judged)


@query("e6_answer_relevance", f"""WITH {MEANS} SELECT label AS qid, round(avg(list_cosine_similarity(embedding::DOUBLE[], vec)), 6) AS relevance, count(*) AS n
FROM embeddings JOIN mv USING (label) GROUP BY label""")
def e6_answer_relevance(t):
    """Vectors of a label stand for generated questions, the label mean for the query."""
    pairs = vector_nodes(t).join(label_means(t).withColumnRenamed("vec", "q"), "label")
    return pairs.groupBy(F.col("label").alias("qid")).agg(
        F.round(F.avg(vx.cosine(F.col("vec"), F.col("q"))), 6).alias("relevance"), F.count("*").alias("n"))


ANSWERS = """ans AS (SELECT a.doc_id, a.text AS answer, b.text AS context FROM documents a JOIN (
  SELECT lang, source, max_by(text, doc_id) AS text FROM documents GROUP BY lang, source) b USING (lang, source))"""


def _answers(t):
    """Each document as an answer; the last document of its language and source as the truth."""
    truth = t.documents.groupBy("lang", "source").agg(F.max_by("text", "doc_id").alias("context"))
    return t.documents.join(truth, ["lang", "source"]).select("doc_id", F.col("text").alias("answer"), "context")


@query("e7_exact_match", f"WITH {ANSWERS} SELECT doc_id, (trim(answer) = trim(context))::INTEGER AS exact_score FROM ans")
def e7_exact_match(t):
    return _answers(t).select("doc_id", ev.exact_match(F.col("answer"), F.col("context")).alias("exact_score"))


@query("e8_cosine_score", f"""WITH {MEANS} SELECT vec_id, round(greatest(0.0, least(1.0, list_cosine_similarity(embedding::DOUBLE[], vec))), 6) AS cosine_score
FROM embeddings JOIN mv USING (label)""")
def e8_cosine_score(t):
    pairs = vector_nodes(t).join(label_means(t).withColumnRenamed("vec", "q"), "label")
    return pairs.select("vec_id", F.round(vx.clamped_cosine(F.col("vec"), F.col("q")), 6).alias("cosine_score"))


CONTAINS = "(len(list_filter(string_split_regex(answer, '[ \\t\\n\\r\\f]+'), lambda w: w <> '' AND NOT contains(context, w))) = 0)::INTEGER"


@query("e9_containment", f"WITH {ANSWERS} SELECT doc_id, {CONTAINS} AS origin_score FROM ans")
def e9_containment(t):
    return _answers(t).select("doc_id", ev.containment(F.col("answer"), F.col("context")).alias("origin_score"))


@query("e10_report", f"""WITH {ANSWERS}, s AS (SELECT (trim(answer) = trim(context))::INTEGER AS exact_score, {CONTAINS} AS origin_score FROM ans)
SELECT 'exact_score' AS metric, sum(exact_score)::DOUBLE AS total, count(*) AS n, printf('%.4f%%', 100.0 * sum(exact_score)::DOUBLE / count(*)) AS percent FROM s
UNION ALL SELECT 'origin_score', sum(origin_score)::DOUBLE, count(*), printf('%.4f%%', 100.0 * sum(origin_score)::DOUBLE / count(*)) FROM s""")
def e10_report(t):
    scores = _answers(t).select(ev.exact_match(F.col("answer"), F.col("context")).alias("exact_score"),
                                ev.containment(F.col("answer"), F.col("context")).alias("origin_score"))
    return ev.report(scores, ["exact_score", "origin_score"])


BOXES = """bx AS (SELECT l_orderkey, l_linenumber, l_tax, 'so \\boxed{' || l_quantity::INTEGER || '}' || CASE WHEN l_returnflag = 'A' THEN ' or \\boxed{\\frac{1}{2}}'
  WHEN l_returnflag = 'N' THEN ' again \\boxed{' || l_quantity::INTEGER || '}' ELSE '' END AS output,
  'steps' || chr(10) || '#### ' || (CASE WHEN l_linestatus = 'O' THEN l_quantity::INTEGER ELSE l_linenumber END) AS truth FROM lineitem)"""
CORRECT = """(len(list_distinct(regexp_extract_all(output, 'boxed\\{((?:[^{}]|\\{[^{}]*\\})*)\\}', 1))) = 1
  AND regexp_extract(output, 'boxed\\{((?:[^{}]|\\{[^{}]*\\})*)\\}', 1) = trim(list_last(string_split(truth, chr(10) || '#### '))))"""


def boxed_rows(t):
    """Answers written from the line items: one, two or the same boxed value twice."""
    q = F.col("l_quantity").cast("int").cast("string")
    box = lambda v: F.concat(F.lit("\\boxed{"), v, F.lit("}"))
    extra = (F.when(F.col("l_returnflag") == "A", F.lit(" or \\boxed{\\frac{1}{2}}"))
             .when(F.col("l_returnflag") == "N", F.concat(F.lit(" again "), box(q))).otherwise(""))
    truth = F.when(F.col("l_linestatus") == "O", q).otherwise(F.col("l_linenumber").cast("string"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_tax", F.concat(F.lit("so "), box(q), extra).alias("output"),
                             F.concat(F.lit("steps\n#### "), truth).alias("truth"))


@query("e11_boxed_accuracy", f"""WITH {BOXES} SELECT l_linenumber, count(*) AS n, count(*) FILTER ({CORRECT}) AS n_correct,
round(count(*) FILTER ({CORRECT}) / count(*)::DOUBLE, 6) AS accuracy FROM bx GROUP BY l_linenumber""")
def e11_boxed_accuracy(t):
    ok = ev.boxed_correct(F.col("output"), ev.true_answer(F.col("truth")))
    return boxed_rows(t).groupBy("l_linenumber").agg(F.count("*").alias("n"), F.count_if(ok).alias("n_correct")).withColumn(
        "accuracy", F.round(F.col("n_correct") / F.col("n"), 6))


@query("e12_sweep", BASE + bm25_cte(k=5) + ",\n" + JACC.replace("<= 3", "<= 5") + f""",
{REF}, r AS (SELECT DISTINCT qid, doc_id FROM ref), nr AS (SELECT qid, count(*) AS n_ref FROM r GROUP BY qid),
u AS (SELECT 'bm25' AS setup, qid, doc_id, rk FROM hits UNION ALL SELECT 'jaccard', qid, doc_id, rk FROM jac),
b AS (SELECT setup, qid, doc_id, min(rk) AS rk FROM u JOIN r USING (qid, doc_id) GROUP BY ALL),
h AS (SELECT setup, qid, count(*) FILTER (rk <= 1) AS k1, count(*) FILTER (rk <= 3) AS k3, count(*) FILTER (rk <= 5) AS k5 FROM b GROUP BY ALL)
SELECT setup, round(sum(k1 / n_ref::DOUBLE) / (SELECT count(*) FROM nr), 6) AS recall_at_1, round(sum(k3 / n_ref::DOUBLE) / (SELECT count(*) FROM nr), 6) AS recall_at_3,
  round(sum(k5 / n_ref::DOUBLE) / (SELECT count(*) FROM nr), 6) AS recall_at_5 FROM h JOIN nr USING (qid) GROUP BY setup""")
def e12_sweep(t):
    nodes, queries = line_words(t), passages(t)
    runs = bm25_search(nodes, queries, 5, KEYS).withColumn("setup", F.lit("bm25")).unionByName(
        jaccard_search(nodes, queries, 5, KEYS).withColumn("setup", F.lit("jaccard")))
    return ev.sweep(runs, _reference(t), [1, 3, 5], "doc_id")


@query("e12_pivot", f"""WITH {MEANS}, sc AS (SELECT mv.label AS qid, vec_id, embeddings.label = mv.label AS good, round(list_cosine_similarity(vec, embedding::DOUBLE[]), 6) AS score FROM mv, embeddings),
h AS ({ranked('sc', 5)})
SELECT qid, round(avg(good::INTEGER) FILTER (rk <= 1), 6) AS p1, round(avg(good::INTEGER) FILTER (rk <= 3), 6) AS p3, round(avg(good::INTEGER) FILTER (rk <= 5), 6) AS p5 FROM h GROUP BY qid""")
def e12_pivot(t):
    """Precision of one top-5 search at k = 1, 3, 5."""
    hits = block_search(vector_nodes(t), label_means(t).withColumnRenamed("label", "qid"), vector_scorer("cosine"), 5, ["vec_id"], ["vec"])
    good = hits.join(t.embeddings.select("vec_id", "label"), "vec_id").withColumn("good", (F.col("label") == F.col("qid")).cast("int"))
    at = good.withColumn("k", F.explode(F.filter(F.array(F.lit(1), F.lit(3), F.lit(5)), lambda k: F.col("rk") <= k)))
    wide = at.groupBy("qid").pivot("k", [1, 3, 5]).agg(F.round(F.avg("good"), 6))
    return wide.select("qid", F.col("1").alias("p1"), F.col("3").alias("p3"), F.col("5").alias("p5"))


@query("e13_same_length", "SELECT o_orderkey AS id, o_orderstatus, n FROM orders JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey")
def e13_same_length(t):
    """Orders that have items against counted items: both sides hold the same ids."""
    counts = t.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(F.count("*").alias("n"))
    orders = t.orders.select(F.col("o_orderkey").alias("id"), "o_orderstatus").join(counts.select("id"), "id", "left_semi")
    return ev.same_length(orders, counts, "id")
