"""Similarity functions (M rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as tx, vector as vx
from tessera.operators.ranking import bm25_search, char_search, jaccard_search, tfidf_search
from tessera.operators.search import block_search, max_sim_scorer, top_k, vector_scorer
from tessera.operators.similarity import Similarity, SimilarityRegistry
from tessera.plans.common import (KEYS, LINE_WORDS, MEANS, PASSAGES, WORDS, bm25_cte, label_means, line_words,
                                  passages, ranked, vector_nodes)
from tessera.plans.registry import query

PAIRED = f"WITH {MEANS}, p AS (SELECT vec_id, embedding::DOUBLE[] AS a, vec AS b FROM embeddings JOIN mv USING (label))\n"


def _paired(t):
    """Every stored vector next to the mean of its label."""
    return vector_nodes(t).join(label_means(t).withColumnRenamed("vec", "mean"), "label")


def _pair_query(name, expr, sql):
    @query(name, PAIRED + f"SELECT vec_id, round({sql}, 6) + 0.0 AS score FROM p")
    def run(t):
        return _paired(t).select("vec_id", F.round(expr(F.col("vec"), F.col("mean")), 6).alias("score"))


_pair_query("m1_cosine", vx.cosine, "list_cosine_similarity(a, b)")
_pair_query("m2_clamped_cosine", vx.clamped_cosine, "greatest(0.0, least(1.0, list_cosine_similarity(a, b)))")
_pair_query("m3_inner_product", vx.dot, "list_inner_product(a, b)")
_pair_query("m4_euclid", vx.euclid, "list_distance(a, b)")


@query("m3_sparse_product", f"""WITH tf AS (SELECT lang, term, count(*)::DOUBLE AS w FROM (
    SELECT lang, unnest({WORDS.format('text')}) AS term FROM documents) GROUP BY lang, term),
  q AS (SELECT item_id, term, count(*)::DOUBLE AS w FROM (
    SELECT item_id, unnest({WORDS.format('text')}) AS term FROM benchmark) GROUP BY item_id, term)
SELECT item_id, lang, round(sum(q.w * tf.w), 6) AS score FROM q JOIN tf USING (term) GROUP BY item_id, lang""")
def m3_sparse_product(t):
    """Word counts of each passage against word counts of each language: both sides are
    aggregated before the join, so a frequent word is one row per language."""
    def counts(df, key):
        return (df.select(key, F.explode(tx.words(F.col("text"))).alias("term")).groupBy(key, "term")
                .agg(F.count("*").cast("double").alias("w")))

    q, n = counts(t.benchmark, "item_id"), counts(t.documents, "lang").withColumnRenamed("w", "nw")
    return q.join(n, "term").groupBy("item_id", "lang").agg(F.round(F.sum(F.col("w") * F.col("nw")), 6).alias("score"))


@query("m5_bm25", f"WITH {LINE_WORDS},\n{PASSAGES},\n{bm25_cte()}\nSELECT * FROM hits")
def m5_bm25(t):
    return bm25_search(line_words(t), passages(t), 5, KEYS)


CJK = r"""list_filter(string_split_regex(regexp_replace(lower({0}), '([一-鿿])', ' \1 ', 'g'), '[ \t\n\r\f]+'), lambda w: w <> '')"""


@query("m6_bm25_chinese", f"""WITH {LINE_WORDS.replace(WORDS.format('content'), CJK.format('content'))},
{PASSAGES.replace(WORDS.format('text'), CJK.format('text'))},
{bm25_cte()}
SELECT * FROM hits""")
def m6_bm25_chinese(t):
    nodes = line_words(t).withColumn("words", tx.cjk_words(F.col("content")))
    return bm25_search(nodes, passages(t).withColumn("words", tx.cjk_words(F.col("text"))), 5, KEYS)


PACKED = r"regexp_replace(lower({0}), '[ \t\n\r\f]+', '', 'g')"
CHARS = f"""nc AS (SELECT doc_id, ch, count(*)::DOUBLE AS tf FROM (SELECT doc_id, unnest(string_split({PACKED.format('text')}, '')) AS ch FROM documents) WHERE ch <> '' GROUP BY doc_id, ch),
qc AS (SELECT qid, ch, count(*)::DOUBLE AS tf FROM (SELECT item_id AS qid, unnest(string_split({PACKED.format('text')}, '')) AS ch FROM benchmark) WHERE ch <> '' GROUP BY qid, ch)"""


def _packed(t):
    return (t.documents.select("doc_id", tx.packed(F.col("text")).alias("packed")),
            t.benchmark.select(F.col("item_id").alias("qid"), tx.packed(F.col("text")).alias("packed")))


@query("m7_char_tfidf", f"""WITH {CHARS},
st AS (SELECT count(*) + 1 AS n FROM documents),
df AS (SELECT ch, count(*) AS df FROM nc GROUP BY ch),
w0 AS (SELECT ch, ln((1 + n) / (1.0 + df)) + 1 AS w0, ln((1 + n) / (2.0 + df)) + 1 AS w1 FROM df, st),
nn AS (SELECT doc_id, sum(tf * tf * w0 * w0) AS s0 FROM nc JOIN w0 USING (ch) GROUP BY doc_id),
qq AS (SELECT qid, ch, tf, ln((1 + n) / (2.0 + coalesce(df, 0))) + 1 AS w1 FROM qc LEFT JOIN df USING (ch), st),
qn AS (SELECT qid, sum(tf * tf * w1 * w1) AS sq FROM qq GROUP BY qid),
x AS (SELECT qid, doc_id, sum(qq.tf * nc.tf * qq.w1 * qq.w1) AS d, sum(nc.tf * nc.tf * (qq.w1 * qq.w1 - w0.w0 * w0.w0)) AS fix
  FROM qq JOIN nc USING (ch) JOIN w0 USING (ch) GROUP BY qid, doc_id),
sc AS (SELECT qid, doc_id, round(d / (sqrt(s0 + fix) * sqrt(sq)), 6) AS score FROM x JOIN nn USING (doc_id) JOIN qn USING (qid))
{ranked('sc', 5, ties='doc_id')}""")
def m7_char_tfidf(t):
    nodes, queries = _packed(t)
    return char_search(nodes, queries, 5, ["doc_id"])


@query("m8_plain_tfidf", f"""WITH {LINE_WORDS},
{PASSAGES},
{bm25_cte(idf='ln(sn / (1.0 + df))', tf='tf / dl::DOUBLE')}
SELECT * FROM hits""")
def m8_plain_tfidf(t):
    return tfidf_search(line_words(t), passages(t), 5, KEYS)


@query("m9_pair_tfidf", f"""WITH {CHARS},
a AS (SELECT pow(ln(1.5) + 1, 2) AS a2),
nn AS (SELECT doc_id, sum(tf * tf) AS s FROM nc GROUP BY doc_id),
qn AS (SELECT qid, sum(tf * tf) AS s FROM qc GROUP BY qid),
x AS (SELECT qid, doc_id, sum(qc.tf * nc.tf) AS d, sum(nc.tf * nc.tf) AS sn, sum(qc.tf * qc.tf) AS sq
  FROM qc JOIN nc USING (ch) GROUP BY qid, doc_id),
sc AS (SELECT qid, doc_id, round(d / sqrt((sn + a2 * (nn.s - sn)) * (sq + a2 * (qn.s - sq))), 6) AS score
  FROM x JOIN nn USING (doc_id) JOIN qn USING (qid), a)
{ranked('sc', 5, ties='doc_id')}""")
def m9_pair_tfidf(t):
    nodes, queries = _packed(t)
    return char_search(nodes, queries, 5, ["doc_id"], mode="pair")


@query("m10_max_sim", f"""WITH {MEANS},
np AS (SELECT vec_id, r, list_slice(embedding::DOUBLE[], r * 8 + 1, r * 8 + 8) AS v FROM embeddings, range(0, 8) g(r)),
qp AS (SELECT label AS qid, r AS qr, list_slice(vec, r * 8 + 1, r * 8 + 8) AS v FROM mv, range(0, 8) g(r)),
b AS (SELECT qid, qr, vec_id, max(list_inner_product(qp.v, np.v)) AS m FROM qp, np GROUP BY qid, qr, vec_id),
sc AS (SELECT qid, vec_id, round(sum(m), 6) AS score FROM b GROUP BY qid, vec_id)
{ranked('sc', 5)}""")
def m10_max_sim(t):
    queries = label_means(t).withColumnRenamed("label", "qid")
    return block_search(vector_nodes(t), queries, max_sim_scorer(8), 5, ["vec_id"], ["vec"])


@query("m10_ragged", f"""WITH {MEANS},
np AS (SELECT vec_id, r, list_slice(embedding::DOUBLE[], r * 8 + 1, r * 8 + 8) AS v FROM embeddings, range(0, 8) g(r) WHERE r < vec_id % 9),
qp AS (SELECT label AS qid, r AS qr, list_slice(vec, r * 8 + 1, r * 8 + 8) AS v FROM mv, range(0, 8) g(r) WHERE r < label % 4 + 1),
b AS (SELECT qid, qr, vec_id, max(list_inner_product(qp.v, np.v)) AS m FROM qp, np GROUP BY qid, qr, vec_id),
sc AS (SELECT qid, vec_id, round(sum(m), 6) AS score FROM b GROUP BY qid, vec_id)
{ranked('sc', 5)}""")
def m10_ragged(t):
    """Nodes of 0 to 8 tokens, queries of 1 to 4."""
    queries = label_means(t).select(F.col("label").alias("qid"), F.slice("vec", F.lit(1), ((F.col("label") % 4 + 1) * 8).cast("int")).alias("vec"))
    nodes = vector_nodes(t).select("vec_id", F.slice("vec", F.lit(1), ((F.col("vec_id") % 9) * 8).cast("int")).alias("vec"))
    return block_search(nodes, queries, max_sim_scorer(8), 5, ["vec_id"], ["vec"])


@query("m10_max_sim_pairs", PAIRED + """, np AS (SELECT vec_id, list_slice(a, r * 8 + 1, r * 8 + 8) AS v FROM p, range(0, 8) g(r)),
qp AS (SELECT vec_id, r AS qr, list_slice(b, r * 8 + 1, r * 8 + 8) AS v FROM p, range(0, 8) g(r)),
m AS (SELECT vec_id, qr, max(list_inner_product(qp.v, np.v)) AS m FROM qp JOIN np USING (vec_id) GROUP BY vec_id, qr)
SELECT vec_id, round(sum(m), 6) AS score FROM m GROUP BY vec_id""")
def m10_max_sim_pairs(t):
    sim = vx.max_sim(vx.rows_of(F.col("mean"), 8), vx.rows_of(F.col("vec"), 8))
    return _paired(t).select("vec_id", F.round(sim, 6).alias("score"))


@query("m11_jaccard", f"""WITH {LINE_WORDS}, {PASSAGES},
nt AS (SELECT doc_id, pos, list_distinct(words) AS ws FROM n), qt AS (SELECT qid, list_distinct(words) AS ws FROM q),
nx AS (SELECT doc_id, pos, unnest(ws) AS term FROM nt), qx AS (SELECT qid, unnest(ws) AS term FROM qt),
sh AS (SELECT qid, doc_id, pos, count(*) AS c FROM qx JOIN nx USING (term) GROUP BY ALL),
sc AS (SELECT qid, doc_id, pos, round(c / (len(nt.ws) + len(qt.ws) - c)::DOUBLE, 6) AS score FROM sh JOIN nt USING (doc_id, pos) JOIN qt USING (qid))
{ranked('sc', 5, ties='doc_id, pos')}""")
def m11_jaccard(t):
    return jaccard_search(line_words(t), passages(t), 5, KEYS)


@query("m11_hamming", PAIRED + """SELECT vec_id, list_sum(list_transform(range(1, 65), lambda i:
  CASE WHEN (a[i] >= 0) <> (b[i] >= 0) THEN 1 ELSE 0 END))::INTEGER AS distance FROM p""")
def m11_hamming(t):
    bits = vx.hamming(vx.sign_bits(F.col("vec")), vx.sign_bits(F.col("mean")))
    return _paired(t).select("vec_id", bits.cast("int").alias("distance"))


def _registry() -> SimilarityRegistry:
    sims = SimilarityRegistry()
    sims.add("l2", vx.euclid, mode="embedding", descending=False)
    sims.add("overlap", tx.word_cosine, mode="text")
    sims.add("lines_bm25", lambda nodes, queries, k: bm25_search(nodes, queries, k, KEYS), mode="text", batch=True)
    return sims


@query("m12_registered", PAIRED + """SELECT 'l2' AS name, vec_id AS node, round(list_distance(a, b), 6) AS score FROM p
UNION ALL SELECT 'lines_bm25', count(*), round(sum(score), 4) FROM (
  WITH """ + f"{LINE_WORDS}, {PASSAGES}, {bm25_cte(k=3)}" + """ SELECT * FROM hits)""")
def m12_registered(t):
    """One pairwise and one whole-group similarity from the registry."""
    sims = _registry()
    pairs = sims["l2"].score_pairs(_paired(t).withColumnRenamed("mean", "query_vec"))
    batch = sims["lines_bm25"].search(line_words(t), passages(t), 3)
    return pairs.select(F.lit("l2").alias("name"), F.col("vec_id").alias("node"), "score").unionByName(
        batch.agg(F.lit("lines_bm25").alias("name"), F.count("*").alias("node"), F.round(F.sum("score"), 4).alias("score")))


@query("m13_dummy", "SELECT lang AS kb, doc_id, score, rk FROM (SELECT lang, doc_id, 0.0::DOUBLE AS score, "
       "row_number() OVER (PARTITION BY lang ORDER BY doc_id)::INTEGER AS rk FROM documents) WHERE rk <= 6")
def m13_dummy(t):
    nodes = t.documents.select(F.col("lang").alias("kb"), "doc_id", F.lit(0.0).alias("score"))
    return top_k(nodes, ["kb"], 6, ["doc_id"])


@query("r1_top_k", f"""WITH {MEANS}, sc AS (SELECT mv.label AS qid, vec_id, round(list_cosine_similarity(vec, embedding::DOUBLE[]), 6) AS score FROM mv, embeddings)
{ranked('sc', 6)}""")
def r1_top_k(t):
    queries = label_means(t).withColumnRenamed("label", "qid")
    return block_search(vector_nodes(t), queries, vector_scorer("cosine"), 6, ["vec_id"], ["vec"])


@query("r1_top_k_l2", f"""WITH {MEANS}, sc AS (SELECT mv.label AS qid, vec_id, round(list_distance(vec, embedding::DOUBLE[]), 6) AS score FROM mv, embeddings)
{ranked('sc', 6, direction='ASC')}""")
def r1_top_k_l2(t):
    queries = label_means(t).withColumnRenamed("label", "qid")
    return block_search(vector_nodes(t), queries, vector_scorer("l2"), 6, ["vec_id"], ["vec"])
