"""Retrieval (R rows) and tree moves (T rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import retrieve as rt, tree, vectors as vc
from tessera.operators.nodes import NodeTree
from tessera.operators.ranking import bm25_search, char_search, jaccard_search, query_terms
from tessera.operators.near_cache import NearResultCache
from tessera.operators.projection import ProjectionIndex
from tessera.operators.term_index import TermIndex
from tessera.operators.search import block_search, vector_scorer
from tessera.plans.common import (KEYS, LINE_WORDS, LINES, MEANS, PASSAGES, WORDS, bm25_cte, label_means, line_words,
                                  passages, ranked, vector_nodes)
from tessera.plans.registry import query
from tessera.plans.similarity_plans import CHARS
from tessera.session import cut

COS = "sc AS (SELECT mv.label AS qid, vec_id, round(list_cosine_similarity(vec, embedding::DOUBLE[]), 6) AS score FROM mv, embeddings {0})"
BASE = f"WITH {LINE_WORDS},\n{PASSAGES},\n"
JACC = """nt AS (SELECT doc_id, pos, list_distinct(words) AS ws FROM n), qt AS (SELECT qid, list_distinct(words) AS ws FROM q),
nx AS (SELECT doc_id, pos, unnest(ws) AS term FROM nt), qx AS (SELECT qid, unnest(ws) AS term FROM qt),
sh AS (SELECT qid, doc_id, pos, count(*) AS c FROM qx JOIN nx USING (term) GROUP BY ALL),
jsc AS (SELECT qid, doc_id, pos, round(c / (len(nt.ws) + len(qt.ws) - c)::DOUBLE, 6) AS score FROM sh JOIN nt USING (doc_id, pos) JOIN qt USING (qid)),
jac AS (""" + ranked("jsc", 3, ties="doc_id, pos") + ")"


def _means(t):
    return label_means(t).withColumnRenamed("label", "qid")


@query("r2_score_floor", f"WITH {MEANS}, {COS.format('WHERE round(list_cosine_similarity(vec, embedding::DOUBLE[]), 6) >= 0.4')}\n{ranked('sc', 6)}")
def r2_score_floor(t):
    return block_search(vector_nodes(t), _means(t), vector_scorer("cosine"), 6, ["vec_id"], ["vec"], floor=0.4)


@query("r2_floor_bm25", BASE + bm25_cte(where="WHERE score >= 55.0") + "\nSELECT * FROM hits")
def r2_floor_bm25(t):
    return bm25_search(line_words(t), passages(t), 5, KEYS, floor=55.0)


@query("r3_several_keys", f"""WITH {MEANS},
a AS (SELECT mv.label AS qid, vec_id, round(list_cosine_similarity(vec, embedding::DOUBLE[]), 6) AS score FROM mv, embeddings),
b AS (SELECT mv.label AS qid, vec_id, round(list_cosine_similarity(vec[1:32], embedding[1:32]::DOUBLE[]), 6) AS score FROM mv, embeddings),
u AS (SELECT qid, vec_id, score FROM ({ranked('a', 6)}) UNION ALL SELECT qid, vec_id, score FROM ({ranked('b', 6)})),
sc AS (SELECT qid, vec_id, max(score) AS score FROM u GROUP BY ALL)
{ranked('sc', 6)}""")
def r3_several_keys(t):
    nodes, queries = vector_nodes(t), _means(t)
    front = lambda df: df.withColumn("vec", F.slice("vec", 1, 32))
    full_hits = block_search(nodes, queries, vector_scorer("cosine"), 6, ["vec_id"], ["vec"])
    front_hits = block_search(front(nodes), front(queries), vector_scorer("cosine"), 6, ["vec_id"], ["vec"])
    return rt.merge_keys([full_hits, front_hits], 6, ["vec_id"])


@query("r2_floor_per_key", f"""WITH {MEANS},
a AS (SELECT mv.label AS qid, vec_id, round(list_cosine_similarity(vec, embedding::DOUBLE[]), 6) AS score FROM mv, embeddings),
b AS (SELECT mv.label AS qid, vec_id, round(list_cosine_similarity(vec[1:32], embedding[1:32]::DOUBLE[]), 6) AS score FROM mv, embeddings),
af AS (SELECT * FROM a WHERE score >= 0.35), bf AS (SELECT * FROM b WHERE score >= 0.45),
u AS (SELECT qid, vec_id, score FROM ({ranked('af', 6)}) UNION ALL SELECT qid, vec_id, score FROM ({ranked('bf', 6)})),
sc AS (SELECT qid, vec_id, max(score) AS score FROM u GROUP BY ALL)
{ranked('sc', 6)}""")
def r2_floor_per_key(t):
    """One floor per embedding key, applied before the shared top-k."""
    floors = {"full": 0.35, "front": 0.45}
    views = {"full": lambda df: df, "front": lambda df: df.withColumn("vec", F.slice("vec", 1, 32))}
    hits = [block_search(view(vector_nodes(t)), view(_means(t)), vector_scorer("cosine"), 6, ["vec_id"], ["vec"], floor=floors[key])
            for key, view in views.items()]
    return rt.merge_keys(hits, 6, ["vec_id"])


@query("r4_metadata_filter", BASE.replace("FROM documents)", "FROM documents WHERE lang IN ('en', 'de') AND source IN ('src1', 'src2', 'src3'))")
       + bm25_cte() + "\nSELECT * FROM hits")
def r4_metadata_filter(t):
    nodes = rt.with_metadata(line_words(t, ("lang", "source")), {"lang": ["en", "de"], "source": ["src1", "src2", "src3"]})
    return bm25_search(nodes, passages(t), 5, KEYS)


@query("r5_filter_expression", f"""WITH {MEANS}, {COS.format("WHERE embeddings.label >= 5")}
SELECT qid, vec_id, score FROM ({ranked('sc', 5)})""")
def r5_filter_expression(t):
    nodes = vector_nodes(t).filter("label >= 5")
    hits = block_search(nodes, _means(t), vector_scorer("cosine"), 5, ["vec_id"], ["vec"])
    return hits.select("qid", "vec_id", "score")


GRANTS = """gr AS (SELECT user_id, 'src' || (user_id % 20) AS department, max(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END)::INTEGER AS max_level
  FROM events GROUP BY user_id)"""


def _grants(t):
    level = F.when(F.col("event_type") == "error", 0).otherwise(1)
    return t.events.groupBy("user_id").agg(F.max(level).alias("max_level")).withColumn(
        "department", F.concat(F.lit("src"), (F.col("user_id") % 20).cast("string")))


@query("r6_access_filter", BASE.replace("FROM documents)", """FROM documents LEFT JOIN labels USING (doc_id)
  WHERE EXISTS (SELECT 1 FROM gr WHERE user_id = 8 AND department = source AND coalesce(toxic, 0) <= max_level))""")
       .replace("WITH ", f"WITH {GRANTS}, ", 1) + bm25_cte() + "\nSELECT * FROM hits")
def r6_access_filter(t):
    docs = (t.documents.join(t.labels.select("doc_id", "toxic"), "doc_id", "left")
            .withColumn("level", F.coalesce("toxic", F.lit(0))))
    seen = rt.visible_nodes(docs, _grants(t), user=8, department="source")
    tree_ = NodeTree(seen).group("line", lambda c: tx.pieces(c, "\n"))
    nodes = tree_.nodes("line").drop("grp", "anc").withColumn("words", tx.words(F.col("content")))
    return bm25_search(nodes, passages(t), 5, KEYS)


@query("r6_visible_counts", f"""WITH {GRANTS}, d AS (SELECT source, coalesce(toxic, 0) AS level, count(*) AS n
  FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL)
SELECT user_id, sum(n)::BIGINT AS visible FROM gr JOIN d ON department = source AND level <= max_level GROUP BY user_id""")
def r6_visible_counts(t):
    """Visible documents per user; documents are counted per department and level before the join."""
    level = F.coalesce("toxic", F.lit(0)).alias("level")
    counts = (t.documents.select("doc_id", "source").join(t.labels.select("doc_id", "toxic"), "doc_id", "left")
              .groupBy("source", level).agg(F.count("*").alias("n")))
    joined = _grants(t).join(counts, (F.col("department") == F.col("source")) & (F.col("level") <= F.col("max_level")))
    return joined.groupBy("user_id").agg(F.sum("n").alias("visible"))


@query("r7_several_kbs", f"""WITH {LINES},
tn AS (SELECT conv_id AS doc_id, turn::INTEGER AS pos, text AS content FROM conversations),
n AS (SELECT kb, doc_id, pos, {WORDS.format('content')} AS words FROM (
  SELECT 'documents' AS kb, doc_id, pos, content FROM ln UNION ALL SELECT 'conversations', doc_id, pos, content FROM tn)),
{PASSAGES}, {bm25_cte(keys='kb, doc_id, pos')}
SELECT * FROM hits""")
def r7_several_kbs(t):
    first = line_words(t).select(F.lit("documents").alias("kb"), *KEYS, "words")
    second = t.conversations.select(F.lit("conversations").alias("kb"), F.col("conv_id").alias("doc_id"),
                                    F.col("turn").cast("int").alias("pos"), tx.words(F.col("text")).alias("words"))
    return bm25_search(first.unionByName(second), passages(t), 5, ["kb", *KEYS])


def _routes(t):
    nodes, queries = line_words(t), passages(t)
    return rt.routes_in_order({"bm25": bm25_search(nodes, queries, 3, KEYS),
                               "jaccard": jaccard_search(nodes, queries, 3, KEYS)})


ROUTES = BASE + bm25_cte(k=3) + ",\n" + JACC + """,
routes AS (SELECT *, 0::INTEGER AS route_no, 'bm25' AS route FROM hits UNION ALL SELECT qid, doc_id, pos, score, rk, 1, 'jaccard' FROM jac)
"""


@query("r8_routes", ROUTES + "SELECT * FROM routes")
def r8_routes(t):
    return _routes(t)


@query("r9_merged_routes", ROUTES + """SELECT qid, doc_id, pos, max(score) AS score, string_agg(route, ',' ORDER BY route) AS routes
FROM routes GROUP BY qid, doc_id, pos""")
def r9_merged_routes(t):
    return rt.merged_routes(_routes(t), KEYS)


WCOS = """(CASE WHEN len(list_distinct(n.words)) * len(list_distinct(q.words)) > 0 THEN
  len(list_intersect(list_distinct(n.words), list_distinct(q.words))) / sqrt(len(list_distinct(n.words))::DOUBLE * len(list_distinct(q.words))) ELSE 0 END)"""
SECOND = f"rs AS (SELECT h.qid, h.doc_id, h.pos, round({WCOS}, 6) AS score FROM hits h JOIN n USING (doc_id, pos) JOIN q USING (qid))"


@query("r10_second_stage", BASE + bm25_cte(k=20) + f",\n{SECOND}\n{ranked('rs', 5, ties='doc_id, pos')}")
def r10_second_stage(t):
    nodes, queries = line_words(t), passages(t)
    return rt.second_stage(bm25_search(nodes, queries, 20, KEYS), nodes, queries, tx.word_cosine, 5, KEYS)


@query("r11_nested_routes", BASE + bm25_cte(k=20) + f",\n{JACC},\n{SECOND}, rr AS ({ranked('rs', 3, ties='doc_id, pos')})"
       " SELECT qid, doc_id, pos, score, rk, 0::INTEGER AS route_no, 'reranked' AS route FROM rr"
       " UNION ALL SELECT qid, doc_id, pos, score, rk, 1, 'plain' FROM jac")
def r11_nested_routes(t):
    nodes, queries = line_words(t), passages(t)
    best = rt.second_stage(bm25_search(nodes, queries, 20, KEYS), nodes, queries, tx.word_cosine, 3, KEYS)
    return rt.routes_in_order({"reranked": best, "plain": jaccard_search(nodes, queries, 3, KEYS)})


def _hit_texts(t, k=3):
    nodes = line_words(t)
    return bm25_search(nodes, passages(t), k, KEYS).join(nodes.select(*KEYS, "content"), KEYS)


HIT_TEXTS = BASE + bm25_cte(k=3) + ",\nht AS (SELECT hits.*, content FROM hits JOIN n USING (doc_id, pos))\n"


@query("r12_output_join", HIT_TEXTS + "SELECT qid, string_agg(content, ' | ' ORDER BY rk) AS output FROM ht GROUP BY qid")
def r12_output_join(t):
    return rt.joined_output(_hit_texts(t), separator=" | ")


@query("r12_output_dict", HIT_TEXTS + "SELECT qid, rk, to_json({'doc_id': doc_id, 'pos': pos, 'content': content})::VARCHAR AS output FROM ht")
def r12_output_dict(t):
    return rt.dict_output(_hit_texts(t), ["doc_id", "pos", "content"]).select("qid", "rk", "output")


@query("r13_context", HIT_TEXTS + """SELECT qid, coalesce(c, '') AS context_str, q.text AS query FROM q LEFT JOIN (
  SELECT qid, string_agg(content, chr(10) ORDER BY rk) AS c FROM ht GROUP BY qid) USING (qid)""")
def r13_context(t):
    return rt.context_record(_hit_texts(t), passages(t))


@query("r14_references", f"""WITH {LINE_WORDS}, {PASSAGES}, {bm25_cte(k=3)},
pn AS (SELECT page_id, url, {WORDS.format('html')} AS words FROM pages),
{bm25_cte(n='pn', keys='page_id', k=2, out='ph')},
a AS (SELECT qid, string_agg(chr(10) || 'Ref' || rk || ': ' || content, chr(10) ORDER BY rk) AS refs FROM hits JOIN n USING (doc_id, pos) GROUP BY qid),
b AS (SELECT qid, count(*)::INTEGER AS m, string_agg('(' || rk || ') ' || trim(url), chr(10) ORDER BY rk) AS imgs FROM ph JOIN pn USING (page_id) WHERE score > 0.015 GROUP BY qid)
SELECT qid, concat_ws(chr(10), '[question]' || chr(10) || q.text || chr(10), '[references]' || chr(10) || refs || chr(10),
  '[images]' || chr(10) || imgs || chr(10)) AS context_str, coalesce(m, 0)::INTEGER AS n_images
FROM q LEFT JOIN a USING (qid) LEFT JOIN b USING (qid) WHERE refs IS NOT NULL OR imgs IS NOT NULL""")
def r14_references(t):
    texts = _hit_texts(t).select("qid", "rk", F.lit("text").alias("kind"), "content", "score")
    pages = t.pages.select("page_id", "url", tx.words(F.col("html")).alias("words"))
    found = bm25_search(pages, passages(t), 2, ["page_id"]).join(pages.select("page_id", "url"), "page_id")
    images = found.select("qid", "rk", F.lit("image").alias("kind"), F.col("url").alias("content"), "score")
    return rt.numbered_context(texts.unionByName(images), passages(t))


@query("r15_exact_lookup", f"WITH {LINES}, ql AS (SELECT DISTINCT item_id, unnest(string_split(text, chr(10))) AS line FROM benchmark)"
       " SELECT item_id, line, doc_id, pos FROM ql JOIN ln ON line = content WHERE line <> ''")
def r15_exact_lookup(t):
    queries = t.benchmark.select("item_id", F.explode(tx.pieces(F.col("text"), "\n")).alias("line")).distinct()
    return rt.exact_lookup(queries, line_words(t).drop("words"), "line")


TERMS = f"tm AS (SELECT doc_id, lang, term, count(*) AS tf FROM (SELECT doc_id, lang, unnest({WORDS.format('text')}) AS term FROM documents) GROUP BY ALL)"


@query("r16_index_delta", f"""WITH {TERMS}
SELECT term, count(*) AS df, sum(tf)::BIGINT AS total FROM tm WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) GROUP BY term""")
def r16_index_delta(t):
    """French documents arrive later and toxic ones leave; equals an index built from what is left."""
    docs = t.documents.select("doc_id", "lang", tx.words(F.col("text")).alias("words"))
    old = cut(rt.postings(docs.filter("lang <> 'fr'"), ["doc_id"]))  # the stored index
    added = rt.postings(docs.filter("lang = 'fr'").join(t.labels.filter("toxic = 1"), "doc_id", "left_anti"), ["doc_id"])
    removed = t.labels.filter("toxic = 1").select("doc_id")
    index, df = rt.updated_index(old, rt.document_frequency(old), added, removed, ["doc_id"])
    total = index.groupBy("term").agg(F.sum("tf").alias("total"))
    return df.join(total, "term")


@query("r16_index_search", f"""WITH {LINE_WORDS.replace("FROM documents)", "FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1))")},
{PASSAGES}, {bm25_cte()} SELECT * FROM hits""")
def r16_index_search(t):
    """French documents arrive later and toxic ones leave; the stored segments answer, equal to a search over what is left."""
    nodes = line_words(t, keep=("lang",)).select(*KEYS, "words", "lang")
    toxic = t.labels.filter("toxic = 1").select("doc_id")
    index = TermIndex(t.spark)
    index.commit(1, nodes.filter("lang <> 'fr' or lang is null").drop("lang"))
    index.commit(2, nodes.filter("lang = 'fr'").drop("lang").join(toxic, "doc_id", "left_anti"), toxic)
    return index.search(passages(t), 5)


@query("r17_partitioned_search")
def r17_partitioned_search(t):
    """Approximate search: 8 stored cells, 4 read per query."""
    nodes = vector_nodes(t)
    model = vc.train_cells(nodes, 8)
    return vc.cell_search(vc.write_cells(nodes, model, ["vec_id"]), model, _means(t), 10, ["vec_id"], nprobe=4)


@query("r17_projection_search", "SELECT DISTINCT label AS qid, 10 AS n, true AS recall_reached FROM embeddings WHERE label IS NOT NULL")
def r17_projection_search(t):
    """Random-projection buckets against the exact top 10: whether the mean recall over all queries reaches 0.8."""
    nodes, queries = vector_nodes(t).select("vec_id", "vec"), _means(t)
    index = ProjectionIndex(t.spark, ["vec_id"], tables=8, directions=2, length=0.1)
    index.write(nodes)
    exact = block_search(nodes, queries, vector_scorer("cosine"), 10, ["vec_id"], ["vec"]).select("qid", "vec_id")
    found = cut(index.search(queries, 10).select("qid", "vec_id", F.lit(1).alias("hit")))
    recall = exact.join(found, ["qid", "vec_id"], "left").agg(F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))
    per_query = found.groupBy("qid").agg(F.count("*").cast("int").alias("n"))
    return per_query.withColumn("recall_reached", recall.scalar() >= 0.8)


@query("r18_result_cache", BASE + bm25_cte(k=3) + """
SELECT qid, doc_id, pos, score, rk FROM hits""")
def r18_result_cache(t):
    """Long passages are answered first; the second run searches only the others."""
    nodes, queries = line_words(t), passages(t)
    cache = rt.ResultCache(t.spark)
    search = lambda q: bm25_search(nodes, q, 3, KEYS)
    cache.answer(queries.filter(F.length("text") > 200), "v1", search)
    return cache.answer(queries, "v1", search).select("qid", *KEYS, "score", "rk")


LETTERS = "abcdefghijklmnopqrstuvwxyz"
COUNTED = "list_transform(string_split('a b c d e f g h i j k l m n o p q r s t u v w x y z', ' '), lambda c: (length({0}) - length(replace({0}, c, '')))::DOUBLE)"
MORE = " the of and"


@query("r18_near_queries", f"""WITH {LINE_WORDS}, q0 AS (SELECT item_id AS id, text, lower(text) AS low FROM benchmark),
q AS (SELECT id AS qid, {WORDS.format('text')} AS words FROM q0 UNION ALL SELECT id + 1000000, {WORDS.format(f"text || '{MORE}'")} FROM q0),
v AS (SELECT id, {COUNTED.format('low')} AS v, {COUNTED.format(f"(low || '{MORE}')")} AS w FROM q0),
near AS (SELECT b.id + 1000000 AS qid, a.id AS source, row_number() OVER (PARTITION BY b.id ORDER BY round(list_cosine_similarity(b.w, a.v), 9) DESC, a.id::VARCHAR) AS n
  FROM v a JOIN v b ON round(list_cosine_similarity(b.w, a.v), 9) >= 0.99),
{bm25_cte(k=3)}
SELECT qid, doc_id, pos, score, rk, false AS saved FROM hits WHERE qid >= 1000000 AND qid NOT IN (SELECT qid FROM near)
UNION ALL SELECT near.qid, doc_id, pos, score, rk, true FROM near JOIN hits ON hits.qid = source WHERE n = 1""")
def r18_near_queries(t):
    """The passages are answered; then they come with some words more. Near enough by their letters, they get the saved hits."""
    nodes = line_words(t)
    counts = lambda c: F.array(*[(F.length(c) - F.length(F.replace(c, F.lit(x), F.lit("")))).cast("double") for x in LETTERS])
    asked = lambda shift, text: t.benchmark.select((F.col("item_id") + shift).alias("qid"), text.alias("text")).select(
        "qid", tx.words(F.col("text")).alias("words"), counts(F.lower("text")).alias("vec"))
    cache = NearResultCache(t.spark, limit=0.99)
    search = lambda q: bm25_search(nodes, q, 3, KEYS)
    cache.answer(asked(0, F.col("text")), "v1", search)
    again = cut(asked(1000000, F.concat("text", F.lit(MORE))))
    near = cut(cache.matches(again, "v1").select("qid", F.lit(True).alias("saved")))
    hits = cache.answer(again, "v1", search).select("qid", *KEYS, "score", "rk")
    return hits.join(near, "qid", "left").withColumn("saved", F.coalesce("saved", F.lit(False)))


@query("r19_many_queries", f"""WITH {LINE_WORDS},
q AS (SELECT conv_id * 1000000 + turn AS qid, {WORDS.format('text')} AS words FROM conversations WHERE role = 'user'),
{bm25_cte(k=3)}
SELECT * FROM hits""")
def r19_many_queries(t):
    """Every user turn is a query."""
    turns = t.conversations.filter("role = 'user'").select(
        (F.col("conv_id") * 1000000 + F.col("turn")).alias("qid"), tx.words(F.col("text")).alias("words"))
    return bm25_search(line_words(t), turns, 3, KEYS)


@query("r20_synonyms", f"""WITH {LINE_WORDS}, q0 AS (SELECT item_id AS qid, unnest({WORDS.format('text')}) AS term FROM benchmark),
sy AS (SELECT DISTINCT term, regexp_replace(term, '[.,]$', '') AS synonym FROM q0 WHERE term SIMILAR TO '.+[.,]'),
q AS (SELECT qid, list(term) AS words FROM (SELECT qid, term FROM q0 UNION SELECT qid, synonym FROM q0 JOIN sy USING (term)) GROUP BY qid),
{bm25_cte()}
SELECT * FROM hits""")
def r20_synonyms(t):
    """Synonyms here: a word that ends with a mark and the bare word."""
    terms = query_terms(passages(t))
    synonyms = terms.filter(F.col("term").rlike("^.+[.,]$")).select(
        "term", F.regexp_replace("term", "[.,]$", "").alias("synonym")).distinct()
    wide = rt.expanded_terms(terms, synonyms).groupBy("qid").agg(F.collect_list("term").alias("words"))
    return bm25_search(line_words(t), wide, 5, KEYS)


@query("r21_templates", r"""SELECT item_id, regexp_replace(regexp_replace(text, '^([^ \n]+) is ([^ \n]+)', 'What is the definition of \1 \2?'),
  '^([^ \n]+) ([^ \n]+) (and|of|the) ', 'Explain \1 \2: ') AS text FROM benchmark""")
def r21_templates(t):
    rules = [(r"^([^ \n]+) is ([^ \n]+)", "What is the definition of $1 $2?"),
             (r"^([^ \n]+) ([^ \n]+) (and|of|the) ", "Explain $1 $2: ")]
    return t.benchmark.select("item_id", rt.rewritten(F.col("text"), rules).alias("text"))


@query("r22_sub_questions", f"""WITH {LINE_WORDS},
sq AS (SELECT item_id AS parent, trim(unnest(string_split_regex(text, '\\n| and '))) AS text FROM benchmark),
s2 AS (SELECT *, row_number() OVER () AS qid FROM sq WHERE text <> ''),
q AS (SELECT qid, {WORDS.format('text')} AS words FROM s2),
{bm25_cte(k=3)},
m AS (SELECT parent AS qid, doc_id, pos, max(score) AS score FROM hits JOIN s2 USING (qid) GROUP BY ALL)
{ranked('m', 5, ties='doc_id, pos')}""".replace("\\\\n", "\\n"))
def r22_sub_questions(t):
    subs = rt.sub_questions(t.benchmark.withColumnRenamed("item_id", "parent"), "\n| and ", qid="parent")
    subs = subs.withColumn("qid", F.concat_ws(":", "parent", "sub"))
    hits = bm25_search(line_words(t), subs.select("qid", tx.words(F.col("text")).alias("words")), 3, KEYS)
    per_parent = hits.withColumn("parent", F.split("qid", ":")[0].cast("bigint")).drop("qid", "rk")
    return tree.to_target(per_parent.withColumnRenamed("parent", "qid"), KEYS).filter("rk <= 5")


@query("r23_history_query", f"""WITH {LINE_WORDS}, w AS (SELECT DISTINCT conv_id AS qid, unnest({WORDS.format('text')}) AS term FROM conversations),
q AS (SELECT qid, list(term) AS words FROM w GROUP BY qid), {bm25_cte(k=3)}
SELECT * FROM hits""")
def r23_history_query(t):
    """The whole session is the query: its distinct words, combined before the shuffle."""
    words = t.conversations.select(F.col("conv_id").alias("qid"), F.explode(tx.words(F.col("text"))).alias("term")).distinct()
    return bm25_search(line_words(t), words.groupBy("qid").agg(F.collect_list("term").alias("words")), 3, KEYS)


@query("r24_duplicate_check", f"""WITH {CHARS},
st AS (SELECT count(*) + 1 AS n FROM documents),
df AS (SELECT ch, count(*) AS df FROM nc GROUP BY ch),
w0 AS (SELECT ch, ln((1 + n) / (1.0 + df)) + 1 AS w0 FROM df, st),
nn AS (SELECT doc_id, sum(tf * tf * w0 * w0) AS s0 FROM nc JOIN w0 USING (ch) GROUP BY doc_id),
qq AS (SELECT qid, ch, tf, ln((1 + n) / (2.0 + coalesce(df, 0))) + 1 AS w1 FROM qc LEFT JOIN df USING (ch), st),
qn AS (SELECT qid, sum(tf * tf * w1 * w1) AS sq FROM qq GROUP BY qid),
x AS (SELECT qid, doc_id, sum(qq.tf * nc.tf * qq.w1 * qq.w1) AS d, sum(nc.tf * nc.tf * (qq.w1 * qq.w1 - w0.w0 * w0.w0)) AS fix
  FROM qq JOIN nc USING (ch) JOIN w0 USING (ch) GROUP BY qid, doc_id),
sc AS (SELECT qid, doc_id, round(d / (sqrt(s0 + fix) * sqrt(sq)), 6) AS score FROM x JOIN nn USING (doc_id) JOIN qn USING (qid)),
best AS ({ranked('sc', 1, ties='doc_id')})
SELECT item_id AS qid, coalesce(score > 0.9, false) AS matched FROM benchmark LEFT JOIN best ON item_id = qid""")
def r24_duplicate_check(t):
    nodes = t.documents.select("doc_id", tx.packed(F.col("text")).alias("packed"))
    queries = t.benchmark.select(F.col("item_id").alias("qid"), tx.packed(F.col("text")).alias("packed"))
    hits = char_search(nodes, queries, 1, ["doc_id"])
    return queries.select("qid").join(hits, "qid", "left").select(
        "qid", F.coalesce(F.col("score") > 0.9, F.lit(False)).alias("matched"))


@query("r25_cross_modal", f"""WITH {MEANS}, {COS.format("WHERE mv.label < 5 AND embeddings.label >= 5")}
{ranked('sc', 5)}""")
def r25_cross_modal(t):
    """Labels below 5 play the texts, the others the images of one vector space."""
    kind = F.when(F.col("label") < 5, "text").otherwise("image")
    nodes = vector_nodes(t).withColumn("kind", kind).filter("kind = 'image'")
    queries = label_means(t).withColumn("kind", kind).filter("kind = 'text'").withColumnRenamed("label", "qid")
    return block_search(nodes, queries, vector_scorer("cosine"), 5, ["vec_id"], ["vec"])


# ---- trees -------------------------------------------------------------------------------------

def _tree(t):
    return (NodeTree(t.documents).group("line", lambda c: tx.pieces(c, "\n"))
            .group("sentence", lambda c: tx.pieces(c, "."), parent="line")
            .group("clause", lambda c: tx.pieces(c, ","), parent="sentence"))


SENTENCES = LINES + """,
sn AS (SELECT doc_id, p1, content, (row_number() OVER (PARTITION BY doc_id ORDER BY p1, i) - 1)::INTEGER AS pos FROM (
  SELECT doc_id, pos AS p1, unnest(range(0, len(s))) AS i, unnest(s) AS content FROM (
    SELECT doc_id, pos, list_filter(string_split(content, '.'), lambda p: p <> '') AS s FROM ln)))"""
SENT_HITS = f"WITH {SENTENCES}, n AS (SELECT doc_id, pos, p1, content, {WORDS.format('content')} AS words FROM sn), {PASSAGES}, {bm25_cte(k=5)}\n"


def _sentence_hits(t):
    nodes = _tree(t).nodes("sentence").withColumn("words", tx.words(F.col("content")))
    hits = bm25_search(nodes, passages(t), 5, KEYS)
    return hits.join(nodes.select(*KEYS, "anc"), KEYS)


@query("t1_parent", SENT_HITS + "SELECT h.qid, h.doc_id, h.pos, n.p1 AS parent_pos, ln.content AS parent_content FROM hits h "
       "JOIN n USING (doc_id, pos) JOIN ln ON ln.doc_id = h.doc_id AND ln.pos = n.p1")
def t1_parent(t):
    up = tree.parents(_sentence_hits(t), _tree(t).nodes("line"))
    return up.select("qid", "doc_id", "pos", "parent_pos", "parent_content")


@query("t2_root", SENT_HITS + "SELECT DISTINCT doc_id FROM hits")
def t2_root(t):
    return tree.roots(_sentence_hits(t))


@query("t3_descendants", f"""WITH {SENTENCES}, n AS (SELECT doc_id, pos, content, {WORDS.format('content')} AS words FROM ln), {PASSAGES}, {bm25_cte(k=5)},
h AS (SELECT DISTINCT doc_id, pos FROM hits),
cl AS (SELECT doc_id, p1, pos AS p2, unnest(range(0, len(s))) AS i, unnest(s) AS content FROM (
  SELECT doc_id, p1, pos, list_filter(string_split(content, ','), lambda p: p <> '') AS s FROM sn))
SELECT h.doc_id, h.pos AS hit_pos, (row_number() OVER (PARTITION BY h.doc_id, h.pos ORDER BY p2, i) - 1)::INTEGER AS nth, content
FROM cl JOIN h ON h.doc_id = cl.doc_id AND h.pos = p1""")
def t3_descendants(t):
    hits = bm25_search(line_words(t), passages(t), 5, KEYS)
    below = tree.descendants(hits, _tree(t).nodes("clause"), depth=0)
    first = below.groupBy("doc_id", "hit_pos").agg(F.min("pos").alias("first_pos"))
    return below.join(first, ["doc_id", "hit_pos"]).select(
        "doc_id", "hit_pos", (F.col("pos") - F.col("first_pos")).alias("nth"), "content")


@query("t4_target", SENT_HITS + """, g AS (SELECT qid, doc_id, p1 AS pos, max(score) AS score FROM hits JOIN n USING (doc_id, pos) GROUP BY ALL)
SELECT qid, doc_id, pos, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id, pos)::INTEGER AS rk FROM g""")
def t4_target(t):
    """Search sentences, return lines."""
    hits = _sentence_hits(t).withColumn("pos", F.element_at("anc", -1))
    return tree.to_target(hits, KEYS)
