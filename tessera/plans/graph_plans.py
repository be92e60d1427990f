"""Knowledge graph (G rows)."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from tessera.functions import text as tx
from tessera.operators import communities as cm, graph as gr
from tessera.operators.ranking import bm25_search
from tessera.plans.common import KEYS, LINE_WORDS, PASSAGES, bm25_cte, line_words, passages
from tessera.operators.graph_store import StoredGraph
from tessera.operators.modularity import leveled_communities
from tessera.plans.registry import query
from tessera.session import cut

ROUNDS = 3

# ---- SQL pieces --------------------------------------------------------------------------------

NAMES = "list_filter(regexp_extract_all({0}, '(\\p{{Lu}}\\p{{Ll}}{{2,}})', 1), lambda x, i: list_position(regexp_extract_all({0}, '(\\p{{Lu}}\\p{{Ll}}{{2,}})', 1), x) = i)"
MENTIONS = f"""nl AS (SELECT doc_id, pos, lang, source, {NAMES.format('content')} AS ns FROM n JOIN (SELECT doc_id, lang, source FROM documents) USING (doc_id)),
mt AS (SELECT doc_id, pos, lang, source, unnest(ns) AS name FROM nl),
lk AS (SELECT doc_id, pos, lang, least(ns[i], ns[i + 1]) AS src, greatest(ns[i], ns[i + 1]) AS tgt FROM (SELECT *, unnest(range(1, len(ns))) AS i FROM nl)),
rel AS (SELECT src, tgt, count(*) AS weight FROM lk GROUP BY src, tgt),
deg AS (SELECT name, count(*) AS degree FROM (SELECT src AS name FROM rel UNION ALL SELECT tgt FROM rel) GROUP BY name)"""
BASE = f"WITH {LINE_WORDS},\n{PASSAGES},\n{MENTIONS}"
BASE_R = BASE.replace("WITH ", "WITH RECURSIVE ", 1)
SEEDS = f"""sd AS (SELECT qid, name, place FROM (SELECT qid, unnest(ns) AS name, unnest(range(0, len(ns))) AS place FROM (SELECT qid, {NAMES.format('text')} AS ns FROM q))
  WHERE name IN (SELECT name FROM mt))"""


def _low(k: int) -> str:
    return f"""lf AS (SELECT qid, src, tgt, max(weight) AS score FROM sd JOIN rel ON name = src OR name = tgt GROUP BY ALL),
lo AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, src, tgt)::INTEGER AS rk FROM lf) WHERE rk <= {k})"""


def _chunks(hits: str, k: int, out: str) -> str:
    return f"""{out}_b AS (SELECT qid, doc_id, pos, min(rk) AS score FROM {hits} JOIN lk USING (src, tgt) GROUP BY ALL),
{out} AS (SELECT qid, doc_id, pos, rk FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score, doc_id, pos)::INTEGER AS rk FROM {out}_b) WHERE rk <= {k})"""


def _ends(hits: str, out: str) -> str:
    return f"""{out}_e AS (SELECT qid, src AS name, rk, 0 AS side FROM {hits} UNION ALL SELECT qid, tgt, rk, 1 FROM {hits}),
{out} AS (SELECT qid, name, row_number() OVER (PARTITION BY qid ORDER BY o)::INTEGER AS rk FROM (SELECT qid, name, min(rk * 2 + side) AS o FROM {out}_e GROUP BY ALL))"""


HIGH = "rn AS (SELECT src, tgt, [lower(src), lower(tgt)] AS words FROM rel),\n" + bm25_cte(n="rn", keys="src, tgt", k=60, out="hi")
EDGES2 = "e2 AS (SELECT src AS a, tgt AS b, weight AS w FROM rel WHERE src <> tgt UNION ALL SELECT tgt, src, weight FROM rel WHERE src <> tgt)"
COMPONENTS = EDGES2 + """,
cc(node, comp) USING KEY (node) AS (SELECT DISTINCT a, a FROM e2 UNION (
  SELECT u.node, min(v.comp) FROM recurring.cc AS u JOIN e2 ON u.node = e2.a JOIN cc AS v ON v.node = e2.b WHERE v.comp < u.comp GROUP BY u.node))"""


def _labels() -> str:
    parts = ["l0 AS (SELECT DISTINCT a AS node, a AS label FROM e2)"]
    for i in range(ROUNDS):
        parts.append(f"""v{i} AS (SELECT node, label, sum(w) AS w FROM (SELECT e2.a AS node, label, w FROM e2 JOIN l{i} ON l{i}.node = e2.b UNION ALL SELECT node, label, 1 FROM l{i}) GROUP BY ALL),
l{i + 1} AS (SELECT node, label FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY w DESC, label) AS r FROM v{i}) WHERE r = 1)""")
    return ",\n".join(parts)


MEMBERS = COMPONENTS + ",\n" + _labels() + f""",
mem AS (SELECT node, 0::INTEGER AS level, comp AS community FROM cc UNION ALL SELECT node, 1, label FROM l{ROUNDS})"""
TABLE = MEMBERS + """,
sz AS (SELECT level, community, count(*) AS n_entities FROM mem GROUP BY ALL),
ri AS (SELECT a.level, a.community, count(*) AS n_relations FROM rel JOIN mem a ON src = a.node JOIN mem b ON tgt = b.node AND a.level = b.level AND a.community = b.community WHERE src <> tgt GROUP BY ALL),
ck AS (SELECT level, community, count(DISTINCT (doc_id, pos)) AS n_chunks FROM mem JOIN mt ON node = name GROUP BY ALL),
sm AS (SELECT level, community, string_agg(node, ' ' ORDER BY r) AS summary FROM (SELECT level, community, node, row_number() OVER (PARTITION BY level, community ORDER BY degree DESC, node) AS r
  FROM mem JOIN deg ON node = name) WHERE r <= 10 GROUP BY ALL),
ct AS (SELECT level, community, n_entities, coalesce(n_relations, 0) AS n_relations, coalesce(n_chunks, 0) AS n_chunks, summary
  FROM sz LEFT JOIN ri USING (level, community) LEFT JOIN ck USING (level, community) LEFT JOIN sm USING (level, community))"""

# ---- inputs ------------------------------------------------------------------------------------


def _chunks_df(t):
    return line_words(t, ("lang", "source"))


def _links(t):
    return gr.links(_chunks_df(t), ("lang",))


class _Stored:
    """The graph tables of one query, written once: the texts are read twice however often they are used."""

    def __init__(self, t):
        chunks = _chunks_df(t)
        self.mentions = cut(gr.mentions(chunks))
        self.links = cut(gr.links(chunks))
        self.relations = cut(self.links.groupBy("src", "tgt").agg(F.count("*").alias("weight")))
        self.entities = cut(self.mentions.select("name").distinct())
        self.queries = passages(t)

    def seeds(self):
        return gr.query_entities(self.queries, self.entities)

    def high(self, k=60):
        words = F.array(F.lower("src"), F.lower("tgt")).alias("words")
        return bm25_search(self.relations.select("src", "tgt", words), self.queries, k, ["src", "tgt"])

    def edges(self):
        return self.relations.filter("src <> tgt")


def _relations(t):
    return _links(t).groupBy("src", "tgt").agg(F.count("*").alias("weight"))


def _entities(t):
    return gr.mentions(_chunks_df(t)).select("name").distinct()


# ---- extraction and merging --------------------------------------------------------------------

@query("g1_entities", """SELECT c_custkey, 'Customer ' || c_custkey AS name, 'customer' AS type, c_mktsegment || ' buyer' AS description FROM customer
UNION ALL SELECT c_custkey, 'NATION_' || c_nationkey, 'nation', 'home of customer ' || c_custkey FROM customer WHERE c_acctbal >= 0""")
def g1_entities(t):
    tuples = gr.parsed_tuples(_extraction(t), "text", ("c_custkey",))
    return gr.parsed_entities(tuples, ("c_custkey",))


@query("g1_relations", """SELECT c_custkey, 'Customer ' || c_custkey AS src, 'NATION_' || c_nationkey AS tgt, 'lives in' AS description, 'home,residence' AS keywords,
(c_custkey % 10)::DOUBLE AS weight FROM customer WHERE c_acctbal >= 0""")
def g1_relations(t):
    tuples = gr.parsed_tuples(_extraction(t), "text", ("c_custkey",))
    return gr.parsed_relations(tuples, ("c_custkey",))


def _extraction(t):
    """Extraction texts written from the customers; a negative balance breaks two of the tuples."""
    c, n = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    weight = (F.col("c_custkey") % 10).cast("string")
    whole = F.concat(F.lit('("entity"<|>"NATION_'), n, F.lit('"<|>"nation"<|>"home of customer '), c, F.lit('")##\n("relationship"<|>"Customer '), c,
                     F.lit('"<|>"NATION_'), n, F.lit('"<|>"lives in"<|>"home,residence"<|>'), weight, F.lit(")"))
    broken = F.concat(F.lit('("entity"<|>"NATION_'), n, F.lit('"<|>"nation")##("relationship"<|>"Customer '), c, F.lit('"<|>"x"<|>"y"<|>"z"<|>heavy)'))
    text = F.concat(F.lit('("entity"<|>"Customer '), c, F.lit('"<|>"customer"<|>"'), F.col("c_mktsegment"), F.lit(' buyer")##'),
                    F.when(F.col("c_acctbal") >= 0, whole).otherwise(broken), F.lit("<|COMPLETE|>"))
    return t.customer.select("c_custkey", text.alias("text"))


@query("g2_relations", f"{BASE} SELECT * FROM rel")
def g2_relations(t):
    return _relations(t)


@query("g2_entities", f"{BASE} SELECT name, count(*) AS n_chunks FROM mt GROUP BY name")
def g2_entities(t):
    return gr.mentions(_chunks_df(t)).groupBy("name").agg(F.count("*").alias("n_chunks"))


def _entity_rows(t):
    rows = gr.mentions(_chunks_df(t), ("lang", "source"))
    return rows.select("name", F.col("lang").alias("type"), F.col("source").alias("description"),
                       F.concat_ws(":", "doc_id", "pos").alias("chunk"))


@query("g3_entities", f"""{BASE}, ty AS (SELECT name, lang, row_number() OVER (PARTITION BY name ORDER BY count(*) DESC, lang) AS r FROM mt GROUP BY name, lang)
SELECT name, lang AS type, n_descriptions, n_chunks FROM ty JOIN (SELECT name, count(DISTINCT source) AS n_descriptions, count(DISTINCT (doc_id, pos)) AS n_chunks FROM mt GROUP BY name) USING (name) WHERE r = 1""")
def g3_entities(t):
    return gr.merged_entities(_entity_rows(t))


@query("g3_descriptions", f"{BASE} SELECT name, source AS description, count(*) AS n FROM mt GROUP BY name, source")
def g3_descriptions(t):
    return gr.entity_descriptions(_entity_rows(t))


@query("g4_relations", f"""{BASE} SELECT src, tgt, count(*)::DOUBLE AS weight, count(DISTINCT lang) AS n_keywords, count(DISTINCT (doc_id, pos)) AS n_chunks FROM lk GROUP BY src, tgt""")
def g4_relations(t):
    rows = _links(t).select("src", "tgt", F.lit(1.0).alias("weight"), F.col("lang").alias("keyword"), F.concat_ws(":", "doc_id", "pos").alias("chunk"))
    return gr.merged_relations(rows)


@query("g4_keywords", f"{BASE} SELECT src, tgt, lang AS keyword, count(*) AS n FROM lk WHERE lang IS NOT NULL GROUP BY ALL")
def g4_keywords(t):
    return gr.relation_values(_links(t).withColumnRenamed("lang", "keyword"), ["keyword"])


@query("g4_chunks", f"{BASE} SELECT src, tgt, doc_id, pos, count(*) AS n FROM lk GROUP BY ALL")
def g4_chunks(t):
    return gr.relation_values(_links(t), gr.CHUNK)


@query("g5_degrees", f"{BASE} SELECT name, degree FROM deg")
def g5_degrees(t):
    return gr.degrees(_relations(t))


@query("g5_isolated", f"{BASE} SELECT DISTINCT name FROM mt WHERE name NOT IN (SELECT name FROM deg)")
def g5_isolated(t):
    return gr.isolated(_entities(t), _relations(t))


# ---- search ------------------------------------------------------------------------------------

@query("g6_low_level", f"{BASE}, {SEEDS}, {_low(60)}, {_chunks('lo', 20, 'co')} SELECT * FROM co")
def g6_low_level(t):
    g = _Stored(t)
    return gr.chunks_of(cut(gr.low_level(g.seeds(), g.relations)), g.links, 20)


@query("g6_relations", f"{BASE}, {SEEDS}, {_low(60)} SELECT qid, src, tgt, score, rk FROM lo")
def g6_relations(t):
    g = _Stored(t)
    return gr.low_level(g.seeds(), g.relations)


@query("g7_high_level", f"{BASE}, {HIGH}, {_ends('hi', 'en')}, {_chunks('hi', 20, 'ch')} SELECT qid, 'entity' AS kind, name AS item, rk FROM en UNION ALL SELECT qid, 'chunk', doc_id || ':' || pos, rk FROM ch")
def g7_high_level(t):
    g = _Stored(t)
    hits = cut(g.high())
    ends = gr.ends_of(hits).select("qid", F.lit("entity").alias("kind"), F.col("name").alias("item"), "rk")
    chunks = gr.chunks_of(hits, g.links, 20).select("qid", F.lit("chunk").alias("kind"), F.concat_ws(":", "doc_id", "pos").alias("item"), "rk")
    return ends.unionByName(chunks)


@query("g8_budget", f"""{BASE}, {HIGH}, {_chunks('hi', 20, 'ch')},
b AS (SELECT qid, doc_id, pos, rk, (sum(len(words)) OVER (PARTITION BY qid ORDER BY rk))::BIGINT AS used FROM ch JOIN n USING (doc_id, pos))
SELECT * FROM b WHERE used <= 300""")
def g8_budget(t):
    g = _Stored(t)
    chunks = gr.chunks_of(cut(g.high()), g.links, 20).join(line_words(t).select(*KEYS, "words"), KEYS)
    return gr.within_budget(chunks, F.size("words"), 300).select("qid", *KEYS, "rk", "used")


CONTEXT = f"""{SEEDS}, {_low(10)}, {_chunks('lo', 5, 'co')}, {_ends('lo', 'en')},
je AS (SELECT qid, to_json(list({{'name': name, 'degree': degree}} ORDER BY rk))::VARCHAR AS entities FROM en JOIN deg USING (name) GROUP BY qid),
jr AS (SELECT qid, to_json(list({{'src': src, 'tgt': tgt, 'score': score}} ORDER BY rk))::VARCHAR AS relations FROM lo GROUP BY qid),
jc AS (SELECT qid, to_json(list({{'doc_id': doc_id, 'pos': pos}} ORDER BY rk))::VARCHAR AS chunks FROM co GROUP BY qid)"""


def _context(t):
    g = _Stored(t)
    hits = cut(gr.low_level(g.seeds(), g.relations, 10))
    ends = gr.ends_of(hits).join(gr.degrees(g.relations), "name")
    chunks = gr.chunks_of(hits, g.links, 5)
    return (gr.json_list(ends, ["name", "degree"], "entities").join(gr.json_list(hits, ["src", "tgt", "score"], "relations"), "qid")
            .join(gr.json_list(chunks, ["doc_id", "pos"], "chunks"), "qid"))


@query("g9_context", f"{BASE}, {CONTEXT} SELECT qid, entities, relations, chunks FROM je JOIN jr USING (qid) JOIN jc USING (qid)")
def g9_context(t):
    return _context(t)


@query("g10_hybrid_context", f"""{BASE}, {CONTEXT}, {bm25_cte(k=3)},
bt AS (SELECT qid, string_agg(content, '' ORDER BY rk) AS c FROM hits JOIN n USING (doc_id, pos) GROUP BY qid)
SELECT qid, concat_ws(chr(10), 'Graph:', entities, relations, chunks, 'Text:', c) AS context_str, q.text AS query FROM je JOIN jr USING (qid) JOIN jc USING (qid) JOIN bt USING (qid) JOIN q USING (qid)""")
def g10_hybrid_context(t):
    from tessera.operators.retrieve import joined_output

    nodes = line_words(t)
    hits = bm25_search(nodes, passages(t), 3, KEYS).join(nodes.select(*KEYS, "content"), KEYS)
    both = _context(t).join(joined_output(hits), "qid").join(passages(t).select("qid", F.col("text").alias("query")), "qid")
    return both.select("qid", F.concat_ws("\n", F.lit("Graph:"), "entities", "relations", "chunks", F.lit("Text:"), "output").alias("context_str"), "query")


@query("g11_incremental", f"{BASE} SELECT * FROM rel")
def g11_incremental(t):
    """French chunks arrive after the rest; equals the graph of all chunks."""
    chunks = _chunks_df(t)
    old = gr.links(chunks.filter("lang <> 'fr'")).groupBy("src", "tgt").agg(F.count("*").alias("weight"))
    return gr.added_links(old, gr.links(chunks.filter("lang = 'fr'")))


LEFT_R = BASE_R.replace("FROM documents))", "FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)))")


@query("g11_changes", f"{LEFT_R}, {COMPONENTS} SELECT src, tgt, weight, comp AS component FROM rel JOIN cc ON node = src")
def g11_changes(t):
    """French chunks arrive later and toxic documents leave; relations and components equal those of what is left."""
    links = gr.links(_chunks_df(t), ("lang",))
    toxic = t.labels.filter("toxic = 1").select("doc_id")
    graph = StoredGraph(t.spark)
    graph.apply(links.filter("lang <> 'fr' or lang is null"))
    graph.apply(links.filter("lang = 'fr'").join(toxic, "doc_id", "left_anti"), toxic)
    return graph.relations().join(graph.roots().withColumnRenamed("node", "src"), "src").select("src", "tgt", "weight", "component")


# ---- communities -------------------------------------------------------------------------------

def _edges(t):
    return cut(_relations(t).filter("src <> tgt"))


@query("g12_components", f"{BASE_R}, {COMPONENTS} SELECT node, comp AS component FROM cc")
def g12_components(t):
    return cm.connected_components(_edges(t).select("src", "tgt"))


@query("g12_communities", f"{BASE_R}, {MEMBERS} SELECT node, level, community FROM mem")
def g12_communities(t):
    return cm.communities(_edges(t), ROUNDS)


@query("g12_levels", f"{BASE_R}, {COMPONENTS} SELECT node, level::INTEGER AS level, comp AS component FROM cc, range(1, 3) AS l(level)")
def g12_levels(t):
    """Members of the communities of two levels, with the component their community lies in."""
    edges = _edges(t).select("src", "tgt", "weight")
    homes = cm.connected_components(edges).select(F.col("node").alias("community"), "component")
    return leveled_communities(edges, 2).join(homes, "community").select("node", "level", "component")


def _table(t):
    g = _Stored(t)
    members = cm.communities(g.edges(), ROUNDS)
    return cm.community_table(members, g.edges(), g.mentions, gr.degrees(g.relations), 10)


@query("g13_community_table", f"{BASE_R}, {TABLE} SELECT * FROM ct")
def g13_community_table(t):
    return _table(t)


@query("g13_relations", f"""{BASE_R}, {MEMBERS} SELECT a.level, a.community, src, tgt FROM rel JOIN mem a ON src = a.node
JOIN mem b ON tgt = b.node AND a.level = b.level AND a.community = b.community WHERE src <> tgt""")
def g13_relations(t):
    edges = cut(_edges(t))
    return cm.community_relations(cm.communities(edges, ROUNDS), edges)


@query("g13_chunks", f"""{BASE_R}, {MEMBERS} SELECT level, community, doc_id, pos, count(DISTINCT name) AS n FROM mem JOIN mt ON node = name GROUP BY ALL""")
def g13_chunks(t):
    g = _Stored(t)
    return cm.community_chunks(cm.communities(g.edges(), ROUNDS), g.mentions)


@query("g14_global_search", f"""{BASE_R}, {TABLE}, cn AS (SELECT community, string_split(lower(summary), ' ') AS words FROM ct WHERE level = 1),
{bm25_cte(n='cn', keys='community', k=5)} SELECT qid, community, score, rk FROM hits""")
def g14_global_search(t):
    """Community summaries of level 1 scored per query; those that share no word drop out."""
    nodes = cut(_table(t).filter("level = 1").select("community", tx.words(F.col("summary")).alias("words")))
    return bm25_search(nodes, passages(t), 5, ["community"])


@query("g15_local_search", f"""{BASE_R}, {MEMBERS}, {SEEDS}, {_low(20)}, {_chunks('lo', 10, 'co')}, {_ends('lo', 'en')},
it AS (SELECT qid, 'entity' AS kind, name AS item, 0 AS prio, place AS o, 1 AS tokens FROM sd
  UNION ALL SELECT qid, 'linked', name, 1, rk, 1 FROM en WHERE (qid, name) NOT IN (SELECT (qid, name) FROM sd)
  UNION ALL SELECT qid, 'relation', src || '-' || tgt, 2, rk, 2 FROM lo
  UNION ALL SELECT qid, 'chunk', doc_id || ':' || pos, 3, rk, len(words) FROM co JOIN n USING (doc_id, pos)
  UNION ALL SELECT DISTINCT qid, 'community', community, 4, 0, 1 FROM sd JOIN mem ON node = name WHERE level = 1),
rk AS (SELECT qid, kind, item, tokens, row_number() OVER (PARTITION BY qid ORDER BY prio, o, item)::INTEGER AS rk FROM it),
us AS (SELECT qid, kind, item, rk, (sum(tokens) OVER (PARTITION BY qid ORDER BY rk))::BIGINT AS used FROM rk)
SELECT * FROM us WHERE used <= 400""")
def g15_local_search(t):
    g = _Stored(t)
    seeds = cut(g.seeds())
    hits = cut(gr.low_level(seeds, g.relations, 20))
    item = lambda df, kind, c, prio, o, tokens: df.select(
        "qid", F.lit(kind).alias("kind"), c.alias("item"), F.lit(prio).alias("prio"), o.cast("int").alias("o"), tokens.cast("int").alias("tokens"))
    linked = gr.ends_of(hits).join(seeds.select("qid", "name"), ["qid", "name"], "left_anti")
    chunks = gr.chunks_of(hits, g.links, 10).join(line_words(t).select(*KEYS, "words"), KEYS)
    members = cm.communities(g.edges(), ROUNDS).filter("level = 1").withColumnRenamed("node", "name")
    around = seeds.join(members, "name").select("qid", "community").distinct()
    one = F.lit(1)
    items = (item(seeds, "entity", F.col("name"), 0, F.col("at"), one)
             .unionByName(item(linked, "linked", F.col("name"), 1, F.col("rk"), one))
             .unionByName(item(hits, "relation", F.concat_ws("-", "src", "tgt"), 2, F.col("rk"), F.lit(2)))
             .unionByName(item(chunks, "chunk", F.concat_ws(":", "doc_id", "pos"), 3, F.col("rk"), F.size("words")))
             .unionByName(item(around, "community", F.col("community"), 4, F.lit(0), one)))
    order = W.partitionBy("qid").orderBy("prio", "o", "item")
    ranked = items.withColumn("rk", F.row_number().over(order))
    return gr.within_budget(ranked, F.col("tokens"), 400).select("qid", "kind", "item", "rk", "used")


TABLES = """fe AS (SELECT 'customer:' || c_custkey AS src, 'nation:' || c_nationkey AS tgt, count(*) AS weight FROM customer GROUP BY ALL
UNION ALL SELECT 'nation:' || n_nationkey, 'region:' || n_regionkey, count(*) FROM nation GROUP BY ALL
UNION ALL SELECT 'order:' || o_orderkey, 'customer:' || o_custkey, count(*) FROM orders GROUP BY ALL)"""


def _table_graph(t):
    return (gr.table_edges(t.customer, ("customer", "c_custkey"), ("nation", "c_nationkey"))
            .unionByName(gr.table_edges(t.nation, ("nation", "n_nationkey"), ("region", "n_regionkey")))
            .unionByName(gr.table_edges(t.orders, ("order", "o_orderkey"), ("customer", "o_custkey"))))


@query("g16_multi_hop", """SELECT 'region:0' AS node, 0::INTEGER AS hop UNION ALL SELECT 'nation:' || n_nationkey, 1 FROM nation WHERE n_regionkey = 0
UNION ALL SELECT 'customer:' || c_custkey, 2 FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 0
UNION ALL SELECT 'order:' || o_orderkey, 3 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 0""")
def g16_multi_hop(t):
    start = t.region.filter("r_regionkey = 0").select(F.concat_ws(":", F.lit("region"), "r_regionkey").alias("node"))
    return gr.reached(_table_graph(t), start, 3)


@query("g17_hybrid_graph", f"""{BASE}, {SEEDS}, {_low(60)}, {HIGH},
u AS (SELECT qid, src, tgt, min(rk) AS best FROM (SELECT qid, src, tgt, rk FROM lo UNION ALL SELECT qid, src, tgt, rk FROM hi) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY best, src, tgt)::INTEGER AS rk FROM u)
SELECT qid, src, tgt, rk, rk * 2::BIGINT AS used FROM r WHERE rk * 2 <= 100""")
def g17_hybrid_graph(t):
    g = _Stored(t)
    low = gr.low_level(g.seeds(), g.relations).select("qid", "src", "tgt", "rk")
    both = low.unionByName(g.high().select("qid", "src", "tgt", "rk")).groupBy("qid", "src", "tgt").agg(F.min("rk").alias("best"))
    ranked = both.withColumn("rk", F.row_number().over(W.partitionBy("qid").orderBy("best", "src", "tgt")))
    return gr.within_budget(ranked, F.lit(2), 100).select("qid", "src", "tgt", "rk", "used")


@query("g18_aliases", f"""{BASE}, nm AS (SELECT DISTINCT name, regexp_replace(name, '(s|en|e)$', '') AS k FROM mt),
ky AS (SELECT name, min(name) OVER (PARTITION BY k) AS key FROM nm),
rr AS (SELECT least(a.key, b.key) AS src, greatest(a.key, b.key) AS tgt, weight FROM rel JOIN ky a ON src = a.name JOIN ky b ON tgt = b.name WHERE a.key <> b.key)
SELECT src, tgt, sum(weight)::BIGINT AS weight FROM rr GROUP BY src, tgt""")
def g18_aliases(t):
    """Names that differ in a plural ending are one entity."""
    g = _Stored(t)
    edges = gr.alias_edges(g.entities, F.regexp_replace("name", "(s|en|e)$", ""))
    keys = cm.connected_components(edges).select(F.col("node").alias("name"), F.col("component").alias("key"))
    merged = gr.renamed(g.relations, keys, ["src", "tgt"]).filter("src <> tgt")
    return (merged.select(F.least("src", "tgt").alias("src"), F.greatest("src", "tgt").alias("tgt"), "weight")
            .groupBy("src", "tgt").agg(F.sum("weight").alias("weight")))


@query("g19_table_graph", f"WITH {TABLES} SELECT * FROM fe")
def g19_table_graph(t):
    return _table_graph(t)
