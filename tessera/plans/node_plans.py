"""Node groups (N rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import masking as mk, text as tx
from tessera.operators import keywords as kw, nodes as nd
from tessera.operators.nodes import NodeTree
from tessera.operators.ranking import bm25_search
from tessera.plans.common import LINES, PASSAGES, WORDS, bm25_cte, lines, passages
from tessera.plans.registry import query
from tessera.sources import html as hx

STRIP = r"trim(regexp_replace(regexp_replace({0}, '<[^>]*>', ' ', 'g'), '[ \t\n\r\f]+', ' ', 'g'))"


def _parts(sql: str, column: str = "text", table: str = "documents", key: str = "doc_id") -> str:
    return (f"SELECT {key}, unnest(range(0, len(ps)))::INTEGER AS pos, unnest(ps) AS content FROM "
            f"(SELECT {key}, {sql} AS ps FROM {table})")


def _split(delimiter: str) -> str:
    return f"list_filter(string_split(text, {delimiter}), lambda p: p <> '')"


@query("n1_root", "SELECT doc_id, 'root' AS grp, 0::INTEGER AS pos, text AS content FROM documents")
def n1_root(t):
    return nd.root_nodes(t.documents)


def _delimiter_query(name, delimiter, sql):
    @query(name, _parts(_split(sql)))
    def run(t):
        return nd.explode_nodes(t.documents, tx.pieces(F.col("text"), delimiter))


_delimiter_query("n2_lines", "\n", "chr(10)")
_delimiter_query("n2_sentences", ".", "'.'")
_delimiter_query("n2_commas", ",", "','")
_delimiter_query("n4_paragraphs", "\n\n", "chr(10) || chr(10)")


def _window_query(name, size, overlap):
    @query(name, _parts(f"CASE WHEN length(text) > 0 THEN list_transform(range(0, length(text), {size - overlap}), "
                        f"lambda i: substr(text, i + 1, {size})) ELSE [] END"))
    def run(t):
        return nd.explode_nodes(t.documents, tx.windows(F.col("text"), size, overlap))


_window_query("n3_coarse_chunks", 1024, 100)
_window_query("n3_medium_chunks", 256, 25)
_window_query("n3_fine_chunks", 128, 12)


@query("n3_word_chunks", f"""WITH d AS (SELECT doc_id, {WORDS.format('text')} AS w FROM documents)
SELECT doc_id, unnest(range(0, len(ps)))::INTEGER AS pos, unnest(ps) AS content FROM (
  SELECT doc_id, list_transform(range(0, len(w), 116), lambda i: array_to_string(w[i + 1 : i + 128], ' ')) AS ps FROM d)""")
def n3_word_chunks(t):
    return nd.explode_nodes(t.documents, tx.windows(F.col("text"), 128, 12, unit="word"))


@query("n5_recursive", """WITH a AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda p: p <> '') AS ps FROM documents),
b AS (SELECT doc_id, flatten(list_transform(ps, lambda p: CASE WHEN length(p) > 200 THEN list_filter(string_split(p, '.'), lambda x: x <> '') ELSE [p] END)) AS ps FROM a),
c AS (SELECT doc_id, flatten(list_transform(ps, lambda p: CASE WHEN length(p) > 200 THEN list_filter(string_split(p, ','), lambda x: x <> '') ELSE [p] END)) AS ps FROM b)
SELECT doc_id, unnest(range(0, len(ps)))::INTEGER AS pos, unnest(ps) AS content FROM c""")
def n5_recursive(t):
    return nd.explode_nodes(t.documents, tx.nested_pieces(F.col("text"), ["\n", ".", ","], 200))


@query("n6_semantic", f"""WITH sn AS ({_parts("list_filter(list_transform(string_split(text, '.'), lambda p: trim(p)), lambda p: p <> '')")}),
w AS (SELECT *, list_distinct({WORDS.format('content')}) AS ws, lag(list_distinct({WORDS.format('content')})) OVER (PARTITION BY doc_id ORDER BY pos) AS pw FROM sn),
f AS (SELECT *, CASE WHEN pw IS NULL THEN 1 WHEN len(ws) * len(pw) = 0 THEN 1
  WHEN len(list_intersect(ws, pw)) / sqrt(len(ws)::DOUBLE * len(pw)) < 0.15 THEN 1 ELSE 0 END AS brk FROM w),
g AS (SELECT *, sum(brk) OVER (PARTITION BY doc_id ORDER BY pos) AS chunk FROM f)
SELECT doc_id, (chunk - 1)::INTEGER AS pos, string_agg(content, ' ' ORDER BY g.pos) AS content FROM g GROUP BY doc_id, chunk""")
def n6_semantic(t):
    sentences = tx.pieces_by_pattern(F.col("text"), r"\.")
    docs = t.documents.select("doc_id", sentences.alias("s"))
    return nd.explode_nodes(docs, nd.semantic_chunks(F.col("s"), 0.15))


BLOCKS = f"""bl AS (SELECT page_id, list_transform(regexp_extract_all(html, '(?s)(<(?:h[1-6]|p)>.*?</(?:h[1-6]|p)>)', 1),
  lambda p: {{'title': p LIKE '<h%', 'content': {STRIP.format('p')}}}) AS b FROM pages),
fo AS (SELECT page_id, b, list_reduce(list_transform(b, lambda x, i: {{'starts': []::BIGINT[], 'size': length(x.content)::BIGINT, 'title': x.title, 'i': i}}),
  lambda acc, x: CASE WHEN x.title OR x.i = 1 OR acc.size + 2 + x.size >= 4096
    THEN {{'starts': list_append(acc.starts, x.i), 'size': x.size, 'title': false, 'i': x.i}}
    ELSE {{'starts': acc.starts, 'size': acc.size + 2 + x.size, 'title': false, 'i': x.i}} END,
  {{'starts': []::BIGINT[], 'size': 0::BIGINT, 'title': false, 'i': 0::BIGINT}}).starts AS st FROM bl WHERE len(b) > 0),
se AS (SELECT page_id, unnest(range(0, len(st)))::INTEGER AS pos, unnest(list_transform(st, lambda s, i: b[s : coalesce(st[i + 1] - 1, len(b))])) AS run,
  unnest(st) AS first FROM fo)"""


def _sections(t):
    blocks = t.pages.select("page_id", hx.layout_blocks(F.col("html")).alias("blocks"))
    runs = nd.section_runs(F.col("blocks"), nd.section_starts(F.col("blocks")))
    return blocks.select("page_id", F.posexplode(runs).alias("pos", "run"))


@query("n7_sections", f"WITH {BLOCKS} SELECT page_id, pos, array_to_string(list_transform(run, lambda x: x.content), chr(10) || chr(10)) AS content FROM se")
def n7_sections(t):
    return _sections(t).select("page_id", "pos", F.array_join("run.content", "\n\n").alias("content"))


@query("n8_boxes", f"""WITH {BLOCKS},
bx AS (SELECT page_id, pos, list_transform(run, lambda x, i: {{'l': CASE WHEN x.title THEN 40 ELSE 60 END, 't': i * 20, 'r': 60 + length(x.content) % 500, 'b': i * 20 + 18}}) AS bs FROM se)
SELECT page_id, pos, list_max(list_transform(bs, lambda x: x.l))::INTEGER AS "left", bs[1].t::INTEGER AS top,
  list_max(list_transform(bs, lambda x: x.r))::INTEGER AS "right", bs[len(bs)].b::INTEGER AS bottom, len(bs)::INTEGER AS n FROM bx""")
def n8_boxes(t):
    """Boxes laid out from the block order and text length of every page."""
    boxes = F.transform("run", lambda x, i: F.struct(
        F.when(x["title"], 40).otherwise(60).alias("left"), ((i + 1) * 20).alias("top"),
        (F.length(x["content"]) % 500 + 60).alias("right"), ((i + 1) * 20 + 18).alias("bottom")))
    placed = _sections(t).withColumn("boxes", boxes)
    return placed.select("page_id", "pos", F.size("boxes").alias("n"), nd.box_union(F.col("boxes")).alias("u")).select(
        "page_id", "pos", "u.left", "u.top", "u.right", "u.bottom", "n")


def _initials(text: str) -> str:
    return "".join(w[0] for w in text.split(" ") if w)


@query("n9_user_transforms", f"""WITH {LINES} SELECT doc_id, pos, replace(content, ',', ';') AS marked,
  array_to_string(list_transform(list_filter(string_split(content, ' '), lambda w: w <> ''), lambda w: w[1]), '') AS initials FROM ln""")
def n9_user_transforms(t):
    """A Column function and a Python function as transforms."""
    marked = kw.column_transform(lines(t), lambda c: F.replace(c, F.lit(","), F.lit(";")), "marked")
    return kw.batch_transform(marked, _initials, "initials", "string").select("doc_id", "pos", "marked", "initials")


PAIRS = """qa AS (SELECT conv_id, turn, question, answer FROM (SELECT conv_id, turn, role, text AS question,
  lead(role) OVER w AS next_role, lead(text) OVER w AS answer FROM conversations WHERE role IN ('user', 'assistant') AND turn IS NOT NULL
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)) WHERE role = 'user' AND next_role = 'assistant' AND conv_id IS NOT NULL)"""
PAIRS_OF_G = PAIRS.replace("FROM conversations", "FROM g")


def _clauses(node):
    """Clauses between commas, each with its place in the metadata; a line without a comma gives none."""
    parts = [p for p in node.text.split(",") if p]
    return [kw.Node(p, {**node.metadata, "part": f"{i + 1}/{len(parts)}"}) for i, p in enumerate(parts)] if "," in node.text else None


@query("n9_node_transforms", f"""WITH {LINES}, d AS (SELECT doc_id, pos, lang, list_filter(string_split(content, ','), lambda p: p <> '') AS ps
  FROM ln JOIN documents USING (doc_id) WHERE contains(content, ','))
SELECT doc_id, pos, unnest(range(0, len(ps)))::INTEGER AS sub, unnest(ps) AS content, lang, (unnest(range(0, len(ps))) + 1) || '/' || len(ps) AS part FROM d""")
def n9_node_transforms(t):
    """A transform of whole nodes: none to many nodes each, with a metadata field of their own."""
    nodes = lines(t, keep=("lang",)).select("doc_id", "pos", "content", F.create_map(F.lit("lang"), F.col("lang")).alias("metadata"))
    made = kw.node_transform(nodes, _clauses, trans_node=True)
    return made.select("doc_id", "pos", "sub", "content", F.col("metadata")["lang"].alias("lang"), F.col("metadata")["part"].alias("part"))


@query("n14_gapped_pairs", f"""WITH g AS (SELECT conv_id, turn * 5000 AS turn, role, text FROM conversations
  UNION ALL SELECT conv_id, turn * 5000 + 1, 'system', 'note' FROM conversations WHERE role = 'user'),
{PAIRS_OF_G} SELECT * FROM qa""")
def n14_gapped_pairs(t):
    """Sessions with gaps and notes between the turns lose no pair."""
    turns = t.conversations.select("conv_id", (F.col("turn") * 5000).alias("turn"), "role", "text")
    notes = turns.filter("role = 'user'").select("conv_id", F.col("turn") + 1, F.lit("system"), F.lit("note"))
    return kw.question_answer_pairs(turns.union(notes))


@query("n10_chained", f"""WITH {LINES},
s AS (SELECT doc_id, pos AS parent_pos, unnest(range(0, len(ps))) AS i, unnest(ps) AS content FROM (
  SELECT doc_id, pos, list_filter(string_split(content, '.'), lambda p: p <> '') AS ps FROM ln))
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY parent_pos, i) - 1)::INTEGER AS pos, parent_pos, length(content)::INTEGER AS chars FROM s""")
def n10_chained(t):
    tree = (NodeTree(t.documents).group("line", lambda c: tx.pieces(c, "\n"))
            .group("sentence", lambda c: tx.pieces(c, "."), parent="line"))
    return tree.nodes("sentence").select("doc_id", "pos", F.element_at("anc", -1).alias("parent_pos"),
                                         F.length("content").alias("chars"))


# Words to hide in the demo; "the" hides "ther" because the shorter word wins.
LISTED = ["the", "ther", "and", "que", "ung", "keit", "eau", "token", "on"]


@query("n11_mask_one", "SELECT doc_id, replace(text, 'the', repeat('*', length('the'))) AS text FROM documents")
def n11_mask_one(t):
    return t.documents.select("doc_id", mk.masked(F.col("text"), ["the"]).alias("text"))


@query("n11_mask_list", """WITH m AS (SELECT doc_id, string_split_regex(text, 'on|and|eau|que|the|ung|keit|token') AS b,
  list_concat(regexp_extract_all(text, 'on|and|eau|que|the|ung|keit|token'), ['']) AS h FROM documents)
SELECT doc_id, array_to_string(list_transform(b, lambda x, i: x || repeat('*', length(h[i]))), '') AS text FROM m""")
def n11_mask_list(t):
    return t.documents.select("doc_id", mk.masked(F.col("text"), LISTED).alias("text"))


DOC_WORDS = f"d AS (SELECT doc_id, {WORDS.format('text')} AS words FROM documents)"
IDF = """tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM d) GROUP BY ALL),
idf AS (SELECT term, ln((SELECT count(*) FROM d) / count(*)::DOUBLE) AS idf FROM tf GROUP BY term)"""


@query("n12_keywords", f"""WITH {DOC_WORDS}, {IDF}, sc AS (SELECT doc_id, term, round(tf * idf, 6) AS score FROM tf JOIN idf USING (term))
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term)::INTEGER AS rk FROM sc) WHERE rk <= 5""")
def n12_keywords(t):
    return kw.keywords(t.documents.select("doc_id", tx.words(F.col("text")).alias("words")), ["doc_id"], 5)


SUMMARY = f"""{DOC_WORDS}, {IDF}, sn AS ({_parts("list_filter(list_transform(string_split_regex(text, '[.\\n]'), lambda p: trim(p)), lambda p: p <> '')")}),
sw AS (SELECT doc_id, pos, unnest({WORDS.format('content')}) AS term FROM sn),
ss AS (SELECT doc_id, pos, round(avg(idf), 6) AS score FROM sw JOIN idf USING (term) GROUP BY doc_id, pos),
top AS (SELECT doc_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS rk FROM ss) WHERE rk <= 3)"""


@query("n13_summary", f"WITH {SUMMARY} SELECT doc_id, string_agg(content, ' ' ORDER BY pos) AS summary FROM top JOIN sn USING (doc_id, pos) GROUP BY doc_id")
def n13_summary(t):
    docs = t.documents.select("doc_id", tx.words(F.col("text")).alias("words"))
    sentences = nd.explode_nodes(t.documents, tx.pieces_by_pattern(F.col("text"), "[.\n]"))
    return kw.summaries(docs, sentences.withColumn("words", tx.words(F.col("content"))), 3)


@query("n14_qa_pairs", f"WITH {PAIRS} SELECT * FROM qa")
def n14_qa_pairs(t):
    return kw.question_answer_pairs(t.conversations)


@query("n14_qa_search", f"""WITH {PAIRS}, n AS (SELECT conv_id, turn, {WORDS.format('question')} AS words FROM qa), {PASSAGES},
{bm25_cte(keys='conv_id, turn', k=3)} SELECT qid, conv_id, turn, score, rk, question, answer FROM hits JOIN qa USING (conv_id, turn)""")
def n14_qa_search(t):
    """Match the question, return the pair."""
    pairs = kw.question_answer_pairs(t.conversations)
    hits = bm25_search(pairs.withColumn("words", tx.words(F.col("question"))), passages(t), 3, ["conv_id", "turn"])
    return hits.join(pairs, ["conv_id", "turn"])


@query("n15_reference", f"""WITH {PAIRS} SELECT conv_id, turn, answer || coalesce(chr(10) || 'reference: ' || source, '') AS content
FROM qa LEFT JOIN (SELECT doc_id, source FROM documents JOIN labels USING (doc_id)) s ON doc_id = conv_id""")
def n15_reference(t):
    """The source label of a document stands for the image path; sessions without one get nothing."""
    paths = t.documents.select("doc_id", "source").join(t.labels.select("doc_id"), "doc_id")
    meta = kw.question_answer_pairs(t.conversations).join(paths.withColumnRenamed("doc_id", "conv_id"), "conv_id", "left")
    metadata = F.when(F.col("source").isNotNull(), F.create_map(F.lit("image_path"), F.col("source"))).otherwise(
        F.create_map().cast("map<string,string>"))
    return meta.select("conv_id", "turn", nd.with_reference(F.col("answer"), metadata, "image_path").alias("content"))


@query("n16_derived_nodes", r"""SELECT page_id, 'page' AS kind, html AS content FROM pages
UNION ALL SELECT page_id, 'page', 'Page titled ' || regexp_extract(html, '<title[^>]*>([^<]*)</title>', 1) FROM pages WHERE html LIKE '%class="ad"%'""")
def n16_derived_nodes(t):
    """Pages with a picture box get a second, described node."""
    nodes = t.pages.select("page_id", F.lit("page").alias("kind"), F.col("html").alias("content"))
    captions = t.pages.filter(F.col("html").contains('class="ad"')).select("page_id", F.concat(
        F.lit("Page titled "), F.regexp_extract("html", "<title[^>]*>([^<]*)</title>", 1)).alias("content"))
    return nd.with_derived(nodes, captions, ["page_id"])


@query("n17_neighbours", f"""WITH {LINES} SELECT doc_id, pos, concat_ws(' ', lag(content) OVER w, content, lead(content) OVER w) AS content
FROM ln WINDOW w AS (PARTITION BY doc_id ORDER BY pos)""")
def n17_neighbours(t):
    return nd.explode_nodes(t.documents, nd.neighbours(tx.pieces(F.col("text"), "\n")))


@query("n17_titled", f"""WITH {LINES} SELECT doc_id, pos, concat_ws(': ', source, content) AS content FROM ln JOIN documents USING (doc_id)""")
def n17_titled(t):
    return lines(t, ("source",)).select("doc_id", "pos", F.concat_ws(": ", "source", "content").alias("content"))


CLEAN = r"trim(regexp_replace(text, '[ \t\n\r\f]+', ' ', 'g'))"


@query("n18_dedup", f"SELECT sha256({CLEAN}) AS hash, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1")
def n18_dedup(t):
    return nd.first_copies(t.documents)


@query("n19_rules_per_kb", """WITH d AS (SELECT lang, doc_id, CASE WHEN lang = 'en' THEN list_filter(string_split(text, chr(10)), lambda p: p <> '')
  WHEN lang = 'de' THEN list_filter(string_split(text, '.'), lambda p: p <> '') ELSE [text] END AS ps FROM documents)
SELECT lang AS kb, doc_id, unnest(range(0, len(ps)))::INTEGER AS pos, unnest(ps) AS content FROM d""")
def n19_rules_per_kb(t):
    text = F.col("text")
    rule = (F.when(F.col("lang") == "en", tx.pieces(text, "\n")).when(F.col("lang") == "de", tx.pieces(text, "."))
            .otherwise(F.array(text)))
    parsed = t.documents.withColumn("ps", rule).withColumnRenamed("lang", "kb")
    return nd.explode_nodes(parsed, F.col("ps"), ("kb", "doc_id"))


@query("n19_parse_once", """WITH m AS (SELECT 'lang:' || lang AS grp, doc_id FROM documents UNION ALL SELECT 'source:' || source, doc_id FROM documents),
p AS (SELECT text, len(list_filter(string_split(text, chr(10)), lambda p: p <> '')) AS n FROM documents GROUP BY text)
SELECT grp, count(*) AS docs, sum(n)::BIGINT AS nodes FROM m JOIN documents USING (doc_id) JOIN p USING (text) GROUP BY grp""")
def n19_parse_once(t):
    """Documents in two groups each; every distinct text is parsed once."""
    docs = t.documents
    members = docs.select(F.concat(F.lit("lang:"), "lang").alias("grp"), "doc_id").unionByName(
        docs.select(F.concat(F.lit("source:"), "source").alias("grp"), "doc_id"))
    parsed = nd.parse_once(members, docs, lambda c: tx.pieces(c, "\n")).groupBy("hash").agg(F.count("*").alias("n"))
    hashed = docs.select("doc_id", F.sha2("text", 256).alias("hash"))
    return (members.join(hashed, "doc_id").groupBy("grp", "hash").agg(F.count("*").alias("docs"))
            .join(parsed, "hash", "left").groupBy("grp")
            .agg(F.sum("docs").alias("docs"), F.sum(F.col("docs") * F.coalesce("n", F.lit(0))).alias("nodes")))


@query("n20_headings", r"""WITH d AS (SELECT page_id, list_filter(string_split(regexp_replace(html, '<h([1-6])', chr(1) || '<h\1', 'g'), chr(1)),
  lambda p: regexp_matches(p, '^<h[1-6]')) AS ps FROM pages)
SELECT page_id, pos, regexp_extract(content, '^<h([1-6])', 1)::INTEGER AS level, """ + STRIP.format("content") + """ AS content FROM (
  SELECT page_id, unnest(range(0, len(ps)))::INTEGER AS pos, unnest(ps) AS content FROM d)""")
def n20_headings(t):
    chunks = nd.explode_nodes(t.pages, hx.heading_chunks(F.col("html")), ("page_id",))
    return chunks.select("page_id", "pos", F.regexp_extract("content", "^<h([1-6])", 1).cast("int").alias("level"),
                         hx.stripped(F.col("content")).alias("content"))
