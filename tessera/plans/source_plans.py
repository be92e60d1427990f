"""Sources and sinks (S rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators.search import block_search, vector_scorer
from tessera.plans.common import MEANS, label_means, ranked, vector_nodes
from tessera.plans.registry import query
from tessera.sources import html as hx, readers as rd, stores as st
from tessera.sources.collection import Collection
from tessera.session import work_path

STRIP = r"trim(regexp_replace(regexp_replace({0}, '<[^>]*>', ' ', 'g'), '[ \t\n\r\f]+', ' ', 'g'))"


@query("s1_scan", "SELECT doc_id, 'documents.parquet' AS file, length(text) AS chars FROM documents")
def s1_scan(t):
    return rd.scan_table(t.spark, t.folder, "documents.parquet").select("doc_id", "file", F.length("text").cast("bigint").alias("chars"))


@query("s2_reader_rules", f"""SELECT page_id, CASE WHEN url LIKE '%/fr/%' THEN 'local' WHEN url LIKE 'http://%' THEN 'plain' WHEN url LIKE 'https://%' THEN 'title' END AS reader,
CASE WHEN url LIKE '%/fr/%' THEN {STRIP.format('html')} WHEN url LIKE 'http://%' THEN html
  WHEN url LIKE 'https://%' THEN regexp_extract(html, '<title>([^<]*)</title>', 1) END AS text FROM pages""")
def s2_reader_rules(t):
    rules = (rd.ReaderRules().add("http://*", "plain", lambda c: c)
             .add("https://*", "title", lambda c: F.regexp_extract(c, "<title>([^<]*)</title>", 1))
             .add("*/fr/*", "local", hx.stripped, kb="web").add("*", "other", F.upper, kb="elsewhere"))
    return rules.read(t.pages, "web", "url", "html").select("page_id", "reader", "text")


@query("s3_visible_text")
def s3_visible_text(t):
    return t.pages.select("page_id", hx.visible_text("html").alias("text"))


@query("s4_class_fields", """SELECT page_id, replace(replace(replace(replace(replace(list_last(regexp_extract_all(html, '<div class="ad">([^<]*)</div>', 1)),
  '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS ad FROM pages""")
def s4_class_fields(t):
    return t.pages.select("page_id", hx.class_fields(F.col("html"), {"ad": "ad"}).alias("f")).select("page_id", "f.ad")


@query("s4_tag_fields", """SELECT page_id, regexp_extract(html, '<title[^>]*>([^<]*)</title>', 1) AS title,
  array_to_string(regexp_extract_all(html, '<a[^>]*>([^<]*)</a>', 1), ';') AS links FROM pages""")
def s4_tag_fields(t):
    return t.pages.select("page_id", F.get(hx.tag_texts(F.col("html"), "title"), F.lit(0)).alias("title"),
                          F.array_join(hx.tag_texts(F.col("html"), "a"), ";").alias("links"))


@query("s5_links", """SELECT page_id, link, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages)
GROUP BY page_id, link""")
def s5_links(t):
    return t.pages.select("page_id", F.explode(hx.hrefs(F.col("html"))).alias("link")).groupBy("page_id", "link").agg(
        F.count("*").alias("n"))


@query("s5_markdown_links", r"""SELECT page_id, unnest(regexp_extract_all(regexp_replace(html, '<a href="([^"]*)">([^<]*)</a>', '[\2](\1)', 'g'),
  '\[[^\]]*\]\(([^)]+)\)', 1)) AS link FROM pages""")
def s5_markdown_links(t):
    """Anchors written as Markdown first, then harvested."""
    md = F.regexp_replace("html", '<a href="([^"]*)">([^<]*)</a>', "[$2]($1)")
    return t.pages.select("page_id", F.explode(hx.markdown_links(md)).alias("link"))


@query("s6_json_round_trip", "SELECT conv_id, turn, role, text FROM conversations")
def s6_json_round_trip(t):
    path = work_path(t.spark, "json")
    t.conversations.write.json(path)
    return rd.scan_json(t.spark, path, "conv_id bigint, turn bigint, role string, text string")


@query("s7_csv_round_trip", "SELECT doc_id, lang, text FROM documents WHERE text <> ''")
def s7_csv_round_trip(t):
    path = work_path(t.spark, "csv")
    t.documents.select("doc_id", "lang", "text").write.option("header", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return rd.scan_csv(t.spark, path, "doc_id bigint, lang string, text string")


@query("s8_load_table", "SELECT c_nationkey, count(*) * 2 AS n, round(sum(c_acctbal) * 2, 4) AS balance FROM customer GROUP BY c_nationkey")
def s8_load_table(t):
    """Two loads: the first creates the table, the second appends."""
    name = work_path(t.spark, "customers").rsplit("/", 1)[1].replace("-", "_")
    st.load_table(t.customer, name)
    table = st.load_table(t.customer, name)
    return table.groupBy("c_nationkey").agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 4).alias("balance"))


@query("s9_kb_files", """WITH d AS (SELECT sha256(text) AS h, any_value(text) AS text FROM documents GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY h) - 1 AS id FROM d)
SELECT id // 10 AS file_no, count(*)::INTEGER AS n, string_agg(text, chr(10) ORDER BY id) AS content FROM r GROUP BY 1""")
def s9_kb_files(t):
    return st.kb_files(t.documents)


@query("s10_vector_collection", f"""WITH {MEANS}, sc AS (SELECT mv.label AS qid, vec_id, round(list_inner_product(vec, embedding::DOUBLE[]), 6) AS score FROM mv, embeddings WHERE embeddings.label IN (1, 2, 3))
{ranked('sc', 3)}""")
def s10_vector_collection(t):
    store = st.VectorCollection(t.spark, "vectors", 64, "label")
    store.insert(vector_nodes(t))
    space = store.search_space("label in (1, 2, 3)", ["vec_id", "vec"])
    return block_search(space, label_means(t).withColumnRenamed("label", "qid"), vector_scorer("ip"), 3, ["vec_id"], ["vec"])


@query("s10_collection", f"""WITH {MEANS}, sc AS (SELECT mv.label AS qid, vec_id, round(list_inner_product(vec, embedding::DOUBLE[]), 6) AS score FROM mv, embeddings WHERE embeddings.label IN (1, 2, 3))
{ranked('sc', 3)}""")
def s10_collection(t):
    """Created, filled, dropped, created again and filled once more; the filter on the label reads only its files."""
    rows = vector_nodes(t)
    store = Collection(t.spark, work_path(t.spark, "collection"))
    for _ in range(2):
        store.create(rows.schema, 64, "label", drop_if_exists=True)
        store.insert(rows)
    space = store.rows().filter("label in (1, 2, 3)").select("vec_id", "vec")
    return block_search(space, label_means(t).withColumnRenamed("label", "qid"), vector_scorer("ip"), 3, ["vec_id"], ["vec"])


@query("s11_snapshot", """WITH d AS (SELECT DISTINCT text, min(CASE WHEN lang = 'en' THEN 0 ELSE 1 END) OVER (PARTITION BY text) AS run FROM documents)
SELECT run::INTEGER AS run, count(*) AS n, sum(length(text))::BIGINT AS chars FROM d GROUP BY run""")
def s11_snapshot(t):
    """First start sees the English documents, the second all of them; only new texts are computed."""
    store = st.Snapshot(t.spark)
    store.refresh(t.documents.filter("lang = 'en'"), F.length, "text")
    rows = store.refresh(t.documents, F.length, "text")
    return rows.groupBy("run").agg(F.count("*").alias("n"), F.sum("value").alias("chars"))


@query("s12_files", r"""WITH p AS (SELECT DISTINCT url, trim(coalesce(html, ''), ' ') AS text FROM pages WHERE url <> ''),
s AS (SELECT *, regexp_replace(url, '[/\\]', '_', 'g')[:100] AS safe FROM p)
SELECT safe || CASE WHEN count(*) OVER (PARTITION BY safe) > 1 THEN '-' || sha256(url || chr(10) || text)[:16] ELSE '' END AS name, text FROM s""")
def s12_files(t):
    """Pages written as one file a name, and read again."""
    path = work_path(t.spark, "named")
    st.write_named_texts(t.pages, "url", "html", path)
    return st.read_named_texts(t.spark, path).withColumnRenamed("value", "text")


@query("s12_named_texts", r"""SELECT page_id, regexp_replace(url, '[/\\]', '_', 'g') AS name, trim(html) AS text FROM pages""")
def s12_named_texts(t):
    return t.pages.select("page_id", st.safe_name(F.col("url")).alias("name"), F.trim("html").alias("text"))
