"""Statistics questions (B rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import bi
from tessera.operators.ranking import bm25_search
from tessera.plans.common import KEYS, LINE_WORDS, PASSAGES, bm25_cte, line_words, passages
from tessera.plans.registry import query
from tessera.sources import html as hx, stores as st
from tessera.session import work_path

RECORDS = "SELECT c_mktsegment AS segment, count(*) AS n FROM customer GROUP BY c_mktsegment"


@query("b1_records", f"SELECT to_json({{'segment': segment, 'n': n}})::VARCHAR AS record FROM ({RECORDS})")
def b1_records(t):
    return bi.SqlTables(t.spark).add("customer", t.customer, {"c_mktsegment": "market"}).records(RECORDS)


@query("b2_count", "SELECT count(*) AS n FROM orders")
def b2_count(t):
    return bi.SqlTables(t.spark).add("orders", t.orders).query("SELECT count(*) AS n FROM orders")


@query("b3_text_match", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%'")
def b3_text_match(t):
    return t.part.filter(F.col("p_name").like("%ring%")).select("p_partkey", "p_name")


@query("b4_compare", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 5000")
def b4_compare(t):
    return t.customer.filter("c_acctbal > 5000").select("c_custkey", "c_acctbal")


@query("b5_most_frequent", "SELECT p_type, count(*) AS n FROM part GROUP BY p_type ORDER BY n DESC, p_type LIMIT 3")
def b5_most_frequent(t):
    return bi.most_frequent(t.part, "p_type", 3)


@query("b6_profit", """SELECT p_type, round(sum(l_extendedprice * l_quantity) - sum(p_retailprice * l_quantity), 2) AS profit
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type ORDER BY profit DESC""")
def b6_profit(t):
    items = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    out = bi.profit(items, "p_type", F.col("l_extendedprice"), F.col("p_retailprice"), F.col("l_quantity"))
    return out.withColumn("profit", F.round("profit", 2)).orderBy(F.desc("profit"))


@query("b7_monthly_growth", """WITH m AS (SELECT date_trunc('month', o_orderdate)::DATE AS month, sum(o_totalprice) AS total FROM orders GROUP BY 1),
c AS (SELECT unnest(range((SELECT min(month) FROM m)::TIMESTAMP, (SELECT max(month) FROM m)::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 1 MONTH))::DATE AS month),
f AS (SELECT month, coalesce(total, 0.0) AS total FROM c LEFT JOIN m USING (month))
SELECT month, round(total, 2) AS total, round((total - lag(total) OVER w) / nullif(lag(total) OVER w, 0), 6) AS mom,
round((total - lag(total, 12) OVER w) / nullif(lag(total, 12) OVER w, 0), 6) AS yoy FROM f WINDOW w AS (ORDER BY month)""")
def b7_monthly_growth(t):
    out = bi.monthly_growth(t.orders, F.col("o_orderdate"), F.col("o_totalprice"))
    return out.select("month", F.round("total", 2).alias("total"), F.round("mom", 6).alias("mom"), F.round("yoy", 6).alias("yoy"))


@query("b8_yearly_report", """SELECT year(o_orderdate)::INTEGER AS year, count(DISTINCT o_orderkey) AS n_orders, round(sum(l_extendedprice), 2) AS revenue, round(avg(l_extendedprice), 4) AS avg_price,
round(sum(l_quantity), 2) AS quantity, round(avg(l_discount), 6) AS avg_discount FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""")
def b8_yearly_report(t):
    """Items are summed per order before the join, so only one row per order meets the orders."""
    sums = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("r"), F.count("*").alias("k"),
                                                F.sum("l_quantity").alias("q"), F.sum("l_discount").alias("d"))
    joined = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year")).join(sums, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("year").agg(
        F.count("*").alias("n_orders"), F.round(F.sum("r"), 2).alias("revenue"), F.round(F.sum("r") / F.sum("k"), 4).alias("avg_price"),
        F.round(F.sum("q"), 2).alias("quantity"), F.round(F.sum("d") / F.sum("k"), 6).alias("avg_discount"))


EMPTY = "SELECT 'none' AS item, sum(o_totalprice) AS value FROM orders WHERE o_totalprice < 0"
FILLED = "SELECT o_orderstatus AS item, count(*)::DOUBLE AS value FROM orders GROUP BY 1"


@query("b9_fallback", f"""WITH {LINE_WORDS}, {PASSAGES}, {bm25_cte(k=1)}
SELECT 'filled' AS question, item, value, 'sql' AS source, true AS chart FROM ({FILLED})
UNION ALL SELECT 'empty', content, score, 'text', false FROM hits JOIN n USING (doc_id, pos)""")
def b9_fallback(t):
    """One question with rows, and one whose sum is empty and falls back to text retrieval."""
    tables = bi.SqlTables(t.spark).add("orders", t.orders)
    nodes = line_words(t)
    text = bm25_search(nodes, passages(t), 1, KEYS).join(nodes.select(*KEYS, "content"), KEYS).select(
        F.col("content").alias("item"), F.col("score").alias("value"))
    filled = bi.with_fallback(tables.query(FILLED.replace("count(*)::DOUBLE", "cast(count(*) AS double)")), text, "value")
    empty = bi.with_fallback(tables.query(EMPTY), text, "value")
    return filled.withColumn("question", F.lit("filled")).unionByName(empty.withColumn("question", F.lit("empty")))


@query("b10_title_clusters")
def b10_title_clusters(t):
    return bi.title_clusters(t.part, "p_partkey", "p_name")


@query("b11_fields_table", """SELECT lang, count(*) AS n, count(DISTINCT title) AS titles, sum(links)::BIGINT AS links FROM (
  SELECT regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
    len(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS links FROM pages) GROUP BY lang""")
def b11_fields_table(t):
    """Fields by regex into a table, then SQL over it."""
    rules = {"lang": F.regexp_extract("html", '<html lang="([a-z]+)"', 1), "title": F.regexp_extract("html", "<title>([^<]*)</title>", 1),
             "links": F.size(hx.hrefs(F.col("html")))}
    name = work_path(t.spark, "fields").rsplit("/", 1)[1].replace("-", "_")
    st.load_table(bi.extracted_fields(t.pages, rules, "html", F.col("url")), name)
    return t.spark.sql(f"SELECT lang, count(*) AS n, count(DISTINCT title) AS titles, sum(links) AS links FROM {name} GROUP BY lang")
