"""Flow combinators (F rows), conversations (C rows) and knowledge-base changes (K rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import chat, flow, kb, nodes as nd
from tessera.operators.order import running_sum
from tessera.plans.registry import query


@query("f1_chain", "SELECT lang, sum(n_chars)::BIGINT AS chars FROM documents WHERE n_chars > 100 GROUP BY lang")
def f1_chain(t):
    return flow.chain(t.documents, lambda d: d.select("lang", "n_chars"), lambda d: d.filter("n_chars > 100"),
                      lambda d: d.groupBy("lang").agg(F.sum("n_chars").alias("chars")))


@query("f2_fan_out", """SELECT o_orderkey, o_custkey * 2 AS twice, o_custkey * o_custkey AS square, to_json([o_custkey * 2, o_custkey * o_custkey])::VARCHAR AS list,
(o_custkey * 2) || ',' || (o_custkey * o_custkey) AS joined, o_custkey * 2 AS from_map FROM orders""")
def f2_fan_out(t):
    out = flow.FanOut(F.col("o_custkey"), {"twice": lambda x: x * 2, "square": lambda x: x * x})
    return t.orders.select("o_orderkey", out.as_struct().alias("s"), F.to_json(out.as_array()).alias("list"),
                           out.joined(",").alias("joined"), out.as_map()["twice"].alias("from_map")).select(
        "o_orderkey", "s.*", "list", "joined", "from_map")


@query("f3_divert", "SELECT l_orderkey, l_linenumber, round(l_quantity * 2, 6) AS a, round(l_tax + 1, 6) AS b FROM lineitem")
def f3_divert(t):
    out = flow.divert([F.col("l_quantity"), F.col("l_tax")], [lambda x: x * 2, lambda x: x + 1])
    return t.lineitem.select("l_orderkey", "l_linenumber", out.alias("d")).select(
        "l_orderkey", "l_linenumber", F.round(F.col("d")[0], 6).alias("a"), F.round(F.col("d")[1], 6).alias("b"))


@query("f4_each", "SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x: length(x)::VARCHAR), ',') AS sizes FROM documents")
def f4_each(t):
    sizes = flow.each(F.split("text", "\n"), lambda x: F.length(x).cast("string"))
    return t.documents.select("doc_id", F.array_join(sizes, ",").alias("sizes"))


@query("f5_branch", "SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'big' ELSE 'small' END AS kind, CASE WHEN o_totalprice > 200000 THEN round(o_totalprice / 2, 4) ELSE o_totalprice END AS price FROM orders")
def f5_branch(t):
    """Column form for the name, row form for the price."""
    big = F.col("o_totalprice") > 200000
    named = t.orders.withColumn("kind", flow.branch(big, F.lit("big"), F.lit("small")))
    out = flow.branch_rows(named, big, lambda d: d.withColumn("price", F.round(F.col("o_totalprice") / 2, 4)),
                           lambda d: d.withColumn("price", F.col("o_totalprice")))
    return out.select("o_orderkey", "kind", "price")


@query("f6_switch", """SELECT event_id, CASE WHEN event_type = 'error' THEN 'alarm' WHEN value > 50 THEN 'large' ELSE 'plain' END AS route,
CASE WHEN event_type = 'error' THEN -1.0 WHEN value > 50 THEN round(value / 10, 4) ELSE value END::DOUBLE AS v FROM events""")
def f6_switch(t):
    cases = [(F.col("event_type") == "error", lambda d: d.withColumn("v", F.lit(-1.0))),
             (F.col("value") > 50, lambda d: d.withColumn("v", F.round(F.col("value") / 10, 4)))]
    named = t.events.withColumn("route", flow.switch([(cases[0][0], F.lit("alarm")), (cases[1][0], F.lit("large"))], F.lit("plain")))
    return flow.switch_rows(named, cases, lambda d: d.withColumn("v", F.col("value"))).select("event_id", "route", "v")


@query("f7_loop", """WITH RECURSIVE r AS (SELECT doc_id, n_chars // 2 AS n, 1 AS rounds FROM documents UNION ALL SELECT doc_id, n // 2, rounds + 1 FROM r WHERE n >= 10)
SELECT doc_id, n, rounds::INTEGER AS rounds, true AS done FROM r WHERE n < 10""")
def f7_loop(t):
    """Halve the length until it is below 10."""
    start = t.documents.select("doc_id", F.col("n_chars").alias("n"))
    return flow.loop(start, lambda d: d.withColumn("n", F.floor(F.col("n") / 2)), F.col("n") < 10, max_rounds=40)


@query("f8_bind", "SELECT lang, text, length(text) || ' of ' || n_chars AS note, lang || ':' || length(text) AS tag FROM documents")
def f8_bind(t):
    """The last step reaches back to the input and to the first output."""
    step1 = t.documents.withColumn("size", F.length("text"))
    step2 = step1.withColumn("note", F.concat_ws(" of ", F.col("size").cast("string"), F.col("n_chars").cast("string")))
    return step2.select("lang", "text", "note", F.concat_ws(":", "lang", F.col("size").cast("string")).alias("tag"))


@query("f9_intent", """WITH s AS (SELECT conv_id, turn, contains(lower(text), 'nicht')::INTEGER + contains(lower(text), 'und')::INTEGER AS a,
  contains(lower(text), 'the')::INTEGER + contains(lower(text), 'of')::INTEGER AS b, contains(lower(text), 'que')::INTEGER AS c FROM conversations WHERE role = 'user')
SELECT conv_id, turn, CASE WHEN greatest(a, b, c) = 0 THEN 'chat' WHEN a >= b AND a >= c THEN 'order' WHEN b >= c THEN 'question' ELSE 'return' END AS intent FROM s""")
def f9_intent(t):
    rules = {"order": ["nicht", "und"], "question": ["the", "of"], "return": ["que"]}
    users = t.conversations.filter("role = 'user'")
    return users.select("conv_id", "turn", flow.intent(F.col("text"), rules, "chat").alias("intent"))


# ---- conversations -----------------------------------------------------------------------------

@query("c1_history", """SELECT conv_id, turn, role, text, (row_number() OVER w - 1) AS turns_before, (sum(length(text)) OVER w - length(text))::BIGINT AS chars_before
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def c1_history(t):
    return chat.history_rows(t.conversations)


SHOTS = [("user", "Hello"), ("assistant", "How can I help?")]


@query("c2_defaults", """WITH f AS (SELECT conv_id, min(turn) AS turn FROM conversations GROUP BY conv_id)
SELECT conv_id, turn, 0::INTEGER AS seq, 'user' AS role, 'Hello' AS text FROM f UNION ALL SELECT conv_id, turn, 1, 'assistant', 'How can I help?' FROM f
UNION ALL SELECT conv_id, turn, 2, role, text FROM conversations JOIN f USING (conv_id, turn)""")
def c2_defaults(t):
    return chat.with_defaults(t.conversations, SHOTS)


@query("c3_history_text", "SELECT conv_id, (turn // 64)::INTEGER AS piece, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS history FROM conversations GROUP BY ALL")
def c3_history_text(t):
    return chat.history_text(t.conversations)


@query("c4_sessions", "SELECT user_id, event_id, count(*) OVER w AS nth, round(sum(value) OVER w, 4) AS total FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)")
def c4_sessions(t):
    """Interleaved events of many users: each user's running count and total is his own."""
    events = t.events.select("user_id", "event_id", "value", F.lit(1).alias("one"))
    counted = running_sum(events, "user_id", "event_id", "one", "nth")
    return running_sum(counted, "user_id", "event_id", "value", "total").select(
        "user_id", "event_id", "nth", F.round("total", 4).alias("total"))


# ---- knowledge-base changes --------------------------------------------------------------------

def _files(t):
    """Documents as files of one knowledge base per language."""
    name = F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return t.documents.select(F.col("lang").alias("kb"), F.concat_ws("/", "source", name).alias("path"), "doc_id",
                              F.lit(0).alias("version"), "text")


FILES = "fi AS (SELECT lang AS kb, source || '/doc' || doc_id || '.txt' AS path, doc_id, 0::INTEGER AS version, text FROM documents)"
BATCH = f"{FILES}, up AS (SELECT kb, path, doc_id, 1 + (length(text) % 2)::INTEGER AS version, lower(text) AS text FROM fi WHERE kb = 'fr' UNION ALL SELECT 'new', path, doc_id, 1, text FROM fi WHERE kb = 'es'), ev AS (SELECT * FROM fi UNION ALL SELECT * FROM up)"


def _batch(t):
    files = _files(t)
    changed = files.filter("kb = 'fr'").withColumn("version", (1 + F.length("text") % 2)).withColumn("text", F.lower("text"))
    fresh = files.filter("kb = 'es'").withColumn("kb", F.lit("new")).withColumn("version", F.lit(1))
    return changed.unionByName(fresh)


@query("k1_listing", f"WITH {FILES} SELECT kb, path, doc_id, 'success' AS status, length(text)::INTEGER AS size FROM fi")
def k1_listing(t):
    files = _files(t).withColumn("status", F.lit("success")).withColumn("size", F.length("text"))
    return kb.listing(files, ["kb", "path", "doc_id", "status", "size"])


@query("k2_upload_override", f"WITH {BATCH} SELECT kb, path, max(version)::INTEGER AS version, md5(arg_max(text, version)) AS body FROM ev GROUP BY kb, path")
def k2_upload_override(t):
    return kb.uploaded(_files(t), _batch(t)).select("kb", "path", "version", F.md5("text").alias("body"))


@query("k2_upload_keep", f"WITH {BATCH} SELECT kb, path, min(version)::INTEGER AS version, md5(arg_min(text, version)) AS body FROM ev GROUP BY kb, path")
def k2_upload_keep(t):
    return kb.uploaded(_files(t), _batch(t), override=False).select("kb", "path", "version", F.md5("text").alias("body"))


@query("k3_delete", f"WITH {FILES} SELECT kb, path FROM fi WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def k3_delete(t):
    files = _files(t)
    gone = files.join(t.labels.filter("toxic = 1").select("doc_id"), "doc_id", "left_semi")
    return kb.deleted(files, gone).select("kb", "path")


@query("k4_metadata", """SELECT doc_id, 'lang=' || lang || ';owner=' || source || ';source=' || source AS added, 'lang=xx;owner=' || lang || ';source=' || source AS updated,
'source=' || source AS removed, 'size=' || n_chars AS reset FROM documents""")
def k4_metadata(t):
    meta = F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"))
    added = kb.meta_added(meta, {"lang": F.lit("zz"), "owner": F.col("source")})
    updated = kb.meta_updated(meta, {"lang": F.lit("xx"), "owner": F.col("lang")})
    return t.documents.select("doc_id", kb.meta_text(added).alias("added"), kb.meta_text(updated).alias("updated"),
                              kb.meta_text(kb.meta_removed(meta, ["lang"])).alias("removed"),
                              kb.meta_text(kb.meta_reset({"size": F.col("n_chars").cast("string")})).alias("reset"))


@query("k5_field_defaults", "SELECT doc_id, coalesce(quality, -1)::INTEGER AS quality, coalesce(CASE WHEN toxic = 1 THEN 'toxic' END, 'clean') AS mark FROM documents LEFT JOIN labels USING (doc_id)")
def k5_field_defaults(t):
    given = t.labels.select("doc_id", "quality", F.when(F.col("toxic") == 1, "toxic").alias("mark"))
    files = kb.with_fields(t.documents.select("doc_id"), given, {"quality": F.lit(-1), "mark": F.lit("clean")}, {"mark": 10})
    return files.select("doc_id", "quality", "mark")


@query("k6_groups", """WITH m AS (SELECT 'lang:' || lang AS grp, doc_id FROM documents UNION ALL SELECT 'good', doc_id FROM labels WHERE quality = 1)
SELECT grp, count(*) AS members, count(DISTINCT text) AS texts FROM m JOIN documents USING (doc_id) GROUP BY grp""")
def k6_groups(t):
    members = t.documents.select(F.concat(F.lit("lang:"), "lang").alias("grp"), "doc_id").unionByName(
        t.labels.filter("quality = 1").select(F.lit("good").alias("grp"), "doc_id"))
    hashed = t.documents.select("doc_id", F.sha2("text", 256).alias("hash"))
    per_text = members.join(hashed, "doc_id").groupBy("grp", "hash").agg(F.count("*").alias("n"))
    return per_text.groupBy("grp").agg(F.sum("n").alias("members"), F.count("*").alias("texts"))
