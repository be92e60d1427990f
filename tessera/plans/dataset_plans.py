"""Training-set building (D rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.passages import holders
from tessera.functions.text import filled
from tessera.operators import datasets as ds, keywords as kw
from tessera.operators.evaluate import true_answer
from tessera.plans.evaluation_plans import BOXES, REF, boxed_rows
from tessera.plans.node_plans import PAIRS
from tessera.plans.common import passages
from tessera.plans.registry import query

HASH = "('0x' || substr(md5({0}), 1, 15))::BIGINT"


@query("d1_evaluation_rows", f"WITH {REF} SELECT d.text AS context, b.text AS question, d.source AS answers FROM ref JOIN documents d USING (doc_id) JOIN benchmark b ON item_id = qid")
def d1_evaluation_rows(t):
    """Passage and the document that holds it; the first of several answers is kept."""
    pairs = holders(t.documents, passages(t)).join(t.documents.select("doc_id", "text", "source", "lang"), "doc_id")
    rows = pairs.join(t.benchmark.select(F.col("item_id").alias("qid"), F.col("text").alias("q")), "qid")
    return ds.evaluation_rows(rows.withColumn("a", F.array("source", "lang")), "text", "q", "a")


@query("d2_instruction_rows", f"WITH {PAIRS} SELECT conv_id, turn, 'Answer the question.' || chr(10) || 'Question: ' || question AS instruction, '' AS input, answer AS output FROM qa")
def d2_instruction_rows(t):
    pairs = kw.question_answer_pairs(t.conversations)
    return ds.instruction_rows(pairs, "Answer the question.\nQuestion: {q}", {"q": "question"}, "answer", ("conv_id", "turn"))


@query("d3_session_rows", f"""WITH {PAIRS}, l AS (SELECT conv_id, max(turn) AS last FROM qa GROUP BY conv_id),
s AS (SELECT conv_id, max(text) AS system FROM conversations WHERE role = 'system' GROUP BY conv_id),
h AS (SELECT conv_id, (turn // 64)::INTEGER AS piece, to_json(list([question, answer] ORDER BY turn))::VARCHAR AS history FROM qa JOIN l USING (conv_id) WHERE turn < last GROUP BY ALL)
SELECT conv_id, coalesce(piece, 0)::INTEGER AS piece, coalesce(system, '') AS system, question AS instruction, answer AS output, coalesce(history, '[]') AS history
FROM qa JOIN l USING (conv_id) LEFT JOIN s USING (conv_id) LEFT JOIN h USING (conv_id) WHERE turn = last""")
def d3_session_rows(t):
    system = t.conversations.filter("role = 'system'").groupBy("conv_id").agg(F.max("text").alias("system"))
    return ds.session_rows(kw.question_answer_pairs(t.conversations), system)


@query("d4_message_rows", f"""WITH {PAIRS} SELECT conv_id, turn, to_json([{{'role': 'user', 'content': '<image>' || question}}, {{'role': 'assistant', 'content': answer}}])::VARCHAR AS messages,
question AS query, answer, 'img/' || conv_id || '.png' AS image FROM qa""")
def d4_message_rows(t):
    pairs = kw.question_answer_pairs(t.conversations)
    image = F.concat(F.lit("img/"), F.col("conv_id").cast("string"), F.lit(".png"))
    rows = ds.message_rows(pairs, F.col("question"), F.col("answer"), image, ("conv_id", "turn"))
    back = ds.from_messages(rows.withColumn("json", F.to_json("messages")), ("conv_id", "turn", "json"))
    return back.withColumnRenamed("json", "messages")


@query("d5_negatives", f"""WITH p AS (SELECT doc_id, text, row_number() OVER (ORDER BY sha256(doc_id::VARCHAR)) - 1 AS id FROM documents),
d AS (SELECT doc_id, id, j, {HASH.format("doc_id || '-' || j || '-1314'")} % ((SELECT count(*) FROM p) - 1) AS x FROM p, range(0, 10) r(j))
SELECT d.doc_id, j::INTEGER AS j, p.doc_id AS neg_key, md5(p.text) AS negative FROM d JOIN p ON p.id = CASE WHEN x >= d.id THEN x + 1 ELSE x END""")
def d5_negatives(t):
    return ds.negatives(t.documents, 10, 1314, "doc_id", "text").withColumn("negative", F.md5("negative"))


@query("d6_columns", f"WITH {PAIRS} SELECT conv_id, question AS query, to_json([answer])::VARCHAR AS pos, 'Represent this sentence for searching relevant passages:' AS prompt FROM qa")
def d6_columns(t):
    pairs = kw.question_answer_pairs(t.conversations).withColumnRenamed("question", "query")
    return pairs.select("conv_id", "query", F.to_json(F.array("answer")).alias("pos"),
                        F.lit("Represent this sentence for searching relevant passages:").alias("prompt"))


@query("d7_split", f"SELECT doc_id, CASE WHEN {HASH.format('doc_id || ' + chr(39) + '-1314' + chr(39))} % 1000 < 100 THEN 'test' ELSE 'train' END AS part FROM documents")
def d7_split(t):
    return t.documents.select("doc_id", ds.split_mark(F.col("doc_id"), 1314).alias("part"))


@query("d8_corpus", f"SELECT doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda p: p <> ''), ' ') AS line FROM documents WHERE {HASH.format('doc_id || ' + chr(39) + '-1314' + chr(39))} % 1000 < 100")
def d8_corpus(t):
    """Test part as one line per passage."""
    test = t.documents.filter(ds.split_mark(F.col("doc_id"), 1314) == "test")
    parts = F.filter(F.split("text", "\n"), lambda p: p != "")
    return test.select("doc_id", F.array_join(parts, " ").alias("line"))


THOUGHT = """th AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_tax > 0.02 THEN 'hm</think>' ELSE 'hm' END || output AS output,
  trim(list_last(string_split(truth, chr(10) || '#### '))) AS answer FROM bx),
ok AS (SELECT *, contains(output, 'boxed{' || answer || '}') AND contains(output, '</think>') AS ok FROM th)"""


def _attempts(t):
    """Line items as numbered attempts of an order."""
    rows = boxed_rows(t)
    thought = F.when(F.col("l_tax") > 0.02, "hm</think>").otherwise("hm")
    rows = rows.select("l_orderkey", "l_linenumber", F.concat(thought, "output").alias("output"),
                       true_answer(F.col("truth")).alias("answer"))
    return rows.withColumn("ok", ds.accepted(F.col("output"), F.col("answer")))


@query("d9_accepted", f"WITH {BOXES}, {THOUGHT} SELECT l_linenumber, ok, count(*) AS n FROM ok GROUP BY ALL")
def d9_accepted(t):
    return _attempts(t).groupBy("l_linenumber", "ok").agg(F.count("*").alias("n"))


@query("d9_rows", f"WITH {BOXES}, {THOUGHT} SELECT l_orderkey, l_linenumber, output, CASE WHEN ok THEN 'accepted' ELSE 'retry' END AS part FROM ok")
def d9_rows(t):
    """Every attempt, in the accepted part or in the one to try again."""
    part = F.when(F.col("ok"), "accepted").otherwise("retry")
    return _attempts(t).select("l_orderkey", "l_linenumber", "output", part.alias("part"))


@query("d10_rounds", f"""WITH {BOXES}, {THOUGHT}, f AS (SELECT l_orderkey, min(l_linenumber) AS l_linenumber, list_first(list(output ORDER BY l_linenumber, output)) AS output FROM ok WHERE ok AND l_linenumber <= 15 GROUP BY l_orderkey)
SELECT l_orderkey, l_linenumber, output, 'kept' AS part FROM f UNION ALL SELECT DISTINCT l_orderkey, NULL::INTEGER, NULL, 'left over' FROM ok WHERE l_orderkey NOT IN (SELECT l_orderkey FROM f)""")
def d10_rounds(t):
    attempts = _attempts(t)
    kept = ds.first_accepted(attempts, "l_orderkey", "l_linenumber", "output", "ok")
    rest = ds.left_over(attempts, kept, "l_orderkey").select(
        "l_orderkey", F.lit(None).cast("int").alias("l_linenumber"), F.lit(None).cast("string").alias("output"))
    return kept.withColumn("part", F.lit("kept")).unionByName(rest.withColumn("part", F.lit("left over")))


@query("d11_true_answer", f"WITH {BOXES} SELECT l_orderkey, l_linenumber, trim(list_last(string_split(truth, chr(10) || '#### '))) AS answer FROM bx")
def d11_true_answer(t):
    return boxed_rows(t).select("l_orderkey", "l_linenumber", true_answer(F.col("truth")).alias("answer"))


@query("d12_oversample", """SELECT 'chat' AS origin, role AS part, count(*) * 120 AS n FROM conversations GROUP BY role
UNION ALL SELECT 'document', lang, count(*) FROM documents GROUP BY lang""")
def d12_oversample(t):
    chat = ds.oversampled(t.conversations.select(F.lit("chat").alias("origin"), F.col("role").alias("part")), 120).drop("copy")
    mixed = chat.unionByName(t.documents.select(F.lit("document").alias("origin"), F.col("lang").alias("part")))
    return mixed.groupBy("origin", "part").agg(F.count("*").alias("n"))


@query("d12_copies", "SELECT conv_id, turn, role, unnest(range(1, 121))::INTEGER AS copy FROM conversations")
def d12_copies(t):
    """All 120 copies of every turn."""
    return ds.oversampled(t.conversations.select("conv_id", "turn", "role"), 120)


@query("d13_prompt", """SELECT doc_id, 'System: answer in ' || lang || chr(10) || 'Context from ' || source || ':' || chr(10) || text || chr(10) || 'Question: what is told?' AS prompt FROM documents""")
def d13_prompt(t):
    template = F.lit("System: answer in {lang}\nContext from {source}:\n{text}\nQuestion: {question}")
    slots = {"lang": F.col("lang"), "source": F.col("source"), "question": F.lit("what is told?"), "text": F.col("text")}
    return t.documents.select("doc_id", filled(template, slots).alias("prompt"))
