"""Streaming (X rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators.ranking import bm25_search
from tessera.operators.term_index import TermIndex
from tessera.plans.common import KEYS, LINES, LINE_WORDS, PASSAGES, bm25_cte, line_words, passages
from tessera.plans.node_plans import LISTED
from tessera.operators.nodes import explode_nodes
from tessera.plans.registry import query
from tessera.session import work_path
from tessera.streaming import live


BATCH = 1 << 30  # stored bytes of a micro-batch where the order of batches does not matter


def _stream(t, name, bytes_per_batch=None):
    return live.table_stream(t.spark, f"{t.folder}/{name}.parquet", bytes_per_batch)


def _line_nodes(docs):
    return explode_nodes(docs, tx.pieces(F.col("text"), "\n"))


@query("x1_live_index", f"WITH {LINES} SELECT doc_id, pos, content FROM ln")
def x1_live_index(t):
    """Documents come twice; the second time replaces the first."""
    index = live.LiveIndex(t.spark, _line_nodes)
    live.run_now(_stream(t, "documents", BATCH), index.take, work_path(t.spark, "cp")).awaitTermination()
    live.run_now(_stream(t, "documents", BATCH), lambda d, b: index.take(d, b + 1000), work_path(t.spark, "cp")).awaitTermination()
    return index.nodes().select(*KEYS, "content")


@query("x1_live_changes", f"""WITH {LINE_WORDS.replace("FROM documents)", "FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1))")},
{PASSAGES}, {bm25_cte()} SELECT * FROM hits""")
def x1_live_changes(t):
    """Documents arrive, toxic ones leave, and older copies of those come late, which changes nothing; the index answers."""
    docs, toxic = t.documents.select("doc_id", "text"), t.labels.filter("toxic = 1").select("doc_id").distinct()
    put = docs.select("doc_id", F.lit(1).cast("bigint").alias("version"), F.lit("put").alias("op"), "text")
    gone = toxic.select("doc_id", F.lit(2).cast("bigint").alias("version"), F.lit("delete").alias("op"), F.lit(None).cast("string").alias("text"))
    source = work_path(t.spark, "changes")
    for wave in (put, gone, put.join(toxic, "doc_id", "left_semi")):
        wave.repartition(2, "doc_id").write.mode("append").parquet(source)
    index = TermIndex(t.spark)
    nodes_of = lambda d: _line_nodes(d).select(*KEYS, tx.words(F.col("content")).alias("words"))
    feed = live.LiveTermIndex(t.spark, index, nodes_of, most_segments=2)
    changes = live.file_stream(t.spark, source, "*.parquet", files_per_batch=2)
    live.run_now(changes, feed.take, work_path(t.spark, "cp")).awaitTermination()
    index.vacuum()  # no search has begun yet
    return index.search(passages(t), 5)


@query("x2_live_questions", f"WITH {LINE_WORDS}, {PASSAGES}, {bm25_cte(k=3)} SELECT * FROM hits")
def x2_live_questions(t):
    search = lambda nodes, q: bm25_search(nodes, q.select(
        F.col("item_id").alias("qid"), tx.words(F.col("text")).alias("words")), 3, KEYS)
    answers = live.LiveAnswers(t.spark, lambda: line_words(t), search)
    live.run_now(_stream(t, "benchmark"), answers.take, work_path(t.spark, "cp")).awaitTermination()
    return answers.answers().select("qid", *KEYS, "score", "rk")


def _stateful(t, stream):
    """Run a stream with state through all its input; what it emitted."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = t.spark.conf.get(key)
    t.spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    out, cp = work_path(t.spark, "stateful"), work_path(t.spark, "cp")
    try:
        stream.writeStream.format("parquet").option("checkpointLocation", cp).trigger(availableNow=True).start(out).awaitTermination()
    finally:
        t.spark.conf.set(key, before)
    return t.spark.read.schema(stream.schema).parquet(out)


@query("x3_session_state", """SELECT conv_id, turn, (row_number() OVER w - 1) AS turns_before, (sum(length(text)) OVER w - length(text))::BIGINT AS chars_before
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def x3_session_state(t):
    return _stateful(t, live.session_stream(_stream(t, "conversations")))


@query("x3_ordered_turns", """SELECT conv_id, turn, (row_number() OVER w - 1) AS turns_before, (sum(length(text)) OVER w - length(text))::BIGINT AS chars_before
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def x3_ordered_turns(t):
    """Turns arrive shuffled over several batches and are handed on in their order; a turn is said a minute after the one before."""
    source = work_path(t.spark, "turns")
    said = t.conversations.withColumn("at", F.timestamp_seconds(1_700_000_000 + F.col("turn") * 60))
    said.repartition(4, F.xxhash64("turn", "conv_id")).write.parquet(source)
    return _stateful(t, live.ordered_sessions(live.file_stream(t.spark, source, "*.parquet"), "at", wait_ms=600_000))


@query("x4_expiry", """WITH r AS (SELECT event_id, user_id, value, ts AS created_at FROM events), m AS (SELECT max(created_at) AS now FROM r)
SELECT event_id, user_id, value FROM r, m WHERE created_at > now - INTERVAL 3 DAY""")
def x4_expiry(t):
    """Saved results are the events; three days after, they no longer count."""
    saved = t.events.select("event_id", "user_id", "value", F.col("ts").alias("created_at"))
    now = t.events.agg(F.max("ts").cast("string")).first()[0]
    return live.fresh_results(saved, now, 3 * 86400).drop("created_at")


@query("x4_expired_lives", """WITH e AS (SELECT user_id AS key, epoch_us(ts) // 1000 AS ms FROM events),
b AS (SELECT *, coalesce(ms >= lag(ms) OVER w + 259200000, true)::INT AS fresh FROM e WINDOW w AS (PARTITION BY key ORDER BY ms)),
l AS (SELECT *, sum(fresh) OVER (PARTITION BY key ORDER BY ms ROWS UNBOUNDED PRECEDING) AS life FROM b),
r AS (SELECT key, min(ms) AS first_ms, max(ms) AS last_ms, count(*) AS saves, max(ms) + 259200000 AS expired_ms FROM l GROUP BY key, life)
SELECT key, first_ms, last_ms, saves, expired_ms FROM r WHERE expired_ms < (SELECT max(ms) - 3600000 FROM e)""")
def x4_expired_lives(t):
    """Saves of a user's result keep it alive for three days each; the stream tells which lives are over."""
    return _stateful(t, live.expired_results(_stream(t, "events"), "user_id", "ts", 3 * 86_400_000))


@query("x5_masked_stream", """WITH m AS (SELECT doc_id, string_split_regex(text, 'on|and|eau|que|the|ung|keit|token') AS b,
  list_concat(regexp_extract_all(text, 'on|and|eau|que|the|ung|keit|token'), ['']) AS h FROM documents)
SELECT doc_id, array_to_string(list_transform(b, lambda x, i: x || repeat('*', length(h[i]))), '') AS text FROM m""")
def x5_masked_stream(t):
    out, cp = work_path(t.spark, "masked"), work_path(t.spark, "cp")
    stream = live.masked_stream(_stream(t, "documents", BATCH).select("doc_id", "text"), "text", LISTED)
    stream.writeStream.format("parquet").option("checkpointLocation", cp).trigger(availableNow=True).start(out).awaitTermination()
    return t.spark.read.parquet(out)
