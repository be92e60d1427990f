"""Tables that are folders of files instead of one file."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators.nodes import explode_nodes
from tessera.plans.all_plans import QUERIES
from tessera.streaming.live import LiveIndex, newest


def folder_of(spark, tmp_path, name, parts, schema):
    """A table of several files, later rows first."""
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


DOCS = [[(2, "on the\n\nhill")], [(1, "a token"), (3, None)]]


@pytest.fixture
def docs(spark, tmp_path):
    return folder_of(spark, tmp_path, "documents", DOCS, "doc_id bigint, text string")


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_scan(spark, docs):
    assert [tuple(r) for r in QUERIES["s1_scan"](spark, docs).orderBy("doc_id").collect()] == [
        (1, "documents.parquet", 7), (2, "documents.parquet", 12), (3, "documents.parquet", None)]


def test_live_index(spark, docs):
    assert rows_of(QUERIES["x1_live_index"](spark, docs)) == [(1, 0, "a token"), (2, 0, "on the"), (2, 1, "hill")]


def test_live_index_reads_batches_whole_or_in_part(spark):
    index = LiveIndex(spark, lambda d: explode_nodes(d, tx.pieces(F.col("text"), "\n")))
    batches = [[(1, 1, "a"), (2, 1, "b\nc"), (2, 2, "d"), (None, 1, "n")], [(3, 1, "e")], [(2, 1, "f"), (4, 1, "g")], [(3, 1, "h\ni")]]
    for i, batch in enumerate(batches):
        index.take(spark.createDataFrame(batch, "doc_id bigint, version bigint, text string"), i)
    got = sorted((r.doc_id, r.pos, r.content) for r in index.nodes().collect())
    assert got == [(1, 0, "a"), (2, 0, "f"), (3, 0, "h"), (3, 1, "i"), (4, 0, "g")]
    whole = LiveIndex(spark, index.nodes_of)
    for i in (0, 1):
        whole.take(spark.createDataFrame(batches[1], "doc_id bigint, version bigint, text string"), i)
    assert "Exchange" not in whole.nodes()._jdf.queryExecution().executedPlan().toString()


def test_masked_stream(spark, docs):
    got = {r.doc_id: r.text for r in QUERIES["x5_masked_stream"](spark, docs).collect()}
    assert got == {1: "a *****", 2: "** ***\n\nhill", 3: None}


def test_a_session_in_several_files(spark, tmp_path):
    parts = [[(1, 2, "ccc"), (2, 1, "z")], [(1, 0, "a"), (1, 1, "bb")], [(2, 0, "yy")]]
    folder = folder_of(spark, tmp_path, "conversations", parts, "conv_id bigint, turn bigint, text string")
    assert rows_of(QUERIES["x3_session_state"](spark, folder)) == [(1, 0, 0, 0), (1, 1, 1, 1), (1, 2, 2, 3), (2, 0, 0, 0), (2, 1, 1, 2)]


def test_newest_rows(spark):
    """Null ids are one document; documents with one row do not meet the others."""
    rows = [(1, 1, "a"), (2, 1, "b"), (2, 3, "c"), (2, 3, "d"), (None, 1, "e"), (None, 2, "f"), (3, None, None)]
    got = newest(spark.createDataFrame(rows, "doc_id bigint, version bigint, text string"), ["version", "text"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, 1, "a"), (2, 3, "d"), (None, 2, "f"), (3, None, None)], key=str)
