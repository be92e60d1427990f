"""Stored inverted index: equal to a search over the live nodes, through segments, retries and compaction."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import nodes as nd
from tessera.operators.ranking import bm25_search
from tessera.operators.term_index import TermIndex
from tessera.streaming.live import LiveTermIndex

KEYS = ["doc_id", "pos"]
SCHEMA = "doc_id bigint, pos int, words array<string>"


def some_nodes(seed, ids):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    return [(d, p, rng.choices(vocabulary, [1 / (i + 1) for i in range(60)], k=rng.randrange(1, 25)) + ["everywhere"]) for d in ids for p in range(3)]


@pytest.fixture(scope="module")
def queries(spark):
    rng = random.Random(7)
    rows = [(i, rng.choices([f"w{j}" for j in range(64)], k=rng.randrange(1, 6))) for i in range(12)]
    return spark.createDataFrame([*rows, (50, ["everywhere"]), (51, ["nowhere"]), (52, [])], "qid int, words array<string>").cache()


def rows_of(df):
    return sorted(tuple(r[c] for c in ["qid", *KEYS, "score", "rk"]) for r in df.collect())


def searched(spark, rows, queries, k=4):
    return rows_of(bm25_search(spark.createDataFrame(rows, SCHEMA), queries, k, KEYS))


def test_segments_removals_and_compaction_equal_a_plain_search(spark, queries):
    index = TermIndex(spark, shelf_nodes=8, buckets=4)
    one, two, three = some_nodes(1, range(40)), some_nodes(2, range(40, 60)), some_nodes(3, range(5, 9))
    df = lambda rows: spark.createDataFrame(rows, SCHEMA)
    index.commit(1, df(one))
    assert rows_of(index.search(queries, 4)) == searched(spark, one, queries)
    index.commit(2, df(two), spark.createDataFrame([(3,), (4,), (77,)], "doc_id bigint"))
    index.commit(3, df(three))  # replaces keys
    index.commit(4, removed=spark.createDataFrame([(10, 1)], "doc_id bigint, pos int"))
    left = [r for r in one if r[0] not in (3, 4, 5, 6, 7, 8) and r[:2] != (10, 1)] + two + three
    want = searched(spark, left, queries)
    assert rows_of(index.search(queries, 4)) == want
    index.commit(4, df(some_nodes(9, range(100, 120))))  # a number already committed
    assert rows_of(index.search(queries, 4)) == want
    assert sorted((r.doc_id, r.pos) for r in index.nodes().collect()) == sorted(r[:2] for r in left)
    begun = index.search(queries, 4)
    index.compact()
    assert [r.seg[0] for r in index.live()] == ["b"] and rows_of(begun) == want
    assert rows_of(index.search(queries, 4)) == want
    index.vacuum()
    assert rows_of(TermIndex(spark, path=index.path, shelf_nodes=8, buckets=4).search(queries, 4)) == want
    index.commit(5, df(one[:9]))  # after a base
    back = [r for r in left if r[:2] not in {x[:2] for x in one[:9]}] + one[:9]
    assert rows_of(index.search(queries, 4)) == searched(spark, back, queries)


def test_a_failed_commit_leaves_nothing(spark, queries):
    index = TermIndex(spark, buckets=4)
    rows = some_nodes(1, range(10))
    index.commit(1, spark.createDataFrame(rows, SCHEMA))
    finish, index._finish = index._finish, lambda *a: 1 / 0
    with pytest.raises(ZeroDivisionError):
        index.commit(2, spark.createDataFrame(some_nodes(2, range(50)), SCHEMA), spark.createDataFrame([(1,)], "doc_id bigint"))
    assert rows_of(index.search(queries, 4)) == searched(spark, rows, queries)
    index._finish = finish
    index.commit(2, spark.createDataFrame(some_nodes(3, range(90, 95)), SCHEMA))
    assert rows_of(index.search(queries, 4)) == searched(spark, rows + some_nodes(3, range(90, 95)), queries)


def test_shelves_that_cannot_reach_the_top_are_not_read(spark):
    rows = [(d, 0, ["common", "x"] + ["rare"] * (d in (3, 500))) for d in range(2000)]
    index = TermIndex(spark, shelf_nodes=16)
    index.commit(1, spark.createDataFrame(rows, SCHEMA))
    q = spark.createDataFrame([(1, ["common", "rare"])], "qid int, words array<string>")
    assert [r.doc_id for r in index.search(q, 2).orderBy("rk").collect()] == [3, 500]
    assert index.open.count() == 2 and index.bounds.count() >= 125


def test_only_term_hashes_of_the_query_are_read(spark):
    index = TermIndex(spark, buckets=64)
    index.commit(1, spark.createDataFrame(some_nodes(1, range(30)), SCHEMA))
    hits = index.search(spark.createDataFrame([(1, ["w1"])], "qid int, words array<string>"), 3)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    bucket = spark.range(1).select(index._bucket_of("w1")).first()[0]
    assert "bucket#" in plan and f" {bucket})" in plan.split("PartitionFilters")[1]


def test_postings_meet_once_for_all_queries(spark, queries):
    index = TermIndex(spark, buckets=4, shelf_nodes=8)
    index.commit(1, spark.createDataFrame(some_nodes(1, range(30)), SCHEMA))
    plan = index.search(queries, 3)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and not re.search(r"hashpartitioning\(qid#\d+, seg#", plan)


def test_edges(spark, queries):
    index = TermIndex(spark, buckets=2)
    assert index.search(queries, 3).count() == 0
    index.commit(1)
    assert index.search(queries, 3).count() == 0
    index.commit(2, spark.createDataFrame([(1, 0, None), (2, 0, []), (None, 0, ["w1"]), (3, 0, ["w1"]), (3, 0, ["w1"])], SCHEMA))
    assert index.nodes().count() == 4
    assert [(r.doc_id, r.rk) for r in index.search(queries.filter("array_contains(words, 'w1')").limit(1), 5).orderBy("rk").collect()] in ([(None, 1), (3, 2)], [])


def test_a_stream_of_changes_equals_the_batch_index(spark, queries):
    index = TermIndex(spark, buckets=4)
    nodes_of = lambda d: nd.explode_nodes(d, tx.pieces(F.col("text"), "\n")).select(*KEYS, tx.words(F.col("content")).alias("words"))
    feed = LiveTermIndex(spark, index, nodes_of, most_segments=2)
    text = lambda seed: "\n".join(" ".join(w) for _, _, w in some_nodes(seed, [0]))
    batches = [[(1, 1, "put", text(1)), (2, 1, "put", text(2)), (3, 5, "put", text(3))],
               [(2, 2, "delete", None), (4, 1, "put", text(4)), (4, 2, "put", text(5))],
               [(3, 4, "delete", None), (2, 1, "put", text(6)), (5, 1, "put", text(7))],  # both late
               [(1, 2, "put", text(8)), (5, 1, "put", text(9)), (6, 1, "delete", None)]]
    frames = [spark.createDataFrame(b, "doc_id bigint, version bigint, op string, text string") for b in batches]
    for i, frame in enumerate(frames):
        feed.take(frame, i)
        feed.take(frame, i)  # the batch is run again
        assert len(index.live()) <= 2 + 1
    last = {1: text(8), 3: text(3), 4: text(5), 5: text(7)}
    docs = spark.createDataFrame(list(last.items()), "doc_id bigint, text string")
    assert rows_of(index.search(queries, 4)) == rows_of(bm25_search(nodes_of(docs), queries, 4, KEYS))
