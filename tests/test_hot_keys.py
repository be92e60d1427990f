"""A term or entity of two thirds of the rows, without automatic broadcasts: split, or combined before the shuffle."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.operators import graph as gr, keywords as kw, vectors as vc
from tessera.operators.ranking import corpus_stats, query_terms

SMALL = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def unhelped(spark):
    before = {name: spark.conf.get(name, None) for name in SMALL}
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture(scope="module")
def nodes(spark):
    rnd = random.Random(3)
    rows = [(i, (["hot"] if i % 3 else []) + [f"w{rnd.randrange(60)}" for _ in range(2)]) for i in range(6000)]
    return spark.createDataFrame(rows, "id int, words array<string>").repartition(4)


def ran(df):
    """The rows, and the plan as AQE ended it."""
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def partial_below_exchange(plan):
    """Every hash exchange on the term stands above a partial count."""
    lines = plan.split("== Initial Plan ==")[0].split("\n")
    at = [i for i, line in enumerate(lines) if re.search(r"Exchange hashpartitioning\(term", line)]
    return bool(at) and all("HashAggregate" in lines[i + 1] + lines[i + 2] for i in at)


@pytest.mark.parametrize("most", [1000, 0])
def test_statistics_count_before_the_shuffle(unhelped, nodes, most):
    queries = unhelped.createDataFrame([(0, ["hot", "w1", "absent"])], "qid int, words array<string>")
    rows, plan = ran(corpus_stats(nodes, query_terms(queries), max_terms=most))
    local = nodes.collect()
    df = collections.Counter(w for r in local for w in set(r.words))
    got = {r.term: r.df for r in rows}
    assert got == {"hot": df["hot"], "w1": df["w1"], "": len(local)}
    assert {r.term: r.total for r in rows}[""] == sum(len(r.words) for r in local)
    assert ("BroadcastHashJoin" in plan) == (most > 0)
    assert partial_below_exchange(plan)


def test_no_nodes_and_no_terms(spark, nodes):
    queries = spark.createDataFrame([(0, ["hot"])], "qid int, words array<string>")
    for most in (10, 0):
        assert corpus_stats(nodes.limit(0), query_terms(queries), max_terms=most).count() == 0
        assert [(r.term, r.df) for r in corpus_stats(nodes, query_terms(queries.limit(0)), max_terms=most).collect()] == [("", 6000)]


def test_joins_with_a_hot_term_are_split(unhelped, nodes):
    best, plan = ran(kw.keywords(nodes, ["id"], 2))
    assert "skew=true" in plan and len(best) == len({(r.id, r.term) for r in best})
    sparse, plan = ran(vc.sparse_vectors(nodes, ["id"]))
    assert "skew=true" in plan
    assert sum(r.term == "hot" for r in sparse) == 4000
    sentences = nodes.withColumn("pos", F.lit(0)).withColumn("content", F.array_join("words", " "))
    made, plan = ran(kw.summaries(nodes.select("id", "words"), sentences, 1, "id"))
    assert "skew=true" in plan and len(made) == 6000


def test_relations_of_a_hub(unhelped):
    rnd = random.Random(5)
    links = [("hub", f"n{i:05d}", rnd.randrange(1000)) for i in range(4000)] + [(f"a{i}", f"b{i}", 1) for i in range(2000)]
    relations = unhelped.createDataFrame(links, "src string, tgt string, weight int").repartition(4)
    seeds = unhelped.createDataFrame([(q, "hub") for q in range(30)] + [(99, "a5")], "qid int, name string")
    found = gr.low_level(seeds, relations, 5).collect()
    want = sorted(links[:4000], key=lambda r: (-r[2], r[0], r[1]))[:5]
    assert sorted((r.rk, r.tgt) for r in found if r.qid == 7) == [(i + 1, r[1]) for i, r in enumerate(want)]
    assert [r.tgt for r in found if r.qid == 99] == ["b5"]
