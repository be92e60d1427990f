"""Terms grouped per task: every count once, one row per group and term, statistics from the same rows."""

import collections
import math

from pyspark.sql import functions as F

from tessera.operators import keywords as kw, term_groups as tg, vectors as vc


def test_groups_hold_every_count(spark):
    given = [(1, "a", ["x", "y", "x"]), (2, None, ["x"]), (2, None, ["x"]), (None, "b", ["z", "ß", "z", "z"]), (5, "c", []), (6, "d", None), (7, "e", ["x", None])]
    nodes = spark.createDataFrame(given, "id int, at string, words array<string>").coalesce(1)
    groups = tg.term_groups(nodes, ["id", "at"])
    assert sorted((r.term, r.n) for r in groups.collect()) == [("x", 4), ("y", 1), ("z", 1), ("ß", 1)]  # a row a term, not one a node
    got = collections.Counter(tuple(r) for r in groups.select("term", F.inline("found")).collect())
    want = collections.Counter((t, i, at, n) for i, at, words in given for t, n in collections.Counter(w for w in words or [] if w).items())
    assert got == want


def test_many_groups_give_the_same_weights(spark, monkeypatch):
    given = [(i % 90, [f"w{i % 7}", "hot", f"w{i % 11}"]) for i in range(100)]  # keys come twice
    nodes = spark.createDataFrame(given, "id int, words array<string>").repartition(3)
    df = collections.Counter(w for _, words in given for w in set(words))
    want = sorted((i, t, n, round(n * math.log(100 / df[t]), 6)) for i, words in given for t, n in collections.Counter(words).items())
    assert sorted((r.id, r.term, r.tf, round(r.w, 6)) for r in vc.sparse_vectors(nodes, ["id"]).collect()) == want
    best = kw.keywords(nodes, ["id"], 1).collect()
    assert {(r.id, r.term) for r in best} == {(i, min((-w, t) for j, t, _, w in want if j == i)[1]) for i in range(90)}
    assert vc.sparse_vectors(nodes.limit(0), ["id"]).count() == 0


def test_a_node_is_read_once_and_a_frequent_term_is_not_a_row_each(spark):
    nodes = spark.createDataFrame([(i, ["hot", "warm"]) for i in range(500)], "id int, words array<string>").coalesce(2)
    plan = vc.sparse_vectors(nodes, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "inline" in plan and "sort_array" not in plan
    assert tg.term_groups(nodes, ["id"]).count() <= 4
