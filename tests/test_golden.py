"""Worked examples with known results."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import masking as mk, text as tx, vector as vx
from tessera.operators import evaluate as ev, flow, graph as gr, vectors as vc
from tessera.operators.nodes import NodeTree
from tessera.operators.ranking import char_search, tfidf_search
from tessera.operators.search import block_search, max_sim_scorer, vector_scorer


def one(df):
    return df.first()[0]


def test_sparse_inner_product(spark):
    df = spark.sql("SELECT map('1', 0.3D, '3', 0.7D, '5', 0.5D) a, map('1', 0.4D, '3', 0.6D, '5', 0.2D) b, map('2', 0.8D, '4', 0.6D) c")
    assert one(df.select(vx.sparse_dot(F.col("a"), F.col("b")))) == pytest.approx(0.64)
    assert one(df.select(vx.sparse_dot(F.col("a"), F.col("c")))) == 0


def test_max_sim(spark):
    q, d = [[0.5, -0.2], [0.3, 0.8]], [[0.1, 0.4], [-0.3, 0.6], [0.7, -0.5]]
    df = spark.createDataFrame([(q, d)], "q array<array<double>>, d array<array<double>>")
    assert one(df.select(vx.max_sim(F.col("q"), F.col("d")))) == pytest.approx(0.84)
    nodes = spark.createDataFrame([(1, sum(d, []))], "id long, vec array<double>")
    queries = spark.createDataFrame([(1, sum(q, []))], "qid long, vec array<double>")
    hit = block_search(nodes, queries, max_sim_scorer(2), 1, ["id"], ["vec"]).first()
    assert hit["score"] == pytest.approx(0.84)


def test_char_tfidf_of_one_node(spark):
    """Corpus of one node plus the query, checked against the formula computed by hand."""
    node, text = "abab c", "a b d"
    n = 2
    idf = lambda df: math.log((1 + n) / (1 + df)) + 1
    wn = {"a": 2 * idf(2), "b": 2 * idf(2), "c": idf(1)}
    wq = {"a": idf(2), "b": idf(2), "d": idf(1)}
    want = sum(wn[c] * wq[c] for c in "ab") / math.sqrt(sum(x * x for x in wn.values()) * sum(x * x for x in wq.values()))
    nodes = spark.createDataFrame([(1, node)], "id long, t string").select("id", tx.packed(F.col("t")).alias("packed"))
    queries = spark.createDataFrame([(1, text)], "qid long, t string").select("qid", tx.packed(F.col("t")).alias("packed"))
    for mode in ("corpus", "pair"):
        assert char_search(nodes, queries, 1, ["id"], mode=mode).first()["score"] == pytest.approx(want, abs=1e-6)


def test_plain_tfidf_zero_idf(spark):
    """A word in N - 1 of N nodes has idf ln(1) = 0 and still counts as a hit."""
    rows = [(1, ["x", "y"]), (2, ["x", "z"]), (3, ["w"])]
    nodes = spark.createDataFrame(rows, "id long, words array<string>")
    queries = spark.createDataFrame([(1, ["x"]), (2, ["y"])], "qid long, words array<string>")
    got = {(r["qid"], r["id"]): r["score"] for r in tfidf_search(nodes, queries, 5, ["id"]).collect()}
    assert got == {(1, 1): 0.0, (1, 2): 0.0, (2, 1): pytest.approx(0.5 * math.log(3 / 2), abs=1e-6)}


def test_product_quantisation_example(spark):
    books = np.array([[[3.0, 4.4], [3.2, 4.5]], [[1.8, 2.7], [1.5, 2.9]]])
    rows = [(1, [3.2, 4.5, 1.8, 2.7]), (2, [2.9, 4.3, 1.5, 2.9]), (3, [3.1, 4.6, 1.9, 2.5]), (4, [3.0, 4.4, 1.7, 2.8])]
    nodes = spark.createDataFrame(rows, "id long, vec array<double>")
    coded = vc.encode_codes(nodes, books, ["id"])
    codes = {r["id"]: list(r["codes"]) for r in coded.collect()}
    assert codes[1] == [1, 0] and codes[3] == [1, 0]
    queries = spark.createDataFrame([(1, [3.1, 4.5, 1.7, 2.8])], "qid long, vec array<double>")
    hits = vc.code_search(coded, nodes, queries, books, 2, ["id"], survivors=2).orderBy("rk").collect()
    assert [(r["id"], round(r["score"], 2)) for r in hits] == [(1, 0.17), (3, 0.37)]


def test_recall_and_relevance(spark):
    got = spark.createDataFrame([(1, "a"), (1, "b")], "qid long, s string")
    ref = spark.createDataFrame([(1, "a"), (2, "z")], "qid long, s string")
    assert {r["qid"]: r["recall"] for r in ev.context_recall(got, ref, "s").collect()} == {1: 1.0, 2: 0.0}
    assert ev.context_relevance(got, ref, got, "s").first()["relevance"] == 0.5


def test_faithfulness_and_flags(spark):
    judged = spark.createDataFrame([(1, True)] * 3 + [(1, False)] * 2, "qid long, supported boolean")
    assert ev.faithfulness(judged).first()["faithfulness"] == 0.6
    flags = spark.createDataFrame([(True, True), (True, False), (False, True)], "relevant boolean, returned boolean")
    assert ev.recall_of_flags(flags, F.col("relevant"), F.col("returned")).first()["recall"] == 0.5


def test_boxed(spark):
    rows = [("x \\boxed{4}", "4", True), ("\\boxed{4} \\boxed{4}", "4", True), ("\\boxed{4} \\boxed{5}", "4", False),
            ("\\boxed{\\frac{1}{2}}", "\\frac{1}{2}", True), ("none", "4", False)]
    df = spark.createDataFrame(rows, "o string, t string, want boolean")
    for r in df.select("want", ev.boxed_correct(F.col("o"), F.col("t")).alias("got")).collect():
        assert r["got"] == r["want"]


def test_mask_shortest_word_wins(spark):
    df = spark.createDataFrame([("abcab",), ("",), ("xyz 😀 a.b",), (None,)], "t string")
    got = [r[0] for r in df.select(mk.masked(F.col("t"), ["abc", "ab"])).collect()]
    assert got == ["**c**", "", "xyz 😀 a.b", None]
    assert one(df.limit(1).select(mk.masked(F.lit("1.a+b axb"), ["a+b", "1."]))) == "**" + "***" + " axb"


def test_combinators(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    out = flow.divert([F.col("x"), F.col("x") * 2, F.col("x")], [lambda v: v * 2, lambda v: v * 2, lambda v: v / 2])
    assert one(df.select(out)) == [2.0, 4.0, 0.5]
    fan = flow.FanOut(F.col("x"), {"a": lambda v: v + 1, "b": lambda v: v * 3})
    row = df.select(fan.as_struct().alias("s"), fan.as_map().alias("m"), fan.joined("-").alias("j")).first()
    assert row["s"].asDict() == {"a": 2.0, "b": 3.0} == row["m"] and row["j"] == "2.0-3.0"


def test_loop_stops_and_reports_open_rows(spark):
    df = spark.createDataFrame([(1,), (50,), (3,)], "n long")
    rows = flow.loop(df, lambda d: d.withColumn("n", F.col("n") * 2), F.col("n") > 20, max_rounds=3).collect()
    assert sorted((r["n"], r["rounds"], r["done"]) for r in rows) == [(8, 3, False), (24, 3, True), (100, 1, True)]


def test_extraction_text(spark):
    text = ('intro ("entity"<|>"Ada"<|>"person"<|>"lost: no leading bracket")##("entity"<|>"Bob"<|>"person"<|>"a man")##\n'
            '("entity"<|>"Broken"<|>"person")##("relationship"<|>"Bob"<|>"Town"<|>"lives\nthere"<|>"home"<|>8)##'
            '("relationship"<|>"Bob"<|>"Town"<|>"bad weight"<|>"home"<|>many)##("content_keywords"<|>"x,y")<|COMPLETE|>')
    df = spark.createDataFrame([(1, text)], "id long, t string")
    tuples = gr.parsed_tuples(df, "t", ("id",))
    assert [tuple(r) for r in gr.parsed_entities(tuples, ("id",)).collect()] == [(1, "Bob", "person", "a man")]
    assert [tuple(r) for r in gr.parsed_relations(tuples, ("id",)).collect()] == [(1, "Bob", "Town", "lives there", "home", 8.0)]


def test_tree_positions(spark):
    docs = spark.createDataFrame([(1, "a b.c\n\nd."), (2, ""), (3, None)], "doc_id long, text string")
    tree = (NodeTree(docs).group("line", lambda c: tx.pieces(c, "\n")).group("sentence", lambda c: tx.pieces(c, "."), "line")
            .group("word", lambda c: tx.pieces(c, " "), "sentence"))
    assert [(r["doc_id"], r["pos"], r["content"]) for r in tree.nodes("line").collect()] == [(1, 0, "a b.c"), (1, 1, "d.")]
    words = [(r["pos"], list(r["anc"]), r["content"]) for r in tree.nodes("word").collect()]
    assert words == [(0, [0, 0], "a"), (1, [0, 0], "b"), (2, [0, 1], "c"), (3, [1, 2], "d")]


def test_clamped_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 0.0], 0.0), ([1.0, 0.0], [-1.0, 0.0], 0.0), ([1.0, 1.0], [2.0, 2.0], 1.0)],
                               "a array<double>, b array<double>, want double")
    for r in df.select("want", vx.clamped_cosine(F.col("a"), F.col("b")).alias("got")).collect():
        assert r["got"] == pytest.approx(r["want"])


def test_euclid_ascending(spark):
    nodes = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(6)], "id long, vec array<double>")
    queries = spark.createDataFrame([(9, [2.2, 0.0])], "qid long, vec array<double>")
    hits = block_search(nodes, queries, vector_scorer("l2"), 3, ["id"], ["vec"]).orderBy("rk").collect()
    assert [(r["id"], r["score"]) for r in hits] == [(2, 0.2), (3, 0.8), (1, 1.2)]
