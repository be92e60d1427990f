"""Transforms of whole nodes, question/answer pairs with gaps, late interaction on ragged tokens, similarity modes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import vector as vx
from tessera.operators import keywords as kw
from tessera.operators.search import block_search, max_sim_scorer, vector_scorer
from tessera.operators.similarity import SimilarityRegistry


def made(df):
    return sorted((r.id, r.sub, r.content, tuple(sorted(r.metadata.items()))) for r in df.collect())


def test_transforms_of_nodes(spark):
    class Splitter:
        def __init__(self, mark):
            self.mark = mark

        def __call__(self, text):
            return text.split(self.mark)

    nodes = spark.createDataFrame([(1, "a.b.c", {"k": "v"}), (2, "", {}), (3, None, None), (4, "one", {"k": "w"})], "id int, content string, metadata map<string,string>")
    assert made(kw.node_transform(nodes, Splitter("."))) == [(1, 0, "a", (("k", "v"),)), (1, 1, "b", (("k", "v"),)), (1, 2, "c", (("k", "v"),)),
                                                            (2, 0, "", ()), (3, 0, "", ()), (4, 0, "one", (("k", "w"),))]
    assert made(kw.node_transform(nodes, lambda t: t.upper() if t else None)) == [(1, 0, "A.B.C", (("k", "v"),)), (4, 0, "ONE", (("k", "w"),))]

    def counted(node):  # none, one or three nodes, with a changed field
        node.metadata["seen"] = "yes"
        return [kw.Node(p, {"n": str(i)}) for i, p in enumerate(node.text.split("."))] if "." in node.text else [node.text] if node.text else []

    assert made(kw.node_transform(nodes, counted, trans_node=True)) == [(1, i, c, (("n", str(i)),)) for i, c in enumerate("abc")] + [(4, 0, "one", (("k", "w"),))]
    changed = kw.node_transform(nodes, lambda n: kw.Node(n.text, {**n.metadata, "k": "x"}), trans_node=True)
    assert made(changed.filter("id = 4")) == [(4, 0, "one", (("k", "x"),))]
    bare = nodes.select("id", "content", F.lit("kept").alias("other"))
    assert {r.other for r in kw.node_transform(bare, Splitter(".")).collect()} == {"kept"}
    assert kw.node_transform(nodes.limit(0), Splitter(".")).count() == 0


def brute_pairs(rows):
    out = []
    for conv in {r[0] for r in rows if r[0] is not None}:
        own = sorted(((t, role, text) for c, t, role, text in rows if c == conv and t is not None and role in ("user", "assistant")))
        out += [(conv, a[0], a[2], b[2]) for a, b in zip(own, own[1:]) if a[1] == "user" and b[1] == "assistant"]
    return sorted(out)


def test_pairs_over_gaps_notes_and_blocks(spark, monkeypatch):
    rows = [(1, 0, "user", "q"), (1, 1, "system", "s"), (1, 2, "assistant", "a"), (1, 9, "user", "q1"), (1, 20, "user", "q2"), (1, 100, "assistant", "a2"), (1, 101, "assistant", "a3"),
            (2, 5, "assistant", "first"), (2, 6, "user", "open"), (None, 0, "user", "x"), (None, 1, "assistant", "y"), (3, None, "user", "z"), (3, 1, "assistant", "w"), (4, 1, None, "v")]
    rows += [(7, i * 3, "user" if i % 2 == 0 else "assistant", str(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    for block in (4096, 4):
        monkeypatch.setattr(kw, "PAIR_BLOCK", block)
        assert sorted(tuple(r) for r in kw.question_answer_pairs(df).collect()) == brute_pairs(rows)


def test_late_interaction_on_ragged_tokens(spark):
    rng, width = np.random.default_rng(3), 3
    lists = [rng.standard_normal(width * n).tolist() for n in (1, 3, 0, 2, 5, 1)] + [None, [1.0, 2.0]]
    asked = [rng.standard_normal(width * n).tolist() for n in (2, 1, 4)] + [[], None]
    nodes = spark.createDataFrame(list(enumerate(lists)), "id int, vec array<double>").repartition(2)
    queries = spark.createDataFrame(list(enumerate(asked)), "qid int, vec array<double>")
    want = {}
    for q, a in enumerate(asked):
        for i, n in enumerate(lists):
            if a and n and len(n) % width == 0:
                want[q, i] = round(float((np.reshape(a, (-1, width)) @ np.reshape(n, (-1, width)).T).max(axis=1).sum()), 6)
    for most in (4_000_000, 3):
        import tessera.operators.search as search
        before, search.CELLS_PER_BLOCK = search.CELLS_PER_BLOCK, most
        try:
            got = {(r.qid, r.id): r.score for r in block_search(nodes, queries, max_sim_scorer(width), 10, ["id"], ["vec"]).collect()}
        finally:
            search.CELLS_PER_BLOCK = before
        assert got == pytest.approx(want, abs=2e-6)


def test_vectors_of_other_lengths_and_nulls_have_no_score(spark):
    nodes = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [1.0]), (4, [0.0, 2.0]), (5, [1.0, 0.0, 0.0])], "id int, vec array<double>")
    queries = spark.createDataFrame([(7, [1.0, 1.0]), (8, None)], "qid int, vec array<double>")
    for metric, want in (("ip", {1: 1.0, 4: 2.0}), ("l2", {1: 1.0, 4: 1.414214}), ("cosine", {1: 0.707107, 4: 0.707107})):
        got = block_search(nodes, queries, vector_scorer(metric), 9, ["id"], ["vec"]).collect()
        assert {(r.qid, r.id): r.score for r in got} == {(7, i): s for i, s in want.items()}


def test_the_mode_picks_the_columns(spark):
    sims = SimilarityRegistry()
    sims.add("l2", vx.euclid, mode="embedding", descending=False)
    sims.add("same", lambda a, b: (a == b).cast("double"), mode="text")
    pairs = spark.createDataFrame([(1, "x", "x", [0.0], [3.0]), (2, "x", "y", [1.0], [1.0])], "id int, text string, content string, query_vec array<double>, vec array<double>")
    assert [r.id for r in sims["l2"].best_pairs(pairs, ["text"], 1, ["id"]).collect()] == [2]
    assert [r.id for r in sims["same"].best_pairs(pairs, ["text"], 1, ["id"]).collect()] == [1]
    with pytest.raises(TypeError):
        sims["l2"].score_pairs(pairs.withColumn("vec", F.lit("text")))
