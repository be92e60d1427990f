"""Search kernels against brute force, and the block grid against the plain scan."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.passages import holders
from tessera.operators import ranking, vectors as vc
from tessera.operators.search import block_search, term_scorer, vector_scorer

WORDS = [f"w{i}" for i in range(60)]


def corpus(n, seed, hot=None):
    """Word lists where ``hot`` fills a third of every list."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        size = rnd.choice([0, 1, 5, 30])
        words = [hot if hot and rnd.random() < 0.33 else rnd.choice(WORDS) for _ in range(size)]
        rows.append((i, words))
    return rows


def brute_bm25(nodes, queries, k):
    n = len(nodes)
    avg = sum(len(w) for _, w in nodes) / n
    df = Counter(t for _, w in nodes for t in set(w))
    out = {}
    for q, qw in queries:
        scored = []
        for i, w in nodes:
            tf = Counter(w)
            s = sum(math.log((n - df[t] + 0.5) / (df[t] + 0.5) + 1) * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(w) / avg))
                    for t in set(qw) if tf[t])
            if s > 0:
                scored.append((-round(s, 6) + 0.0, i))
        out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def as_dict(df):
    out = {}
    for r in df.orderBy("qid", "rk").collect():
        out.setdefault(r["qid"], []).append((r["id"], r["score"]))
    return out


@pytest.mark.parametrize("k", [1, 4, 1000])
def test_bm25_brute_force_and_grid(spark, k):
    nodes, queries = corpus(300, 1, hot="w0"), [(i, w) for i, w in corpus(25, 2, hot="w0")]
    n = spark.createDataFrame(nodes, "id long, words array<string>").repartition(5)
    q = spark.createDataFrame(queries, "qid long, words array<string>")
    want = {k_: v for k_, v in brute_bm25(nodes, queries, k).items() if v}
    weights, scorer = ranking.bm25_parts(n, q)
    for limit in (4096, 7):
        got = as_dict(block_search(n, weights, scorer, k, ["id"], ["words"], max_queries=limit))
        assert got.keys() == want.keys()
        for key in want:
            assert [i for i, _ in got[key]] == [i for i, _ in want[key]]
            assert [s for _, s in got[key]] == pytest.approx([s for _, s in want[key]], abs=1.1e-6)


def test_jaccard_and_share(spark):
    nodes, queries = corpus(200, 3), corpus(10, 4)
    n = spark.createDataFrame(nodes, "id long, words array<string>")
    q = spark.createDataFrame(queries, "qid long, words array<string>")
    got = as_dict(ranking.jaccard_search(n, q, 3, ["id"]))
    for key, words in queries:
        scored = sorted((-round(len(set(words) & set(w)) / len(set(words) | set(w)), 6), i) for i, w in nodes if set(words) & set(w))
        assert got.get(key, []) == [(i, -s) for s, i in scored[:3]]


def test_vector_search_ties_grid_and_floor(spark):
    rnd = np.random.default_rng(5)
    x = rnd.integers(-2, 3, (400, 6)).astype(float)
    x[x.sum(axis=1) == 0, 0] = 1.0
    x[7] = 0.0
    n = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>").repartition(6)
    qv = rnd.integers(-2, 3, (9, 6)).astype(float) + 0.5
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(qv)], "qid long, vec array<double>")
    for floor in (None, 0.6):
        runs = [as_dict(block_search(n, q, vector_scorer("cosine"), 5, ["id"], ["vec"], floor=floor, max_queries=m)) for m in (100, 2)]
        assert runs[0] == runs[1]
        for j, v in enumerate(qv):
            s = [(-round(float(a @ v / np.linalg.norm(a) / np.linalg.norm(v)), 6) + 0.0, i) for i, a in enumerate(x) if i != 7]
            want = [(i, -c) for c, i in sorted(s)[:5] if floor is None or -c >= floor]
            assert runs[0].get(j, []) == want


def test_empty_inputs(spark):
    n = spark.createDataFrame([(1, ["a"])], "id long, words array<string>")
    q = spark.createDataFrame([(1, [])], "qid long, words array<string>")
    assert ranking.bm25_search(n, q, 3, ["id"]).count() == 0
    assert ranking.bm25_search(n.limit(0), spark.createDataFrame([(1, ["a"])], "qid long, words array<string>"), 3, ["id"]).count() == 0


def test_all_cells_equal_exact(spark):
    rnd = np.random.default_rng(6)
    n = spark.createDataFrame([(i, rnd.normal(size=8).tolist()) for i in range(300)], "id long, vec array<double>")
    q = spark.createDataFrame([(i, rnd.normal(size=8).tolist()) for i in range(5)], "qid long, vec array<double>")
    model = vc.train_cells(n, 6)
    path = vc.write_cells(n, model, ["id"])
    exact = as_dict(block_search(n, q, vector_scorer("cosine"), 10, ["id"], ["vec"]))
    assert as_dict(vc.cell_search(path, model, q, 10, ["id"], nprobe=6)) == exact
    some = as_dict(vc.cell_search(path, model, q, 10, ["id"], nprobe=3))
    recall = np.mean([len({i for i, _ in some[k]} & {i for i, _ in exact[k]}) / 10 for k in exact])
    assert recall >= 0.5


def test_product_quantisation_recall(spark):
    rnd = np.random.default_rng(8)
    n = spark.createDataFrame([(i, rnd.normal(size=8).tolist()) for i in range(400)], "id long, vec array<double>")
    q = spark.createDataFrame([(i, rnd.normal(size=8).tolist()) for i in range(5)], "qid long, vec array<double>")
    books = vc.train_codebooks(n, 4, 8)
    got = as_dict(vc.code_search(vc.encode_codes(n, books, ["id"]), n, q, books, 5, ["id"], survivors=80))
    exact = as_dict(block_search(n, q, vector_scorer("l2"), 5, ["id"], ["vec"]))
    assert np.mean([len({i for i, _ in got[k]} & {i for i, _ in exact[k]}) / 5 for k in exact]) >= 0.8


def test_passage_holders_grid(spark):
    docs = [(i, f"start {i % 3} one two {i} end") for i in range(40)] + [(99, ""), (100, "one two 5 end one two 5 end")]
    passages = [(1, "one two 5 end"), (2, "start 0"), (3, "nothing"), (4, "one two 5 end"), (5, "end")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    p = spark.createDataFrame(passages, "qid long, text string")
    want = sorted((q, i) for q, s in passages for i, t in docs if s in t)
    for limit in (100, 2):
        assert sorted((r["qid"], r["doc_id"]) for r in holders(d, p, max_passages=limit).collect()) == want


def test_rare_and_frequent_words_agree(spark):
    """The same sums whether a word is multiplied or handed out."""
    rnd = random.Random(9)
    nodes = [(i, ["hot"] * 3 + [f"r{rnd.randrange(500)}" for _ in range(20)]) for i in range(500)]
    queries = [(i, ["hot", *[f"r{rnd.randrange(500)}" for _ in range(3)]]) for i in range(80)]
    n = spark.createDataFrame(nodes, "id long, words array<string>")
    q = spark.createDataFrame([(i, w, [1.0] * len(set(w))) for i, w in queries], "qid long, t array<string>, weights array<double>").select(
        "qid", F.array_distinct("t").alias("terms"), "weights")
    got = as_dict(block_search(n, q, term_scorer("share"), 3, ["id"], ["words"]))
    for key, words in queries:
        scored = sorted((-round(sum(w.count(t) for t in set(words)) / len(w), 6), i) for i, w in nodes)
        assert got[key] == [(i, -s) for s, i in scored[:3]]


def test_many_queries_are_not_repeated_with_the_nodes(spark):
    """Blocks of queries come one after the other; equal and null query ids may lie in any of them."""
    rng = random.Random(11)
    nodes = spark.createDataFrame([(i, [rng.random() for _ in range(4)]) for i in range(300)], "id bigint, vec array<double>").repartition(5)
    rows = [(i % 9 if i % 10 else None, [rng.random() for _ in range(4)]) for i in range(40)]
    queries = spark.createDataFrame(rows, "qid bigint, vec array<double>")
    found = [block_search(nodes, queries, vector_scorer("ip"), 3, ["id"], ["vec"], max_queries=m) for m in (100, 7)]
    assert "CoGroups" not in found[1]._jdf.queryExecution().executedPlan().toString()
    once, many = (sorted(tuple(r) for r in f.fillna({"qid": -1}).collect()) for f in found)
    assert once == many and len(once) == 30
