"""Search by random-projection buckets against the exact search."""

import numpy as np
from pyspark.sql import functions as F

from tessera.operators.projection import ProjectionIndex
from tessera.operators.search import block_search, vector_scorer


def test_clustered_vectors_are_found_and_most_others_not_read(spark):
    rng = np.random.default_rng(8)
    centers = rng.standard_normal((40, 16))
    rows = [(i, (centers[i % 40] + 0.03 * rng.standard_normal(16)).tolist()) for i in range(800)]
    nodes = spark.createDataFrame([*rows, (900, None), (901, [0.0] * 16)], "id int, vec array<double>")
    queries = spark.createDataFrame([(q, centers[q].tolist()) for q in range(10)], "qid int, vec array<double>")
    index = ProjectionIndex(spark, ["id"], tables=6, directions=2, length=0.1)
    index.write(nodes)
    found = {(r.qid, r.id): r.score for r in index.search(queries, 10).collect()}
    exact = {(r.qid, r.id): r.score for r in block_search(nodes.filter("id < 900"), queries, vector_scorer("cosine"), 10, ["id"], ["vec"]).collect()}
    same = set(found) & set(exact)
    assert len(same) >= 0.95 * len(exact)
    assert all(abs(found[p] - exact[p]) < 2e-6 for p in same)
    assert index.search(queries, 1000).count() < 0.8 * 10 * 800
    assert index.search(queries.select("qid", F.lit(None).cast("array<double>").alias("vec")), 3).count() == 0
