"""Coded cells against the exact search."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators.coded_cells import CodedCells, _prepare, _score
from tessera.operators.search import block_search, vector_scorer
from tessera.operators.vectors import nearest_centers

DIM = 10


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(4)
    centers = rng.standard_normal((8, DIM))
    rows = [(i, (centers[i % 8] + 0.3 * rng.standard_normal(DIM)).tolist(), "extra", 1.0) for i in range(1200)]
    rows += [(2000, None, "x", 1.0), (2001, [0.0] * DIM, "x", 1.0), (2002, [1.0] * (DIM - 1), "x", 1.0),
             (2003, [float("nan")] + [1.0] * (DIM - 1), "x", 1.0), (2004, [float("inf")] + [1.0] * (DIM - 1), "x", 1.0),
             (2005, [], "x", 1.0)]
    nodes = spark.createDataFrame(rows, "id int, vec array<double>, code string, bias double")
    queries = spark.createDataFrame([(q, centers[q].tolist()) for q in range(8)] + [(90, None), (91, [1.0])], "qid int, vec array<double>")
    return nodes, queries


def pairs(df):
    return {(r.qid, r.id): r.score for r in df.collect()}


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_uneven_parts_and_recall(spark, tables, metric):
    nodes, queries = tables
    index = CodedCells(spark, ["id"], cells=6, parts=4, codes=16, metric=metric)
    index.write(nodes)
    assert [b - a for a, b in zip(index.bounds, index.bounds[1:])] == [2, 3, 2, 3]
    kept = {r.id for r in index.rows().select("id").collect()}
    assert kept == set(range(1200)) | ({2001} if metric == "l2" else set())
    assert index.rows().count() == len(kept)
    sound = nodes.filter(F.col("id").isin(list(kept)))
    want = pairs(block_search(sound, queries.filter("qid < 90"), vector_scorer(metric), 10, ["id"], ["vec"]))
    some = pairs(index.search(queries, 10, nprobe=3, survivors=60))
    assert len(some) == 80 and len(set(some) & set(want)) >= 0.9 * len(want)
    assert all(abs(some[p] - want[p]) < 2e-6 for p in set(some) & set(want))
    assert {q for q, _ in some} == set(range(8))
    # every cell and every row scored exactly: the exact search
    assert pairs(index.search(queries, 10, nprobe=6, survivors=2000)) == pytest.approx(want, abs=2e-6)


def test_distance_by_code(spark, tables):
    """|q - c|^2 + |r|^2 - 2 (q - c).s, with the true length of the rest r and its coded form s."""
    nodes, queries = tables
    index = CodedCells(spark, ["id"], cells=6, parts=4, codes=16, metric="l2")
    index.write(nodes)
    rows = index.rows().toArrow()
    asked = queries.filter("qid < 3").withColumn("cells", F.array(*[F.lit(c) for c in range(6)])).toArrow()
    args = {"centers": index.centers, "books": index.books, "bounds": index.bounds}
    got = np.vstack([_score(_prepare(asked, args), b, args) for b in rows.to_batches()])
    home = index.centers[rows["cell"].to_pylist()]
    assert (np.linalg.norm(np.array(rows["vec"].to_pylist())[:, None] - index.centers, axis=2).argmin(axis=1) == rows["cell"].to_numpy()).all()
    coded = np.array([np.concatenate([index.books[p][k] for p, k in enumerate(code)]) for code in rows["code"].to_pylist()])
    rest = np.array(rows["vec"].to_pylist()) - home
    away = np.array(asked["vec"].to_pylist())[None] - home[:, None]
    want = (away ** 2).sum(axis=2) + (rest ** 2).sum(axis=1)[:, None] - 2 * (away * coded[:, None]).sum(axis=2)
    assert np.allclose(got, np.sqrt(np.maximum(want, 0)), atol=1e-6)


def test_coarse_codes_lose_nothing(spark, tables):
    """With two codes a part and few survivors the result is still the exact top k of the probed cells."""
    nodes, queries = tables
    for metric in ("cosine", "l2"):
        index = CodedCells(spark, ["id"], cells=6, parts=3, codes=2, metric=metric)
        index.write(nodes)
        got = pairs(index.search(queries, 10, nprobe=6, survivors=10))
        sound = index.rows().select("id", "vec")
        want = pairs(block_search(sound, queries.filter("qid < 90"), vector_scorer(metric), 10, ["id"], ["vec"]))
        assert got == pytest.approx(want, abs=2e-6)
        # by code alone some are lost
        assert set(pairs(index.search(queries, 10, nprobe=6, survivors=10, certain=False))) != set(want)
        # fewer survivors than k: no limit is known, all rows are scored
        assert set(pairs(index.search(queries, 10, nprobe=6, survivors=4))) == set(want)


def test_only_probed_cells_are_read(spark, tables):
    nodes, queries = tables
    index = CodedCells(spark, ["id"], cells=6, parts=4, codes=16)
    index.write(nodes)
    quick = index.search(queries.filter("qid = 0"), 5, nprobe=1, survivors=20, certain=False)
    scans = [line for line in quick._jdf.queryExecution().toString().split("\n") if "FileScan parquet" in line]
    assert scans and all(re.search(r"PartitionFilters: \[[^]]*\(?cell#\d+ (=|IN)", line) for line in scans)
    # the scan of the codes has no vectors
    assert any("vec:" not in line.split("ReadSchema")[1] for line in scans)
    near = nearest_centers(queries.filter("qid = 0"), index.centers, "vec", 1, "cells").first()["cells"]
    cells = {r.cell for r in index.rows().join(quick.select("id"), "id").select("cell").collect()}
    assert cells == set(near)


def test_few_and_no_vectors(spark, tables):
    nodes, queries = tables
    index = CodedCells(spark, ["id"], cells=6, parts=4, codes=16)
    index.write(nodes.filter("id < 3"))
    assert index.search(queries.filter("qid = 0"), 5, nprobe=6, survivors=20).count() == 3
    empty = CodedCells(spark, ["id"], cells=6, parts=4, codes=16)
    empty.write(nodes.filter("id = 2000"))
    found = empty.search(queries, 5, nprobe=2, survivors=20)
    assert found.columns == ["qid", "id", "score", "rk"] and found.count() == 0
    with pytest.raises(ValueError):
        CodedCells(spark, ["code"])
