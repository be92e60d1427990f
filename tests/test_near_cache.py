"""Results saved for near-equal queries."""

import numpy as np
from pyspark.sql import functions as F

from tessera.operators.near_cache import NearResultCache, banded

Q = "qid bigint, vec array<double>"


class Search:
    """Two hits per query with an even id, none for the others; counts what it is asked."""

    def __init__(self):
        self.asked = []

    def __call__(self, queries):
        self.asked.append(sorted(r.qid for r in queries.select("qid").collect()))
        return queries.filter("qid % 2 = 0").select("qid", F.explode(F.array(F.lit(1), F.lit(2))).alias("rk"), (F.col("qid") * 10).alias("doc_id"))


def vectors(n, seed=1, dim=24):
    return np.random.default_rng(seed).standard_normal((n, dim))


def asked(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in rows], Q)


def test_reworded_queries_answer_from_the_cache(spark):
    base, search = vectors(30), Search()
    cache = NearResultCache(spark, limit=0.95)
    first = cache.answer(asked(spark, enumerate(base)), "v1", search)
    assert first.count() == 30 and search.asked[-1] == list(range(30))
    noise = vectors(30, seed=2)
    near = base + 0.15 * noise  # cosine about 0.99
    far = base + 1.5 * noise  # about 0.55
    second = cache.answer(asked(spark, [*[(100 + i, v) for i, v in enumerate(near)], *[(200 + i, v) for i, v in enumerate(far)]]), "v1", search)
    assert search.asked[-1] == list(range(200, 230))  # queries without hits are remembered too
    got = {}
    for r in second.collect():
        got.setdefault(r.qid, set()).add((r.doc_id, r.rk))
    assert {q: h for q, h in got.items() if q < 200} == {100 + i: {(10 * i, 1), (10 * i, 2)} for i in range(0, 30, 2)}
    assert {q for q in got if q >= 200} == set(range(200, 230, 2))
    cache.answer(asked(spark, [(300, near[0])]), "v2", search)  # another version of the index
    assert search.asked[-1] == [300]


def test_the_limit_is_exact(spark):
    a = np.array([1.0, 0.0])
    turned = lambda c: np.array([c, np.sqrt(1 - c * c)])
    search, cache = Search(), NearResultCache(spark, limit=0.9)
    cache.answer(asked(spark, [(0, a)]), "v", search)
    cache.answer(asked(spark, [(2, turned(0.9001)), (4, turned(0.8999)), (6, 5 * a), (8, -a)]), "v", search)
    assert 4 in search.asked[-1] and 8 in search.asked[-1] and 6 not in search.asked[-1]
    exact = cache.matches(asked(spark, [(6, turned(0.95))]), "v").collect()
    assert [r.qid for r in exact] == [6]


def test_nulls_zeros_repeats_expiry_and_nothing(spark):
    search, cache = Search(), NearResultCache(spark, limit=0.9, expires=0)
    rows = [(0, None), (2, [0.0, 0.0]), (4, [float("nan"), 1.0]), (6, []), (8, [1.0, 2.0])]
    assert cache.answer(asked(spark, rows), "v", search).count() == 10
    assert banded(asked(spark, rows), "vec", ["qid"]).select("qid").distinct().collect()[0].qid == 8
    cache.answer(asked(spark, rows), "v", search)
    assert search.asked[-1] == [0, 2, 4, 6, 8]  # expired at once
    kept = NearResultCache(spark, limit=0.9)
    kept.answer(asked(spark, rows).limit(0), "v", search)
    kept.answer(asked(spark, rows), "v", search)
    kept.answer(asked(spark, rows), "v", search)
    assert search.asked[-1] == [0, 2, 4, 6]
    mixed = spark.createDataFrame([(9, [1.0, None])], Q)
    assert banded(mixed, "vec", ["qid"]).count() == 0
