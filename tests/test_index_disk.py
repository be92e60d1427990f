"""A commit and a compaction move neither words nor postings through a shuffle, also with repeated and null keys."""

import random

from pyspark.sql import DataFrame

from tessera.operators.ranking import bm25_search
from tessera.operators.term_index import TermIndex

SCHEMA = "doc_id bigint, pos int, words array<string>"


def test_nodes_and_postings_stay_where_they_are(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(d if d % 11 else None, p, rng.choices([f"w{i}" for i in range(30)], k=rng.randrange(1, 12))) for d in range(60) for p in range(2)]
    seen = set()
    rows = [r for r in rows if r[0] is not None or (r[1] not in seen and not seen.add(r[1]))]  # a null document has a row per place
    queries = spark.createDataFrame([(i, [f"w{i}", f"w{i + 3}"]) for i in range(8)], "qid int, words array<string>")
    index = TermIndex(spark, buckets=2, shelf_nodes=8)
    with monkeypatch.context() as m:
        for name in ("repartition", "repartitionByRange"):
            m.setattr(DataFrame, name, lambda *a, **b: 1 / 0)
        shorter = [(7, 0, [])] if any(r[:2] == (7, 0) for r in rows) else []
        index.commit(1, spark.createDataFrame(rows + shorter, SCHEMA))  # the larger list stays
        index.commit(2, removed=spark.createDataFrame([(3,), (4,)], "doc_id bigint"))
        index.compact()
    left = [r for r in rows if r[0] not in (3, 4)]
    of = lambda df: sorted((r.qid, r.rk, str(r.doc_id), r.pos, r.score) for r in df.collect())
    assert of(index.search(queries, 4)) == of(bm25_search(spark.createDataFrame(left, SCHEMA), queries, 4, ["doc_id", "pos"]))
    blocks = index._table("blocks", [r.seg for r in index.live()]).collect()
    for b in blocks:
        assert b.n == len(b.entries) and b.top_tf == max(e.tf for e in b.entries) and b.least_dl == min(e.dl for e in b.entries)
    assert sum(b.n for b in blocks) == sum(len(set(w)) for _, _, w in left)
