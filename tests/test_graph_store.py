"""A stored graph after additions and removals equals one built anew."""

import random
from collections import Counter

import pytest

from tessera.operators import graph_store
from tessera.operators.graph_store import StoredGraph

SCHEMA = "src string, tgt string, doc_id bigint, pos int"


def rebuilt(rows):
    weight = Counter((a, b) for a, b, _, _ in rows)
    chunks = Counter((a, b) for a, b, _, _ in set(rows))
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in weight:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return sorted((*k, n, chunks[k]) for k, n in weight.items()), sorted((x, find(x)) for x in list(root))


def stored(graph):
    return sorted(tuple(r) for r in graph.relations().collect()), sorted((r.node, r.component) for r in graph.roots().collect())


def links(rng, docs, names=40):
    out = []
    for d in docs:
        for p in range(rng.randrange(3)):
            a, b = sorted(rng.sample(range(names), 2))
            out.append((f"n{a:02d}", f"n{b:02d}", d, p))
    return out


def test_changes_equal_a_rebuild(spark):
    rng, graph, live = random.Random(2), StoredGraph(spark), []
    ids = spark.createDataFrame([(-5,)], "doc_id bigint")
    for step in range(4):
        fresh = links(rng, range(step * 12, step * 12 + 12)) + ([("n00", "n01", 900, 0)] * 2 if step == 1 else [])
        gone = rng.sample(range(step * 12), 4 * step) + ([900] if step == 3 else [])
        graph.apply(spark.createDataFrame(fresh, SCHEMA), spark.createDataFrame([(g,) for g in gone], "doc_id bigint") if gone else ids)
        live = [r for r in live if r[2] not in gone] + fresh
        assert stored(graph) == rebuilt(live)
    again = StoredGraph(spark, graph.path)
    assert again.version == 3 and stored(again) == rebuilt(live)
    again.apply(spark.createDataFrame([], SCHEMA), spark.createDataFrame([(r[2],) for r in live], "doc_id bigint"))
    assert stored(again) == ([], [])


def test_a_document_comes_again_and_a_failed_version_is_written_anew(spark, monkeypatch):
    graph = StoredGraph(spark)
    one = [("a", "b", 1, 0), ("b", "c", 1, 1), ("x", "y", 2, 0)]
    graph.apply(spark.createDataFrame(one, SCHEMA))
    new = [("a", "c", 1, 0), ("c", "x", 3, 0)]
    with monkeypatch.context() as m:
        m.setattr(graph_store, "connected_components", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            graph.apply(spark.createDataFrame(new, SCHEMA), spark.createDataFrame([(1,)], "doc_id bigint"))
    graph = StoredGraph(spark, graph.path)
    assert stored(graph) == rebuilt(one)
    graph.apply(spark.createDataFrame([*new, (None, "z", 4, 0)], SCHEMA), spark.createDataFrame([(1,), (None,)], "doc_id bigint"))
    assert stored(graph) == rebuilt([one[2], *new])
