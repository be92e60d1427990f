"""Communities by modularity: connected, listed once per level, no worse than label rounds."""

import random

import pytest

from tessera.operators.communities import connected_components, label_rounds
from tessera.operators.modularity import Graph, leveled_communities


def planted(seed, groups=6, size=12, inside=0.5, outside=0.02):
    rng = random.Random(seed)
    nodes = [f"n{g:02d}_{i:02d}" for g in range(groups) for i in range(size)]
    return [(a, b, rng.choice([1.0, 1.0, 2.0])) for x, a in enumerate(nodes) for b in nodes[x + 1:]
            if rng.random() < (inside if a[:3] == b[:3] else outside)]


def brute_quality(edges, label):
    ends = 2 * sum(w for _, _, w in edges)
    degree, total = {}, {}
    for a, b, w in edges:
        for x in (a, b):
            degree[x] = degree.get(x, 0) + w
    for n, k in degree.items():
        total[label[n]] = total.get(label[n], 0) + k
    return sum(2 * w for a, b, w in edges if label[a] == label[b]) / ends - sum((t / ends) ** 2 for t in total.values())


def check(edges, rows, levels):
    nodes = {x for a, b, _ in edges for x in (a, b)}
    by_level = {}
    for r in rows:
        assert by_level.setdefault(r.level, {}).setdefault(r.node, r.community) == r.community
    assert sorted(by_level) == list(range(1, levels + 1)) and all(set(m) == nodes for m in by_level.values())
    assert len(rows) == levels * len(nodes)
    near = {n: set() for n in nodes}
    for a, b, _ in edges:
        near[a].add(b)
        near[b].add(a)
    for label in by_level.values():
        for c in set(label.values()):
            members = {n for n in nodes if label[n] == c}
            assert c in members
            seen, todo = set(), [c]
            while todo:
                n = todo.pop()
                if n not in seen:
                    seen.add(n)
                    todo += near[n] & members
            assert seen == members
    return by_level


def test_planted_groups_are_found(spark):
    edges = planted(3)
    df = spark.createDataFrame(edges, "src string, tgt string, weight double")
    by_level = check(edges, leveled_communities(df, 2).collect(), 2)
    scores = [brute_quality(edges, by_level[level]) for level in (1, 2)]
    assert scores[0] <= scores[1] + 1e-9
    labels = {r.node: r.label for r in label_rounds(df, 5).collect()}
    assert scores[0] >= brute_quality(edges, labels) - 1e-9
    truth = brute_quality(edges, {n: n[:3] for n in by_level[1]})
    assert scores[1] >= truth - 0.02
    graph = Graph.of(df)
    assert graph.quality(spark.createDataFrame(list(by_level[2].items()), "node string, c string")) == pytest.approx(scores[1])


def test_hubs_chains_repeats_and_nothing(spark):
    hub = [("hub", f"leaf{i}", 1.0) for i in range(60)] + [(f"c{i}", f"c{i + 1}", 1.0) for i in range(12)]
    df = spark.createDataFrame([*hub, ("hub", "leaf1", 1.0), ("leaf2", "hub", 1.0), (None, "x", 1.0), ("self", "self", 2.0), ("y", "z", 0.0)], "src string, tgt string, weight double")
    rows = leveled_communities(df, 2, rounds=6).collect()
    by_level = {lv: {r.node: r.community for r in rows if r.level == lv} for lv in (1, 2)}
    merged = {("hub", f"leaf{i}"): 2.0 if i in (1, 2) else 1.0 for i in range(60)}
    edges = [(a, b, merged.get((a, b), w)) for a, b, w in hub]
    assert {n for n in by_level[2]} == {x for a, b, _ in edges for x in (a, b)} | {"self"}
    check(edges, [r for r in rows if r.node != "self"], 2)
    assert leveled_communities(df.limit(0), 2).count() == 0


def test_communities_stay_inside_components(spark):
    edges = planted(5, groups=3, outside=0.0)
    df = spark.createDataFrame(edges, "src string, tgt string, weight double")
    component = {r.node: r.component for r in connected_components(df).collect()}
    for r in leveled_communities(df, 2, rounds=5).collect():
        assert component[r.node] == component[r.community]
