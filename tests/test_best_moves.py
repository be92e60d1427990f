"""The best move of every node against brute force, and moves of which no two linked nodes make one."""

import math
import random

from tessera.operators.modularity import Graph, _wishes


def test_best_moves_are_a_row_a_node(spark):
    rng = random.Random(2)
    edges = [(f"n{a}", f"n{b}", float(rng.randrange(1, 4))) for a in range(9) for b in range(a + 1, 9) if rng.random() < 0.5]
    graph = Graph.of(spark.createDataFrame([*edges, ("n0", "n0", 2.0)], "src string, tgt string, weight double"))
    k = {r.node: r.k for r in graph.nodes.collect()}
    own = {n: f"c{int(n[1:]) % 3}" for n in k}
    best = graph.best(spark.createDataFrame(list(own.items()), "node string, c string")).collect()
    assert sorted(r.node for r in best) == sorted(k)  # not a row per node and neighbouring community
    near = {(a, b): w for x, y, w in edges for a, b in ((x, y), (y, x))}
    for r in best:
        kin = {own[r.node]: 0.0}
        for (a, b), w in near.items():
            if a == r.node:
                kin[own[b]] = kin.get(own[b], 0.0) + w
        total = {c: sum(k[n] for n in k if own[n] == c) for c in kin}
        gain = {c: round(kin[c] - k[r.node] * (total[c] - (k[r.node] if c == own[r.node] else 0)) / graph.ends, 9) for c in kin}
        c, first = min(gain.items(), key=lambda g: (-g[1], g[0]))
        assert (r.c, r.k, r.kin, r.total) == (c, k[r.node], kin[own[r.node]], total[own[r.node]])
        assert math.isclose(r.gain, first, abs_tol=1e-8) and math.isclose(r.stay, gain[own[r.node]], abs_tol=1e-8)
    wishes = _wishes(graph.best(spark.createDataFrame([(n, n) for n in k], "node string, c string")))
    moving = {r.node for r in graph.apart(wishes, 3).collect()}
    assert moving and not any((a, b) in near for a in moving for b in moving)
