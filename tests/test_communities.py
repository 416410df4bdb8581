"""Refined communities: connected, parts of what label moves found, and no lower in modularity."""

import numpy as np
from pyspark.sql import functions as F

from cellweave.operators import communities as cm
from cellweave.operators.lineage import materialize


def both_ways(spark, pairs):
    rows = [(a, b, float(w)) for a, b, w in pairs] + [(b, a, float(w)) for a, b, w in pairs]
    return materialize(spark.createDataFrame(rows, "src bigint, dst bigint, weight double"))


def pieces(pairs, label):
    """Components inside each label, by a plain search."""
    near = {n: set() for n in label}
    for a, b, _ in pairs:
        if label[a] == label[b]:
            near[a].add(b)
            near[b].add(a)
    root = {}
    for n in sorted(label):
        heap = [n] if n not in root else []
        while heap:
            m = heap.pop()
            if m not in root:
                root[m] = n
                heap.extend(near[m])
    return root


def random_graph(seed, nodes=60, links=110):
    rng = np.random.default_rng(seed)
    found = {(min(a, b), max(a, b)) for a, b in rng.integers(0, nodes, (links, 2)).tolist() if a != b}
    return [(a, b, int(w)) for (a, b), w in zip(sorted(found), rng.integers(1, 4, len(found)))]


def test_refined_communities_hold_together(spark):
    pairs = random_graph(1, 30, 50)
    edges = both_ways(spark, pairs)
    plain = materialize(cm.communities(edges, 1.0, refined=False))
    fine = materialize(cm.communities(edges, 1.0))
    label = {r.node: r.community for r in fine.collect()}
    assert set(label) == {n for a, b, _ in pairs for n in (a, b)}
    assert pieces(pairs, label) == label
    assert cm.modularity(edges, fine, 1.0) >= cm.modularity(edges, plain, 1.0) - 1e-9


def test_a_community_that_falls_apart_is_refined(spark):
    # Two cliques under one label, linked only through node 20, which has another label.
    cliques = [(0, 1, 2, 3), (10, 11, 12, 13)]
    pairs = [(a, b, 2) for c in cliques for a in c for b in c if a < b] + [(3, 20, 1), (10, 20, 1), (20, 21, 3)]
    edges = both_ways(spark, pairs)
    label = {n: (7 if n < 20 else 8) for a, b, _ in pairs for n in (a, b)}
    labels = spark.createDataFrame(sorted(label.items()), "node bigint, label bigint")
    degree = edges.groupBy(F.col("src").alias("node")).agg(F.sum("weight").alias("degree"))
    parts, grown = cm.refine(edges, labels.join(degree, "node"), 2.0 * sum(w for _, _, w in pairs), 1.0)
    part = {r.node: (r.label, r.part) for r in parts.collect()}
    assert grown and all(part[n][0] == label[n] for n in label)
    held = {n: p for n, (_, p) in part.items()}
    assert len(set(pieces(pairs, held).values())) == len(set(held.values()))
    # Nodes that grew together in pairs stay pairs; the next level joins them.
    assert held[0] != held[10] and all(len({held[n] for n in c}) < len(c) for c in cliques)
    told = cm.connected_parts(edges, labels.withColumnRenamed("label", "community"))
    assert {r.node: r.community for r in told.collect()} == pieces(pairs, label)
    before, after = (cm.modularity(edges, m, 1.0) for m in (labels.withColumnRenamed("label", "community"), told))
    assert after > before


def test_communities_of_nothing_and_of_loops(spark):
    assert cm.communities(spark.createDataFrame([], "src bigint, dst bigint, weight double")).count() == 0
    loops = spark.createDataFrame([(1, 1, 1.0), (2, 2, 1.0)], "src bigint, dst bigint, weight double")
    assert {tuple(r) for r in cm.communities(loops).select("node", "community").collect()} == {(1, 1), (2, 2)}


def test_nodes_with_the_same_links_are_one_node(spark):
    def both(links):
        return spark.createDataFrame([(a, b, w) for a, b, w in links] + [(b, a, w) for a, b, w in links], "src long, dst long, weight double")
    # 1 to 4 all know each other; 5 knows 4 and 6; 7 and 8 have the same neighbour but no link; 9 to 11 differ by a weight.
    links = [(a, b, 1.0) for a in range(1, 5) for b in range(a + 1, 5)] + [(4, 5, 1.0), (5, 6, 1.0), (6, 7, 1.0), (6, 8, 1.0)]
    links += [(9, 10, 2.0), (9, 11, 1.0), (10, 11, 1.5)]
    edges = both(links)
    two_m = 2 * sum(w for _, _, w in links)
    assert {(r.node, r.twin) for r in cm.twins(edges, two_m).collect()} == {(1, 1), (2, 1), (3, 1)}
    # At a resolution at which chance alone would give more links, they are left apart.
    assert cm.twins(edges, two_m, 100.0).count() == 0
    got = {r.node: r.community for r in cm.communities(edges).collect()}
    assert set(got) == set(range(1, 12)) and got[1] == got[2] == got[3] == 1 and got[9] == got[10] == got[11] == 9
    cliques = both([(100 * c + a, 100 * c + b, 1.0) for c in range(3) for a in range(12) for b in range(a)])
    for refined in (True, False):
        assert {(r.node, r.community) for r in cm.communities(cliques, refined=refined).collect()} == {(100 * c + a, 100 * c) for c in range(3) for a in range(12)}
