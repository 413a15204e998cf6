"""Density topics against the definition on all pairs; class-wise term labels."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from murmur.operators import density, neighbours
from conftest import SF0001


def frame(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")


def all_pairs(x, ids, min_points, min_size):
    """Topic of each point, from all pairs: Kruskal's tree, then the hierarchy as sets of points."""
    n = len(x)
    d = np.array([np.sqrt(((x - v) ** 2).sum(axis=1)) for v in x])
    core = np.array([np.sort(np.delete(d[i], i))[min(min_points, n - 1) - 1] if n > 1 else 0.0 for i in range(n)])
    w = np.maximum(np.maximum(core[:, None], core), d)
    edges = sorted((w[i, j], min(ids[i], ids[j]), max(ids[i], ids[j]), i, j) for i in range(n) for j in range(i))
    group = {i: {i} for i in range(n)}
    name = {i: None for i in range(n)}                # cluster of a large group
    tree, clusters, leave = [], {}, {}
    fresh = 0
    for weight, lo, hi, i, j in edges:
        a, b = group[i], group[j]
        if a is b:
            continue
        tree.append((weight, lo, hi))
        big = [g for g in (a, b) if len(g) >= min_size]
        both = a | b
        if len(big) == 2:
            kids = [name[min(a)], name[min(b)]]
            clusters[fresh] = (kids, weight, both)
            label, fresh = fresh, fresh + 1
        elif len(big) == 1:
            label = name[min(big[0])]
            for p in both - big[0]:
                leave[p] = (label, weight)
        elif len(both) >= min_size:
            clusters[fresh] = ([], weight, both)
            label, fresh = fresh, fresh + 1
            for p in both:
                leave[p] = (label, weight)
        else:
            label = None
        for p in both:
            group[p], name[p] = both, label
    parent, birth = {}, {}
    for c, (kids, weight, _) in clusters.items():
        for k in kids:
            parent[k], birth[k] = c, 1 / weight
    points = defaultdict(list)
    for p, (c, weight) in leave.items():
        points[c].append((p, 1 / weight))
    best, chosen, members = {}, {}, {}
    for c in sorted(clusters):                         # children have smaller numbers
        kids = clusters[c][0]
        members[c] = {p for p, _ in points[c]}.union(*(members[k] for k in kids))
        stable = sum(v - birth.get(c, 0) for _, v in points[c]) + sum(len(members[k]) * (birth[k] - birth.get(c, 0)) for k in kids)
        below = sum(best[k] for k in kids)
        chosen[c] = c in parent and (not kids or stable >= below)
        best[c] = stable if chosen[c] else below
    topic = {}
    for c in sorted(clusters, reverse=True):
        above = c
        while above in parent and not topic.get(("in", above)):
            above = parent[above]
        if topic.get(("in", parent.get(c))) is not None:
            topic["in", c] = topic["in", parent[c]]
        else:
            topic["in", c] = c if chosen[c] else None
    out = {}
    for i in range(n):
        c = leave[i][0] if i in leave else None
        out[ids[i]] = topic.get(("in", c))
    least = {}
    for i, c in out.items():
        if c is not None:
            least[c] = min(least.get(c, i), i)
    return {i: least.get(c) for i, c in out.items()}, sorted(tree)


def blobs(seed, sizes=(40, 30, 25), noise=20, dims=3):
    rng = np.random.default_rng(seed)
    x = [rng.normal(size=(s, dims)) * rng.uniform(0.3, 0.8) + rng.uniform(-6, 6, dims) for s in sizes]
    return np.concatenate(x + [rng.uniform(-9, 9, (noise, dims))])


def topics(df, **kw):
    return {r["vec_id"]: r["topic"] for r in density.topic_density(df, **kw).collect()}


@pytest.mark.parametrize("seed, list_size", [(1, 16), (2, 5)])
def test_topics_equal_all_pairs(spark, seed, list_size):
    """Short lists too: what they do not show is searched for."""
    x = blobs(seed)
    want, _ = all_pairs(x, list(range(len(x))), 5, 10)
    assert topics(frame(spark, x).repartition(3), list_size=list_size) == want
    assert len({t for t in want.values() if t is not None}) >= 2 and None in want.values()


def test_tree_and_contraction_in_rounds(spark, monkeypatch):
    """The tree equals Kruskal's, and contraction by rounds alone gives what merging edge by edge does."""
    x = blobs(3, sizes=(30, 25), noise=15)
    ids = [7 * i + 3 for i in range(len(x))]
    want, tree = all_pairs(x, ids, 4, 8)
    rows = neighbours.vectors(frame(spark, x, ids), "vec_id", "embedding")
    points, edges = density.reachability(neighbours.lists(rows, 3, None, 1), 3, 4, 6)
    got = density.spanning_tree(points, edges, 3)
    assert sorted(map(tuple, got.select("w", "lo", "hi").collect())) == tree
    for finish in (1, 20, 1000):
        members, clusters = density.hierarchy(points, got, 8, finish)
        into = density.select_clusters(members, clusters)
        found = defaultdict(set)
        for r in members.collect():
            found[into[r["cluster"]]].add(r["id"])
        assert {i: (None if c is None else min(p)) for c, p in found.items() for i in p} == want
        assert members.count() == len(x)


def test_topics_of_the_given_table(spark):
    p = spark.read.parquet(f"{SF0001}/embeddings.parquet")
    x = p.toPandas()
    want, _ = all_pairs(np.stack(x.embedding.to_numpy()).astype(float), x.vec_id.tolist(), 5, 10)
    assert topics(p) == want


def test_few_rows_copies_and_left_out_rows(spark):
    assert topics(frame(spark, np.zeros((0, 2)))) == {}
    assert topics(frame(spark, [[1.0, 2.0]])) == {0: None}
    assert topics(frame(spark, np.ones((12, 2)))) == {i: None for i in range(12)}         # one cluster is the root
    rng = np.random.default_rng(5)
    x = np.concatenate([np.ones((15, 2)), rng.normal(size=(15, 2)) * 0.1 + 9])
    odd = spark.createDataFrame([(None, [1.0, 1.0]), (900, None), (901, [float("nan"), 1.0]), (902, [1.0]), (3, [1.0, 1.0])],
                                "vec_id long, embedding array<double>")
    got = topics(frame(spark, x).unionByName(odd))
    assert got.keys() == set(range(30)) and {got[i] for i in range(15)} == {0} and {got[i] for i in range(15, 30)} <= {15, None}


def test_neighbour_lists_and_recall_by_probes(spark):
    x = blobs(6, sizes=(120, 100, 90, 80), noise=60, dims=8)
    rows = neighbours.vectors(frame(spark, x), "vec_id", "embedding")
    exact = neighbours.neighbours(neighbours.lists(rows, 8, None, 1), 8, 10).cache()
    for r in exact.where("id in (0, 200, 449)").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("rank", "other"))).alias("near")).collect():
        d = np.sqrt(((x - x[r["id"]]) ** 2).sum(axis=1))
        d[r["id"]] = np.inf
        assert [n["other"] for n in r["near"]] == np.argsort(d, kind="stable")[:10].tolist()
    probed = neighbours.neighbours(neighbours.lists(rows, 8, 4, 16), 8, 10)
    assert 0.9 <= neighbours.recall(probed, exact) <= 1.0
    assert neighbours.recall(exact, exact) == 1.0


def test_query_groups_are_bounded(spark, monkeypatch):
    x = blobs(7, sizes=(50, 40), noise=10)
    rows = neighbours.vectors(frame(spark, x), "vec_id", "embedding")
    one = {tuple(r) for r in neighbours.neighbours(neighbours.lists(rows, 3, None, 1), 3, 4).collect()}
    monkeypatch.setattr(neighbours, "GROUP_BYTES", 24 * 30)             # 30 queries a scan
    assert {tuple(r) for r in neighbours.neighbours(neighbours.lists(rows, 3, None, 1), 3, 4).collect()} == one


def test_memory_of_a_scan_does_not_grow_with_queries_or_rows():
    import tracemalloc
    import numpy as np
    import pyarrow as pa
    from murmur.operators import density, neighbours
    dims, n = 4, 6000
    v = np.random.default_rng(2).random(n * dims)
    vectors = pa.ListArray.from_arrays(np.arange(0, n * dims + 1, dims, dtype=np.int32), pa.array(v))
    zeros = pa.array(np.zeros(n, dtype=np.int32))
    probe = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32), zeros)
    ids = np.arange(n)
    batch = pa.RecordBatch.from_pydict({"id": ids, "v": vectors, "list": zeros, "probe": probe, "comp": ids % 7, "core": np.zeros(n)})
    asked = pa.Table.from_batches([batch]).slice(0, 1500)
    for work in (neighbours._nearest(dims, 5), density._outside(dims)):
        tracemalloc.start()
        found = sum(b.num_rows for b in work(asked, iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert found >= 1500 and peak < 8 * 8 * neighbours.CELLS
    assert list(neighbours.chunks(5, neighbours.CELLS // 2)) == [(0, 2), (2, 4), (4, 5)]
