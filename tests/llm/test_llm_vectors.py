"""Operators on vectors: whitening, nearest neighbours, hard negatives."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from murmur.llm import hard_negatives, multi_index, queries, query_scan, whitening

SF0001 = "/root/testdata/sf0.001"
VECS = "vec_id long, embedding array<double>, label int, at string, n string, x int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "at", "n", 1) for i, v, label in rows], VECS)


def given_table(spark):
    p = spark.read.parquet(f"{SF0001}/embeddings.parquet").toPandas()
    return p.vec_id.to_numpy(), np.stack(p.embedding.to_numpy()).astype(float), p.label.to_numpy()


BROKEN = [(901, None, 1), (902, [1.0, None], 1), (903, [float("nan"), 1.0], 1), (904, [1.0, float("inf")], 1)]


# -- whitening

def whitened_by_hand(x, k):
    n = len(x)
    total = [sum(int(v) for v in col) for col in x.T]
    centred = x - np.array([t / n for t in total])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    deviation = [sum((n * int(v) - t) ** 2 for v, t in zip(row, total)) for row in x]
    return centred @ axes[:, :k] / np.sqrt(values[:k]), deviation, values[:k] / values.sum()


def test_whitening_of_the_given_table(spark):
    ids, v, _ = given_table(spark)
    want, deviation, explained = whitened_by_hand(np.floor(1024 * v) + 100_000, 8)
    got = queries.op11_embedding_whitening(spark, SF0001).toPandas()
    assert len(got) == 8 * len(ids) and (got.n == len(ids)).all()
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    sign = np.sign((wide * want).sum(axis=0))
    assert np.abs(wide * sign - want).max() < 1e-9
    assert got[got.component == 1].set_index("vec_id").deviation.loc[ids].tolist() == deviation
    assert np.allclose(got.groupby("component").explained.first(), explained, rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error.max() < 1e-9


def test_whitening_blocks_short_ends_repeats_and_left_out_rows(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_VALUES", 6)           # three rows of two entries a block
    rng = np.random.default_rng(3)
    v = rng.normal(size=(40, 2))
    v[7] = v[8]
    rows = [(i % 38 if i else None, r.tolist(), 0) for i, r in enumerate(v)]
    rows += BROKEN + [(905, [1.0, 2.0, 3.0], 1), (906, [], 1)]
    got = whitening.whiten(vectors(spark, rows).repartition(5)).toPandas()
    want, deviation, _ = whitened_by_hand(np.floor(1024 * v) + 100_000, 2)
    assert len(got) == 80 and set(got.component) == {1, 2}
    assert sorted(map(int, got[got.component == 2].deviation)) == sorted(deviation)
    one = got[got.component == 1].sort_values("deviation").whitened.to_numpy()
    assert np.allclose(np.sort(np.abs(one)), np.sort(np.abs(want[:, 0])))
    assert got.vec_id.isna().sum() == 2 and (got.vec_id == 1).sum() == 4


def test_whitening_deviation_beyond_64_bits(spark):
    rows = [(i, [float(s) * 2.0 ** 40, float(i)], 0) for i, s in enumerate([1, -1, 1, 1, -1])]
    got = whitening.whiten(vectors(spark, rows)).where("component = 1").toPandas()
    x = np.array([[int(1024 * c) + 100_000 for c in v] for _, v, _ in rows], dtype=object)
    total = x.sum(axis=0)
    want = {i: sum((5 * a - t) ** 2 for a, t in zip(row, total)) for i, row in enumerate(x)}
    assert {r.vec_id: int(r.deviation) for r in got.itertuples()} == want and max(want.values()) > 2 ** 63


def test_whitening_without_rows_or_variance(spark):
    for rows in ([], BROKEN, [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)]):
        out = whitening.whiten(vectors(spark, rows))
        assert out.count() == 0 and out.columns[0] == "vec_id"
    line = whitening.whiten(vectors(spark, [(i, [float(i), float(i)], 0) for i in range(9)])).toPandas()
    assert set(line.component) == {1} and abs(line.explained.iloc[0] - 1) < 1e-12


# -- nearest neighbours

def neighbours_by_hand(ids, v, picked, k):
    out = {}
    for q in picked:
        d = np.sqrt(((v - v[ids == q][0]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != q][:k]
        out[int(q)] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def as_lists(found):
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_neighbours_of_the_given_table(spark):
    ids, v, _ = given_table(spark)
    got = as_lists(queries.op12_nearest_neighbours(spark, SF0001))
    want = neighbours_by_hand(ids, v, ids[ids % 100 == 0], 10)
    assert got.keys() == want.keys() and all(len(g) == 10 for g in got.values())
    hit = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hit >= 0.9 * 10 * len(want)
    exact = multi_index.exact(spark.read.parquet(f"{SF0001}/embeddings.parquet"), F.col("vec_id") % 100 == 0)
    assert as_lists(exact) == want
    assert multi_index.recall(queries.op12_nearest_neighbours(spark, SF0001), exact) >= 0.9


def test_neighbours_ties_copies_and_left_out_rows(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(300, 16))
    v[20:140] = v[0]                                            # a hot vector: ties by id
    rows = [(i, r.tolist(), 0) for i, r in enumerate(v)]
    rows += [(i, [c] * 16 if c is not None else None, 0) for i, c in ((500, 0.0), (600, None), (700, float("nan")))]
    rows += [(None, v[3].tolist(), 0), (800, [1.0], 0), (1, v[1].tolist(), 0), (100, (v[0] + 9).tolist(), 0)]
    got = as_lists(multi_index.search(vectors(spark, rows).repartition(7), F.col("vec_id") % 100 == 0))
    assert set(got) == {0, 100, 200}
    assert [i for i, _ in got[0]] == list(range(20, 30))
    assert all(s == 0 for _, s in got[0]) and not {500, 600, 700, 800} & {i for i, _ in got[200]}
    assert len({i for i, _ in got[200]}) == 10


def test_neighbours_of_few_rows(spark):
    few = [(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [-1.0, 0.0], 0)]
    got = as_lists(multi_index.search(vectors(spark, few), F.col("vec_id") % 100 == 0))
    assert got == {0: [(1, 2 ** 0.5), (2, 2.0)]}
    for rows in ([], BROKEN, [(5, [1.0, 2.0], 0)], [(0, [1.0, 2.0], 0)]):
        assert multi_index.search(vectors(spark, rows), F.col("vec_id") % 100 == 0).count() == 0


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(0, 12))
def test_probing_finds_every_code_within_the_radius(seed, radius):
    """One worker call against the definition: all codes within the radius, and no other."""
    import pyarrow as pa
    rng = np.random.default_rng(seed)
    codes = rng.integers(0, 2, size=(60, 24)).astype(np.uint8)
    codes[:20] = codes[0] ^ (rng.random((20, 24)) < 0.1)
    packed = np.packbits(codes, axis=1)
    v = rng.normal(size=(60, 3))
    batch = pa.RecordBatch.from_pydict({"vec_id": list(range(60)), "v": v.tolist(), "code": [c.tobytes() for c in packed]})
    asked = {"vec_id": [0], "v": [v[0].tolist()], "code": [packed[0].tobytes()], "radius": [radius], "bound": [None]}
    out = pa.Table.from_batches(multi_index._probe(3, 60)(asked, iter([batch])))
    within = {i for i in range(1, 60) if (codes[i] != codes[0]).sum() <= radius}
    assert set(out.column("vec_id").to_pylist()) == within


# -- hard negatives

def negatives_by_hand(ids, x, labels, anchors, k=5):
    out = set()
    for a in anchors:
        score = [int(sum(int(p) * int(q) for p, q in zip(r, x[a]))) for r in x]
        order = sorted((j for j in range(len(ids)) if ids[j] != ids[a]), key=lambda j: (-score[j], ids[j]))
        for p in [j for j in order if labels[j] == labels[a]][:k]:
            fit = [j for j in order if labels[j] != labels[a] and 80 * score[p] <= 100 * score[j] <= 100 * score[p]]
            out |= {(ids[a], ids[p], r + 1, ids[j], score[p], score[j]) for r, j in enumerate(fit[:k])}
    return out


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10 ** 6), st.sampled_from([3, 300, 40_000, 2 ** 22, 2 ** 40, 2 ** 70]))
def test_packed_products_are_exact(seed, top):
    rng = np.random.default_rng(seed)
    x = hard_negatives.integers(rng.uniform(-top, top, size=(11, 4)), 1)
    a = [[int(v) for v in row] for row in hard_negatives.integers(rng.uniform(-top, top, size=(3, 4)), 1)]
    bias = [min(c) for c in zip(*a)]
    packed = hard_negatives.Packed(x, [max(c) - b for c, b in zip(zip(*a), bias)])
    shared = x.astype(object) @ np.array(bias, dtype=object)
    if x.dtype != object:
        shared = shared.astype(np.int64)
    for row in a:
        assert packed.scores(row, bias, shared).tolist() == [sum(int(p) * q for p, q in zip(r, row)) for r in x]


@pytest.mark.parametrize("copies", [0, 120])
def test_hard_negatives_equal_all_pairs(spark, copies):
    rng = np.random.default_rng(6)
    v = np.round(rng.normal(size=(400, 6)) + 1, 2)
    v[10:10 + copies] = v[0]
    labels = rng.integers(0, 3, size=400)
    rows = [(i, r.tolist(), int(c)) for i, (r, c) in enumerate(zip(v, labels))]
    extra = BROKEN + [(None, v[0].tolist(), 0), (950, v[0].tolist(), None), (1000, [1.0], 0)]
    got = hard_negatives.mine(vectors(spark, rows + extra + rows[5:9]).repartition(6), F.col("vec_id") % 100 == 0)
    want = negatives_by_hand(list(range(400)), np.floor(256 * v).astype(int), labels, [0, 100, 200, 300])
    assert {tuple(r) for r in got.collect()} == want and want


def test_hard_negatives_without_anchors_positives_or_rows(spark):
    alone = [(0, [1.0, 1.0], 0), (1, [1.0, 1.0], 1)]
    for rows in ([], BROKEN, alone, [(3, [1.0, 2.0], 0), (4, [1.0, 2.0], 1)]):
        assert hard_negatives.mine(vectors(spark, rows), F.col("vec_id") % 100 == 0).count() == 0


def test_query_groups_cover_all_queries(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, r.tolist(), int(i % 3)) for i, r in enumerate(rng.normal(size=(200, 4)) + 1)]
    one = {tuple(r) for r in hard_negatives.mine(vectors(spark, rows), F.col("vec_id") % 10 == 0).collect()}
    grouped = query_scan.grouped
    monkeypatch.setattr(query_scan, "grouped", lambda q, d: grouped(q, d, 200))      # several scans
    assert {tuple(r) for r in hard_negatives.mine(vectors(spark, rows), F.col("vec_id") % 10 == 0).collect()} == one
