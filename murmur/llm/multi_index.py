"""Nearest neighbours by multi-index hashing.

A sample of at most ``fit_rows`` rows, chosen by a hash, gives the mean, the principal axes and a rotation that
brings rotated axes near the corners of a cube (iterative quantisation); the signs of the rotated axes are a code.  A
code is split into substrings of at most 16 bits.  Every row is indexed: each block of rows has, for each substring, a
table from value to rows.  Codes within ``r`` bits agree with the query's within ``r // m`` bits in at least one of
``m`` substrings, so probing all values that near retrieves every code within the radius; the rest are ruled out by the
whole code, and what remains is ranked by the distance of the vectors themselves.

The radius is chosen for each query: a first small one, set by the number of rows, gives an upper bound of the distance
sought, the learnt quantile of code distances at that bound is the second.  A query that still has fewer than ``k``
results is probed at the full width, which finds all rows.

Rows: vectors null, of zeros only, with a null, NaN or infinite entry, or with a length that is not the most frequent one
take no part, neither do rows with a null id.  Rows of one id are one candidate with its nearest vector, and never
neighbours of their own id; a query id that repeats asks with its least vector.  Ties go to the smaller id.  An empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from murmur.llm import query_scan
from murmur.llm.common import bound_batches, stored
from murmur.llm.whitening import finite

#: Rows the rotation and the radii are learnt on; a bound whatever the table.
FIT_ROWS = 20_000
#: Share of neighbours a radius is to cover, by the sample.
COVER = 0.985
#: Rows a query is to meet in the first round, in expectation.
FIRST_ROWS = 200
SUBSTRING = 16
MAX_BITS = 256

FOUND = "query_id long, vec_id long, score double"
_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


class Codes:
    """Learnt binary codes: mean, projection (axes rotated), and the radius by distance."""

    def __init__(self, mean: np.ndarray, axes: np.ndarray):
        self.mean, self.axes = mean, axes
        self.bits = axes.shape[1]
        self.steps: list[tuple[float, int]] = []        #: (distance, radius), both rising
        self.spread = np.zeros(self.bits + 1)           #: share of pairs within r bits

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Codes as bytes, one row of ``ceil(bits / 8)`` a vector."""
        return np.packbits((x - self.mean) @ self.axes > 0, axis=1)

    def learn_radii(self, x: np.ndarray, k: int, seed: int = 5) -> None:
        """Quantiles of code distance by distance, from neighbours of every rank within the sample."""
        codes = self.encode(x)
        picks = np.random.default_rng(seed).permutation(len(x))[:1000]
        dists, hams = [], []
        for i in picks:
            d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
            h = _ONES[codes ^ codes[i]].sum(axis=1)
            self.spread += np.bincount(h, minlength=self.bits + 1)
            near = np.argsort(d, kind="stable")[:20 * k]
            near = near[near != i]
            dists.append(d[near])
            hams.append(h[near])
        self.spread = (self.spread / self.spread.sum()).cumsum()
        if not dists or not len(np.concatenate(dists)):
            return
        dist, ham = np.concatenate(dists), np.concatenate(hams)
        order = np.argsort(dist)
        reach = 0
        for part in np.array_split(order, 50):
            if len(part):
                reach = max(reach, int(np.ceil(np.quantile(ham[part], COVER))))
                self.steps.append((float(dist[part].max()), reach))

    def first_radius(self, rows: int) -> int:
        return int(np.searchsorted(self.spread, min(1.0, FIRST_ROWS / max(rows, 1))))

    def radius(self, distance: Column) -> Column:
        """Radius that covers neighbours up to ``distance``; all bits beyond the distances seen."""
        out = F.lit(self.bits)
        for d, r in reversed(self.steps):
            out = F.when(distance <= d, r).otherwise(out)
        return out


def fit(rows: DataFrame, dims: int, n: int, k: int, fit_rows: int = FIT_ROWS, rounds: int = 40, seed: int = 5) -> Codes:
    """Learn codes from some ``fit_rows`` of the ``n`` rows ``(vec_id, v)``, chosen by a hash."""
    share = min(1.0, 0.9 * fit_rows / n)
    picked = rows.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 30)) < int(share * (1 << 30))) if share < 1 else rows
    x = query_scan.matrix(picked.select("v").limit(fit_rows).toArrow().column("v").combine_chunks(), dims)
    if not len(x):
        x = np.zeros((1, dims))
    x = x[np.lexsort(x.T[::-1])]                     # the same fit whatever the order of partitions
    mean = x.mean(axis=0)
    _, axes = np.linalg.eigh((x - mean).T @ (x - mean))
    axes = axes[:, ::-1][:, :MAX_BITS]
    turn, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(axes.shape[1],) * 2))
    z = (x - mean) @ axes
    for _ in range(rounds):                          # rotation towards the nearest corners
        u, _, vt = np.linalg.svd(np.where(z @ turn > 0, 1.0, -1.0).T @ z)
        turn = (u @ vt).T
    codes = Codes(mean, axes @ turn)
    codes.learn_radii(x, k)
    return codes


def index(rows: DataFrame, codes: Codes, dims: int) -> DataFrame:
    """Store every row with its code."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code = codes.encode(query_scan.matrix(b.column("v"), dims))
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("v"), pa.array([c.tobytes() for c in code], pa.binary())],
                names=["vec_id", "v", "code"])

    schema = T.StructType(rows.schema.fields + [T.StructField("code", T.BinaryType())])
    return stored(rows.mapInArrow(encode, schema), "codes")


def _values(codes: np.ndarray) -> list[np.ndarray]:
    """Substrings of 16 bits (the last may be of 8) of codes given as bytes."""
    out = []
    for s in range(0, codes.shape[1], SUBSTRING // 8):
        part = codes[:, s:s + SUBSTRING // 8].astype(np.uint16)
        out.append(part[:, 0] << 8 | part[:, 1] if part.shape[1] == 2 else part[:, 0])
    return out


def _probe(dims: int, k: int):
    """Worker: block tables by substring, probing, check of the code, rank by distance."""
    def work(asked: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = np.array([v for v in asked["v"]], dtype=np.float64).reshape(-1, dims)
        q_codes = np.frombuffer(b"".join(asked["code"]), dtype=np.uint8).reshape(len(q), -1)
        q_values = _values(q_codes)
        radius = np.array(asked["radius"])
        limit = [math.inf if b is None else b for b in asked["bound"]]
        best = query_scan.Best(len(q), k)
        for batch in batches:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            x = query_scan.matrix(batch.column("v"), dims)
            codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), dtype=np.uint8).reshape(len(x), -1)
            tables = []
            for values in _values(codes):            # value -> rows, as sorted runs
                order = np.argsort(values, kind="stable")
                uniq, start = np.unique(values[order], return_index=True)
                tables.append((order, uniq, np.append(start, len(order))))
            reach = radius // len(tables)
            for i in range(len(q)):
                hit = np.zeros(len(x), dtype=bool)
                for (order, uniq, start), mine in zip(tables, q_values):
                    apart = uniq ^ mine[i]
                    near = np.flatnonzero(_ONES[apart & 255] + _ONES[apart >> 8] <= reach[i])
                    if len(near) == len(uniq):
                        hit[:] = True
                        break
                    sizes = start[near + 1] - start[near]
                    at = np.repeat(start[near] - np.append(0, sizes.cumsum()[:-1]), sizes) + np.arange(sizes.sum())
                    hit[order[at]] = True
                rows = np.flatnonzero(hit)
                rows = rows[_ONES[codes[rows] ^ q_codes[i]].sum(axis=1) <= radius[i]]
                rows = rows[ids[rows] != asked["vec_id"][i]]
                score = np.sqrt(((x[rows] - q[i]) ** 2).sum(axis=1))
                near = score <= limit[i]
                best.offer(i, score[near], ids[rows[near]])
        out = list(best.rows())
        yield pa.RecordBatch.from_pydict(
            {"query_id": [asked["vec_id"][i] for i, _, _ in out], "vec_id": [v for _, v, _ in out],
             "score": [s for _, _, s in out]},
            schema=pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))

    return work


def _nearest(found: DataFrame, k: int) -> DataFrame:
    """One row per candidate, the ``k`` nearest of each query."""
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    by = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def prepare(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int, int]:
    """``(vec_id, v)`` of the rows that take part, their dimensions and their number."""
    bound_batches(df.sparkSession)
    rows = (df.where(F.col(key).isNotNull() & finite(F.col(vector)) & F.exists(vector, lambda c: c != 0))
            .select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("v")))
    top = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).limit(1).collect()
    dims, n = (top[0]["d"], top[0]["count"]) if top else (0, 0)
    return rows.where(F.size("v") == dims), dims, n


def search(df: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding",
           fit_rows: int = FIT_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found of each row where ``is_query`` (a condition on
    ``vec_id``) holds."""
    rows, dims, n = prepare(df, key, vector)
    if not n:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    codes = fit(rows, dims, n, k, fit_rows)
    indexed = index(rows, codes, dims)
    asked = (indexed.where(is_query).groupBy("vec_id").agg(F.min(F.struct("v", "code")).alias("q"))
             .select("vec_id", "q.v", "q.code"))
    asked, parts = query_scan.grouped(asked, dims)
    first, last = codes.first_radius(n), codes.radius(F.lit(codes.steps[-1][0] if codes.steps else math.inf))

    def probed(queries: DataFrame) -> DataFrame:
        return stored(_nearest(query_scan.scan(indexed, queries, parts, FOUND, _probe(dims, k)), k), "neighbours")

    one = probed(asked.withColumn("radius", F.lit(first)).withColumn("bound", F.lit(None).cast("double")))
    seen = one.groupBy("query_id").agg(F.count("*").alias("hits"), F.max("score").alias("far"))
    full = F.coalesce(F.col("hits") >= k, F.lit(False))
    again = (asked.join(seen, asked["vec_id"] == seen["query_id"], "left")
             .withColumn("radius", F.when(full, codes.radius(F.col("far"))).otherwise(last))
             .withColumn("bound", F.when(full, F.col("far"))).drop("query_id", "hits", "far"))
    two = probed(again.where(F.col("radius") > first))
    both = two.unionByName(one).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    enough = both.groupBy("query_id").count().where(F.col("count") >= k).select(F.col("query_id").alias("vec_id"))
    rest = stored(asked.join(enough, "vec_id", "left_anti"), "short-queries")
    if rest.limit(1).count():
        three = probed(rest.withColumn("radius", F.lit(codes.bits)).withColumn("bound", F.lit(None).cast("double")))
        both = both.unionByName(three.select("query_id", "vec_id", "score"))
    return _nearest(both, k).select("query_id", "rank", "vec_id", "score")


def exact(df: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The true ``k`` nearest: every code is within the full width.  For measuring ``recall``."""
    rows, dims, n = prepare(df, key, vector)
    if not n:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    codes = Codes(np.zeros(dims), np.eye(dims)[:, :8])
    indexed = index(rows, codes, dims)
    asked = (indexed.where(is_query).groupBy("vec_id").agg(F.min(F.struct("v", "code")).alias("q"))
             .select("vec_id", "q.v", "q.code", F.lit(codes.bits).alias("radius"), F.lit(None).cast("double").alias("bound")))
    asked, parts = query_scan.grouped(asked, dims)
    return _nearest(query_scan.scan(indexed, asked, parts, FOUND, _probe(dims, k)), k).select("query_id", "rank", "vec_id", "score")


def recall(found: DataFrame, truth: DataFrame) -> float:
    """Share of the true neighbours that were found."""
    hit = truth.join(found.select("query_id", "vec_id"), ["query_id", "vec_id"], "left_semi").count()
    return hit / max(truth.count(), 1)
