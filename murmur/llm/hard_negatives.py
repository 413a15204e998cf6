"""Hard-negative mining on exact integer inner products, many at a time.

Components become integers ``floor(scale * x)``.  For a block of candidates, each dimension is packed into one wide
integer (Kronecker substitution): candidates are biased to be non-negative and stand in fields wide enough for the whole
sum, so one multiplication per anchor component scores the block, and the fields of the sum, less the biases, are
the exact inner products.

Two scans for each broadcast group of anchors: rows of the anchor's label give its positives, then rows of other
labels give each positive's negatives, at least ``low`` and at most ``high`` hundredths of the positive's score.

Rows: a null id, label or vector, a null, NaN or infinite entry, or a length that is not the most frequent one takes no
part.  Rows of one id are one candidate with its best eligible score; an anchor id that repeats asks with its least
(label, vector).  Higher scores come first, ties by smaller id.  An anchor without positives or without
eligible negatives gives no row, an empty table none at all; other columns are ignored, whatever their names.  Scores
must fit 64 bits; a returned one that doesn't raises.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from murmur.llm import query_scan
from murmur.llm.common import bound_batches, stored
from murmur.llm.whitening import finite

POSITIVES = "anchor_id long, positive_id long, positive_score long"
NEGATIVES = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


class Packed:
    """A block of candidates as one wide integer per dimension."""

    def __init__(self, x: np.ndarray, anchor_top: list[int]):
        """``x``: candidates by dimension; ``anchor_top``: greatest biased anchor component, by dimension."""
        low = x.min(axis=0)
        self.count, self.bias = len(x), [int(v) for v in low]
        top = [int(h) - b for h, b in zip(x.max(axis=0), self.bias)]
        bits = max(sum(a * t for a, t in zip(anchor_top, top)).bit_length(), 1)
        self.width = 4 if bits <= 32 else 8 if bits < 62 else -(-bits // 64) * 8 + 8         # bytes of a field
        self.wide = [self._pack(x[:, d], b) for d, b in enumerate(self.bias)]

    def _pack(self, column: np.ndarray, bias: int) -> int:
        if self.width <= 8 and column.dtype != object:
            return int.from_bytes((column - bias).astype(f"<u{self.width}").tobytes(), "little")
        return int.from_bytes(b"".join((int(v) - bias).to_bytes(self.width, "little") for v in column), "little")

    def scores(self, anchor: list[int], anchor_bias: list[int], shared: np.ndarray) -> np.ndarray:
        """Exact inner products ``a . x = (a - b) . (x - c) + (a - b) . c + b . x`` with biases b and c; ``shared`` is
        ``b . x``."""
        biased = [a - b for a, b in zip(anchor, anchor_bias)]
        fields = sum(map(mul, biased, self.wide)).to_bytes(self.count * self.width, "little")
        fixed = sum(map(mul, biased, self.bias))
        if self.width <= 8 and shared.dtype != object and abs(fixed) < 2 ** 61:
            return np.frombuffer(fields, dtype=f"<u{self.width}").astype(np.int64) + fixed + shared
        got = [int.from_bytes(fields[i:i + self.width], "little") for i in range(0, len(fields), self.width)]
        return np.array(got, dtype=object) + fixed + shared.astype(object)


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``: 64-bit where products of two stay far below 2**63, Python's integers beyond."""
    y = np.floor(x * scale)
    if not y.size or np.abs(y).max() < 2 ** 24:
        return y.astype(np.int64)
    return np.array([[int(v) for v in row] for row in y], dtype=object).reshape(y.shape)


class Anchors:
    """A group of anchors in a worker: integer components, biased by dimension."""

    def __init__(self, asked: dict, dims: int, scale: int):
        x = integers(np.array(asked["v"], dtype=np.float64).reshape(-1, dims), scale)
        self.ids, self.labels = asked["vec_id"], np.array(asked["label"])
        self.x = [[int(v) for v in row] for row in x]
        self.bias = [min(row[d] for row in self.x) for d in range(dims)]
        self.top = [max(row[d] for row in self.x) - b for d, b in enumerate(self.bias)]
        self.bias_vector = np.array(self.bias, dtype=np.int64 if max(map(abs, self.bias)) < 2 ** 24 else object)

    def blocks(self, batch: pa.RecordBatch, dims: int, scale: int, same: bool):
        """``(ids, scores by anchor index)`` of the rows with the anchor's label, or with another one."""
        ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
        labels = batch.column("label").to_numpy(zero_copy_only=False)
        x = integers(query_scan.matrix(batch.column("v"), dims), scale)
        shared = x @ self.bias_vector if x.dtype != object else x.astype(object) @ self.bias_vector.astype(object)
        for label in np.unique(labels if same else self.labels):
            rows = np.flatnonzero(labels == label if same else labels != label)
            mine = np.flatnonzero(self.labels == label)
            if not len(rows) or not len(mine):
                continue
            packed = Packed(x[rows], self.top)
            for i in mine:
                yield i, ids[rows], packed.scores(self.x[i], self.bias, shared[rows])


def _positives(dims: int, scale: int, k: int):
    def work(asked: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(asked, dims, scale)
        best = query_scan.Best(len(anchors.ids), k)
        for batch in batches:
            for i, ids, scores in anchors.blocks(batch, dims, scale, same=True):
                other = ids != anchors.ids[i]
                best.offer(i, -scores[other], ids[other])
        found = [(anchors.ids[i], v, -cost) for i, v, cost in best.rows()]
        yield pa.RecordBatch.from_pydict(
            {n: [r[j] for r in found] for j, n in enumerate(("anchor_id", "positive_id", "positive_score"))},
            schema=pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())]))

    return work


def _negatives(dims: int, scale: int, k: int, low: int, high: int):
    names = ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")

    def work(asked: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(asked, dims, scale)
        pairs = [(i, p["positive_id"], p["positive_score"]) for i, ps in enumerate(asked["positives"]) for p in ps]
        of: list[list[int]] = [[] for _ in anchors.ids]
        for j, (i, _, _) in enumerate(pairs):
            of[i].append(j)
        best = query_scan.Best(len(pairs), k)
        for batch in batches:
            for i, ids, scores in anchors.blocks(batch, dims, scale, same=False):
                for j in of[i]:
                    p = pairs[j][2]
                    fits = (100 * scores <= high * p) & (100 * scores >= low * p)
                    if fits.any():
                        best.offer(j, -scores[fits], ids[fits])
        found = [(anchors.ids[pairs[j][0]], pairs[j][1], pairs[j][2], v, -cost) for j, v, cost in best.rows()]
        yield pa.RecordBatch.from_pydict({n: [r[c] for r in found] for c, n in enumerate(names)},
                                         schema=pa.schema([(n, pa.int64()) for n in names]))

    return work


def mine(df: DataFrame, is_anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label",
         scale: int = 256, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; ``is_anchor`` is a condition on
    ``vec_id``."""
    spark = df.sparkSession
    bound_batches(spark)
    rows = (df.where(F.col(key).isNotNull() & F.col(label).isNotNull() & finite(F.col(vector)) & (F.size(vector) > 0))
            .select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
                    F.col(vector).alias("v")))
    top = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).limit(1).collect()
    dims = top[0]["d"] if top else 0
    rows = rows.where(F.size("v") == dims)
    asked = (rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("a"))
             .select("vec_id", "a.label", "a.v"))
    asked, parts = query_scan.grouped(asked, max(dims, 1))

    found = query_scan.scan(rows, asked, parts, POSITIVES, _positives(dims, scale, positives))
    found = found.groupBy("anchor_id", "positive_id").agg(F.max("positive_score").alias("positive_score"))
    first = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    found = stored(found.withColumn("at", F.row_number().over(first)).where(F.col("at") <= positives).drop("at"), "positives")
    pairs = found.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))    # at most `positives` entries
    got = query_scan.scan(rows, stored(asked.join(pairs, "vec_id"), "anchors"), parts, NEGATIVES,
                          _negatives(dims, scale, negatives, low, high))
    got = got.groupBy("anchor_id", "positive_id", "negative_id").agg(
        F.max("positive_score").alias("positive_score"), F.max("negative_score").alias("negative_score"))
    by = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    return got.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
