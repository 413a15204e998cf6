"""A stated query set against all rows, in blocks: bounded groups of queries are broadcast, and each group scans the
rows once.  What a task keeps is a few rows a query."""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from murmur.llm.common import stored

#: Bytes of query vectors (8 a component) that are broadcast at a time; more queries take more scans.
GROUP_BYTES = 32 << 20


def grouped(queries: DataFrame, dims: int, group_bytes: int = GROUP_BYTES) -> tuple[DataFrame, int]:
    """Store ``queries`` with a column ``part`` that deals them to groups of some ``group_bytes`` bytes."""
    held = stored(queries.withColumn("row_no", F.monotonically_increasing_id()), "queries")
    parts = max(1, math.ceil(held.count() * dims * 8 / group_bytes))
    return held.withColumn("part", F.pmod(F.xxhash64("row_no"), F.lit(parts))), parts


def scan(rows: DataFrame, queries: DataFrame, parts: int, schema: str,
         work: Callable[[dict, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``work(queries, batches)`` over the rows for each group of queries; ``queries`` are the columns as lists."""
    spark = rows.sparkSession
    found = []
    for part in range(parts):
        group = queries.where(F.col("part") == part).drop("part", "row_no").toArrow()
        if not group.num_rows:
            continue
        held = spark.sparkContext.broadcast({c: group.column(c).to_pylist() for c in group.column_names})

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            yield from work(held.value, batches)

        found.append(rows.mapInArrow(run, schema))
    return reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], schema)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The vectors of a list column, all of ``dims`` entries, as float64."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


class Best:
    """The ``k`` best (cost, id) of each query, ids distinct: least cost first, ties to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.kept: list[dict] = [{} for _ in range(queries)]
        self.bound = [None] * queries           #: k-th best cost so far, None before there are k

    def offer(self, q: int, costs: np.ndarray, ids: np.ndarray) -> None:
        """Costs in any order.  Only the best ``k`` distinct ids can matter, so ties at the cut are kept until ids decide."""
        bound, kept = self.bound[q], self.kept[q]
        if bound is not None:
            near = costs <= bound
            costs, ids = costs[near], ids[near]
        if len(costs) > 4 * self.k:
            order = np.lexsort((ids, costs))
            first = np.unique(ids[order], return_index=True)[1]
            if len(first) > self.k:
                order = order[np.sort(first)[:self.k]]
            costs, ids = costs[order], ids[order]
        for cost, i in zip(costs.tolist(), ids.tolist()):
            if i not in kept or cost < kept[i]:
                kept[i] = cost
        if len(kept) >= self.k:
            best = heapq.nsmallest(self.k, ((c, i) for i, c in kept.items()))
            self.kept[q] = {i: c for c, i in best}
            self.bound[q] = best[-1][0]

    def rows(self) -> Iterator[tuple[int, int, object]]:
        for q, kept in enumerate(self.kept):
            for i, cost in kept.items():
                yield q, i, cost
