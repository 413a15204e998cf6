"""Nearest rows of every row, by lists: groups of queries are broadcast and scan the lists they need.

Rows are dealt to the lists of their nearest pivots (a bounded sample of rows).  A query probes the ``probes`` nearest
lists; ``probes=None`` probes all, which is exact.  A group of queries is bounded by its bytes, whatever the size of a
list, and a scan keeps ``k`` rows a query.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from murmur.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])         # executors need no copy of this package

#: Bytes of query vectors (8 a component) broadcast at a time.
GROUP_BYTES = 32 << 20
#: Distances (8 bytes each, some arrays of them) that a worker holds at a time.
CELLS = 1 << 20
#: Pivots are at most so many rows, whatever the table.
MAX_PIVOTS = 2048


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: computed once, and nothing is lost with an executor."""
    path = scratch_path(df.sparkSession, name) + "/data"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, v)`` of rows with an id and a vector of finite numbers; of rows of one id, the least vector."""
    ok = F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & F.forall(
        vec_col, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    return (df.where(F.col(id_col).isNotNull() & ok)
            .select(F.col(id_col).cast("long").alias("id"), F.transform(vec_col, lambda c: c.cast("double")).alias("v"))
            .groupBy("id").agg(F.min("v").alias("v")))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def scan(rows: DataFrame, queries: DataFrame, dims: int, schema: str, work) -> DataFrame:
    """``work(queries as an Arrow table, batches)`` over ``rows(list, ...)`` for each bounded group of ``queries(probe, ...)``."""
    spark = rows.sparkSession
    queries = stored(queries.withColumn("row_no", F.monotonically_increasing_id()), "queries")
    per = queries.groupBy("list").count().collect()                 # at most MAX_PIVOTS rows
    room = max(1, GROUP_BYTES // (8 * dims))
    groups: list[tuple[list[int], int, int]] = []                   # (lists, share, of shares)
    held, size = [], 0
    for r in sorted(per, key=lambda r: r["list"]):
        shares = math.ceil(r["count"] / room)
        if shares > 1:
            groups += [([r["list"]], i, shares) for i in range(shares)]
            continue
        if size + r["count"] > room and held:
            groups.append((held, 0, 1))
            held, size = [], 0
        held.append(r["list"])
        size += r["count"]
    if held:
        groups.append((held, 0, 1))
    found = []
    for lists, share, shares in groups:
        mine = queries.where(F.col("list").isin(lists) & (F.pmod(F.xxhash64("row_no"), F.lit(shares)) == share))
        table = mine.drop("row_no").toArrow().combine_chunks()
        probed = sorted(set(table.column("probe").combine_chunks().flatten().to_pylist())) if table.num_rows else []
        sent = spark.sparkContext.broadcast(table)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            yield from work(sent.value, batches)

        found.append(rows.where(F.col("list").isin(probed)).mapInArrow(run, schema))
    return reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], schema)


def lists(rows: DataFrame, dims: int, probes: int | None, pivots: int, seed: int = 7) -> DataFrame:
    """Stored rows with their ``list`` (that of the nearest pivot) and the lists they ``probe``."""
    if probes is None:
        return stored(rows.withColumn("list", F.lit(0)).withColumn("probe", F.array(F.lit(0))), "lists")
    pivots = min(pivots, MAX_PIVOTS)
    picked = rows.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(pivots).toArrow().column("v").combine_chunks()
    centre = matrix(picked, dims)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("v"), dims)
            d = (centre ** 2).sum(axis=1) - 2 * x @ centre.T
            near = np.argsort(d, axis=1, kind="stable")[:, :min(probes, len(centre))].astype(np.int32)
            probe = pa.ListArray.from_arrays(np.arange(0, near.size + 1, near.shape[1], dtype=np.int32), pa.array(near.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), pa.array(near[:, 0]), probe],
                                             names=["id", "v", "list", "probe"])

    return stored(rows.select("id", "v").mapInArrow(deal, "id long, v array<double>, list int, probe array<int>"), "lists")


def chunks(queries: int, rows: int) -> Iterator[tuple[int, int]]:
    """Runs of queries whose distances to ``rows`` rows are at most ``CELLS`` (one query at least)."""
    step = max(1, CELLS // max(rows, 1))
    for a in range(0, queries, step):
        yield a, min(a + step, queries)


def _nearest(dims: int, k: int):
    def work(asked: pa.Table, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = asked.column("id").to_numpy()
        q = matrix(asked.column("v").combine_chunks(), dims)
        probe = asked.column("probe").to_pylist()
        best_d, best_id = np.full((len(q), k), np.inf), np.full((len(q), k), np.iinfo(np.int64).max)
        for batch in batches:
            other, x = batch.column("id").to_numpy(), matrix(batch.column("v"), dims)
            of = batch.column("list").to_numpy()
            many = len(np.unique(of)) > 1 or any(of[0] not in p for p in probe)
            square = (x ** 2).sum(axis=1)
            for a, b in chunks(len(q), len(x)):
                part = q[a:b]
                near = square - 2 * part @ x.T                  # ranks rows; the distances follow exactly
                near[ids[a:b, None] == other] = np.inf
                if many:
                    for i, p in enumerate(probe[a:b]):
                        near[i, ~np.isin(of, p)] = np.inf
                top = min(k + 8, len(x))
                pick = np.argpartition(near, top - 1, axis=1)[:, :top]
                d = np.sqrt(((x[pick] - part[:, None]) ** 2).sum(axis=2))
                d[np.isinf(np.take_along_axis(near, pick, axis=1))] = np.inf
                all_d = np.concatenate([best_d[a:b], d], axis=1)
                all_id = np.concatenate([best_id[a:b], other[pick]], axis=1)
                order = np.argsort(all_id, axis=1, kind="stable")
                all_d, all_id = (np.take_along_axis(y, order, axis=1) for y in (all_d, all_id))
                order = np.argsort(all_d, axis=1, kind="stable")[:, :k]
                best_d[a:b], best_id[a:b] = (np.take_along_axis(y, order, axis=1) for y in (all_d, all_id))
        row, col = np.nonzero(np.isfinite(best_d))
        yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(best_id[row, col]), pa.array(best_d[row, col])],
                                         names=["id", "other", "d"])

    return work


def neighbours(held: DataFrame, dims: int, k: int) -> DataFrame:
    """``id, other, d, rank``: the ``k`` nearest other rows found of each row of ``held`` (see ``lists``), ties by id."""
    found = scan(held, held, dims, "id long, other long, d double", _nearest(dims, k))
    by = Window.partitionBy("id").orderBy("d", "other")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def recall(found: DataFrame, truth: DataFrame) -> float:
    """Share of the true neighbours that were found."""
    hit = truth.join(found.select("id", "other"), ["id", "other"], "left_semi").count()
    return hit / max(truth.count(), 1)
