"""Embedding whitening with MLlib's ``BlockMatrix``.

Rows become integers ``x = floor(scale * c) + shift``.  One pass packs them into blocks of rows, which are stored with
their exact column sums; a block of centred rows is a block of a distributed matrix A.  ``A' * A`` (over many tasks,
summed) is the scatter matrix, a local ``eigh`` of its d x d values gives the components, and ``A * W`` projects every
row on them.

Rows: a null vector, or one with a null, NaN or infinite entry, is left out, and so is a vector whose length is not the
most frequent one (ties: the greater length).  Repeated rows and equal keys count and are returned as often as they
occur; a null key is returned as null.  Other columns of the input are ignored, whatever their names.  An empty table,
or one of equal vectors only, gives no rows: components without variance are left out, as they can't be scaled.
Entries must keep ``|scale * c|`` below 2**52, beyond which the integers raise.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, functions as F, types as T

from murmur.llm.common import bound_batches, stored

#: Values of a block of rows: the least (512 kB) and the most (64 MB) that a task holds of one.
BLOCK_VALUES, MAX_BLOCK_VALUES = 1 << 16, 1 << 23
#: The driver keeps one index per block while it plans a product; blocks grow with the rows beyond so many.
MAX_BLOCKS = 1_000_000

DECIMAL = T.DecimalType(38, 0)


def finite(vector: Column) -> Column:
    """Whether a vector is present and holds finite numbers only."""
    return vector.isNotNull() & F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 8,
           scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error`` of each remaining row and each of the
    first ``k`` components.

    ``deviation`` is the exact sum over dimensions of ``(n * x - S) ** 2`` as DECIMAL(38, 0).
    """
    spark = df.sparkSession
    bound_batches(spark)
    key_type = df.schema[key].dataType
    schema = T.StructType([T.StructField(key, key_type), T.StructField("component", T.IntegerType()),
                           T.StructField("n", T.LongType()), T.StructField("deviation", DECIMAL),
                           T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
                           T.StructField("identity_error", T.DoubleType())])
    rows = (df.where(finite(F.col(vector)) & (F.size(vector) > 0))
            .select(F.col(key).alias("key"),
                    F.transform(vector, lambda c: F.floor(c.cast("double") * scale) + shift).alias("x")))
    top = (rows.groupBy(F.size("x").alias("d")).count()
           .orderBy(F.col("count").desc(), F.col("d").desc()).limit(1).collect())
    if not top:
        return spark.createDataFrame([], schema)
    d, n = top[0]["d"], top[0]["count"]
    size = min(max(BLOCK_VALUES // d, math.ceil(n / MAX_BLOCKS), 1), max(MAX_BLOCK_VALUES // d, 1))

    blocks, count = _blocks(rows.where(F.size("x") == d), key_type, d, size)
    sums = _sums(blocks, d)
    a = _matrix(blocks, [s / n for s in sums], count, d, size)
    values, vectors = _components(a, n, count)
    kept = min(k, int((values > d * np.finfo(float).eps * values.sum()).sum()))
    if not kept:
        return spark.createDataFrame([], schema)
    w = vectors[:, :kept] / np.sqrt(values[:kept])
    projected = a.multiply(BlockMatrix(
        spark.sparkContext.parallelize([((0, 0), DenseMatrix(d, kept, w.ravel(order="F").tolist()))], 1), d, kept))
    out = stored(_rows(projected, blocks, key_type, sums, n, size, kept), "whitened")
    error = _identity_error(out, n)
    explained = F.array(*[F.lit(float(v / values.sum())) for v in values[:kept]])
    return out.select("key", "deviation", F.posexplode("y").alias("at", "whitened")).select(
        F.col("key").alias(key), (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        "whitened", explained[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"))


def _blocks(rows: DataFrame, key_type: T.DataType, d: int, size: int) -> tuple[DataFrame, int]:
    """Stored blocks of up to ``size`` rows, numbered from 0: keys, values row by row and column sums; and their number."""
    schema = T.StructType([T.StructField("task", T.IntegerType()), T.StructField("seq", T.IntegerType()),
                           T.StructField("keys", T.ArrayType(key_type)), T.StructField("x", T.ArrayType(T.LongType())),
                           T.StructField("sums", T.ArrayType(T.LongType()))])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seq = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def emit(part: pa.Table) -> pa.RecordBatch:
            part = part.combine_chunks()
            x = part.column("x").combine_chunks()
            keys = part.column("key").combine_chunks()
            flat = x.flatten()
            sums = flat.to_numpy(zero_copy_only=False).reshape(-1, d).sum(axis=0)
            ends = [0, part.num_rows]
            return pa.RecordBatch.from_arrays(
                [pa.array([task], pa.int32()), pa.array([seq], pa.int32()), pa.ListArray.from_arrays(ends, keys),
                 pa.ListArray.from_arrays([0, len(flat)], flat), pa.array([sums.tolist()], pa.list_(pa.int64()))],
                names=["task", "seq", "keys", "x", "sums"])

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= size:
                whole = pa.Table.from_batches(held)
                yield emit(whole.slice(0, size))
                seq += 1
                held = whole.slice(size).to_batches()
        if sum(b.num_rows for b in held):
            yield emit(pa.Table.from_batches(held))

    packed = stored(rows.mapInArrow(pack, schema), "vector-blocks")
    per_task = sorted((r["task"], r["blocks"]) for r in packed.groupBy("task").agg(F.count("*").alias("blocks")).collect())
    starts, total = {}, 0
    for task, blocks in per_task:
        starts[task] = total
        total += blocks
    first = packed.sparkSession.createDataFrame(sorted(starts.items()), "task int, start int")
    return packed.join(first, "task").withColumn("block", F.col("start") + F.col("seq")), total


def _sums(blocks: DataFrame, d: int) -> list[int]:
    """Exact column sums."""
    per = (blocks.select(F.posexplode("sums").alias("at", "s")).groupBy("at")
           .agg(F.sum(F.col("s").cast(DECIMAL)).alias("s")).collect())
    return [int(r["s"]) for r in sorted(per, key=lambda r: r["at"])]


def _matrix(blocks: DataFrame, means: list[float], count: int, d: int, size: int) -> BlockMatrix:
    """The centred rows as a ``BlockMatrix`` of one column of blocks; short blocks end in rows of zeros."""
    schema = T.StructType([T.StructField("at", T.StructType([T.StructField("row", T.LongType()),
                                                             T.StructField("col", T.LongType())])),
                           T.StructField("block", MatrixUDT())])
    mean = np.asarray(means)
    at_type = pa.struct([("row", pa.int64()), ("col", pa.int64())])

    def centre(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x = batch.column("x")[i].values.to_numpy(zero_copy_only=False).reshape(-1, d)
                a = np.zeros((size, d))
                a[:len(x)] = x - mean
                values = pa.ListArray.from_arrays([0, a.size], pa.array(a.ravel()))
                none = pa.nulls(1, pa.list_(pa.int32()))
                block = pa.StructArray.from_arrays(
                    [pa.array([1], pa.int8()), pa.array([size], pa.int32()), pa.array([d], pa.int32()), none, none,
                     values, pa.array([True])],
                    names=["type", "numRows", "numCols", "colPtrs", "rowIndices", "values", "isTransposed"])
                at = pa.array([{"row": batch.column("block")[i].as_py(), "col": 0}], at_type)
                yield pa.RecordBatch.from_arrays([at, block], names=["at", "block"])

    parts = blocks.select("block", "x").mapInArrow(centre, schema)
    return BlockMatrix(callMLlibFunc("createBlockMatrix", parts, size, d, count * size, d), size, d)


def _components(a: BlockMatrix, n: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and unit eigenvectors of the covariance, falling; the greatest entry of a vector is positive."""
    # The Scala API's second argument spreads the inner dimension over tasks; Python's signature lacks it.
    splits = min(count, max(8, math.ceil(count / 8)))
    product = a.transpose()._java_matrix_wrapper.call("multiply", a._java_matrix_wrapper._java_model, splits)
    d = a.numCols()
    scatter = BlockMatrix(product, d, d).toLocalMatrix().toArray()
    values, vectors = np.linalg.eigh((scatter + scatter.T) / (2 * n))
    values, vectors = values[::-1].clip(min=0), vectors[:, ::-1]
    lead = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.where(vectors[lead, np.arange(d)] < 0, -1.0, 1.0)


def _rows(projected: BlockMatrix, blocks: DataFrame, key_type: T.DataType, sums: list[int], n: int,
          size: int, k: int) -> DataFrame:
    """``key, deviation, y`` of each row: projected blocks meet the keys and exact deviations of their blocks."""
    total = np.array(sums, dtype=object)
    dev_schema = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("keys", T.ArrayType(key_type)),
                               T.StructField("deviations", T.ArrayType(DECIMAL))])

    def deviations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x = batch.column("x")[i].values.to_numpy(zero_copy_only=False).reshape(-1, len(total))
                widest = max(abs(n * int(m) - t) for side in (x.min(axis=0), x.max(axis=0)) for m, t in zip(side, total))
                if widest * widest * len(total) < 2 ** 63 and n * int(np.abs(x).max()) < 2 ** 63:
                    t = n * x - total.astype(np.int64)
                    dev = (t * t).sum(axis=1).tolist()
                else:                                   # beyond 64 bits: Python's integers
                    dev = [sum(v * v for v in n * row.astype(object) - total) for row in x]
                out = pa.ListArray.from_arrays([0, len(dev)], pa.array(dev, pa.decimal128(38, 0)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("block").slice(i, 1), batch.column("keys").slice(i, 1), out],
                    names=["block", "keys", "deviations"])

    schema = T.StructType([T.StructField("key", key_type), T.StructField("deviation", DECIMAL),
                           T.StructField("y", T.ArrayType(T.DoubleType()))])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                m = batch.column("m")[i]
                flat = m["values"].values.to_numpy(zero_copy_only=False)
                y = flat.reshape(size, k) if m["isTransposed"].as_py() else flat.reshape(k, size).T
                keys, dev = batch.column("keys")[i].values, batch.column("deviations")[i].values
                y = np.ascontiguousarray(y[:len(keys)]).ravel()
                yield pa.RecordBatch.from_arrays(
                    [keys, dev, pa.ListArray.from_arrays(np.arange(0, len(y) + 1, k, dtype=np.int32), pa.array(y))],
                    names=["key", "deviation", "y"])

    products = callMLlibFunc("getMatrixBlocks", projected._java_matrix_wrapper._java_model)
    products = products.select(F.col("_1._1").alias("block"), F.col("_2").alias("m"))
    named = blocks.select("block", "keys", "x").mapInArrow(deviations, dev_schema)
    return products.join(named, "block").select("m", "keys", "deviations").mapInArrow(unpack, schema)


def _identity_error(rows: DataFrame, n: int) -> float:
    """Largest absolute entry of the covariance of ``y`` minus the identity."""
    means = {r["at"]: r["m"] for r in rows.select(F.posexplode("y").alias("at", "v")).groupBy("at")
             .agg((F.sum("v") / n).alias("m")).collect()}
    k = len(means)
    c = [F.col("y")[i] - means[i] for i in range(k)]
    cells = rows.agg(*[F.sum(c[i] * c[j]).alias(f"c{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    return max(abs(cells[f"c{i}_{j}"] / n - (i == j)) for i in range(k) for j in range(i, k))
