"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from murmur.session import scratch_path

#: Rows of (integer key, small payload) that a broadcast side may have; at a few
#: dozen bytes a row this is some 100 MB in an executor.
BROADCAST_ROWS = 2_000_000


#: Bytes of a batch that goes to a Python worker; by rows alone (10,000) a batch of very long texts has no bound.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20)


def bound_batches(spark: SparkSession) -> None:
    """Set ``BATCH_BYTES`` for the session, unless its configuration names a bound itself."""
    if spark.sparkContext.getConf().get(BATCH_BYTES[0]) is None:
        spark.conf.set(*BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared scratch folder and read it back:
    it is computed once, and a lost executor loses nothing of it."""
    spark = df.sparkSession
    bound_batches(spark)
    path = scratch_path(spark, name) + "/data"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sized_join(left: DataFrame, right: DataFrame, on, how: str, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join that broadcasts ``right`` only if it is counted to have at most
    ``max_rows`` rows, and is left to Spark's shuffle joins beyond that."""
    if right.count() <= max_rows:
        right = F.broadcast(right)
    return left.join(right, on, how)


def remainder(key: Column, m: int) -> Column:
    """``crc32(key as text) mod m``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(m)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once for use at several places of ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def worker_state(name: str, build: Callable[[], object]):
    """State that lives as long as a (reused) Python worker process works for one operator.

    Functions are shipped by value, so their module globals start afresh with
    each task; what is costly to build is kept here instead.  The first word of ``name``
    is the operator.
    """
    states = sys.__dict__.setdefault("_murmur_worker_state", {})
    if name not in states:
        if TaskContext.get():
            only_state_of(name.split()[0])
        states[name] = build()
    return states[name]


def only_state_of(operator: str) -> None:
    """Drop the state that tasks of other operators left in this worker, so that the stages of a pipeline do not add up
    in the workers they share, and return freed memory to the system where the C library can."""
    states = sys.__dict__.setdefault("_murmur_worker_state", {})
    others = [name for name in states if name.split()[0] != operator]
    if not others:
        return
    for name in others:
        del states[name]
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def slices(texts: list, limit: int) -> Iterator[tuple[int, int]]:
    """Cut a list of texts into runs of at most ``limit`` characters (one text
    at least), which bounds the size of arrays made from a run."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)
