"""Readers for the given Parquet tables and for day-partitioned post tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from murmur.operators.dedup import latest_per_key

GIVEN_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                "events", "documents", "embeddings", "pages", "benchmark", "labels",
                "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table; column pruning and filters reach the Parquet scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan that yields fewer splits than the cluster has cores.

    A small file is one split, and when every later join is a broadcast the
    whole (possibly text-heavy) pipeline would run in one task.  Large inputs
    already have many splits and are returned unchanged (no shuffle).
    """
    n = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if _scan_splits(df) < n else df


def _scan_splits(df: DataFrame) -> int:
    """Lower bound of the splits of the files under ``df`` (from their number, or the sizes of a few; runs nothing)."""
    files = df.inputFiles()
    if len(files) >= 64:
        return len(files)
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    path_of = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path
    most = df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    sizes = [path_of(f).getFileSystem(conf).getFileStatus(path_of(f)).getLen() for f in files]
    return sum(-(-size // most) for size in sizes)


def read_table_dedup(df: DataFrame, keys=("dt", "id"), order_col: str | None = None) -> DataFrame:
    """A post table read as-is, one row per (dt, id): the copy that arrived last wins.

    Arrival is ``batch_id`` where the table has it (all copies of a post share
    ``created_at``, its time of birth), else ``created_at``.
    """
    return latest_per_key(df, list(keys), order_col or ("batch_id" if "batch_id" in df.columns else "created_at"))


def read_day(df: DataFrame, day: str, keys=("dt", "id"), order_col: str | None = None) -> DataFrame:
    """One ``dt`` partition (pruned at the scan when ``dt`` is a partition column), deduplicated."""
    return read_table_dedup(df.where(F.col("dt") == F.lit(day)), keys, order_col)


def read_text_sample(df: DataFrame, n: int = 10000, order_col: str = "id") -> DataFrame:
    """``bid, text`` of posts with text, the first ``n`` by ``order_col``.

    ``orderBy + limit`` plans as TakeOrderedAndProject: a top-n per partition
    and one merge of n rows per partition, never a full sort.
    """
    return (df.where(F.col("text").isNotNull() & (F.col("text") != ""))
            .orderBy(F.col(order_col).asc())
            .limit(n)
            .select("bid", "text"))
