"""Parquet-lake sinks: day-partitioned posts, upsert, blue/green publish, export.

All writes are whole Spark jobs (no driver-side rows).  Exactly-once without a
transactional table format: every micro-batch lands in its own
``(dt, batch_id)`` partitions written with dynamic partition overwrite, so a
replayed batch replaces exactly what it wrote before; readers (or the daily
compaction) deduplicate on ``(dt, id)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from murmur.operators.dedup import latest_per_key
from murmur.sources.tables import read_text_sample
from murmur.session import cut


def write_posts_batch(df: DataFrame, path: str, batch_id: int, partition_cols=("dt",)) -> None:
    """Append one micro-batch idempotently: its own (dt, batch_id) partitions."""
    (df.withColumn("batch_id", F.lit(int(batch_id)))
       .write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_cols, "batch_id")
       .parquet(path))


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Landing table with one copy per (dt, id): the one that arrived last."""
    return latest_per_key(spark.read.parquet(path), ["dt", "id"], "batch_id").drop("batch_id")


def compact_day(spark: SparkSession, landing: str, target: str, day: str) -> None:
    """Fold one day of micro-batch partitions into the ``dt``-partitioned table
    (dynamic overwrite of that day only; a rerun gives the same files)."""
    day_rows = spark.read.parquet(landing).where(F.col("dt") == F.lit(day))         # before the dedup: one day is read
    d = latest_per_key(day_rows, ["dt", "id"], "batch_id").drop("batch_id")
    d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(target)


def ensure_table(spark: SparkSession, name: str, schema, partition_col: str = "dt",
                 compression: str | None = None, location: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS ... USING parquet PARTITIONED BY (dt)``."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    opts = f" OPTIONS (compression '{compression}')" if compression else ""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{opts} "
              f"PARTITIONED BY ({partition_col}){loc}")


def append_partitioned(df: DataFrame, table: str) -> None:
    """Insert by column name (the table's order), never by position."""
    cols = df.sparkSession.table(table).columns
    df.select(*cols).write.insertInto(table)


def repair_partitions(spark: SparkSession, table: str) -> None:
    """Register partition folders written outside the catalog (``insertInto``
    registers its own partitions; only external writers need this)."""
    spark.catalog.recoverPartitions(table)


def upsert_merge(old: DataFrame, new: DataFrame, keys: list[str], order_col: str | None = None) -> DataFrame:
    """Rows of ``new`` replace rows of ``old`` with equal keys; others stay.

    ``old LEFT ANTI new UNION ALL new`` -- one shuffle on the keys; ``new`` is
    first reduced to one row per key, the largest ``order_col`` (ties: see
    :func:`latest_per_key`).
    """
    n = latest_per_key(new, keys, order_col) if keys else new
    return old.join(n.select(*keys), keys, "left_anti").unionByName(n)


def upsert_partitioned(spark: SparkSession, new: DataFrame, path: str, keys: list[str],
                       partition_col: str = "dt") -> None:
    """Lake upsert: only the partitions touched by ``new`` are rewritten.

    The merged rows of those partitions are checkpointed first (reading and
    overwriting the same files in one job is not allowed), then written
    with dynamic partition overwrite.
    """
    touched = new.select(partition_col).distinct()
    old = spark.read.parquet(path).join(touched, partition_col, "left_semi")
    merged = cut(upsert_merge(old, new, keys))
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col).parquet(path))


def publish_blue_green(spark: SparkSession, df: DataFrame, view: str, base_path: str,
                       copies: tuple[str, str] = ("v1", "v2")) -> str:
    """Write the inactive copy, then point the view at it.

    The view text itself records the active copy, so switching is one
    ``CREATE OR REPLACE VIEW`` (atomic in the catalog); no separate config row.
    Returns the copy now active.
    """
    active = active_copy(spark, view, base_path, copies)
    target = copies[1] if active == copies[0] else copies[0]
    path = f"{base_path.rstrip('/')}/{target}"
    df.write.mode("overwrite").parquet(path)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{path}`")
    return target


def active_copy(spark: SparkSession, view: str, base_path: str, copies=("v1", "v2")) -> str | None:
    if not spark.catalog.tableExists(view):
        return None
    text = " ".join(r[0] for r in spark.sql(f"SHOW CREATE TABLE {view}").collect())
    for c in copies:
        if f"{base_path.rstrip('/')}/{c}`" in text:
            return c
    return None


def export_text_sample(df: DataFrame, path: str, n: int = 10000) -> None:
    """``bid, text`` of up to ``n`` posts as one CSV file with a header.

    ``coalesce(1)`` is safe only because ``limit`` bounds the rows.
    """
    read_text_sample(df, n).coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


# --- job checkpoint (last processed day per task) ------------------------------------

def read_last_dt(spark: SparkSession, path: str, task: str, default: str = "1970-01-01") -> DataFrame:
    """One-row frame ``last_dt`` for ``task`` (the default when absent)."""
    from murmur.schemas import JOB_CHECKPOINT
    ck = read_versioned(spark, path, JOB_CHECKPOINT)
    return (ck.where(F.col("task_name") == task)
            .agg(F.coalesce(F.max("last_dt"), F.lit(default)).alias("last_dt")))


def incremental_since(df: DataFrame, last_dt: str) -> DataFrame:
    """Rows of days after the last processed one (pruned at the scan)."""
    return df.where(F.col("dt") > F.lit(last_dt))


def update_last_dt(spark: SparkSession, path: str, task: str, new_dt: str) -> None:
    """Upsert ``(task, new_dt)`` after the task's output is written."""
    from murmur.schemas import JOB_CHECKPOINT
    new = spark.createDataFrame([(task, new_dt)], JOB_CHECKPOINT)
    write_versioned(spark, upsert_merge(read_versioned(spark, path, JOB_CHECKPOINT), new, ["task_name"]), path)


# --- small state tables ------------------------------------------------------------

def _versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of a state table, in order."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/v*/_SUCCESS")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return sorted(int(f.getPath().getParent().getName()[1:]) for f in found)


def read_versioned(spark: SparkSession, path: str, schema) -> DataFrame:
    """The newest complete version of a state table; empty if there is none.  Read errors raise."""
    versions = _versions(spark, path)
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/v{versions[-1]:08d}")


def write_versioned(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Write ``df`` as the next version; readers switch when it is complete, so a
    failed write leaves the version before."""
    versions = _versions(spark, path)
    df.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/v{(versions[-1] if versions else 0) + 1:08d}")
