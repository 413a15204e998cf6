"""Relational serving tables over JDBC: overwrite, append, upsert.

Writes go straight from the executors (``numPartitions`` bounds the number of
connections).  Upsert writes a staging table, then runs one dialect MERGE
statement on the driver's JDBC connection -- the only non-Spark step, and it
moves no rows through the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _writer(df: DataFrame, url: str, table: str, props: dict | None, num_partitions: int | None):
    w = df.write.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (props or {}).items():
        w = w.option(k, v)
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    return w


def publish_overwrite(df: DataFrame, url: str, table: str, props: dict | None = None,
                      num_partitions: int | None = 8) -> None:
    """Replace the contents, keeping the table definition (TRUNCATE, not DROP)."""
    _writer(df, url, table, props, num_partitions).option("truncate", "true").mode("overwrite").save()


def publish_append(df: DataFrame, url: str, table: str, props: dict | None = None,
                   num_partitions: int | None = 8) -> None:
    _writer(df, url, table, props, num_partitions).mode("append").save()


def merge_sql(table: str, staging: str, columns: list[str], keys: list[str], dialect: str = "ansi") -> str:
    """The upsert statement: ANSI ``MERGE`` or MySQL ``ON DUPLICATE KEY UPDATE``."""
    non_keys = [c for c in columns if c not in keys]
    if dialect == "mysql":
        upd = ", ".join(f"{c} = t.{c}" for c in non_keys)
        return (f"INSERT INTO {table} ({', '.join(columns)}) SELECT {', '.join('t.' + c for c in columns)} "
                f"FROM {staging} t ON DUPLICATE KEY UPDATE {upd}")
    on = " AND ".join(f"d.{k} = s.{k}" for k in keys)
    upd = ", ".join(f"{c} = s.{c}" for c in non_keys)
    ins = ", ".join(f"s.{c}" for c in columns)
    return (f"MERGE INTO {table} d USING {staging} s ON {on} "
            f"WHEN MATCHED THEN UPDATE SET {upd} "
            f"WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) VALUES ({ins})")


def upsert_jdbc(spark: SparkSession, df: DataFrame, url: str, table: str, keys: list[str],
                props: dict | None = None, dialect: str = "ansi") -> None:
    """Staging write from the executors, then one MERGE; the staging table is dropped."""
    staging = f"{table}_stg_{uuid.uuid4().hex[:8]}"
    _writer(df, url, staging, props, 8).mode("overwrite").save()
    jvm = spark.sparkContext._jvm
    p = jvm.java.util.Properties()
    for k, v in (props or {}).items():
        if k in ("user", "password"):
            p.setProperty(k, v)
    conn = jvm.java.sql.DriverManager.getConnection(url, p)
    try:
        st = conn.createStatement()
        st.execute(merge_sql(table, staging, df.columns, keys, dialect))
    finally:
        try:
            conn.createStatement().execute(f"DROP TABLE {staging}")
        finally:
            conn.close()
