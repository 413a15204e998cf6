"""Keyed deduplication that is deterministic and skew tolerant."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from murmur.session import cut

#: Repeated keys that are broadcast; beyond that all rows are shuffled by their keys.
BROADCAST_KEYS = 1_000_000


def latest_per_key(df: DataFrame, keys: list[str], order_col: str | None = None) -> DataFrame:
    """Keep one row per ``keys``: the one with the largest ``order_col``.

    Ties (and a NULL ``order_col``) go to the largest hash of the remaining
    columns, so the survivor does not depend on partitioning.  ``row_number() = 1``
    plans as a group limit on both sides of the shuffle: each task sends one
    row per key, so a key holding a third of all rows costs a row per map task,
    and rows are ordered by narrow columns, never by their texts.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(keys)
    plain = [c for c in others if df.schema[c].dataType.typeName() not in ("map", "vector", "variant")]
    order = ([F.col(order_col).desc_nulls_last()] if order_col else []) + [F.xxhash64(*[F.col(c) for c in plain]).desc()]
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def latest_of_repeated(df: DataFrame, keys: list[str], order_col: str | None = None) -> DataFrame:
    """:func:`latest_per_key` for wide rows, where most keys have one row: keys are counted first, without the other columns,
    and only rows of repeated keys are shuffled and sorted.

    With more than ``BROADCAST_KEYS`` repeated keys all rows are.  Keys are not null; ``df`` gives the same rows each time.
    """
    repeated = cut(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys))
    n = repeated.count()
    if not n:
        return df
    if n > BROADCAST_KEYS:
        return latest_per_key(df, keys, order_col)
    again = F.broadcast(repeated)
    return df.join(again, keys, "left_anti").select(*df.columns).unionByName(
        latest_per_key(df.join(again, keys, "left_semi").select(*df.columns), keys, order_col))
