"""Run metrics: batch accounting in one aggregate; stream metrics as named
observations reported with each micro-batch's progress (no extra job).

Batch ``Observation`` objects are not used: in this Spark version a plan
executed after one was used could fail to serialize the session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from murmur.functions import text as TX
from murmur.vocab import REFERENCE, Vocab


def observed_stream(df: DataFrame, name: str, **metrics: Column) -> DataFrame:
    """Streaming form: metrics appear in ``query.lastProgress['observedMetrics'][name]``."""
    exprs = [e.alias(k) for k, e in metrics.items()] or [F.count(F.lit(1)).alias("rows")]
    return df.observe(name, *exprs)


def ingest_metrics(parsed: DataFrame, vocab: Vocab = REFERENCE) -> DataFrame:
    """One-pass accounting of an ingest batch: messages, rejected (no id or
    time), blocked / too short after mention removal, and kept."""
    t = TX.remove_mentions(F.col("text"))
    no_key = F.col("id").isNull() | F.col("created_at").isNull()
    blocked = F.coalesce(~TX.free_of(t, vocab.blocklist), F.lit(False))
    short = F.coalesce(F.length(t) <= 5, F.lit(True))
    kept = ~no_key & ~blocked & ~short

    def n(c):
        return F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return parsed.agg(F.count(F.lit(1)).alias("messages"), n(no_key).alias("rejected"),
                      n(~no_key & blocked).alias("blocked"), n(~no_key & ~blocked & short).alias("too_short"),
                      n(kept).alias("kept"))
