"""Ingest cleaning and time derivation (stateless: same code on batch and stream)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from murmur.functions import text as TX
from murmur.functions.json import post_struct, to_int
from murmur.functions.time import day_key, parse_created_at, period_of_hour
from murmur.schemas import DROPPED_FIELDS, INT_FIELDS, POST_RAW_FIELDS
from murmur.vocab import REFERENCE, Vocab

REGION_SEP = " \\| "        # blank, escaped bar, blank (a bar alone does not split)
COUNTERS = ("reposts_count", "comments_count", "attitudes_count")


def parse_posts(raw: DataFrame, col: str = "json_data", keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON message column -> 21 typed post fields (bad JSON gives NULLs), and the columns ``keep`` of ``raw``.

    The fields come out of a generator: a message is parsed once, however many filters on its fields follow.
    """
    fields = raw.select(*[F.col(k).alias(f"_keep_{k}") for k in keep], F.inline(F.array(post_struct(F.col(col)))))
    return fields.select(*[(to_int(F.col(f)) if f in INT_FIELDS else F.col(f)).alias(f) for f in POST_RAW_FIELDS],
                         *[F.col(f"_keep_{k}").alias(k) for k in keep])


def drop_unused(df: DataFrame) -> DataFrame:
    return df.drop(*DROPPED_FIELDS)


def counters_to_int(df: DataFrame) -> DataFrame:
    """Counters as int; an unparsable counter becomes NULL (never raises)."""
    return df.withColumns({c: F.col(c).try_cast("int") for c in COUNTERS if c in df.columns})


def clean_text(df: DataFrame, vocab: Vocab = REFERENCE) -> DataFrame:
    """Remove @mentions, drop blocklisted or NULL texts, keep length > 5 after removal.

    The blocklist terms fold into one conjunctive predicate; as part of a generator, the replace runs once a text and not
    once a condition.
    """
    good = F.filter(F.array(TX.remove_mentions(F.col("text"))),
                    lambda t: TX.free_of(t, vocab.blocklist) & t.isNotNull() & (F.length(t) > 5))
    return df.select(*[c for c in df.columns if c != "text"], F.explode(good).alias("text")).select(*df.columns)


def fill_auth(df: DataFrame, vocab: Vocab = REFERENCE) -> DataFrame:
    a = F.col("user_authentication")
    return df.withColumn("user_authentication",
                         F.when(a.isNull() | (a == ""), F.lit(vocab.default_auth)).otherwise(a))


def clean_posts(df: DataFrame, vocab: Vocab = REFERENCE, dedup: bool = True) -> DataFrame:
    """Batch form of the ingest chain: drop, counters, dedup by id, text, identity.

    On a stream the dedup is the watermarked one of :mod:`murmur.streaming`;
    here it is a deterministic choice by key (newest ``created_at`` wins) that shuffles only posts with copies.
    Rows with a NULL id are dropped (they would otherwise collapse into one).
    """
    from murmur.operators.dedup import latest_of_repeated
    out = counters_to_int(drop_unused(df)).where(F.col("id").isNotNull())
    if dedup:
        out = latest_of_repeated(out, ["id"], "created_at" if "created_at" in out.columns else None)
    return fill_auth(clean_text(out, vocab), vocab)


def derive_time(df: DataFrame, vocab: Vocab = REFERENCE, ts_col: str = "created_at") -> DataFrame:
    """created_at -> timestamp, hour, six-bucket time_period, dt; counters to int."""
    c = F.col(ts_col)
    dtype = df.schema[ts_col].dataType.typeName()
    ts = parse_created_at(c) if dtype == "string" else c.cast("timestamp")
    out = df.withColumn(ts_col, ts)
    out = out.withColumns({
        "hour": F.hour(ts_col),
        "dt": day_key(F.col(ts_col)),
    })
    out = out.withColumn("time_period", period_of_hour(F.col("hour"), vocab))
    return counters_to_int(out)


def nonempty(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def explode_region(df: DataFrame, keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Non-empty ``location`` -> one row per region (split on blank-bar-blank)."""
    regions = F.explode(F.split(F.col("location"), REGION_SEP)).alias("region")
    return (df.where(nonempty(F.col("location")))
              .select(*[F.col(k) for k in keep], regions)
              .where(nonempty(F.col("region"))))


def nonempty_text(df: DataFrame) -> DataFrame:
    return df.where(nonempty(F.col("text")))
