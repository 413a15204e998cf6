"""Distributed sentiment / topic scoring with a pluggable scorer.

The original collects all new posts to the driver and sends one HTTP body to
a model service.  Here texts are deduplicated (each distinct text is scored
once, as the original's text-keyed result map implies), scored on the
executors, and joined back on a 256-bit hash, so texts are shuffled once at
most.  A scorer is any ``DataFrame[_text, ...] -> DataFrame[_text, ..., <outputs>]``; one that
only adds columns per row (``in_place``) is applied to the posts themselves,
with no shuffle at all.  Three kinds are provided: native lexicon
rules (column expressions), a fitted Spark ML model, and an Arrow-batched
pandas function (``mapInPandas``) for an external model with a
list-of-texts -> list-of-results contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from murmur.functions import text as TX
from murmur.operators.clean import nonempty
from murmur.vocab import REFERENCE, Vocab

Scorer = Callable[[DataFrame], DataFrame]


def _hits(c: Column, terms) -> Column:
    e = F.lit(0)
    for t in terms:
        e = e + F.regexp_count(c, F.lit(TX.escape_term(t)))
    return e


def lexicon_sentiment(vocab: Vocab = REFERENCE) -> Scorer:
    """score = (pos + 1) / (pos + neg + 2); label by side of 0.5; confidence = |2 score - 1|."""
    def scorer(texts: DataFrame) -> DataFrame:
        t = F.col("_text")
        pos, neg = _hits(t, vocab.positive_terms), _hits(t, vocab.negative_terms)
        score = (pos + 1).cast("double") / (pos + neg + 2)
        label = (F.when(score > 0.5, vocab.positive).when(score < 0.5, vocab.negative).otherwise(vocab.neutral))
        lid = F.when(score > 0.5, 2).when(score < 0.5, 0).otherwise(1)
        return texts.withColumns({"label": label, "label_id": lid, "score": score, "confidence": F.abs(score * 2 - 1)})
    scorer.in_place = True
    return scorer


def lexicon_topic(vocab: Vocab = REFERENCE) -> Scorer:
    """Topic with most term hits (ties: listed order); no hit -> NULL topic."""
    def scorer(texts: DataFrame) -> DataFrame:
        t = F.col("_text")
        hits = [(_hits(t, terms), i, name) for i, (name, terms) in enumerate(vocab.topic_terms)]
        cands = F.array(*[F.struct(h.alias("h"), F.lit(-i).alias("neg_i"), F.lit(i).alias("i"), F.lit(n).alias("name"))
                          for h, i, n in hits])
        best = F.array_max(cands)
        total = sum((h for h, _, _ in hits), F.lit(0))
        has = best["h"] > 0
        return texts.withColumns({
            "topic_label": F.when(has, best["name"]),
            "topic_id": F.when(has, best["i"]),
            "confidence": F.when(has, best["h"].cast("double") / total).otherwise(F.lit(0.0))})
    scorer.in_place = True
    return scorer


def model_scorer(model, labels: tuple[str, ...], feature_fn: Callable[[DataFrame], DataFrame] | None = None) -> Scorer:
    """A fitted Spark ML pipeline: prediction -> label, max probability -> confidence,
    probability of the last class -> score."""
    from pyspark.ml.functions import vector_to_array

    def scorer(texts: DataFrame) -> DataFrame:
        x = texts.withColumn("text", F.col("_text"))
        if feature_fn is not None:
            x = feature_fn(x)
        out = model.transform(x).withColumn("_p", vector_to_array("probability"))
        pred = F.col("prediction").cast("int")
        lab = F.element_at(F.array(*[F.lit(v) for v in labels]), pred + 1)
        return out.select("_text", lab.alias("label"), pred.alias("label_id"),
                          F.element_at("_p", -1).alias("score"), F.array_max("_p").alias("confidence"))
    return scorer


def pandas_scorer(fn: Callable, schema: T.StructType) -> Scorer:
    """Wrap a batch function ``list[str] -> pandas.DataFrame`` (same order)
    as an Arrow-batched ``mapInPandas`` scorer; one model load per worker
    process is up to ``fn`` (e.g. a module-level cache)."""
    out_schema = T.StructType([T.StructField("_text", T.StringType())] + list(schema.fields))

    def run(batches):
        import pandas as pd
        for pdf in batches:
            res = fn(pdf["_text"].tolist())
            yield pd.concat([pdf[["_text"]].reset_index(drop=True), res.reset_index(drop=True)], axis=1)

    def scorer(texts: DataFrame) -> DataFrame:
        return texts.mapInPandas(run, out_schema)
    return scorer


def score_text(df: DataFrame, scorer: Scorer, text_col: str = "text", dedup: bool = True) -> DataFrame:
    """Score each post's text; results replace same-named columns of the input.

    In-place scorers run on the posts.  For the others equal texts share one
    scoring: one text per hash goes to the scorer (a partial aggregate, so a
    widely copied text costs a row per task) and the results, without texts,
    are joined back on the hash.
    """
    src = df.where(nonempty(F.col(text_col)))
    if getattr(scorer, "in_place", False):
        return scorer(src.withColumn("_text", F.col(text_col))).drop("_text")
    src = src.withColumn("_hash", F.sha2(F.col(text_col), 256))
    texts = src.select("_hash", F.col(text_col).alias("_text"))
    if dedup:
        texts = texts.groupBy("_hash").agg(F.first("_text").alias("_text"))
    scored = scorer(texts.select("_text"))
    results = [c for c in scored.columns if c != "_text"]
    scored = scored.select(F.sha2("_text", 256).alias("_hash"), *results)
    return src.drop(*[c for c in results if c in src.columns and c != text_col]).join(scored, "_hash").drop("_hash")


def unscored_rows(day_posts: DataFrame, done: DataFrame) -> DataFrame:
    """Posts of a day that have no result yet (anti join on id), with text.

    ``done`` should be bounded to the same days (it is a partitioned table):
    the original scans every id ever scored.
    """
    return (day_posts.join(done.select("id"), "id", "left_anti")
            .where(nonempty(F.col("text"))))


def score_new_posts(day_posts: DataFrame, done: DataFrame, scorer: Scorer, run_ts: str | None = None,
                    stamp_col: str | None = None) -> DataFrame:
    """Incremental scoring job body: new rows only, distinct texts scored once."""
    out = score_text(unscored_rows(day_posts, done), scorer)
    if stamp_col and run_ts is not None:
        out = out.withColumn(stamp_col, F.to_timestamp(F.lit(run_ts)))
    return out
