"""Language identification: multinomial naive Bayes over hashed character n-grams.

Every training text adds its 1- to 4-grams of lower-cased code points (a word
boundary is one space) to one of ``2**bits`` buckets; counts are pre-summed in
each task and added up by Spark over all training rows.  The matrix of log
probabilities, languages x buckets, is bounded by ``max_langs * 2**bits`` and
broadcast; batches of texts are scored by gathering its rows in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from murmur.llm.common import slices

BITS = 16
ORDERS = 4
UNDETERMINED = "und"
#: Characters handled at once in a task (a longer text is handled alone).
RUN_CHARS = 1_000_000


def gram_buckets(texts: list[str], bits: int = BITS, orders: int = ORDERS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of ``texts``, order after order, and the index of
    the text each belongs to (n-grams never cross texts)."""
    clean = [f" {' '.join(t.lower().split())} " for t in texts]
    codes = np.frombuffer("".join(clean).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(clean), dtype=np.int32), [len(t) for t in clean])
    found, owners = [], []
    h = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, orders + 1):
        m = len(codes) - n + 1
        if m <= 0:
            break
        h = h[:m] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1:] + np.uint64(n)
        x = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        inside = owner[:m] == owner[n - 1:]
        found.append((x >> np.uint64(64 - bits))[inside].astype(np.int32))
        owners.append(owner[:m][inside])
    return np.concatenate(found), np.concatenate(owners)


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def gram_counts(train: DataFrame, bits: int = BITS, orders: int = ORDERS) -> DataFrame:
    """``lang``, ``bucket`` (-1: number of texts), ``n`` summed over ``train(text, lang)``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pandas()
            texts = batch.column("text").to_pandas()
            for lang, rows in texts.groupby(langs):
                acc = sums.setdefault(lang, np.zeros((1 << bits) + 1, dtype=np.int64))
                rows = rows.tolist()
                acc[-1] += len(rows)
                for a, b in slices(rows, RUN_CHARS):
                    acc[:-1] += np.bincount(gram_buckets(rows[a:b], bits, orders)[0], minlength=1 << bits)
        for lang, acc in sums.items():
            at = np.flatnonzero(acc)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(at), pa.string()),
                "bucket": pa.array(np.where(at == 1 << bits, -1, at).astype(np.int32)), "n": pa.array(acc[at])})

    return (train.select("text", "lang").mapInArrow(count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))


def fit(train: DataFrame, bits: int = BITS, orders: int = ORDERS, max_langs: int = 500) -> dict:
    """Model of ``train(text, lang)``: ``langs`` (sorted) and ``logp`` (buckets + 1, langs), the
    last row being the log prior.  Rows with a null text or lang teach nothing.

    At most ``max_langs * 2**bits`` counts reach the driver; more languages raise.
    """
    rows = gram_counts(train.where("text IS NOT NULL AND lang IS NOT NULL"), bits, orders)
    n_langs = rows.where("bucket = -1").count()
    if n_langs > max_langs:
        raise ValueError(f"{n_langs} languages; the bound max_langs is {max_langs}")
    got = rows.toPandas() if n_langs else pd.DataFrame({"lang": [], "bucket": [], "n": []})
    langs = sorted(got["lang"].unique())
    counts = np.zeros(((1 << bits) + 1, len(langs)))
    counts[got["bucket"].to_numpy(dtype=np.int64), got["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(dtype=np.int64)] = got["n"]
    grams = counts[:-1] + 0.5
    logp = np.log(grams / grams.sum(axis=0)) if langs else grams
    prior = np.log((counts[-1:] + 1) / (counts[-1:] + 1).sum()) if langs else counts[-1:]
    return {"langs": langs, "logp": np.vstack([logp, prior]).astype(np.float32), "bits": bits, "orders": orders}


def predict_texts(model: dict, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Best language and its posterior probability for each text."""
    langs, logp = model["langs"], model["logp"]
    best, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    live = [i for i, t in enumerate(texts) if langs and _has_letter(t)]
    for a, b in slices([texts[i] for i in live], RUN_CHARS):
        rows = live[a:b]
        at, owner = gram_buckets([texts[i] for i in rows], model["bits"], model["orders"])
        total = np.stack([np.bincount(owner, weights=logp[at, k], minlength=len(rows)) for k in range(len(langs))], axis=1)
        total += logp[-1]
        top = total.argmax(axis=1)          # a tie goes to the first name
        p = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        for i, k, s in zip(rows, top, p):
            best[i], score[i] = langs[k], s
    return best, score


def identify(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``lang_pred`` and ``score`` (0 to 1) for every row of ``docs``.

    A null text, one without a letter, or a model that learnt nothing gives
    ``und`` with score 0.  Equal rows are predicted alike, each on its own; null keys
    are returned; an empty table gives no rows; other columns are ignored, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, p = predict_texts(shared.value, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(best, pa.string()), pa.array(p, pa.float64())],
                                             names=["key", "lang_pred", "score"])

    kind = docs.schema[key].dataType.simpleString()
    return (docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
            .mapInArrow(score, f"key {kind}, lang_pred string, score double"))
