"""Benchmark decontamination by a broadcast set of test n-grams (native expressions only).

Texts are lower-cased (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.
A benchmark item gives one window per run of ``n`` words; an item of fewer
words is one window.  Documents are scanned once: every document window is
hashed, looked up in the broadcast set of benchmark hashes, and a match is
verified word by word.  A document word inside a verified window is *hit*.

The set is broadcast only while it is counted to be small; a larger benchmark
is joined by hash through a shuffle, with the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from murmur.llm.common import sized_join, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
N = 13
#: Benchmark windows that may be broadcast (a few hundred bytes each).
MAX_WINDOWS = 500_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS), "")


def _slide(words: Column, n: int) -> Column:
    """Hash of each run of ``n`` words; empty where there are fewer."""
    return F.when(F.size(words) < n, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.xxhash64(F.slice(words, i, n))))


def benchmark_windows(benchmark: DataFrame, n: int = N, item: str = "item_id", text: str = "text") -> DataFrame:
    """One row per distinct window: its ``words`` (joined by one space), their
    number ``len``, hash ``h`` and ``items`` (ids of the items that have it)."""
    w = benchmark.select(F.col(item).alias("item"), words_of(F.col(text)).alias("words")).where(F.size("words") > 0)
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("words") - (n - 1), F.lit(1))),
                       lambda i: F.slice("words", i, n))
    return (w.select("item", F.explode_outer(F.array_distinct(runs)).alias("run"))
            .groupBy("run").agg(F.collect_set("item").alias("items"))
            .select(F.xxhash64("run").alias("h"), F.size("run").alias("len"),
                    F.array_join("run", " ").alias("window"), "items"))


def scan(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", n: int = N,
         item: str = "item_id", item_text: str = "text", max_windows: int = MAX_WINDOWS) -> DataFrame:
    """Per distinct (key, text): ``n_words``, ``hits`` (sorted (pos, len) of
    verified windows, 0-based), ``items`` (ids of items with one), ``copies``
    (equal rows) and ``text_hash``.

    A null text has no words; an empty benchmark hits nothing; equal rows are
    counted in ``copies``; a null item id hits words, but is in no list of items;
    an empty table gives no rows; other columns are ignored, whatever their names.
    """
    grams = benchmark_windows(benchmark, n, item, item_text)
    lengths = sorted(r[0] for r in grams.select("len").distinct().collect())     # at most n values
    tokens = (docs.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("text_hash"),
                          F.col(text).isNull().alias("no_text"), words_of(F.col(text)).alias("words"))
              .withColumn("n_words", F.size("words")))
    # One array of hashes a document: a null that stands for the document itself, then the
    # windows of each length; place and length follow from the index in it.  It is never empty:
    # "outer" only keeps Spark from adding a size filter that would compute the array twice.
    hashes = F.concat(F.array(F.lit(None).cast("long")), *[_slide(F.col("words"), m) for m in lengths])
    rows = (tokens.withColumn("hashes", hashes)
            .select("key", "text_hash", "no_text", "n_words", "words", F.posexplode_outer("hashes").alias("idx", "h")))
    pos, size, before = F.lit(-1), F.lit(0), F.lit(1)
    for m in lengths:
        pos = F.when(F.col("idx") >= before, F.col("idx") - before).otherwise(pos)
        size = F.when(F.col("idx") >= before, F.lit(m)).otherwise(size)
        before = before + F.greatest(F.col("n_words") - (m - 1), F.lit(0))
    grams = grams.withColumnRenamed("len", "g_len")
    hit = ((F.col("len") == F.col("g_len"))
           & (F.array_join(F.slice("words", F.col("pos") + 1, F.col("g_len")), " ") == F.col("window")))
    found = (sized_join(rows, grams, "h", "left", max_windows)
             .where((F.col("idx") == 0) | F.col("window").isNotNull())
             .withColumns({"pos": pos, "len": size})
             .select("key", "text_hash", "no_text", "n_words", "pos", "len", F.when(F.col("pos") < 0, True).otherwise(hit).alias("ok"), "items")
             .where("ok"))
    return (found.groupBy("key", "text_hash", "no_text")
            .agg(F.max("n_words").cast("long").alias("n_words"),
                 F.count(F.when(F.col("pos") < 0, 1)).alias("copies"),
                 F.array_sort(F.collect_set(F.when(F.col("pos") >= 0, F.struct("pos", "len")))).alias("hits"),
                 F.array_distinct(F.flatten(F.collect_set("items"))).alias("items")))


def covered(hits: Column) -> Column:
    """Words covered by sorted (pos, len) runs."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def add(acc: Column, x: Column) -> Column:
        end = (x["pos"] + x["len"]).cast("long")
        return F.struct((acc["n"] + F.greatest(F.lit(0).cast("long"), end - F.greatest(acc["end"], x["pos"].cast("long")))).alias("n"),
                        F.greatest(acc["end"], end).alias("end"))

    return F.aggregate(hits, zero, add, lambda acc: acc["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """One row per input row: key, n_words, n_hit, ``items`` (sorted as text) and contaminated
    (some hit, and hit words are at least a twentieth of the words)."""
    return (scan(docs, benchmark, key, text, **kw)
            .withColumn("n_hit", covered(F.col("hits")))
            .withColumn("items", F.array_sort(F.transform("items", lambda x: x.cast("string"))))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .drop("copy", "copies"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                  remove: str = "documents", **kw) -> DataFrame:
    """Rows of ``docs`` (all their columns) without contamination.

    ``remove="documents"`` drops contaminated rows; ``"spans"`` keeps every row
    and cuts the hit words of contaminated rows out of ``text`` (their
    remaining lower-cased words, joined by one space).
    """
    flags = (contamination(docs, benchmark, key, text, **kw).where("contaminated")
             .select(F.col("key").alias("_k"), F.col("text_hash").alias("_h"), F.col("no_text").alias("_n"), F.col("hits").alias("_hits"))
             .dropDuplicates(["_k", "_h", "_n"]))
    flags = stored(flags, "contaminated")
    packed = docs.select(F.struct("*").alias("row"), F.col(key).alias("k"), F.col(text).alias("t"))
    same = F.col("k").eqNullSafe(F.col("_k")) & (F.xxhash64("t") == F.col("_h")) & (F.col("t").isNull() == F.col("_n"))
    if remove == "documents":
        return sized_join(packed, flags, same, "left_anti").select("row.*")
    words = words_of(F.col("t"))
    left = F.filter(words, lambda w, i: ~F.exists("_hits", lambda s: (i >= s["pos"]) & (i < s["pos"] + s["len"])))
    out = F.when(F.col("_k").isNull() & F.col("_h").isNull(), F.col("t")).otherwise(F.array_join(left, " "))
    cols = [out.alias(text) if c == text else F.col(f"row.{c}") for c in docs.columns]
    return sized_join(packed, flags, same, "left").select(*cols)
