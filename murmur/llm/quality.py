"""Quality rules as a short-circuit cascade (native expressions only).

Words are the runs of ``[^\\x20\\x09-\\x0D]``.  Each rule is a boolean column
that is true where the rule *rejects*.  A cascade is one ``CASE`` whose
branches Spark evaluates in order until one is true, so the order only decides
how much is computed, never the verdict.  The order comes from a sample: each
rule's seconds and share of rejected rows are measured there, and rules run by
rejection per second, highest first.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from murmur.llm.common import let

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def repeated_words(words: Column, n: Column, k: int = WINDOW) -> Column:
    """Words inside ``k``-word windows that occur twice or more.

    Windows are compared by a 64-bit hash within one text; only texts that have
    an equal pair sort their windows, so the cost is O(n log n) at worst.
    """
    starts = F.sequence(F.lit(0), n - k)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.arrays_zip(h.alias("h"), F.sequence(F.lit(0), F.size(h) - 1).alias("i")))
        return let(pairs, lambda s: let(
            F.sort_array(F.transform(
                F.filter(s, lambda x, j: F.get(s, j - 1)["h"].eqNullSafe(x["h"]) | F.get(s, j + 1)["h"].eqNullSafe(x["h"])),
                lambda x: x["i"])),
            lambda p: F.aggregate(
                F.transform(p, lambda x, j: F.least(F.lit(k), F.coalesce(F.get(p, j + 1) - x, F.lit(k)))),
                F.lit(0).cast("long"), lambda a, b: a + b)))

    return F.when(n < k + 1, F.lit(0).cast("long")).otherwise(let(
        hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h))))


def with_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the whole input row), ``text`` and the statistics of each text.

    Columns: n_words, word_chars (code points in words), n_symbols,
    n_lines (``\n``-split lines with a word), n_dup_lines (those equal to an
    earlier one), n_repeat_words.  A null or empty text has zero everywhere.
    Input columns of any name stay inside ``row``, so none can clash.
    """
    t = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    # Words and lines are bound inside one expression each: as columns of their own, a filter on
    # top could make Spark compute them anew for every window.
    words = let(words_of(F.col("text")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w, F.size(w)).alias("n_repeat_words")))
    lines = let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return (df.select(F.struct("*").alias("row"), F.col(text).alias("text"))
            .select("row", "text", words.alias("w"), lines.alias("l"),
                    F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
            .select("row", "text", "w.n_words", "w.word_chars", "n_symbols", "l.n_lines", "l.n_dup_lines", "w.n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def default_rules() -> dict[str, Column]:
    """Rejecting rules over the columns of :func:`with_stats`."""
    n, t = F.col("n_words"), F.coalesce(F.col("text"), F.lit(""))
    return {
        "symbols": 10 * F.col("n_symbols") > n,
        "repeated_lines": 100 * F.col("n_dup_lines") > 35 * F.col("n_lines"),
        "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n),
        "exclamations": 2 * F.regexp_count(t, F.lit("!")) > n,
        "capitals": 2 * F.regexp_count(t, F.lit(r"\p{Lu}{2,}")) > n,
    }


def rule_order(texts: DataFrame, rules: Mapping[str, Column], sample_rows: int = 2000) -> list[str]:
    """Names of ``rules`` by rejected share per second, measured on a sample.

    ``texts`` has a column ``text``.  The sample (about ``sample_rows`` rows, a
    seeded Bernoulli sample) decides the order of evaluation only.  On an empty
    input the given order stays.
    """
    total = texts.count()
    if not total:
        return list(rules)
    sample = with_stats(texts.sample(min(1.0, sample_rows / total), seed=17)).drop("row").cache()
    sample.count()

    def seconds(column: Column) -> tuple[float, float]:
        began = time.perf_counter()
        rejected = sample.agg(F.avg(column.cast("double"))).first()[0]
        return time.perf_counter() - began, rejected or 0.0

    seconds(F.lit(False))
    idle, _ = seconds(F.lit(False))
    gain = {}
    for name, rule in rules.items():
        cost, rejected = seconds(F.coalesce(rule, F.lit(False)))
        gain[name] = rejected / max(cost - idle, 1e-4)
    sample.unpersist()
    return sorted(rules, key=lambda r: -gain[r])


def cascade(rules: Mapping[str, Column], order: list[str]) -> Column:
    """Name of the first rule, in ``order``, that rejects the row; null if none does."""
    out = None
    for name in order:
        out = (F if out is None else out).when(rules[name], F.lit(name))
    return out.otherwise(F.lit(None).cast("string")) if out is not None else F.lit(None).cast("string")


def judge(df: DataFrame, text: str = "text", rules: Mapping[str, Column] | None = None,
          sample_rows: int = 2000) -> DataFrame:
    """The frame of :func:`with_stats` with ``base_failed``, ``rejected_by`` and ``kept``.

    Repeated rows are judged alike, each on its own; nulls count as empty
    texts (which fail the base rule); an empty table gives an empty frame.
    """
    rules = default_rules() if rules is None else rules
    order = rule_order(df.select(F.col(text).alias("text")), rules, sample_rows) if rules else []
    return (with_stats(df, text)
            .withColumn("base_failed", base_failed())
            .withColumn("rejected_by", F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(rules, order)))
            .withColumn("kept", F.col("rejected_by").isNull()))


def quality_filter(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``df`` that the cascade keeps, with their own columns."""
    # The generator keeps the filter above the statistics, so that they are computed once.
    kept = F.when(F.col("kept"), F.array("row"))
    return judge(df, text).select(F.explode_outer(kept).alias("row")).where("row IS NOT NULL").select("row.*")
