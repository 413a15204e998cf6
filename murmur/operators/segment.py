"""Words of text that is written without spaces: a dictionary learnt from the corpus and a most probable path.

A character n-gram is a word if it is *cohesive* (it occurs far more often than its best split into two parts would by
chance) and *free* (many different characters stand before and after it).  Counts of all n-grams are one aggregate; the
characters after a gram are the grams one longer, so entropies and splits are joins of that table with itself.

A run of characters is a lattice of dictionary words and single characters; its segmentation is the path of the highest
probability.  The dictionary goes to the workers as a trie while it has at most ``MAX_WORDS`` words; beyond, the
lattices come from a join of the substrings of distinct runs with the dictionary table.

Grams are counted in two steps: the longest gram at each position, then the starts of distinct ones.
"""

from __future__ import annotations

import math
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from murmur.functions import text as TX
from murmur.operators.neighbours import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])         # executors need no copy of this package

#: Words that are broadcast (some 100 bytes each in a worker).
MAX_WORDS = 500_000
HAN_RUN = TX.HAN + "+"
START, END = "\x02", "\x03"
#: Probability of a character that is no word, in occurrences.
UNKNOWN = 0.5


def learn(texts: DataFrame, text_col: str = "text", run: str = HAN_RUN, max_len: int = 4, min_count: int = 5,
          min_cohesion: float = 2.0, min_entropy: float = 1.0, digits: int = 6) -> DataFrame:
    """``word, n, cohesion, left_entropy, right_entropy`` of the words of 2 to ``max_len`` characters.

    ``cohesion``: least ``ln(n * N / (n_left * n_right))`` of all splits, N the characters of all runs; entropies in nats,
    an end of a run counts as a character.  Copies of a run are counted, not expanded.
    """
    runs = (texts.select(F.explode(F.regexp_extract_all(F.col(text_col), F.lit(run), 0)).alias("run"))
            .groupBy("run").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("run", F.concat(F.lit(START), "run", F.lit(END))))
    # one row a position: every shorter gram that starts there is the start of the longest
    longest = F.regexp_extract_all("run", F.lit(f"(?s)(?=(.{{1,{max_len + 1}}}))."), 1)
    windows = runs.select(F.explode(longest).alias("window"), "n").groupBy("window").agg(F.sum("n").alias("n"))
    starts = F.transform(F.sequence(F.lit(1), F.length("window")), lambda k: F.substring(F.col("window"), F.lit(1), k))
    counts = windows.select(F.explode(starts).alias("gram"), "n").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = stored(counts.withColumn("size", F.length("gram")), "grams")       # read for words, splits, entropies and the total
    inner = counts.where(~F.col("gram").contains(START) & ~F.col("gram").contains(END) & (F.col("n") >= min_count))
    total = inner_total(counts)
    word = inner.where((F.col("size") >= 2) & (F.col("size") <= max_len)).select(F.col("gram").alias("word"), "n", "size")

    part = inner.select("gram", F.col("n").alias("part_n"))
    splits = (word.select("word", "n", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"))
              .withColumn("left", F.substring(F.col("word"), F.lit(1), F.col("cut")))
              .withColumn("right", F.substring(F.col("word"), F.col("cut") + 1, F.col("size"))))
    cohesion = (splits.join(part.withColumnsRenamed({"gram": "left", "part_n": "left_n"}), "left")
                .join(part.withColumnsRenamed({"gram": "right", "part_n": "right_n"}), "right")
                .groupBy("word").agg(F.round(F.min(F.log(F.col("n") / F.col("left_n") * total / F.col("right_n"))), digits).alias("cohesion")))

    def entropy(key: Column, name: str) -> DataFrame:
        n = F.col("n").cast("double")
        each = counts.where(F.col("size") >= 3).select(key.alias("word"), "n")
        return (each.groupBy("word").agg(F.sum("n").alias("t"), F.sum(n * F.log(n)).alias("s"))
                .select("word", F.round(F.log("t") - F.col("s") / F.col("t"), digits).alias(name)))

    before = F.substring(F.col("gram"), F.lit(2), F.col("size") - 1)
    after = F.substring(F.col("gram"), F.lit(1), F.col("size") - 1)
    return (word.select("word", "n").join(cohesion.where(F.col("cohesion") >= min_cohesion), "word")
            .join(entropy(before, "left_entropy").where(F.col("left_entropy") >= min_entropy), "word")
            .join(entropy(after, "right_entropy").where(F.col("right_entropy") >= min_entropy), "word"))


def inner_total(counts: DataFrame) -> Column:
    """Characters of all runs, as a scalar."""
    return counts.where((F.col("size") == 1) & ~F.col("gram").isin(START, END)).select(F.sum("n").cast("double")).scalar()


def best_path(size: int, arcs: dict[int, list[tuple[int, float]]], unknown: float) -> list[tuple[int, int]]:
    """(start, end) of the most probable path over ``size`` characters; ``arcs``: start -> (end, log probability).

    A character without an arc of its own weighs ``unknown``.  Of equal paths, the one whose last word is longest, then
    the one before it.
    """
    weight, origin = [-math.inf] * (size + 1), [0] * (size + 1)
    weight[0] = 0.0
    for i in range(size):
        alone = True
        for j, w in arcs.get(i, ()):
            alone &= j != i + 1
            if weight[i] + w > weight[j]:
                weight[j], origin[j] = weight[i] + w, i
        if alone and weight[i] + unknown > weight[i + 1]:
            weight[i + 1], origin[i + 1] = weight[i] + unknown, i
    out, at = [], size
    while at:
        out.append((origin[at], at))
        at = origin[at]
    return out[::-1]


class Trie:
    """Words by character; ``segment`` walks it from every position of a run."""

    def __init__(self, words: dict[str, float], unknown: float):
        self.unknown, self.start = unknown, {}
        for word, w in words.items():
            state = self.start
            for c in word:
                state = state.setdefault(c, {})
            state[""] = w

    def segment(self, run: str) -> list[str]:
        arcs: dict[int, list[tuple[int, float]]] = {}
        for i in range(len(run)):
            state = self.start
            for j in range(i, len(run)):
                state = state.get(run[j])
                if state is None:
                    break
                if "" in state:
                    arcs.setdefault(i, []).append((j + 1, state[""]))
        return [run[a:b] for a, b in best_path(len(run), arcs, self.unknown)]


def weights(dictionary: DataFrame) -> DataFrame:
    """``word, logp`` from ``word, n``; repeated words are summed, null and empty ones dropped."""
    words = dictionary.where(F.length("word") > 0).groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")
    return words.select("word", F.log(F.col("n") / words.select(F.sum("n")).scalar()).alias("logp"))


def segment_runs(df: DataFrame, dictionary: DataFrame, runs: Column, out: str = "segments", max_words: int | None = None) -> DataFrame:
    """``df`` with the words of each of its ``runs`` (an array of strings), in order, in ``out``; null runs give null."""
    max_words = MAX_WORDS if max_words is None else max_words
    dictionary = stored(dictionary.select("word", "n"), "dictionary")           # read for the weights, their total and the trie
    words = weights(dictionary)
    total = dictionary.where(F.length("word") > 0).agg(F.sum("n").alias("n")).first()["n"] or 1
    unknown = math.log(UNKNOWN / total)
    head = words.limit(max_words + 1).collect()
    if len(head) > max_words:
        return _by_join(df, words, runs, out, unknown)
    spark = df.sparkSession
    held = spark.sparkContext.broadcast({r["word"]: r["logp"] for r in head})
    kept: list[Trie] = []                                   # one trie per worker task

    @F.arrow_udf("array<string>")
    def cut(batch: pa.Array) -> pa.Array:
        if not kept:
            kept.append(Trie(held.value, unknown))
        trie, seen = kept[0], {}
        values = []
        for row in batch.to_pylist():
            if row is None:
                values.append(None)
                continue
            words: list[str] = []
            for run in row:
                if run not in seen:
                    seen[run] = trie.segment(run or "")
                words += seen[run]
            values.append(words)
        return pa.array(values, pa.list_(pa.string()))

    return df.withColumn(out, cut(runs))


def _by_join(df: DataFrame, words: DataFrame, runs: Column, out: str, unknown: float) -> DataFrame:
    """The same without a broadcast: distinct runs, their substrings joined with the dictionary, lattices per run."""
    longest = F.lit(words.agg(F.max(F.length("word")).alias("m")).first()["m"] or 1)
    rows = df.withColumn("_row", F.struct("*")).withColumn("_runs", runs).select("_row", "_runs")
    rows = rows.withColumn("_no", F.monotonically_increasing_id())
    rows = stored(rows, "runs")                             # row numbers must stay
    runs_ = rows.select(F.explode("_runs").alias("run")).distinct()
    size = F.length("run")
    spans = F.flatten(F.transform(F.sequence(F.lit(1), size), lambda i: F.transform(
        F.sequence(F.lit(1), F.least(longest, size - i + 1)), lambda k: F.struct((i - 1).alias("start"), (i - 1 + k).alias("end"),
                                                                                F.substring(F.col("run"), i, k).alias("word")))))
    arcs = (runs_.where(size > 0).select("run", F.inline(spans)).join(words, "word")
            .groupBy("run").agg(F.collect_list(F.struct("start", "end", "logp")).alias("arcs")))     # at most longest * size

    @F.arrow_udf("array<string>")
    def path(run: pa.Array, arcs: pa.Array) -> pa.Array:
        got = []
        for r, a in zip(run.to_pylist(), arcs.to_pylist()):
            by: dict[int, list[tuple[int, float]]] = {}
            for x in sorted(a or [], key=lambda x: x["end"]):
                by.setdefault(x["start"], []).append((x["end"], x["logp"]))
            got.append([r[i:j] for i, j in best_path(len(r), by, unknown)])
        return pa.array(got, pa.list_(pa.string()))

    cut = runs_.join(arcs, "run", "left").select("run", path("run", "arcs").alias("words"))
    each = (rows.select("_no", F.posexplode("_runs").alias("at", "run")).join(cut, "run")
            .groupBy("_no").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("at", "words"))), lambda x: x["words"])).alias("_words")))
    done = F.when(F.col("_runs").isNotNull(), F.coalesce("_words", F.array().cast("array<string>")))
    return rows.join(each, "_no", "left").select("_row.*", done.alias(out))


def segmented_tokens(df: DataFrame, dictionary: DataFrame, text_col: str = "text", out: str = "words", min_len: int = 2,
                     run: str = HAN_RUN, max_words: int | None = None) -> DataFrame:
    """``df`` with the tokens of a text: its letter and digit runs, then the words of its Han runs, both of at least
    ``min_len`` characters; a null or blank text has none."""
    none = F.array().cast("array<string>")
    text = F.col(text_col)
    found = segment_runs(df, dictionary, F.coalesce(F.regexp_extract_all(text, F.lit(run), 0), none), "_cut", max_words)
    words = F.concat(TX.word_tokens(text, min_len), F.filter("_cut", lambda w: F.length(w) >= min_len))
    return found.withColumn(out, F.coalesce(words, none)).drop("_cut")
