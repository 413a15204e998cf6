"""Toxicity scores from a weighted lexicon matched by Aho-Corasick.

Texts are folded first: lower case, look-alike letters to Latin ones, digits
and signs that stand for letters to those letters, and ``l`` to ``i`` (as the
digit 1 stands for either).  Lexicon entries are folded words, or word
beginnings (``prefix=True``); each word of a text counts once, with its
heaviest entry, unless it stands in an exception phrase.  The sum of weights is
divided by the length in words.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import astuple, dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from murmur.llm.common import only_state_of, sized_join, stored, worker_state

# Look-alikes and substitutions, each with the letter it stands for.
CYRILLIC = {"а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c",
            "т": "t", "у": "y", "х": "x", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ӏ": "i", "ո": "n"}
GREEK = {"α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
         "υ": "u", "χ": "x", "ω": "w"}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s", "!": "i"}

_FULLWIDTH = {chr(0xFF41 + i): chr(ord("a") + i) for i in range(26)}
_TABLE = {ord(a): b for a, b in (CYRILLIC | GREEK | DIGITS | _FULLWIDTH | {"l": "i"}).items()}
_TABLE |= {ord(a): "i" for a, b in _FULLWIDTH.items() if b == "l"}
_SIGN = re.compile(r"[@$](?=\w)|(?<=\w)!(?=\w)")
_WORD = re.compile(r"[^\W_]+")

MIN_PREFIX, MAX_PREFIX = 4, 7
CUT = 0.7


def fold(text: str) -> str:
    return _SIGN.sub(lambda m: SIGNS[m[0]], text.lower()).translate(_TABLE)


@dataclass
class Lexicon:
    """``words`` and ``prefixes``: folded entry -> weight; ``exceptions``: folded
    two-word phrases; ``scale``: weight per 100 words that scores 0.7."""

    words: dict[str, float] = field(default_factory=dict)
    prefixes: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    scale: float = 1.0

    def automaton(self) -> ahocorasick.Automaton:
        a = ahocorasick.Automaton()
        for entry in self.words.keys() | self.prefixes.keys():
            a.add_word(entry, (len(entry), self.words.get(entry), self.prefixes.get(entry)))
        a.make_automaton()
        return a


def hits(lexicon: Lexicon, automaton: ahocorasick.Automaton, folded: str) -> dict[int, tuple[float, list[str]]]:
    """Start of each matched word -> (weight, the phrases of two words it stands in)."""
    found: dict[int, float] = {}
    n = len(folded)
    if not len(automaton):
        return {}
    for end, (size, word, prefix) in automaton.iter(folded):
        start = end - size + 1
        if start and folded[start - 1].isalnum():
            continue
        whole = end + 1 == n or not folded[end + 1].isalnum()
        weight = max(word if whole and word is not None else 0.0, prefix or 0.0)
        if weight > found.get(start, 0.0):
            found[start] = weight
    out = {}
    for start, weight in found.items():
        here = _WORD.match(folded, start)
        before, after = _word_before(folded, start), _WORD.search(folded, here.end())
        out[start] = (weight, [f"{before} {here[0]}"] * bool(before) + ([f"{here[0]} {after[0]}"] if after else []))
    return out


def _word_before(folded: str, start: int) -> str:
    """The last word that ends before ``start``; empty if there is none."""
    end = start
    while end and not folded[end - 1].isalnum():
        end -= 1
    begin = end
    while begin and folded[begin - 1].isalnum():
        begin -= 1
    return folded[begin:end]


def weight_per_100(lexicon: Lexicon, automaton: ahocorasick.Automaton, text: str | None) -> float:
    """Weight of the hits per 100 words (of 20 more words than the text has, so
    that one hit does not decide over a text of three words)."""
    if not text:
        return 0.0
    total = sum(w for w, phrases in hits(lexicon, automaton, fold(text)).values()
                if not lexicon.exceptions.intersection(phrases))
    return 100 * total / (len(text.split()) + 20) if total else 0.0


def score_of(lexicon: Lexicon, x: float) -> float:
    """0 for no hit, 0.7 at the fitted scale, towards 1 beyond."""
    return x / (x + lexicon.scale * (1 - CUT) / CUT)


def _features(text: str) -> set[str]:
    """Folded words, and word beginnings marked by a star."""
    words = set(_WORD.findall(fold(text)))
    return words | {f"{w[:k]}*" for w in words for k in range(MIN_PREFIX, min(MAX_PREFIX, len(w)) + 1)}


def _count(train: DataFrame, of) -> DataFrame:
    """Texts of each label that have each item of ``of(text)``: item, pos, neg."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_state_of("toxicity")
        sums = (Counter(), Counter())

        def flush():
            keys = list(sums[0].keys() | sums[1].keys())
            yield pa.RecordBatch.from_pydict({
                "item": pa.array(keys, pa.string()), "pos": pa.array([sums[1][k] for k in keys], pa.int64()),
                "neg": pa.array([sums[0][k] for k in keys], pa.int64())})
            sums[0].clear(), sums[1].clear()

        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                sums[toxic].update(of(text))
                if len(sums[0]) + len(sums[1]) > 150_000:
                    yield from flush()
        yield from flush()

    return (train.select("text", "toxic").mapInArrow(count, "item string, pos long, neg long")
            .groupBy("item").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))


def _select(rows: list, n_pos: int, n_neg: int) -> tuple[dict[str, float], dict[str, float]]:
    """Entries from (item, pos, neg): of a word and its beginnings, the one that says most."""
    weight = {r["item"]: math.log((r["pos"] + .5) / (n_pos + 1)) - math.log((r["neg"] + .5) / (n_neg + 1)) for r in rows}
    support = {r["item"]: r["pos"] for r in rows}

    def beginnings(item: str):
        stem = item.rstrip("*")
        return (f"{stem[:k]}*" for k in range(MIN_PREFIX, len(stem) + (not item.endswith("*"))) if f"{stem[:k]}*" in weight)

    kept = set(weight)
    for item in weight:                      # a beginning that reaches many more texts replaces what it covers
        if any(support[b] >= 1.2 * support[item] and weight[b] >= weight[item] - .5 for b in beginnings(item)):
            kept.discard(item)
    for item in sorted(kept, key=lambda x: (-len(x), x)):
        kept -= {b for b in beginnings(item) if item in kept and weight[item] >= weight[b] - .5}
    return ({x: weight[x] for x in kept if not x.endswith("*")}, {x[:-1]: weight[x] for x in kept if x.endswith("*")})


#: Least shares of toxic texts an entry must be in, from which held-back rows choose.
SHARES = (0.02, 0.01, 0.005)


def fit(train: DataFrame, fit_rows: int = 20_000, min_texts: int = 4, min_weight: float = 3.0, key: str = "doc_id") -> Lexicon:
    """Learn a lexicon from ``train(key, text, toxic)``.

    At most about ``fit_rows`` labelled rows are used (chosen by a hash of the
    key).  Entries are words and beginnings whose log odds reach ``min_weight`` in
    at least a share of the toxic texts; a quarter of the rows is held back to
    choose that share from ``SHARES`` (the greatest of equally good ones).  All candidates come to the driver: each is in
    at least the least share of the toxic texts of the bounded rows.  An exception is a phrase around an entry found in three
    or more clean texts and not more often in toxic ones.  Rows with a null
    text or label teach nothing; without toxic rows the lexicon is empty.
    """
    train = (train.where("text IS NOT NULL AND toxic IN (0, 1)")
             .select(F.col(key).alias("key"), "text", F.col("toxic").cast("int").alias("toxic")))
    total = train.count()
    if total > fit_rows:
        chosen = F.pmod(F.xxhash64(F.lit("fit"), F.col("key")), F.lit(1_000_000))
        train = train.where(chosen < int(1e6 * fit_rows / total))
    train = stored(train, "toxicity-fit")
    held = F.pmod(F.xxhash64(F.lit("held"), F.col("key")), F.lit(4)) == 0
    tried = _lexicons(train.where(~held), SHARES, min_texts, min_weight)
    errors = [_errors(train.where(held), lexicon) for lexicon in tried]
    share = SHARES[errors.index(min(errors))]
    return _lexicons(train, (share,), min_texts, min_weight)[0]


def _lexicons(train: DataFrame, shares: tuple[float, ...], min_texts: int, min_weight: float) -> list[Lexicon]:
    """One fitted lexicon for each least share."""
    n = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    n_pos, n_neg = n.get(1, 0), n.get(0, 0)
    if not n_pos:
        return [Lexicon() for _ in shares]
    odds = F.log((F.col("pos") + .5) / (n_pos + 1)) - F.log((F.col("neg") + .5) / (n_neg + 1))
    rows = (_count(train, _features).where(F.col("pos") >= max(min_texts, min(shares) * n_pos)).where(odds >= min_weight)
            .orderBy(F.desc("pos"), "item").collect())
    out = []
    for share in shares:
        entries = Lexicon(*_select([r for r in rows if r["pos"] >= share * n_pos], n_pos, n_neg))

        name = " ".join((*sorted(entries.words), "*", *sorted(entries.prefixes)))

        def phrases(text: str, entries=entries, name=name) -> set[str]:
            kept = worker_state("toxicity automaton", dict)         # the last one used
            if name not in kept:
                kept.clear()
                kept[name] = entries.automaton()
            automaton = kept[name]
            return {p for _, around in hits(entries, automaton, fold(text)).values() for p in around}

        found = (_count(train, phrases).where((F.col("neg") >= 3) & (F.col("neg") * n_pos >= F.col("pos") * n_neg))
                 .orderBy(F.desc("neg"), "item").collect())
        lexicon = Lexicon(entries.words, entries.prefixes, frozenset(r["item"] for r in found))
        lexicon.scale = _scale(train, lexicon)
        out.append(lexicon)
    return out


def _errors(held: DataFrame, lexicon: Lexicon) -> int:
    x = weights(held.select(F.col("toxic").alias("key"), "text"), lexicon)
    wrong = (F.col("x") >= lexicon.scale).cast("int") != F.col("key")
    return x.agg(F.sum(wrong.cast("int"))).first()[0] or 0


def _scale(train: DataFrame, lexicon: Lexicon) -> float:
    """The cut of least error between toxic and clean training texts (the middle of the widest best gap)."""
    x = weights(train.select(F.col("toxic").alias("key"), "text"), lexicon)
    rows = (x.where("x > 0").groupBy(F.round(F.log(F.col("x")), 2).alias("bin"))       # some 1500 bins at most
            .agg(F.sum(F.col("key")).alias("pos"), F.sum(1 - F.col("key")).alias("neg")).orderBy("bin").collect())
    if not rows:
        return 1.0
    bins = [rows[0]["bin"] - 1.0] + [r["bin"] for r in rows]
    wrong = np.concatenate([[sum(r["neg"] for r in rows)], sum(r["neg"] for r in rows) + np.cumsum([r["pos"] - r["neg"] for r in rows])])
    gaps = [(wrong[i], -((bins[i + 1] - bins[i]) if i + 1 < len(bins) else 0), i) for i in range(len(bins))]
    _, _, i = min(gaps)
    return math.exp((bins[i] + bins[i + 1]) / 2 if i + 1 < len(bins) else bins[i] + .5)


def weights(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``key`` and ``x`` (weight per 100 words) for every row of ``docs(key, text)``."""
    shared = docs.sparkSession.sparkContext.broadcast(astuple(lexicon))      # learnt from bounded rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_state_of("toxicity")
        lex = Lexicon(*shared.value)
        automaton = lex.automaton()
        for batch in batches:
            xs = [weight_per_100(lex, automaton, t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(xs, pa.float64())], names=["key", "x"])

    kind = docs.schema["key"].dataType.simpleString()
    return docs.select("key", "text").mapInArrow(run, f"key {kind}, x double")


def score(docs: DataFrame, lexicon: Lexicon, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``score`` (0 to 1) and ``predicted`` (1 from 0.7 on) for every row.

    Null and empty texts score 0; equal rows score alike; null keys are returned; an empty table gives no rows; other
    columns are ignored, whatever their names.  Whole texts are scored, however long.
    """
    x = weights(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), lexicon)
    s = F.col("x") / (F.col("x") + F.lit(lexicon.scale * (1 - CUT) / CUT))
    return x.select("key", s.alias("score")).withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``toxic`` of the rows whose id has one agreed label
    (an id with differing labels teaches nothing)."""
    one = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id")
           .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_m")).where("toxic = _m").drop("_m"))
    return sized_join(docs.select("doc_id", "text"), one, "doc_id", "inner")


def toxicity_filter(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """Rows of ``docs``, with their own columns, that are not predicted toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(astuple(lexicon))

    def run(batches):
        only_state_of("toxicity")
        lex = Lexicon(*shared.value)
        automaton = lex.automaton()
        for batch in batches:
            keep = [score_of(lex, weight_per_100(lex, automaton, t.as_py())) < CUT for t in batch.column(batch.schema.get_field_index(text))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
