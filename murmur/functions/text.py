"""Text expressions: mention removal, term rules, rule features, tokens."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Java's \S without the Unicode flag is "not one of these six"; spelled out
# so that the same class means the same in other regex engines.
NON_SPACE = "[^ \\t\\n\\x0B\\f\\r]"
MENTION = "@" + NON_SPACE + "+"
WORD = "[\\p{L}\\p{N}]+"
HAN = "\\p{IsHan}"


def escape_term(t: str) -> str:
    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", t)


def alternation(terms: Iterable[str]) -> str:
    """Terms joined as a regex alternation, in the order given."""
    return "|".join(escape_term(t) for t in terms)


def remove_mentions(c: Column) -> Column:
    return F.regexp_replace(c, MENTION, "")


def free_of(c: Column, terms: Iterable[str]) -> Column:
    """True when ``c`` contains none of ``terms``; NULL text gives NULL."""
    cond = None
    for t in terms:
        e = ~c.contains(t)
        cond = e if cond is None else cond & e
    return cond if cond is not None else c.isNotNull()


def split_count(c: Column, terms: Iterable[str]) -> Column:
    """size(split(text, alternation)) -- number of hits + 1."""
    return F.size(F.split(c, alternation(terms)))


def removed_length(c: Column, terms: Iterable[str], divisor: int) -> Column:
    """(length - length without the terms) / divisor."""
    return (F.length(c) - F.length(F.regexp_replace(c, alternation(terms), ""))) / F.lit(divisor)


def word_tokens(c: Column, min_len: int = 2) -> Column:
    """Letter/digit runs outside Han script, length >= ``min_len``."""
    latin = F.regexp_extract_all(F.regexp_replace(c, HAN, " "), F.lit(WORD), 0)
    return F.filter(latin, lambda w: F.length(w) >= min_len)


def han_bigrams(c: Column) -> Column:
    """Character bigrams of every Han run (a dictionary-free segmenter)."""
    runs = F.regexp_extract_all(c, F.lit(HAN + "{2,}"), 0)
    grams = F.transform(
        runs, lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - 1),
                                    lambda i: F.substring(r, i, 2)))
    return F.flatten(grams)


def tokens(c: Column, min_len: int = 2) -> Column:
    """Token list: word runs plus Han bigrams; NULL or blank text -> []."""
    # the bigram pass only runs on texts that contain a Han character
    grams = F.when(c.rlike(HAN), han_bigrams(c)).otherwise(F.array().cast("array<string>"))
    t = F.concat(word_tokens(c, min_len), grams)
    return F.when(F.trim(F.coalesce(c, F.lit(""))) == "", F.array().cast("array<string>")).otherwise(t)
