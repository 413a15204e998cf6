"""Time columns: parsing ``created_at``, hour, day period buckets, day key."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from murmur.vocab import Vocab

MINUTE_FMT = "yyyy-MM-dd HH:mm"
SECOND_FMT = "yyyy-MM-dd HH:mm:ss"


def parse_created_at(c: Column) -> Column:
    """String -> timestamp; minute format first, seconds accepted too.

    ``try_to_timestamp`` keeps ANSI mode on and yields NULL on bad input,
    where a plain cast would raise.
    """
    return F.coalesce(F.try_to_timestamp(c, F.lit(MINUTE_FMT)),
                      F.try_to_timestamp(c, F.lit(SECOND_FMT)))


def period_of_hour(hour: Column, vocab: Vocab) -> Column:
    """Six-bucket day period; a NULL hour falls to the last bucket."""
    b, p = vocab.period_bounds, vocab.periods
    e = F.when(hour < b[0], p[0])
    for bound, name in zip(b[1:], p[1:5]):
        e = e.when(hour < bound, name)
    return e.otherwise(p[5])


def readme_period_of_hour(hour: Column, vocab: Vocab) -> Column:
    """Five day parts declared in the README: 0-5, 6-10, 11-14, 15-18, 19-23."""
    p = vocab.readme_periods
    return (F.when(hour < 6, p[0]).when(hour < 11, p[1]).when(hour < 15, p[2])
            .when(hour < 19, p[3]).when(hour.isNotNull(), p[4]))


def day_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def is_night(hour: Column) -> Column:
    """Night = hour >= 23 or hour < 4."""
    return (hour >= 23) | (hour < 4)
