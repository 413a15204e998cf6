"""Import every query module so that all queries are registered."""

from __future__ import annotations

import importlib

from murmur.plans.registry import REGISTRY, Entry

_MODULES = (
    "murmur.plans.stats_queries",
    "murmur.plans.profile_queries",
    "murmur.plans.recommend_queries",
    "murmur.plans.text_queries",
    "murmur.plans.topic_queries",
    "murmur.plans.io_queries",
    "murmur.plans.rollup_queries",
)


def load() -> dict[str, Entry]:
    for m in _MODULES:
        importlib.import_module(m)
    return REGISTRY


def queries():
    return {k: e.fn for k, e in load().items()}


def oracle_sql():
    return {k: e.sql for k, e in load().items() if e.sql is not None}


def headline():
    return [k for k, e in load().items() if e.headline]
