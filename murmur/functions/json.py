"""JSON field extraction for raw post messages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from murmur.schemas import INT_FIELDS, POST_RAW, POST_RAW_FIELDS


def field(c: Column, name: str) -> Column:
    """One top-level field; bad JSON, a missing field or JSON null -> NULL."""
    return F.get_json_object(c, f"$.{name}")


def to_int(c: Column) -> Column:
    """Strict string -> int: '7' -> 7, 'x7' / '12.7' -> NULL (never raises)."""
    return c.try_cast("int")


def post_fields_fieldwise(c: Column) -> list[Column]:
    """The 21 message fields by one path extraction each (re-parses the text per field)."""
    out = []
    for name in POST_RAW_FIELDS:
        v = field(c, name)
        out.append((to_int(v) if name in INT_FIELDS else v).alias(name))
    return out


def post_struct(c: Column) -> Column:
    """All message fields as strings, from a single parse."""
    return F.from_json(c, POST_RAW, {"mode": "PERMISSIVE"})


def post_fields(c: Column) -> list[Column]:
    """The 21 message fields from a single parse, counters and level as int.

    Every field is declared as a string, so a JSON number arrives as its
    text (as path extraction gives it) and a quoted ``"7"`` still becomes 7
    after ``try_cast``; bad JSON, a missing field or JSON null give NULL.
    """
    s = post_struct(c)
    return [(to_int(s[name]) if name in INT_FIELDS else s[name]).alias(name) for name in POST_RAW_FIELDS]
