"""String helpers with the reference's semantics, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def java_split(col, sep: str) -> Column:
    """Split like Java's ``String.split(regex)`` on a literal separator: trailing
    empty fields are dropped; a text of separators only gives an empty array,
    the empty text gives one empty field."""
    import re

    esc = re.escape(sep)
    c = _c(col)
    stripped = F.regexp_replace(c, f"({esc})+$", "")
    return F.when((stripped == "") & (c != ""), F.array().cast("array<string>")).otherwise(F.split(stripped, esc))


def day_part(col) -> Column:
    """``yyyy-MM-dd`` of a ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.substring(_c(col), 1, 10)


def hour_part(col) -> Column:
    """``HH`` of a ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.substring(_c(col), 12, 2)


def utf8_length(col) -> Column:
    """Length in bytes of the UTF-8 encoding."""
    return F.octet_length(F.encode(_c(col), "UTF-8"))
