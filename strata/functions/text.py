"""Text helpers: names, header names, slugs, JSON text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def col(name: str) -> Column:
    """Column by exact name, whatever characters the name holds."""
    return F.col(quoted(name))


_WORD_BREAKS = [
    re.compile(r"(?<=[a-z0-9])(?=[A-Z])"),
    re.compile(r"(?<=[A-Z])(?=[A-Z][a-z])"),
    re.compile(r"(?<=[a-zA-Z])(?=\d)"),
]


def snake_case(name: str) -> str:
    """Header text -> snake_case: break words on case and before digits, everything else becomes '_'."""
    for boundary in _WORD_BREAKS:
        name = boundary.sub("_", name)
    return "_".join(part for part in re.split(r"[^a-zA-Z0-9]+", name) if part).lower()


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def json_text(*cols: Column | str) -> Column:
    """Row as JSON text that keeps null fields."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def namespace(source: Column, market: Column) -> Column:
    """Schema name of a target table: source_market, lower-cased, blanks to '_'."""

    def tidy(c):
        return F.replace(F.trim(F.lower(c)), F.lit(" "), F.lit("_"))

    return F.concat(tidy(source), F.lit("_"), tidy(market))
