"""Typed parsing of landed text.

Dates come in many layouts. Trying patterns in turn costs an exception inside the parser for every one that does not
fit, and a long expression besides. Here the separators of a text tell its layout, its pieces are put into ISO order,
and one cast decides. Where month and day cannot be told apart the month comes first; a first number above 12 can only
be a day. That gives what the ordered pattern list in ``fixed`` gives.

The ``*_sql`` functions give SQL text over one column name. Tables have up to hundreds of columns, and one text per
column is handed to Spark much faster than the thousands of calls the same expressions take piece by piece.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata import fixed
from strata.functions.text import quoted

_BARE_CLOCK = r"^\s*T?\d{1,2}:"
_NOT_TIMESTAMP = r"^(\d{2}([/-])\d{2}\2\d{4}|\d{4}/\d{2}/\d{2}|\d{2}-[A-Za-z]{3}-.*)$"
_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[dDfF]?|[iI]nf(inity)?)\s*$"
_MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def _ends(c: str, n: int) -> str:
    """The text ends with its n-letter date, or goes on with ' HH:mm:ss'."""
    clock = f"substr({c}, {n + 1}, 1) = ' ' AND substr({c}, {n + 4}, 1) = ':' AND substr({c}, {n + 7}, 1) = ':'"
    return f"(length({c}) = {n} OR (length({c}) = {n + 9} AND {clock}))"


def _year_last(c: str) -> str:
    return f"substr({c}, 3, 1) IN ('/', '-')"


def _year_slash(c: str) -> str:
    return f"(substr({c}, 5, 1) = '/' AND substr({c}, 8, 1) = '/')"


def iso_sql(name: str) -> str:
    """Date text in ISO order, any clock kept; null for a bare time of day, which a cast would take for today."""
    c = quoted(name)
    first, second, year, rest = f"substr({c}, 1, 2)", f"substr({c}, 4, 2)", f"substr({c}, 7, 4)", f"substr({c}, 11, 9)"
    numbers = f"""CASE WHEN substr({c}, 6, 1) = substr({c}, 3, 1) AND {_ends(c, 10)} THEN
        CASE WHEN {first} > '12' THEN concat({year}, '-', {second}, '-', {first}, {rest})
             ELSE concat({year}, '-', {first}, '-', {second}, {rest}) END END"""
    pairs = ", ".join(f"'{month}', '-{i:02d}-'" for i, month in enumerate(_MONTHS, 1))
    month = f"try_element_at(map({pairs}), lower(substr({c}, 4, 3)))"
    named = f"""CASE WHEN substr({c}, 7, 1) <> '-' OR substr({c}, 3, 1) <> '-' THEN NULL
        WHEN {_ends(c, 9)} THEN concat('20', substr({c}, 8, 2), {month}, {first}, substr({c}, 10, 9))
        WHEN {_ends(c, 11)} THEN concat(substr({c}, 8, 4), {month}, {first}, substr({c}, 12, 9)) END"""
    return f"""CASE WHEN {_year_last(c)} THEN coalesce({numbers}, {named})
        WHEN {_year_slash(c)} THEN CASE WHEN {_ends(c, 10)} THEN translate({c}, '/', '-') END
        WHEN NOT (contains({c}, ':') AND {c} RLIKE r'{_BARE_CLOCK}') THEN {c} END"""


def moment_sql(name: str) -> str:
    """The instant a date or timestamp text stands for."""
    return f"try_cast({iso_sql(name)} AS timestamp)"


def is_timestamp_sql(name: str) -> str:
    """Whether the timestamp layouts cover a text: month names do not belong to them, nor bare dates out of ISO order."""
    c = quoted(name)
    return f"NOT (({_year_last(c)} OR {_year_slash(c)}) AND {c} RLIKE r'{_NOT_TIMESTAMP}')"


def _own_patterns(c: str, patterns: list[str]) -> str:
    tries = ", ".join("try_to_timestamp({}, '{}')".format(c, p.replace("'", "''")) for p in patterns)
    return f"coalesce({tries})"


def date_sql(name: str, patterns: list[str] | None = None) -> str:
    """Date from text; ``patterns`` narrows a column to its own layouts (day-first, say)."""
    instant = _own_patterns(quoted(name), patterns) if patterns else moment_sql(name)
    return f"cast({instant} AS date)"


def timestamp_sql(name: str, patterns: list[str] | None = None) -> str:
    if patterns:
        return _own_patterns(quoted(name), patterns)
    return f"CASE WHEN {is_timestamp_sql(name)} THEN {moment_sql(name)} END"


def number_text_sql(name: str) -> str:
    """'12 %' -> '12': one trailing percent sign and the blanks around it dropped."""
    c = quoted(name)
    return rf"CASE WHEN contains({c}, '%') THEN regexp_replace({c}, r'\s*%\s*$', '') ELSE {c} END"


def number_sql(name: str, target: str) -> str:
    """Number from text, percent sign ignored. The word nan means no value, so it never becomes a number. No number
    begins with an n, and most null words do; they are spared the exception of a failed cast."""
    value = f"CASE WHEN substr({quoted(name)}, 1, 1) NOT IN ('n', 'N') THEN try_cast({number_text_sql(name)} AS {target}) END"
    return f"nullif({value}, cast('NaN' AS {target}))" if target in ("float", "double") else value


def whole_sql(name: str) -> str:
    """A bigint where a text is a whole number, of any length."""
    text = number_text_sql(name)
    return rf"CASE WHEN ({text}) RLIKE r'^\s*[+-]?\d+\s*$' THEN try_cast({text} AS bigint) END"


def unsigned_sql(name: str) -> str:
    """The text of a number without sign and blanks."""
    return rf"regexp_replace(trim({number_text_sql(name)}), r'^[+-]', '')"


def is_real_sql(name: str) -> str:
    return f"({number_text_sql(name)}) RLIKE r'{_NUMBER}'"


def is_null_word_sql(name: str) -> str:
    c, words = quoted(name), ", ".join(f"'{word}'" for word in fixed.NULL_WORDS)
    return f"({c} IS NULL OR lower(trim({c})) IN ({words}))"


def spark_type(data_type: str) -> str | None:
    """Spark type for a configured type name, None when the name is unknown."""
    name = data_type.lower().strip()
    if re.fullmatch(r"decimal\(\s*\d+\s*,\s*\d+\s*\)", name):
        return name.replace(" ", "")
    return fixed.COLUMN_TYPES.get(name)


def typed_sql(name: str, target: str, patterns: list[str] | None = None) -> str:
    """The column as ``target``, null where it does not parse. Null words parse as nothing but text."""
    if target == "string":
        return f"try_cast({quoted(name)} AS string)"
    if target == "date":
        return date_sql(name, patterns)
    if target == "timestamp":
        return timestamp_sql(name, patterns)
    return number_sql(name, target)


def fails_sql(name: str, target: str, patterns: list[str] | None = None) -> str:
    """True where a text means something but is not a ``target``. The word list is looked at only after a failed parse."""
    if target == "string":
        return "false"
    return f"({typed_sql(name, target, patterns)}) IS NULL AND NOT {is_null_word_sql(name)}"


def typed(name: str, target: str, patterns: list[str] | None = None) -> Column:
    return F.expr(typed_sql(name, target, patterns))
