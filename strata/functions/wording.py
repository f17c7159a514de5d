"""Texts and labels for reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata import fixed


def column_in_message(message: Column) -> Column:
    found = F.regexp_extract(message, fixed.COLUMN_IN_MESSAGE, 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(fixed.NOT_APPLICABLE))


def percent_text(pct: Column) -> Column:
    return F.when(pct.isNull(), fixed.NOT_APPLICABLE).otherwise(F.concat(F.format_number(pct, 1), F.lit("%")))


def score_band(pct: Column) -> Column:
    return F.when(pct >= fixed.GOOD_SCORE, "green").when(pct >= fixed.FAIR_SCORE, "amber").otherwise("red")


def failure_digest(failed_checks: Column, first: int) -> Column:
    """The first few failed checks in one text."""
    return F.array_join(F.slice(failed_checks, 1, first), " | ")


def clipped(text: Column, length: int) -> Column:
    return F.substring(text, 1, length)


def email_list(emails: Column, fallback: list[str] = ()) -> Column:
    """Trimmed, plausible addresses in first-seen order; the fallback list when none is left."""
    trimmed = F.transform(emails, lambda e: F.trim(e))
    valid = F.array_distinct(F.filter(trimmed, lambda e: e.contains("@") & F.substring_index(e, "@", -1).contains(".")))
    backup = F.array(*[F.lit(e) for e in fallback]).cast("array<string>")
    return F.when(F.size(F.coalesce(valid, F.array())) > 0, valid).otherwise(backup)
