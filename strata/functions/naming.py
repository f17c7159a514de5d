"""Names derived from job names, regions and table identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata import fixed


def job_key(job: Column, prefix: str = "") -> Column:
    """Job name as the control table spells it: prefix dropped, lower case."""
    name = F.trim(job)
    if prefix:
        name = F.regexp_replace(name, f"(?i)^{prefix}", "")
    return F.lower(name)


def cadence(job: Column) -> Column:
    last = F.element_at(F.split(F.upper(job), "_"), -1)
    return F.when(last.isin(*fixed.CADENCE_HOURS), last).otherwise(F.lit("UNKNOWN"))


def cadence_hours(cadence_col: Column) -> Column:
    pairs = [F.lit(x) for pair in fixed.CADENCE_HOURS.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), cadence_col)


def job_schema(job: Column, prefix: str = "") -> Column:
    """Schema name out of a job name: prefix, cadence suffix and region infix go away."""
    name = F.upper(job)
    if prefix:
        name = F.regexp_replace(name, prefix.upper(), "")
    name = F.regexp_replace(name, "_(" + "|".join(fixed.CADENCE_HOURS) + ")$", "")
    for infix in fixed.REGION_INFIXES:
        name = F.replace(name, F.lit(infix), F.lit("_"))
    return F.lower(name)


def region_code(region: Column) -> Column:
    """Short code of a region; unknown regions give the initials of their words."""
    key = F.upper(F.trim(region))
    pairs = [F.lit(x) for pair in fixed.REGION_CODES.items() for x in pair]
    words = F.filter(F.split(key, r"\s+"), lambda w: w != "")
    initials = F.lower(F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), ""))
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), initials)


def data_age_hours(last_update: Column, now: Column) -> Column:
    micros = F.unix_micros(now.cast("timestamp")) - F.unix_micros(last_update.cast("timestamp"))
    return F.round(micros / F.lit(3600e6), 2)


def freshness(last_update: Column, age_hours: Column, limit_hours: Column) -> Column:
    return (
        F.when(last_update.isNull(), "MISSING")
        .when(limit_hours.isNull(), "UNKNOWN")
        .when(age_hours <= limit_hours, "FRESH")
        .otherwise("STALE")
    )
