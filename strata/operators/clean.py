"""Header, row and column cleaning, and removal of repeated rows."""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import fixed
from strata.functions.text import col, snake_case


def business_columns(df: DataFrame) -> list[str]:
    """Columns of the source itself, lineage and the lines of malformed rows left out."""
    return [name for name in df.columns if name not in (fixed.LINEAGE_COLUMN, fixed.MALFORMED_COLUMN)]


# ---- headers -----------------------------------------------------------------------------------------------


def standard_names(columns: list[str]) -> list[str]:
    names = [snake_case(name) for name in columns]
    clashes = {name for name, times in Counter(names).items() if times > 1}
    if clashes:
        sources = [c for c, name in zip(columns, names) if name in clashes]
        raise ValueError(f"headers {sources} all become {sorted(clashes)}; rename them in the source")
    return names


def standardize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*standard_names(df.columns))


# ---- null rows ---------------------------------------------------------------------------------------------


def any_filled(columns: list[str]) -> Column:
    return reduce(or_, [col(name).isNotNull() for name in columns])


def drop_null_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drops rows in which every business column is null; ``columns`` names another set to look at."""
    return df.where(any_filled(columns or business_columns(df)))


# ---- columns without a header ------------------------------------------------------------------------------


def headerless_columns(columns: list[str]) -> list[str]:
    return [name for name in columns if re.fullmatch(r"_c\d+|Unnamed:\s*\d+", name)]


def settle_headerless(df: DataFrame, filled: dict[str, int], table_name: str = "") -> DataFrame:
    """Drops headerless columns that are null throughout; any value in one of them is an error."""
    with_data = [name for name, count in filled.items() if count]
    if with_data:
        raise ValueError(f"columns without a header hold data in '{table_name}': {with_data}")
    return df.drop(*filled)


def drop_empty_headers(df: DataFrame, table_name: str = "") -> DataFrame:
    suspects = headerless_columns(df.columns)
    if not suspects:
        return df
    filled = df.agg(*[F.count(col(name)).alias(name) for name in suspects]).first().asDict()
    return settle_headerless(df, filled, table_name)


# ---- repeated rows -----------------------------------------------------------------------------------------


def dedup_enabled(setting) -> bool:
    """True for true and 'true'; false for false, null and other texts; anything else is an error."""
    if setting is None or isinstance(setting, bool):
        return bool(setting)
    if isinstance(setting, str):
        return setting.strip().lower() == "true"
    raise TypeError(f"'deduplication' must be true or false, got {setting!r}")


def drop_duplicate_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per distinct value of the business columns.

    Grouping collapses copies before the shuffle, so a row repeated a billion times travels once per task. The
    lineage column takes its smallest value, which is the same on every attempt.
    """
    keys = columns or business_columns(df)
    others = [name for name in df.columns if name not in keys]
    if not others:
        return df.distinct()
    kept = df.groupBy(*[col(k) for k in keys]).agg(*[F.min(col(name)).alias(name) for name in others])
    return kept.select(*[col(name) for name in df.columns])


def duplicate_statistics(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows before and after removing repeats, in one row."""
    keys = columns or business_columns(df)
    copies = df.groupBy(*[col(k) for k in keys]).agg(F.count("*").alias("copies"))
    return copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("before_count"),
        F.count("*").alias("after_count"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("removed_count"),
    )
