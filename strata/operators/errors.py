"""Error records: which rows and which messages made a check fail.

Rows never pass through the driver; records are a DataFrame that is written where it is computed. There is no cap.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import fixed
from strata.functions.text import col, json_text
from strata.functions.wording import column_in_message
from strata.operators.checks import CheckResult, repeated_rows, results_frame
from strata.operators.clean import business_columns

ERROR_COLUMNS = [
    "error_timestamp",
    "error_date",
    "job_id",
    "run_id",
    "job_name",
    "source_table",
    "expectation_type",
    "column_name",
    "failed_value",
    "full_record",
    "severity",
]
_RECORD = ["expectation_type", "column_name", "failed_value", "full_record"]


MALFORMED = "malformed_row"


def malformed_records(df: DataFrame) -> DataFrame:
    """One record per source row that had more or fewer cells than its file has columns: its line, and the row it became."""
    return df.where(col(fixed.MALFORMED_COLUMN).isNotNull()).select(
        F.lit(MALFORMED).alias("expectation_type"),
        F.lit(fixed.ALL_COLUMNS).alias("column_name"),
        col(fixed.MALFORMED_COLUMN).alias("failed_value"),
        json_text(*[col(c) for c in business_columns(df)]).alias("full_record"),
    )


def any_null(keys: list[str]) -> Column:
    return reduce(or_, [col(k).isNull() for k in keys])


def duplicate_row_records(df: DataFrame) -> DataFrame:
    """One record per row value that occurs more than once."""
    columns = business_columns(df)
    repeated = repeated_rows(df, columns)
    return repeated.select(
        F.lit(fixed.DUPLICATE_CHECK).alias("expectation_type"),
        F.lit(fixed.ALL_COLUMNS).alias("column_name"),
        F.lit(fixed.NOT_APPLICABLE).alias("failed_value"),
        json_text(*[col(c) for c in columns]).alias("full_record"),
    )


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a null in the key or a key that other rows have too, as they are.

    Offending keys come from a grouping of the key columns alone; the rows are fetched by a semi join, which Spark
    broadcasts when the offending keys are few and splits when one of them is hot.
    """
    groups = df.where(~any_null(keys)).groupBy(*[col(k) for k in keys]).agg(F.count("*").alias("__n"))
    shared = groups.where(F.col("__n") > 1).select(*[col(k) for k in keys])
    return df.where(any_null(keys)).unionByName(df.join(shared, keys, "left_semi").select(*df.columns))


def key_violation_records(df: DataFrame, keys: list[str]) -> DataFrame:
    """One record per distinct offending row. The distinct runs on the record texts: it has a partial step of its own,
    and needs a shuffle other than the join's, so the join stays free to split a hot key."""
    bad = key_violations(df, keys)
    return bad.select(
        F.lit(fixed.KEY_CHECK).alias("expectation_type"),
        F.lit(", ".join(keys)).alias("column_name"),
        json_text(*[col(k) for k in keys]).alias("failed_value"),
        json_text(*[col(c) for c in business_columns(df)]).alias("full_record"),
    ).distinct()


def message_records(checks: DataFrame) -> DataFrame:
    """One record per message of the failed checks in a result table (name, passed, details, failed_checks)."""
    messages = F.when(F.size("failed_checks") > 0, F.col("failed_checks")).otherwise(F.array("details"))
    failed = checks.where(~F.col("passed")).select("name", F.explode(messages).alias("message"))
    return failed.select(
        F.col("name").alias("expectation_type"),
        column_in_message(F.col("message")).alias("column_name"),
        F.lit(fixed.NOT_APPLICABLE).alias("failed_value"),
        F.col("message").alias("full_record"),
    )


def failure_records(
    spark: SparkSession,
    results: list[CheckResult],
    df: DataFrame | None = None,
    keys: list[str] = (),
) -> DataFrame | None:
    """Records of all failed checks: rows where a check is about rows, messages elsewhere. None if nothing failed."""
    failed = [r for r in results if not r.passed]
    parts, by_message = [], []
    for result in failed:
        if result.name == fixed.DUPLICATE_CHECK and df is not None:
            parts.append(duplicate_row_records(df))
        elif result.name == fixed.KEY_CHECK and df is not None and keys:
            parts.append(key_violation_records(df, list(keys)))
        else:
            by_message.append(result)
    if by_message:
        parts.append(message_records(results_frame(spark, by_message)))
    return reduce(lambda a, b: a.unionByName(b), parts) if parts else None


def with_envelope(
    records: DataFrame,
    *,
    now: datetime | str,
    job_id: str,
    run_id: str,
    job_name: str,
    source_table: str,
    severity: str = fixed.DEFAULT_SEVERITY,
) -> DataFrame:
    moment = F.lit(now).cast("timestamp")
    return records.select(
        moment.alias("error_timestamp"),
        moment.cast("date").alias("error_date"),
        F.lit(job_id).alias("job_id"),
        F.lit(run_id).alias("run_id"),
        F.lit(job_name).alias("job_name"),
        F.lit(source_table).alias("source_table"),
        *_RECORD,
        F.lit(severity).alias("severity"),
    )


def write_errors(records: DataFrame, path: str) -> None:
    records.select(*ERROR_COLUMNS).write.mode("append").partitionBy("error_date").parquet(path)
