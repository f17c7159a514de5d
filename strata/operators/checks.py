"""Structural checks on a table.

One grouping pass answers them all. With key columns it groups by key: row count, nulls per key column, distinct keys,
and, since equal rows have equal keys, whether repeated rows are possible at all. Without keys it groups by a 64-bit
row hash, so that only hashes are shuffled. Only when a group has more than one row is there a second pass, which
counts repeats on the full rows of those groups, exactly.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import fixed
from strata.functions.text import col
from strata.operators.clean import business_columns
from strata.operators.schema import AUDIT_COLUMNS, schema_entries

RESULT_SCHEMA = "name string, passed boolean, details string, failed_checks array<string>"


@dataclass
class CheckResult:
    name: str
    passed: bool
    details: str
    failed_checks: list[str] = field(default_factory=list)


class ChecksFailed(ValueError):
    def __init__(self, table_name: str, results: list[CheckResult]):
        self.results = results
        self.failed_checks = [message for r in results for message in r.failed_checks]
        super().__init__(f"{table_name}: " + " | ".join(self.failed_checks))


# ---- what to check -----------------------------------------------------------------------------------------


def _trusted(config: dict) -> dict:
    return (config.get("ingestion_steps") or {}).get("raw_trusted") or {}


def enabled_checks(config: dict) -> list[str]:
    return _trusted(config).get("validations") or fixed.DEFAULT_CHECKS


def primary_key(config: dict) -> list[str]:
    return _trusted(config).get("primary_key") or []


def expected_columns(config: dict) -> list[str]:
    return [e["column_name"] for e in schema_entries(config.get("schema")) if e.get("column_name")]


# ---- counting ----------------------------------------------------------------------------------------------


@dataclass
class TableCounts:
    total: int
    distinct_rows: int
    distinct_keys: int | None = None
    key_nulls: dict[str, int] = field(default_factory=dict)


def _hashable(df: DataFrame, columns: list[str]) -> list:
    maps = {f.name for f in df.schema.fields if "map<" in f.dataType.simpleString()}
    return [F.to_json(col(c)) if c in maps else col(c) for c in columns]


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: total, distinct keys (rows with a null in the key left out), largest group, nulls per key column."""
    groups = df.groupBy(*[col(k) for k in keys]).agg(F.count("*").alias("__n"))
    complete = reduce(and_, [col(k).isNotNull() for k in keys])
    nulls = [F.coalesce(F.sum(F.when(col(k).isNull(), F.col("__n"))), F.lit(0)).alias(f"nulls_{i}") for i, k in enumerate(keys)]
    return groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("total"),
        F.count_if(complete).alias("distinct_keys"),
        F.coalesce(F.max("__n"), F.lit(0)).alias("largest"),
        *nulls,
    )


def repeated_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Each row value that occurs more than once, with its number of ``copies``."""
    columns = columns or business_columns(df)
    copies = df.groupBy(*_named(df, columns)).agg(F.count("*").alias("copies"))
    return copies.where(F.col("copies") > 1)


def _named(df: DataFrame, columns: list[str]) -> list:
    return [c.alias(name) for c, name in zip(_hashable(df, columns), columns)]


def surplus_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: how many rows repeat another. Repeated hashes name the suspects, full rows decide."""
    columns = columns or business_columns(df)
    hashed = df.withColumn("__h", F.xxhash64(*_hashable(df, columns)))
    groups = hashed.groupBy("__h").agg(F.count("*").alias("__n"))
    suspects = hashed.join(groups.where(F.col("__n") > 1).select("__h"), "__h", "left_semi")
    return repeated_rows(suspects, columns).agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus"))


def count_table(df: DataFrame, keys: list[str] = ()) -> TableCounts:
    columns = business_columns(df)
    if keys:
        row = key_counts(df, list(keys)).first()
        nulls = {k: row[f"nulls_{i}"] for i, k in enumerate(keys)}
        total, distinct_keys, largest = row["total"], row["distinct_keys"], row["largest"]
    else:
        hashes = df.select(F.xxhash64(*_hashable(df, columns)).alias("__h")).groupBy("__h").agg(F.count("*").alias("__n"))
        row = hashes.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("total"), F.coalesce(F.max("__n"), F.lit(0)).alias("m")).first()
        nulls, total, distinct_keys, largest = {}, row["total"], None, row["m"]
    surplus = 0
    if largest > 1:
        surplus = surplus_rows(df, columns).first()["surplus"]
    return TableCounts(total, total - surplus, distinct_keys, nulls)


# ---- judging -----------------------------------------------------------------------------------------------


def judge_duplicates(counts: TableCounts) -> CheckResult:
    surplus = counts.total - counts.distinct_rows
    if not surplus:
        return CheckResult(fixed.DUPLICATE_CHECK, True, f"all {counts.total} rows are unique")
    message = fixed.DUPLICATES_FAILED.format(dup=surplus, total=counts.total, distinct=counts.distinct_rows)
    return CheckResult(fixed.DUPLICATE_CHECK, False, message, [message])


def judge_row_count(counts: TableCounts) -> CheckResult:
    if counts.total:
        return CheckResult(fixed.COUNT_CHECK, True, f"{counts.total} rows found")
    return CheckResult(fixed.COUNT_CHECK, False, fixed.COUNT_FAILED, [fixed.COUNT_FAILED])


def judge_key(counts: TableCounts, keys: list[str]) -> CheckResult:
    if not keys:
        return CheckResult(fixed.KEY_CHECK, True, "skipped, no primary key configured")
    failed = [fixed.KEY_NULLS_FAILED.format(col=k, n=n) for k, n in counts.key_nulls.items() if n]
    surplus = counts.total - counts.distinct_keys
    if surplus and len(keys) == 1:
        failed.append(fixed.KEY_FAILED.format(col=keys[0], dup=surplus, distinct=counts.distinct_keys, total=counts.total))
    elif surplus:
        failed.append(fixed.COMPOSITE_KEY_FAILED.format(cols=", ".join(keys), dup=surplus))
    details = "; ".join(failed) or f"{keys} unique and non-null over {counts.total} rows"
    return CheckResult(fixed.KEY_CHECK, not failed, details, failed)


def judge_columns(actual: list[str], expected: list[str]) -> CheckResult:
    """Lineage and audit columns belong to the engine and are never unexpected."""
    if not expected:
        return CheckResult(fixed.SCHEMA_CHECK, True, "skipped, no expected columns configured")
    present = set(actual)
    own = AUDIT_COLUMNS | {fixed.LINEAGE_COLUMN}
    failed = [fixed.MISSING_COLUMN.format(col=c) for c in sorted(set(expected) - present)]
    failed += [fixed.UNEXPECTED_COLUMN.format(col=c) for c in sorted(present - set(expected) - own)]
    details = "; ".join(failed) or f"all {len(expected)} expected columns present"
    return CheckResult(fixed.SCHEMA_CHECK, not failed, details, failed)


def run_checks(df: DataFrame, config: dict, strict: bool = False) -> list[CheckResult]:
    """Repeated rows always; the others as configured. ``strict`` raises when any fails."""
    enabled, keys = enabled_checks(config), primary_key(config)
    counts = count_table(df, keys if fixed.KEY_CHECK in enabled else [])
    results = [judge_duplicates(counts)]
    if fixed.COUNT_CHECK in enabled:
        results.append(judge_row_count(counts))
    if fixed.KEY_CHECK in enabled:
        results.append(judge_key(counts, keys))
    if fixed.SCHEMA_CHECK in enabled:
        results.append(judge_columns(df.columns, expected_columns(config)))
    if strict and any(r.failed_checks for r in results):
        raise ChecksFailed(config.get("table_name", "unknown"), results)
    return results


def results_frame(spark: SparkSession, results: list[CheckResult]) -> DataFrame:
    return spark.createDataFrame([(r.name, r.passed, r.details, r.failed_checks) for r in results], RESULT_SCHEMA)


def score(results: DataFrame) -> DataFrame:
    """'passed/total' with the names of the passed and of the failed checks."""

    def names(flag):
        return F.array_join(F.sort_array(F.collect_list(F.when(flag, F.col("name")))), ", ")

    passed = F.count_if(F.col("passed"))
    return results.agg(
        F.concat_ws("/", passed.cast("string"), F.count("*").cast("string")).alias("validation_score"),
        names(F.col("passed")).alias("passed_validations"),
        names(~F.col("passed")).alias("failed_validations"),
    )

