"""Reports over the run log and the control table. Each is one query; nothing is looked up table by table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata import fixed
from strata.functions import naming
from strata.functions.text import namespace
from strata.functions.wording import email_list, percent_text, score_band
from strata.operators.trusted import DEFINITION
from strata.plans.run_log import value_of
from strata.sources import folders


def latest_per(df: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """The newest row of each key. Spark keeps one row per key and task before the shuffle, so a busy key is cheap."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("__place", place).where("__place = 1").drop("__place")


def _newest() -> list[Column]:
    return [F.col("timestamp").desc(), F.col("run_id").desc()]


def summaries(log: DataFrame, job_run_id: str | None = None) -> DataFrame:
    """Newest outcome event per job, run and table."""
    events = log.where(F.col("function_name") == fixed.SUMMARY_FUNCTION)
    if job_run_id is not None:
        events = events.where(F.col("job_run_id") == job_run_id)
    return latest_per(events, ["job_run_id", "job_name", "table_name"], _newest())


def completeness(passed: Column, total: Column) -> Column:
    """Share of rows kept, 4 decimals; null when there were none."""
    return F.round(passed / F.nullif(total, F.lit(0)), 4)


def table_results(log: DataFrame, job_run_id: str | None = None) -> DataFrame:
    """Per run and table: status, rows loaded, completeness score, reason. One pass over the log for the metrics."""
    summary = summaries(log, job_run_id).select(
        "job_run_id",
        "table_name",
        "run_id",
        F.when(F.col("status") == "success", "SUCCESS").otherwise("FAILED").alias("status"),
        F.nullif(value_of("failure_reason"), F.lit("")).alias("failure_reason"),
        F.nullif(value_of("dq_message"), F.lit("")).alias("dq_message"),
    )
    loaded = (F.col("function_name") == "process_raw_trusted") & (F.col("status") == "success") & (F.col("layer") == "raw_trusted")
    scored = (F.col("function_name") == "process_raw") & (F.col("layer") == "dq_completeness")
    metric_rows = log.where(loaded | scored)
    if job_run_id is not None:
        metric_rows = metric_rows.where(F.col("job_run_id") == job_run_id)
    metrics = (
        metric_rows.withColumn("kind", F.when(loaded, "loaded").otherwise("scored"))
        .select(
            "run_id",
            "table_name",
            "kind",
            "timestamp",
            value_of("record_count").try_cast("bigint").alias("rows"),
            value_of("passed_count").try_cast("bigint").alias("passed"),
            value_of("total_count").try_cast("bigint").alias("total"),
        )
    )
    newest = latest_per(metrics, ["run_id", "table_name", "kind"], [F.col("timestamp").desc()])
    per_table = newest.groupBy("run_id", "table_name").agg(
        F.max(F.when(F.col("kind") == "loaded", F.col("rows"))).alias("rows_ingested"),
        F.max(F.when(F.col("kind") == "scored", completeness(F.col("passed"), F.col("total")))).alias("dq_score"),
    )
    return summary.join(per_table, ["run_id", "table_name"], "left").select(
        "job_run_id", "table_name", "status", "rows_ingested", "dq_score", "failure_reason", "dq_message"
    )


def run_report(expected: DataFrame, results: DataFrame) -> DataFrame:
    """``expected`` (job_run_id, table_name) with its results; a table that left no trace has failed."""
    traced = results.withColumn("__traced", F.lit(True))
    joined = expected.join(traced, ["job_run_id", "table_name"], "left")
    return joined.select(
        "job_run_id",
        "table_name",
        F.coalesce("status", F.lit("FAILED")).alias("status"),
        "rows_ingested",
        "dq_score",
        F.when(F.col("__traced"), F.col("failure_reason")).otherwise(fixed.NO_LOG_ENTRY).alias("failure_reason"),
        "dq_message",
    )


def log_unavailable(expected: DataFrame, reason: str) -> DataFrame:
    """The report when the log itself cannot be read: every table failed, for that reason."""
    return expected.select(
        "job_run_id",
        "table_name",
        F.lit("FAILED").alias("status"),
        F.lit(None).cast("bigint").alias("rows_ingested"),
        F.lit(None).cast("double").alias("dq_score"),
        F.lit(f"Log table unavailable: {reason}").alias("failure_reason"),
        F.lit(None).cast("string").alias("dq_message"),
    )


def run_rollup(report: DataFrame) -> DataFrame:
    """One row per run: counts, the three status readings, mean score with its text and band."""
    ok, failed = F.col("status") == "SUCCESS", F.col("status") == "FAILED"
    rolled = report.groupBy("job_run_id").agg(
        F.count("*").alias("total_tables"),
        F.count_if(ok).alias("succeeded_tables"),
        F.count_if(~ok).alias("failed_tables"),
        F.when(F.bool_or(failed), "FAILED").when(F.bool_and(ok), "SUCCESS").otherwise("UNKNOWN").alias("dashboard_status"),
        F.when(F.bool_and(ok), "SUCCESS").when(F.bool_and(failed), "FAILED").otherwise("PARTIAL").alias("email_status"),
        F.when(F.bool_and(ok), "SUCCESS").otherwise("PARTIAL/FAILED").alias("job_status"),
        F.round(F.avg(F.col("dq_score").cast("decimal(9,4)")) * 100, 1).cast("double").alias("dq_pct"),
    )
    return rolled.withColumns({"dq_text": percent_text(F.col("dq_pct")), "dq_band": score_band(F.col("dq_pct"))})


def table_status(log: DataFrame, job_run_id: str | None = None) -> DataFrame:
    """Newest status per job, run and table, upper-cased, with the message to show."""
    newest = summaries(log, job_run_id).where(F.coalesce(F.col("table_name"), F.lit("")) != "")
    message = F.coalesce(F.nullif(value_of("dq_message"), F.lit("")), value_of("failure_reason"), F.lit(""))
    return newest.select(
        "job_run_id",
        "job_name",
        "table_name",
        F.upper(F.coalesce("status", F.lit("UNKNOWN"))).alias("status"),
        message.alias("error_message"),
    )


def monitoring_rows(
    control: DataFrame, statuses: DataFrame, last_updates: DataFrame, *, job_id: str, trigger_type: str, run_url: str, now, prefix=""
) -> DataFrame:
    """Rows of the status board: control rows of tables this run touched, with status and freshness.

    A status belongs to a table of its own job, for jobs may have tables of the same name. ``last_updates`` is (job_name,
    table_name, last_table_update_time). Tables without a status are left alone.
    """
    moment = F.lit(now).cast("timestamp")
    board = control.join(statuses, ["job_name", "table_name"], "inner").join(last_updates, ["job_name", "table_name"], "left")
    cadence = naming.cadence(F.col("job_name"))
    updated = F.col("last_table_update_time").cast("timestamp")
    age = naming.data_age_hours(updated, moment)
    return board.select(
        F.lit(job_id).alias("job_id"),
        "job_name",
        F.col("job_run_id").alias("run_id"),
        "status",
        "error_message",
        F.lit(trigger_type).alias("trigger_type"),
        F.lit(run_url).alias("run_url"),
        "table_name",
        "region",
        "market",
        "domain",
        "source_name",
        "sync_timestamp",
        cadence.alias("cadence"),
        updated.alias("last_table_update_time"),
        age.alias("data_age_hours"),
        naming.freshness(updated, age, naming.cadence_hours(cadence)).alias("freshness_status"),
        moment.alias("refresh_timestamp"),
    )


def last_updates(spark: SparkSession, control: DataFrame, base: str) -> DataFrame:
    """(job_name, table_name, last_table_update_time) of the control table's trusted tables below ``base``, out of the tables'
    own definitions in one read. Tables that were never loaded are left out."""
    pattern = f"{base.rstrip('/')}/trusted/*/*/{DEFINITION}"
    told = "table struct<root: string, loaded_at: string>"
    if folders.matching(spark, pattern):
        definitions = spark.read.schema(told).option("multiLine", True).json(pattern)
    else:
        definitions = spark.createDataFrame([], told)
    place = F.split("table.root", "/")
    loaded = definitions.select(
        F.element_at(place, -2).alias("__schema"), F.element_at(place, -1).alias("table_name"), F.col("table.loaded_at").cast("timestamp").alias("last_table_update_time")
    )
    wanted = control.select("job_name", "table_name", namespace(F.col("source_name"), F.col("market")).alias("__schema"))
    return wanted.join(loaded, ["__schema", "table_name"]).drop("__schema")


def job_name_of_run(log: DataFrame) -> DataFrame:
    """(job_run_id, job_name) from the outcome events."""
    events = log.where((F.col("function_name") == fixed.SUMMARY_FUNCTION) & F.col("job_name").isNotNull())
    return events.groupBy("job_run_id").agg(F.any_value("job_name", True).alias("job_name"))


def notify_settings(control: DataFrame, job_name: str, prefix: str = "") -> list[str]:
    """Addresses configured for a job, from one of its active control rows; none configured is an error."""
    wanted = naming.job_key(F.lit(job_name), prefix)
    row = control.where(F.col("is_active") & (F.col("job_name") == wanted)).select(_emails(control).alias("e")).limit(1).first()
    if row is None or row["e"] is None:
        raise ValueError(f"no notify settings for job '{job_name}'")
    return row["e"]


def _emails(control: DataFrame) -> Column:
    """The address list, whether notify is a struct or JSON text."""
    if control.schema["notify"].dataType.simpleString() == "string":
        return F.from_json("notify", "struct<emails:array<string>>")["emails"]
    return F.col("notify.emails")


def receivers(control: DataFrame, fallback: list[str] = ()) -> DataFrame:
    """(job_name, receivers) over all jobs with active rows. Jobs have one list, so one row per job stands for all."""
    per_job = latest_per(control.where("is_active"), ["job_name"], [F.col("table_name")])
    return per_job.select("job_name", email_list(_emails(control), fallback).alias("receivers"))
