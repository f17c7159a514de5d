"""Run log and reports. Events stand for outcomes of table runs: a run per day, a table per user."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.catalogue.common import Catalogue, moment, scratch, table
from strata.functions import naming
from strata.functions.wording import clipped, column_in_message, failure_digest
from strata.operators.trusted import TrustedTable
from strata.plans import reports as r
from strata.plans.jobs import publish_board
from strata.plans.run_log import LOG_SCHEMA, read_log, value_of

reports = Catalogue()

CADENCES = ["daily", "weekly", "monthly", "quarterly", "yearly", "adhoc"]
NOW = "2024-02-01 00:00:00"
RUN = "run-2024-01-30"


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three log rows per event: its outcome, the rows loaded, the share of rows kept."""
    e = table(spark, sf_dir, "events")
    run = F.concat(F.lit("run-"), F.date_format("ts", "yyyy-MM-dd"))
    failed, kept = F.col("event_type") == "error", F.floor("value").cast("string")
    total = (F.floor("value") + F.col("event_id") % 3).cast("string")
    reason = F.when(failed, F.concat(F.lit("Error: event "), F.col("event_id").cast("string")))
    message = F.when(failed & (F.col("event_id") % 2 == 0), F.lit("ROW COUNT FAILED"))

    def entry(function, status, layer, **data):
        pairs = [x for k, v in data.items() for x in (F.lit(k), v)]
        return F.struct(
            F.lit(function).alias("function_name"), status.alias("status"), F.create_map(*pairs).alias("additional_data"), F.lit(layer).alias("layer")
        )

    entries = F.array(
        entry("pipeline_summary", F.when(failed, "failed").otherwise("success"), None, job_run_id=run, failure_reason=reason, dq_message=message),
        entry("process_raw_trusted", F.lit("success"), "raw_trusted", record_count=kept),
        entry("process_raw", F.lit("warning"), "dq_completeness", passed_count=kept, total_count=total),
    )
    rows = e.select("*", F.explode(entries).alias("x"))
    log = rows.select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit("INFO").alias("log_level"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("message"),
        F.concat(F.lit("shop_na_us_"), _cadence()).alias("job_name"),
        F.concat(F.lit("t"), F.col("user_id").cast("string")).alias("table_name"),
        "x.function_name",
        "x.status",
        "x.additional_data",
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("run_id"),
        run.alias("job_run_id"),
        "x.layer",
    )
    return log


def _cadence():
    return F.element_at(F.array(*[F.lit(c) for c in CADENCES]), (F.col("user_id") % len(CADENCES) + 1).cast("int"))


_CADENCE_SQL = "['daily','weekly','monthly','quarterly','yearly','adhoc'][user_id % 6 + 1]"
_LATEST = """latest AS (SELECT *, concat('run-', strftime(ts, '%Y-%m-%d')) AS run, event_type = 'error' AS failed FROM events
             QUALIFY row_number() OVER (PARTITION BY date_trunc('day', ts), user_id ORDER BY ts DESC, event_id DESC) = 1)"""
_EXPECTED = """expected AS (SELECT DISTINCT concat('run-', strftime(ts, '%Y-%m-%d')) AS run, user_id AS u FROM events
               UNION ALL SELECT DISTINCT concat('run-', strftime(ts, '%Y-%m-%d')), user_id + 1000000000 FROM events WHERE event_type = 'signup')"""
_REPORT = f"""{_LATEST}, {_EXPECTED}, report AS (
    SELECT e.run AS job_run_id, concat('t', e.u) AS table_name, CASE WHEN l.run IS NULL OR l.failed THEN 'FAILED' ELSE 'SUCCESS' END AS status,
           CAST(floor(l.value) AS BIGINT) AS rows_ingested,
           round(CAST(floor(l.value) AS DOUBLE) / nullif(floor(l.value) + l.event_id % 3, 0), 4) AS dq_score,
           CASE WHEN l.run IS NULL THEN 'No log entry found — task may have crashed before logging'
                WHEN l.failed THEN concat('Error: event ', l.event_id) END AS failure_reason,
           CASE WHEN l.failed AND l.event_id % 2 = 0 THEN 'ROW COUNT FAILED' END AS dq_message
    FROM expected e LEFT JOIN latest l ON e.run = l.run AND e.u = l.user_id)"""


def _expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    run = F.concat(F.lit("run-"), F.date_format("ts", "yyyy-MM-dd")).alias("job_run_id")

    def name(shift):
        return F.concat(F.lit("t"), (F.col("user_id") + shift).cast("string")).alias("table_name")

    untraced = e.where("event_type = 'signup'").select(run, name(1_000_000_000)).distinct()
    return e.select(run, name(0)).distinct().unionByName(untraced)


@reports.query(
    "run_log",
    """SELECT event_id, CAST(floor(value) AS BIGINT) AS record_count, concat('run-', strftime(ts, '%Y-%m-%d')) AS job_run_id FROM events""",
)
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows appended to the log table and read back: a filter on real columns, values out of the map."""
    path = scratch(spark, "log")
    log = event_log(spark, sf_dir)
    assert log.columns == [f.split()[0] for f in LOG_SCHEMA.split(", ")]
    log.write.mode("append").parquet(path)
    loaded = read_log(spark, path).where((F.col("function_name") == "process_raw_trusted") & (F.col("layer") == "raw_trusted"))
    return loaded.select(F.col("run_id").cast("bigint").alias("event_id"), value_of("record_count").cast("bigint").alias("record_count"), "job_run_id")


@reports.query(
    "latest_status",
    f"""WITH {_LATEST} SELECT run AS job_run_id, concat('t', user_id) AS table_name, CASE WHEN failed THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               CASE WHEN failed AND event_id % 2 = 0 THEN 'ROW COUNT FAILED' WHEN failed THEN concat('Error: event ', event_id) ELSE '' END AS error_message
        FROM latest""",
)
def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.table_status(event_log(spark, sf_dir)).drop("job_name")


@reports.query("run_report", f"WITH {_REPORT} SELECT * FROM report")
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every expected table of every run with its newest result; tables without a trace have failed."""
    return r.run_report(_expected(spark, sf_dir), r.table_results(event_log(spark, sf_dir)))


@reports.query(
    "status_rollup",
    f"""WITH {_REPORT}, s AS (SELECT job_run_id, count(*) AS n, count(*) FILTER (WHERE status = 'SUCCESS') AS ok, CAST((2 * sum(CAST(round(dq_score * 10000) AS BIGINT)) + 10 * count(dq_score)) // (20 * count(dq_score)) AS DOUBLE) / 10 AS pct
                              FROM report GROUP BY job_run_id)
        SELECT job_run_id, CAST(n AS BIGINT) AS total_tables, CAST(ok AS BIGINT) AS succeeded_tables, CAST(n - ok AS BIGINT) AS failed_tables,
               CASE WHEN ok < n THEN 'FAILED' ELSE 'SUCCESS' END AS dashboard_status,
               CASE WHEN ok = n THEN 'SUCCESS' WHEN ok = 0 THEN 'FAILED' ELSE 'PARTIAL' END AS email_status,
               CASE WHEN ok = n THEN 'SUCCESS' ELSE 'PARTIAL/FAILED' END AS job_status,
               pct AS dq_pct, concat(printf('%.1f', pct), '%') AS dq_text,
               CASE WHEN pct >= 90 THEN 'green' WHEN pct >= 70 THEN 'amber' ELSE 'red' END AS dq_band FROM s""",
)
def status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.run_rollup(r.run_report(_expected(spark, sf_dir), r.table_results(event_log(spark, sf_dir))))


@reports.query(
    "log_unavailable",
    f"""WITH {_EXPECTED} SELECT run AS job_run_id, concat('t', u) AS table_name, 'FAILED' AS status, CAST(NULL AS BIGINT) AS rows_ingested,
               CAST(NULL AS DOUBLE) AS dq_score, 'Log table unavailable: not found' AS failure_reason, CAST(NULL AS VARCHAR) AS dq_message FROM expected""",
)
def log_unavailable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.log_unavailable(_expected(spark, sf_dir), "not found")


def _control(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    return users.select(
        F.concat(F.lit("shop_na_us_"), _cadence()).alias("job_name"),
        F.concat(F.lit("t"), F.col("user_id").cast("string")).alias("table_name"),
        F.lit("NORTH AMERICA").alias("region"),
        F.lit("US").alias("market"),
        F.lit("SALES").alias("domain"),
        F.lit("SHOP").alias("source_name"),
        F.lit(NOW).cast("timestamp").alias("sync_timestamp"),
    )


@reports.query(
    "freshness",
    f"""WITH {_LATEST}, upd AS (SELECT user_id, max(ts) AS last FROM events WHERE user_id % 10 <> 0 AND event_type <> 'view' GROUP BY user_id),
             aged AS (SELECT l.*, u.last, upper({_CADENCE_SQL.replace('user_id', 'l.user_id')}) AS c,
                             round((epoch_us(TIMESTAMP '{NOW}') - epoch_us(u.last)) / 3600e6, 2) AS age
                      FROM latest l LEFT JOIN upd u ON l.user_id = u.user_id WHERE l.run = '{RUN}')
        SELECT concat('t', user_id) AS table_name, CASE WHEN failed THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               CASE WHEN c = 'ADHOC' THEN 'UNKNOWN' ELSE c END AS cadence, age AS data_age_hours,
               CASE WHEN last IS NULL THEN 'MISSING' WHEN c = 'ADHOC' THEN 'UNKNOWN'
                    WHEN age <= CASE c WHEN 'DAILY' THEN 26 WHEN 'WEEKLY' THEN 170 WHEN 'MONTHLY' THEN 745 WHEN 'QUARTERLY' THEN 2208 ELSE 8760 END
                    THEN 'FRESH' ELSE 'STALE' END AS freshness_status FROM aged""",
)
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status board of one run: tables the run touched, with the age of their data."""
    updates = (
        table(spark, sf_dir, "events")
        .where("user_id % 10 <> 0 AND event_type <> 'view'")
        .groupBy("user_id")
        .agg(F.max("ts").alias("last_table_update_time"))
        .select(
            F.concat(F.lit("shop_na_us_"), _cadence()).alias("job_name"),
            F.concat(F.lit("t"), F.col("user_id").cast("string")).alias("table_name"),
            "last_table_update_time",
        )
    )
    board = r.monitoring_rows(
        _control(spark, sf_dir), r.table_status(event_log(spark, sf_dir), RUN), updates, job_id="1", trigger_type="MANUAL", run_url="", now=NOW
    )
    return board.select("table_name", "status", "cadence", "data_age_hours", "freshness_status")


@reports.query(
    "status_board",
    """SELECT concat('t', user_id) AS table_name,
              concat('run-2024-01-', CASE WHEN bool_or(day(ts) = 30) THEN '30' ELSE '29' END) AS run_id
       FROM events WHERE day(ts) IN (29, 30) GROUP BY user_id""",
)
def status_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The boards of two runs published one after the other: tables the second run left alone keep their row."""
    board, log = TrustedTable(spark, scratch(spark, "board")), event_log(spark, sf_dir)
    none = spark.createDataFrame([], "job_name string, table_name string, last_table_update_time timestamp")
    for run in ("run-2024-01-29", "run-2024-01-30"):
        rows = r.monitoring_rows(_control(spark, sf_dir), r.table_status(log, run), none, job_id="1", trigger_type="MANUAL", run_url="", now=NOW)
        publish_board(rows, board, NOW)
    return board.read().select("table_name", "run_id")


@reports.query(
    "job_of_run",
    f"""SELECT concat('run-', strftime(ts, '%Y-%m-%d')) AS job_run_id, true AS job_known FROM events GROUP BY 1""",
)
def job_of_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = r.job_name_of_run(event_log(spark, sf_dir))
    return named.select("job_run_id", F.col("job_name").startswith("shop_na_us_").alias("job_known"))


@reports.query(
    "receivers",
    """SELECT concat('job_', c_nationkey % 25) AS job_name, CASE WHEN c_nationkey % 5 = 0 THEN 'team@example.org'
              ELSE concat(replace(lower(arg_min(c_name, c_custkey)), '#', ''), '@example.org,second@mail.example.org') END AS receivers
       FROM customer GROUP BY c_nationkey""",
)
def receivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of each job from its first active control row: trimmed, plausible, without repeats, or the fallback."""
    own = F.concat(F.lit(" "), F.replace(F.lower("c_name"), F.lit("#"), F.lit("")), F.lit("@example.org "))
    given = F.array(own, F.lit("nobody"), F.lit("second@mail.example.org"), F.lit(None).cast("string"), F.trim(own), F.lit("a.b@c"))
    emails = F.when(F.col("c_nationkey") % 5 == 0, F.array(F.lit("nobody"), F.lit(""))).otherwise(given)
    twice = table(spark, sf_dir, "customer").withColumn("active", F.explode(F.array(F.lit(True), F.lit(False))))
    control = twice.select(
        F.concat(F.lit("job_"), F.col("c_nationkey").cast("string")).alias("job_name"),
        F.lpad(F.col("c_custkey").cast("string"), 20, "0").alias("table_name"),
        F.col("active").alias("is_active"),
        F.struct(F.when(F.col("active"), emails).otherwise(F.array(F.lit("off@example.org"))).alias("emails")).alias("notify"),
    )
    return r.receivers(control, ["team@example.org"]).withColumn("receivers", F.array_join("receivers", ","))


@reports.query(
    "job_names",
    """SELECT c_custkey, concat(lower(c_mktsegment), '_', r, 'us_', c) AS job_key,
              CASE WHEN c = 'adhoc' THEN 'UNKNOWN' ELSE upper(c) END AS cadence,
              concat(lower(c_mktsegment), CASE WHEN r = 'me_' THEN '_me_us' ELSE '_us' END, CASE WHEN c = 'adhoc' THEN '_adhoc' ELSE '' END) AS job_schema
       FROM (SELECT *, ['daily','weekly','monthly','quarterly','yearly','adhoc'][c_custkey % 6 + 1] AS c,
                    ['na_','eu_','apac_','me_'][c_nationkey % 4 + 1] AS r FROM customer)""",
)
def job_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key, cadence and schema out of job names such as JOB_MACHINERY_EU_US_DAILY."""
    infix = F.element_at(F.array(*[F.lit(x) for x in ("_NA_", "_EU_", "_APAC_", "_ME_")]), F.col("c_nationkey") % 4 + 1)
    cadence = F.element_at(F.array(*[F.lit(c.upper()) for c in CADENCES]), (F.col("c_custkey") % 6 + 1).cast("int"))
    job = F.concat(F.lit("JOB_"), F.upper("c_mktsegment"), infix, F.lit("US_"), cadence)
    return table(spark, sf_dir, "customer").select(
        "c_custkey", naming.job_key(job, "JOB_").alias("job_key"), naming.cadence(job).alias("cadence"), naming.job_schema(job, "JOB_").alias("job_schema")
    )


@reports.query(
    "failure_texts",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'o_custkey' ELSE 'N/A' END AS column_name,
              concat('first ', o_orderkey, ' | second | third') AS digest, left(concat(o_orderpriority, repeat('x', 300)), 150) AS clipped FROM orders""",
)
def failure_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    message = F.when(F.col("o_orderkey") % 2 == 0, "column 'o_custkey' has 3 NULLs, column 'other' too").otherwise("no rows")
    failed = F.array(F.concat(F.lit("first "), key), F.lit("second"), F.lit("third"), F.lit("fourth"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        column_in_message(message).alias("column_name"),
        failure_digest(failed, 3).alias("digest"),
        clipped(F.concat("o_orderpriority", F.repeat(F.lit("x"), 300)), 150).alias("clipped"),
    )
