"""Jobs: registering configs, running all tables of a job, publishing the status board."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.schema import align_to
from strata.operators.snapshots import ensure_namespace
from strata.operators.trusted import TrustedTable
from strata.plans import config as cfg
from strata.plans import reports
from strata.plans.run_log import read_log
from strata.plans.table_run import run_table
from strata.session import scratch_dir, session_like

MAX_PARALLEL_TABLES = 100


def ensure_table(spark: SparkSession, name: str, schema: str) -> None:
    """Creates ``catalog.schema.table`` as Parquet if it is not there (run log, control table)."""
    ensure_namespace(spark, name)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet")


def require_valid(configs: DataFrame) -> None:
    """Fails when any config breaks a rule, naming some of them and how many there are."""
    broken = cfg.config_errors(configs).where(F.size("errors") > 0).select("job_name", "table_name", "errors")
    count = broken.count()
    if count:
        path = scratch_dir(broken.sparkSession, "broken-configs")
        broken.write.json(path)
        told = "; ".join(f"{r.job_name}/{r.table_name}: {', '.join(r.errors)}" for r in broken.take(3))
        raise ValueError(f"{count} broken config(s), all of them in {path}; the first are {told}")


def register_configs(configs: DataFrame, control: TrustedTable, now: str) -> int:
    """Valid config texts into the control table, one row per job and table; a config seen before is replaced."""
    require_valid(configs)
    rows = cfg.control_rows(configs, now)
    wanted = control.schema() if control.exists() else T.StructType.fromDDL(cfg.CONTROL_SCHEMA)
    return control.upsert_all(align_to(rows, wanted), ["job_name", "table_name"], now=now)


def publish_board(rows: DataFrame, board: TrustedTable, now: str | None = None) -> int:
    """Status rows into the board, one per job and table; rows of tables this run did not touch stay."""
    return board.upsert_all(rows, ["job_id", "table_name"], now=now)


def refresh_board(spark: SparkSession, control: DataFrame, base: str, board: TrustedTable, *, job_run_id: str, job_id: str, now: str, **shown) -> int:
    """The status board of one run: statuses from the run log, ages from the tables themselves."""
    statuses = reports.table_status(read_log(spark, f"{base.rstrip('/')}/run_log"), job_run_id)
    shown = {"trigger_type": "MANUAL", "run_url": "", **shown}
    rows = reports.monitoring_rows(control, statuses, reports.last_updates(spark, control, base), job_id=job_id, now=now, **shown)
    return publish_board(rows, board, now)


def run_job(spark: SparkSession, control: DataFrame, job_name: str, base: str, tables: list[str] | None = None, parallel: int = 4, **options) -> dict:
    """Runs the active tables of a job, some at a time, and returns {table: number of the load or the exception} under ``tables``.

    A failing table does not stop the others. All of them log under one ``job_run_id``, which is returned. Named tables
    without a control row are reported under ``missing``.
    """
    options = {"job_run_id": f"{job_name}-{uuid.uuid4().hex[:12]}", **options}
    rows = cfg.active_rows(control, job_name)
    missing: list[str] = []
    if tables:
        names = spark.createDataFrame([(t,) for t in tables], "table_name string")
        rows, absent = cfg.pick_tables(rows, names)
        missing = [r.table_name for r in absent.orderBy("table_name").collect()]
    configs = [cfg.config_of_row(row) for row in rows.collect()]
    if not configs:
        raise ValueError(f"no active config for job '{job_name}'" + (f" among {tables}" if tables else ""))

    def run(config: dict):
        try:
            return run_table(session_like(spark), config, base, **options)
        except Exception as failure:
            return failure

    with ThreadPoolExecutor(max_workers=min(len(configs), parallel, MAX_PARALLEL_TABLES)) as pool:
        outcomes = dict(zip([c["table_name"] for c in configs], pool.map(run, configs)))
    return {"job_run_id": options["job_run_id"], "tables": outcomes, "missing": missing}
