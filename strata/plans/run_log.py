"""Run log: one row per event, a map for whatever else is known, and the fields reports filter on as real columns."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import fixed

LOG_SCHEMA = (
    "timestamp timestamp, log_level string, message string, job_name string, table_name string, "
    "function_name string, status string, additional_data map<string,string>, run_id string, "
    "job_run_id string, layer string"
)


class RunLog:
    """Events of one run. They are kept until ``flush``, which writes them to a folder of the run's own, so runs side by
    side never share a writer's temporary folder."""

    def __init__(self, spark: SparkSession, path: str, job_name: str, run_id: str, job_run_id: str | None = None):
        self.spark, self.path = spark, path
        self.job_name, self.run_id, self.job_run_id = job_name, run_id, job_run_id or run_id
        self.events: list[tuple] = []
        self.flushes = 0

    def event(self, level, message, *, function=None, status=None, table=None, record_count=None, **data) -> None:
        extra = {} if record_count is None else {"record_count": str(record_count)}
        extra |= {k: str(v) for k, v in data.items()}
        now = datetime.now(timezone.utc)
        self.events.append(
            (now, level.upper(), message, self.job_name, table, function, status, extra or None, self.run_id)
            + (self.job_run_id, extra.get("layer"))
        )

    def flush(self) -> None:
        if self.events:
            rows = self.spark.createDataFrame(self.events, LOG_SCHEMA)
            rows.coalesce(1).write.mode("append").parquet(f"{self.path}/{self.run_id}/{self.flushes:04d}")
            self.events, self.flushes = [], self.flushes + 1

    def summary(self, table: str, succeeded: bool, failure_reason=None, dq_message=None) -> None:
        """The outcome event every report starts from."""
        told = {"failure_reason": failure_reason, "dq_message": dq_message}
        outcome = "success" if succeeded else "failed"
        self.event(
            "INFO",
            f"{table}: {outcome}",
            function=fixed.SUMMARY_FUNCTION,
            status=outcome,
            table=table,
            job_run_id=self.job_run_id,
            **{k: v for k, v in told.items() if v},
        )


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", True).parquet(path)


def value_of(key: str):
    return F.try_element_at("additional_data", F.lit(key))
