"""Arrival-driven ingestion, and batch runs that archive what they loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.catalogue.common import Catalogue, moment, scratch, table
from strata.catalogue.workbook_maker import workbook_bytes
from strata.operators.trusted import TrustedTable
from strata.plans.config import locations
from strata.plans.table_run import run_table
from strata.session import ship_package
from strata.sources.folders import matching, source_files, write_bytes
from strata.streaming.arrivals import ingest_arrivals

arrivals = Catalogue()

COLUMNS = ["eventId", "at", "Event Type", "value"]


def events_config(source_path: str) -> dict:
    return {
        "job_name": "shop_na_us_daily",
        "table_name": "events",
        "region": "NA",
        "market": "US",
        "domain": "WEB",
        "source_name": "SHOP",
        "ingestion_steps": {
            "landing": {"source_path": source_path, "file_format": "csv", "pii_columns": []},
            "raw": {"schema_config": "enforce", "deduplication": True},
            "raw_trusted": {"load_type": "append", "primary_key": ["event_id"], "schema_evolution": False},
        },
        "schema": [
            {"column_name": "event_id", "data_type": "bigint"},
            {"column_name": "at", "data_type": "timestamp"},
            {"column_name": "event_type", "data_type": "string"},
            {"column_name": "value", "data_type": "double"},
        ],
    }


@arrivals.query("file_arrival", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, event_type, value FROM events")
def file_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of events, the stream run after each and once more when nothing is new."""
    base, events = scratch(spark, "arrivals"), table(spark, sf_dir, "events")
    settings = events_config(f"{base}/staging")
    rows = events.select(F.col("event_id").alias("eventId"), moment("ts").alias("at"), F.col("event_type").alias("Event Type"), "value")
    for parity in (0, 1):
        rows.where(F.col("eventId") % 2 == parity).write.mode("append").option("header", True).csv(f"{base}/staging/EVENTS")
        ingest_arrivals(spark, settings, base, f"{base}/checkpoint", COLUMNS, available_now=True).awaitTermination()
    ingest_arrivals(spark, settings, base, f"{base}/checkpoint", COLUMNS, available_now=True).awaitTermination()
    trusted = TrustedTable(spark, locations(settings, "", base)["raw_trusted"]).read()
    return trusted.select("event_id", moment("at").alias("at"), "event_type", "value")


@arrivals.query(
    "batch_archive",
    "SELECT event_id, event_type, value, true AS nothing_left FROM events",
)
def batch_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, each appended by a batch run that archives it: no row is loaded twice and no file stays."""
    base, events = scratch(spark, "batch-archive"), table(spark, sf_dir, "events")
    settings = events_config(f"{base}/staging")
    rows = events.select(F.col("event_id").alias("eventId"), moment("ts").alias("at"), F.col("event_type").alias("Event Type"), "value")
    for parity in (0, 1):
        rows.where(F.col("eventId") % 2 == parity).write.mode("append").option("header", True).csv(f"{base}/staging/EVENTS")
        run_table(spark, settings, base, archive=f"{base}/archive")
    left = source_files(spark, f"{base}/staging/EVENTS")
    trusted = TrustedTable(spark, locations(settings, "", base)["raw_trusted"]).read()
    return trusted.select("event_id", "event_type", "value", F.lit(not left).alias("nothing_left"))


def _format_config(staging: str, file_format: str, **options) -> dict:
    config = events_config(staging)
    config["table_name"] = f"events_{file_format}"
    config["ingestion_steps"]["landing"] |= {"file_format": file_format, **options}
    return config


@arrivals.query(
    "file_arrival_formats",
    """SELECT CASE WHEN event_id % 2 = 0 THEN 'json' ELSE 'parquet' END AS format, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, event_type, value FROM events
       UNION ALL SELECT 'excel', s_suppkey, '2024-01-01 00:00:00', s_name, CAST(s_nationkey AS DOUBLE) FROM supplier""",
)
def file_arrival_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams of JSON, Parquet and workbook files, each in two deliveries and a look when nothing is new."""
    base, events = scratch(spark, "arrival-formats"), table(spark, sf_dir, "events")
    rows = events.select("event_id", moment("ts").alias("at"), "event_type", "value")
    typed = rows.withColumn("at", F.to_timestamp("at"))
    books = table(spark, sf_dir, "supplier").withColumn("book", F.floor(F.col("s_suppkey") / 400))
    configs = [
        _format_config(f"{base}/staging", "json", json_options={"multiLine": False}),
        _format_config(f"{base}/staging", "parquet"),
        _format_config(f"{base}/staging", "excel", excel_options={"sheet_name": "Data", "header_row": 1, "data_start_row": 2}),
    ]
    found = None
    for config, deliver in zip(
        configs,
        (
            lambda half, folder: rows.where((F.col("event_id") % 2 == 0) & half(F.col("event_id"))).write.mode("append").json(folder),
            lambda half, folder: typed.where((F.col("event_id") % 2 == 1) & half(F.col("event_id"))).write.mode("append").parquet(folder),
            lambda half, folder: _deliver_workbooks(books.where(half(F.col("book") * 4)), folder),
        ),
        strict=True,
    ):
        name = config["table_name"]
        for parity in (0, 1):
            deliver(lambda key, p=parity: F.floor(key / 4) % 2 == p, f"{base}/staging/{name.upper()}")
            ingest_arrivals(spark, config, base, f"{base}/checkpoint/{name}", available_now=True).awaitTermination()
        ingest_arrivals(spark, config, base, f"{base}/checkpoint/{name}", available_now=True).awaitTermination()
        trusted = TrustedTable(spark, locations(config, "", base)["raw_trusted"]).read()
        part = trusted.select(F.lit(name.removeprefix("events_")).alias("format"), "event_id", moment("at").alias("at"), "event_type", "value")
        found = part if found is None else found.unionByName(part)
    return found


def _deliver_workbooks(books: DataFrame, folder: str) -> None:
    """A workbook of suppliers per value of ``book``, of at most 400 rows, packed in tasks and copied one by one."""

    def pack(key, pdf):
        import pandas as pd

        rows = [["event_id", "at", "event_type", "value"]]
        rows += [[int(r.s_suppkey), "2024-01-01 00:00:00", r.s_name, float(r.s_nationkey)] for r in pdf.itertuples()]
        return pd.DataFrame({"book": [int(key[0])], "content": [workbook_bytes({"Data": rows})]})

    spark = books.sparkSession
    ship_package(spark)
    packed = books.groupBy("book").applyInPandas(pack, "book long, content binary")
    for row in packed.toLocalIterator():
        write_bytes(spark, f"{folder}/suppliers_{row.book}.xlsx", bytes(row.content))


@arrivals.query(
    "file_arrival_two_checkpoints",
    "SELECT event_id, event_type, CAST(2 AS BIGINT) AS landing_folders, CAST(2 AS BIGINT) AS raw_folders FROM events",
)
def file_arrival_two_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams, one after the other, into one table: the second one's batch 0 replaces nothing of the first one's."""
    base, events = scratch(spark, "two-streams"), table(spark, sf_dir, "events")
    rows = events.select(F.col("event_id").alias("eventId"), moment("ts").alias("at"), F.col("event_type").alias("Event Type"), "value")
    for parity in (0, 1):
        settings = events_config(f"{base}/staging{parity}")
        rows.where(F.col("eventId") % 2 == parity).write.option("header", True).csv(f"{base}/staging{parity}/EVENTS")
        ingest_arrivals(spark, settings, base, f"{base}/checkpoint{parity}", COLUMNS, available_now=True).awaitTermination()
    at = locations(settings, "", base)
    folders = {layer: len(matching(spark, f"{at[f'{layer}_runs']}/*/_SUCCESS")) for layer in ("landing", "raw")}
    trusted = TrustedTable(spark, at["raw_trusted"]).read()
    counts = [F.lit(n).cast("long").alias(f"{layer}_folders") for layer, n in folders.items()]
    return trusted.select("event_id", "event_type", *counts)
