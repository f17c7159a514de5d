"""Arrival-driven ingestion: files that appear in a folder start a table run.

The stream's checkpoint remembers which files were taken, so each is ingested once; every micro-batch runs the layers
under its own batch id, so a batch repeated after a failure replaces its earlier rows. Files are archived by the source
itself, and only those it has read.
"""

from __future__ import annotations

import functools
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata import fixed
from strata.functions.parsing import spark_type
from strata.functions.text import col
from strata.operators.schema import schema_entries
from strata.plans.table_run import run_table
from strata.sources import folders
from strata.sources.landing_files import landing_settings
from strata.sources.readers import format_name
from strata.sources.workbook import PATH_COLUMN, read_workbooks

MIN_SECONDS_BETWEEN_RUNS = 300


def arriving_rows(spark: SparkSession, config: dict, columns: list[str] | None = None, archive: str | None = None) -> DataFrame:
    """New files of a table's source folder as a stream of rows with lineage; workbooks as a stream of whole files.

    CSV rows are texts under the headers ``columns``, with the line of a malformed row; JSON fields are texts as well, Parquet
    columns have the types of the config's schema.
    """
    landing = config["ingestion_steps"]["landing"]
    folder, kind = f"{landing['source_path'].rstrip('/')}/{config['table_name'].upper()}", format_name(landing["file_format"])
    options = {k: v for k, v in landing_settings(landing)[0].items() if k != "excel_options"}
    if archive:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive}
    if kind == "excel":
        schema = "path string, modificationTime timestamp, length long, content binary"
        return spark.readStream.format("binaryFile").schema(schema).options(**options, pathGlobFilter="*.[xX][lL][sS][xXmM]").load(folder)
    if kind not in ("csv", "json", "parquet"):
        raise ValueError(f"no stream of '{kind}' files; supported: csv, excel, json, parquet")
    entries = schema_entries(config.get("schema"))
    names = list(columns or [e["column_name"] for e in entries])
    if not names:
        raise ValueError(f"a stream of {kind} files needs columns or a schema in the config")
    types = {e["column_name"]: spark_type(e["data_type"]) for e in entries} if kind == "parquet" else {}
    fields = [f"`{c}` {types.get(c) or 'string'}" for c in names]
    if kind == "csv":
        names, fields = [*names, fixed.MALFORMED_COLUMN], [*fields, f"`{fixed.MALFORMED_COLUMN}` string"]
        suffix = {"pathGlobFilter": "*.[cC][sS][vV]", "enforceSchema": False}
        options = {**fixed.CSV_READ_DEFAULTS, **suffix, **options, "columnNameOfCorruptRecord": fixed.MALFORMED_COLUMN}
    elif kind == "json":
        options = {**fixed.JSON_READ_DEFAULTS, **options}
    options = {k: v for k, v in options.items() if v is not None}
    stream = spark.readStream.format(kind).schema(", ".join(fields)).options(**options).load(folder)
    return stream.select(*[col(c) for c in names], F.col("_metadata.file_name").alias(fixed.LINEAGE_COLUMN))


def workbook_rows(files: DataFrame, config: dict) -> DataFrame:
    """Rows of the workbooks of one micro-batch."""
    options = dict(landing_settings(config["ingestion_steps"]["landing"])[0].get("excel_options") or {})
    rows = read_workbooks(files.select("path", "content"), options)
    return rows.withColumn(fixed.LINEAGE_COLUMN, F.element_at(F.split(F.col(PATH_COLUMN), "/"), -1)).drop(PATH_COLUMN)


def ingest_arrivals(
    spark: SparkSession,
    config: dict,
    base: str,
    checkpoint: str,
    columns: list[str] | None = None,
    *,
    archive: str | None = None,
    available_now: bool = False,
    **run_options,
) -> StreamingQuery:
    """Starts the stream for one table. ``columns`` are the headers of CSV files. Runs are at least 300 s apart;
    ``available_now`` takes what is there and ends. Batches and layer folders carry the stream's own id, which its checkpoint
    keeps, so another stream, whose batch numbers start anew, never replaces them."""
    files = arriving_rows(spark, config, columns, archive)
    workbooks = format_name(config["ingestion_steps"]["landing"]["file_format"]) == "excel"

    @functools.cache
    def stream_id() -> str:
        return json.loads(folders.read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        rows = workbook_rows(batch, config) if workbooks else batch
        run_ts = f"batch_{stream_id()[:8]}_{batch_id:012d}"
        run_table(spark, config, base, rows=rows, run_ts=run_ts, batch_id=f"{stream_id()}-{batch_id}", **run_options)

    trigger = {"availableNow": True} if available_now else {"processingTime": f"{MIN_SECONDS_BETWEEN_RUNS} seconds"}
    return files.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run_batch).trigger(**trigger).start()
