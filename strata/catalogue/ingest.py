"""Sources and file layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import fixed
from strata.catalogue.common import Catalogue, moment, scratch, table
from strata.catalogue.workbook_maker import workbook_bytes
from strata.sources import payload, readers
from strata.sources.folders import latest_run
from strata.sources.landing_files import read_source_files, reader_options
from strata.sources.producers import producer, run_producer
from strata.session import ship_package
from strata.sources.workbook import read_workbooks

ingest = Catalogue()


@ingest.query(
    "csv_scan",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
              o_orderpriority FROM orders""",
)
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as CSV, read with the source defaults: every column is text."""
    path = scratch(spark, "csv")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    table(spark, sf_dir, "orders").select(columns).write.option("header", True).csv(path)
    return readers.reader_for(" CSV ")(spark, path, **reader_options({"file_format": "csv", "csv_options": {"delimiter": ","}}))


@ingest.query("json_scan", "SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer")
def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "json")
    table(spark, sf_dir, "customer").write.json(path)
    return readers.read_json(spark, path, multiLine=False).select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")


@ingest.query("parquet_scan", "SELECT p_partkey, p_name, p_brand, CASE WHEN p_size > 25 THEN p_type END AS p_type FROM part")
def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders of files with different columns under one root, read with merged schema."""
    path, part = scratch(spark, "parquet"), table(spark, sf_dir, "part")
    readers.write_parquet(part.where("p_size > 25").select("p_partkey", "p_name", "p_brand", "p_type"), f"{path}/a")
    readers.write_parquet(part.where("p_size <= 25").select("p_partkey", "p_name", "p_brand"), f"{path}/b")
    return readers.read_parquet(spark, path).select("p_partkey", "p_name", "p_brand", "p_type")


@ingest.query(
    "landing_csv_round_trip",
    """SELECT doc_id, lang, CAST(length(text) AS BIGINT) AS n, sha256(text) AS digest FROM documents
       UNION ALL SELECT -1 - doc_id, '', NULL, NULL FROM documents""",
)
def landing_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes, commas and line breaks, empty strings and nulls come back from Landing as they were."""
    path, documents = scratch(spark, "landing"), table(spark, sf_dir, "documents")
    blank = documents.select((F.lit(-1) - F.col("doc_id")).alias("doc_id"), F.lit("").alias("lang"), F.lit(None).cast("string").alias("text"))
    readers.write_csv(documents.select("doc_id", "lang", "text").unionByName(blank), path)
    back = readers.read_landing_csv(spark, path)
    return back.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "lang",
        F.length("text").cast("bigint").alias("n"),
        F.sha2("text", 256).alias("digest"),
    )


@ingest.query(
    "xlsx_scan",
    """SELECT CAST(c_custkey AS VARCHAR) AS "Cust Key", c_name AS "Name", CAST(c_nationkey AS VARCHAR) AS "Nation"
       FROM customer""",
)
def xlsx_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer in workbooks of up to 500 rows: title rows, header in row 3, a gap, an unused column, a blank column."""

    def pack(key, pdf):
        import pandas as pd

        rows = [["Customers"], [], [None, "Cust Key", "Name", "", "Nation", "Ignored"], ["gap"]]
        for r in pdf.itertuples():
            rows += [[None, int(r.c_custkey), r.c_name, None, int(r.c_nationkey), "x"]]
        return pd.DataFrame({"path": [f"customers-{key[0]}.xlsx"], "content": [workbook_bytes({"Info": [["nothing"]], "Data": rows})]})

    ship_package(spark)
    path = scratch(spark, "workbooks")
    blocks = table(spark, sf_dir, "customer").withColumn("block", F.floor(F.col("c_custkey") / 500))
    blocks.groupBy("block").applyInPandas(pack, "path string, content binary").write.parquet(path)
    options = {"sheet_name": "Data", "header_row": 3, "data_start_row": 5, "usecols": "B:E"}
    return read_workbooks(spark.read.parquet(path), options).drop("__path")


def _deliver_by_status(spark: SparkSession, sf_dir: str, path: str) -> None:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    for status, columns in (("F", ["o_orderkey", "o_orderstatus", "o_totalprice"]), ("O", ["o_totalprice", "o_orderkey", "o_orderstatus"])):
        rows = orders.where(F.col("o_orderstatus") == status).select(columns)
        rows.write.mode("append").option("header", True).csv(path)
    rest = orders.where(~F.col("o_orderstatus").isin("F", "O")).withColumn("note", F.lit("extra"))
    rest.write.mode("append").option("header", True).csv(path)


@ingest.query(
    "multi_file_lineage",
    """SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS row_count, CAST(sum(o_orderkey) AS BIGINT) AS key_sum,
              CAST(count(*) FILTER (WHERE o_orderstatus NOT IN ('F','O')) AS BIGINT) AS noted, true AS one_status_per_file
       FROM orders GROUP BY o_orderstatus""",
)
def multi_file_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with another column order and with an extra column, united by name, each row tagged with its file."""
    path = scratch(spark, "files")
    _deliver_by_status(spark, sf_dir, path)
    rows = read_source_files(spark, path, "csv", {}, drift="allow")
    per_file = rows.groupBy(fixed.LINEAGE_COLUMN, "o_orderstatus").agg(
        F.count("*").alias("n"), F.sum(F.col("o_orderkey").cast("bigint")).alias("k"), F.count("note").alias("noted")
    )
    statuses = per_file.groupBy(fixed.LINEAGE_COLUMN).agg(F.count("*").alias("statuses"))
    return (
        per_file.join(statuses, fixed.LINEAGE_COLUMN)
        .groupBy("o_orderstatus")
        .agg(
            F.sum("n").alias("row_count"),
            F.sum("k").alias("key_sum"),
            F.sum("noted").alias("noted"),
            (F.max("statuses") == 1).alias("one_status_per_file"),
        )
    )


@ingest.query("latest_run_scan", "SELECT s_suppkey, s_name FROM supplier")
def latest_run_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two completed runs and a later one without its success mark, the newer completed run is read."""
    base, supplier = scratch(spark, "runs"), table(spark, sf_dir, "supplier")
    readers.write_parquet(supplier.select("s_suppkey", F.lit("old").alias("s_name")), f"{base}/20240101_000000")
    readers.write_parquet(supplier.select("s_suppkey", "s_name"), f"{base}/20240201_000000")
    unfinished = supplier.select("s_suppkey", F.lit("partial").alias("s_name")).write
    unfinished.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{base}/20240301_000000")
    return spark.read.parquet(latest_run(spark, base))


@ingest.query(
    "producer_source",
    "SELECT p_brand, CAST(count(*) AS BIGINT) AS parts, 'notebook' AS source_file_name, 'parts' AS asked_for FROM part GROUP BY p_brand",
)
def producer_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    @producer("brand_counts")
    def brand_counts(session, params):
        counts = table(session, params["folder"], "part").groupBy("p_brand").agg(F.count("*").alias("parts"))
        return counts.withColumn("asked_for", F.lit(params["table_name"]))

    landing = {"notebook_path": "brand_counts", "parameters": f'{{"folder": "{sf_dir}"}}'}
    return run_producer(spark, landing, "parts", "run", scratch(spark, "producer"))


@ingest.query(
    "api_flatten",
    """SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "date", value AS temperature_max, CAST(event_id AS DOUBLE) AS temperature_min,
              CAST(NULL AS DOUBLE) AS precipitation_sum, -value AS windspeed_max, CAST(user_id AS DOUBLE) AS latitude, CAST(1.5 AS DOUBLE) AS longitude
       FROM events""",
)
def api_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user in payloads of at most 64, parallel arrays each, flattened back to rows."""
    events = table(spark, sf_dir, "events").withColumn("chunk", F.floor(F.col("event_id") / 64))
    entry = F.struct(
        "event_id",
        moment("ts").alias("time"),
        F.col("value").alias("hi"),
        F.col("event_id").cast("double").alias("lo"),
        F.lit(None).cast("double").alias("rain"),
        (-F.col("value")).alias("wind"),
    )
    chunks = events.groupBy("user_id", "chunk").agg(F.sort_array(F.collect_list(entry)).alias("e"))
    daily = F.struct(
        F.col("e.time").alias("time"),
        F.col("e.hi").alias("temperature_2m_max"),
        F.col("e.lo").alias("temperature_2m_min"),
        F.col("e.rain").alias("precipitation_sum"),
        F.col("e.wind").alias("windspeed_10m_max"),
    )
    text = F.to_json(F.struct(daily.alias("daily"), F.col("user_id").cast("double").alias("latitude"), F.lit(1.5).alias("longitude")))
    texts = chunks.select("user_id", text.alias("payload"))
    return payload.flatten_parallel(texts, F.col("payload"), "daily", payload.WEATHER_ARRAYS, payload.WEATHER_SCALARS, keep=["user_id"])
