"""The whole road in one query: messy CSV of lineitem -> Landing -> Raw -> trusted -> revenue by return flag."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.catalogue.common import Catalogue, scratch, table
from strata.operators.trusted import TrustedTable
from strata.plans.config import locations
from strata.plans.table_run import run_table

flagship = Catalogue()

SCHEMA = [
    ("order_key", "bigint"),
    ("part_key", "bigint"),
    ("supp_key", "bigint"),
    ("line_number", "int"),
    ("quantity", "double"),
    ("extended_price", "double"),
    ("discount", "double"),
    ("tax", "double"),
    ("return_flag", "string"),
    ("line_status", "string"),
    ("ship_date", "date"),
]


def messy_lineitem(lineitem: DataFrame) -> DataFrame:
    """lineitem as someone might deliver it: other headers, percent texts, four date layouts, null words, rows sent
    twice, and blank rows."""
    ship = F.col("l_shipdate")
    layout = F.col("l_orderkey") % 4
    shown = (
        F.when(layout == 0, F.date_format(ship, "yyyy-MM-dd"))
        .when(layout == 1, F.date_format(ship, "yyyy/MM/dd"))
        .when(layout == 2, F.date_format(ship, "dd-MMM-yyyy"))
        .otherwise(F.date_format(ship, "yyyy-MM-dd HH:mm:ss"))
    )
    rows = lineitem.select(
        F.col("l_orderkey").cast("string").alias("orderKey"),
        F.col("l_partkey").cast("string").alias("Part Key"),
        F.col("l_suppkey").cast("string").alias("SuppKey"),
        F.col("l_linenumber").cast("string").alias("Line Number"),
        F.col("l_quantity").cast("string").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("ExtendedPrice"),
        F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit(" %")).alias("Discount %"),
        F.when(F.col("l_tax") == 0, "n/a").otherwise(F.concat(F.round(F.col("l_tax") * 100).cast("int").cast("string"), F.lit("%"))).alias("tax"),
        F.col("l_returnflag").alias("returnFlag"),
        F.col("l_linestatus").alias("LineStatus"),
        shown.alias("ship-date"),
    )
    sent = F.when(F.col("orderKey").cast("bigint") % 5 == 0, 2).otherwise(1)
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), sent))).drop("copy")


def config(source_path: str, load_type: str = "append", keys=()) -> dict:
    return {
        "job_name": "shop_na_us_daily",
        "table_name": "line_items",
        "region": "NORTH AMERICA",
        "market": "US",
        "domain": "SALES",
        "source_name": "SHOP",
        "ingestion_steps": {
            "landing": {"source_path": source_path, "file_format": "csv", "csv_options": {"delimiter": ","}, "pii_columns": []},
            "raw": {"schema_config": "enforce", "deduplication": True},
            "raw_trusted": {
                "load_type": load_type,
                "primary_key": list(keys),
                "enable_expiration": False,
                "validations": ["row_count_validation", "schema_validation"],
                "schema_evolution": True,
            },
        },
        "schema": [{"column_name": name, "data_type": kind} for name, kind in SCHEMA],
    }


def deliver(spark: SparkSession, sf_dir: str, base: str) -> dict:
    """Writes the messy files and returns the config that ingests them."""
    messy_lineitem(table(spark, sf_dir, "lineitem")).write.option("header", True).csv(f"{base}/staging/LINE_ITEMS")
    return config(f"{base}/staging")


def ingest(spark: SparkSession, settings: dict, base: str) -> DataFrame:
    run_table(spark, settings, base)
    return TrustedTable(spark, locations(settings, "", base)["raw_trusted"]).read()


@flagship.query(
    "flagship_trusted_revenue",
    """
    SELECT l_returnflag AS return_flag, CAST(count(*) AS BIGINT) AS row_count,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (100 - CAST(round(l_discount * 100) AS INT))) AS DOUBLE) / 100
             AS revenue,
           strftime(min(l_shipdate), '%Y-%m-%d') AS first_ship, strftime(max(l_shipdate), '%Y-%m-%d') AS last_ship,
           CAST(count(*) FILTER (WHERE l_tax = 0) AS BIGINT) AS untaxed
    FROM (SELECT DISTINCT * FROM lineitem) GROUP BY l_returnflag
    """,
)
def trusted_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch(spark, "flagship")
    trusted = ingest(spark, deliver(spark, sf_dir, base), base)
    price, share = F.col("extended_price").cast("decimal(18,2)"), F.lit(100) - F.col("discount").cast("int")
    return trusted.groupBy("return_flag").agg(
        F.count("*").alias("row_count"),
        (F.sum(price * share).cast("double") / 100).alias("revenue"),
        F.date_format(F.min("ship_date"), "yyyy-MM-dd").alias("first_ship"),
        F.date_format(F.max("ship_date"), "yyyy-MM-dd").alias("last_ship"),
        F.count_if(F.col("tax").isNull()).alias("untaxed"),
    )
