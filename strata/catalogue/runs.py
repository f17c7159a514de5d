"""Whole runs of tables and jobs: what they load, what they leave behind, and what a repeated one does."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import fixed
from strata.catalogue.common import Catalogue, scratch, table
from strata.functions.pii import decrypt_columns
from strata.functions.text import json_text
from strata.operators.trusted import TrustedTable
from strata.plans import config as cfg
from strata.plans import jobs, reports
from strata.plans.config import locations
from strata.plans.run_log import read_log
from strata.plans.table_run import run_table
from strata.session import ship_package
from strata.sources import folders, manifest

runs = Catalogue()

T1, T2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"


def deliver(spark: SparkSession, df: DataFrame, path: str, **options) -> None:
    """``df`` as one CSV file at ``path``, as a sender names it."""
    aside = f"{scratch(spark, 'delivery')}"
    df.coalesce(1).write.options(**{"header": True, **options}).csv(aside)
    folders.rename(spark, folders.matching(spark, f"{aside}/part-*")[0], path)


def settings(staging: str, name: str, columns: dict[str, str], raw: dict | None = None, landing: dict | None = None, **trusted) -> dict:
    return {
        "job_name": "shop_na_us_daily",
        "table_name": name,
        "region": "NORTH AMERICA",
        "market": "US",
        "domain": "SALES",
        "source_name": "SHOP",
        "ingestion_steps": {
            "landing": {"source_path": staging, "file_format": "csv", "csv_options": {"delimiter": ","}, "pii_columns": [], **(landing or {})},
            "raw": {"schema_config": "enforce", "deduplication": False, **(raw or {})},
            "raw_trusted": {"load_type": "append", "primary_key": [], "schema_evolution": False, "validations": ["row_count_validation"], **trusted},
        },
        "schema": [{"column_name": c, "data_type": t} for c, t in columns.items()],
    }


def trusted(spark: SparkSession, config: dict, base: str) -> DataFrame:
    return TrustedTable(spark, locations(config, "", base)["raw_trusted"]).read()


@runs.query(
    "source_file_audit",
    """SELECT concat('lines_', l_linestatus, '.csv') AS file_name, CAST(count(*) AS BIGINT) AS rows, true AS known_size, 1 AS listed_again FROM lineitem GROUP BY l_linestatus
       UNION ALL SELECT 'empty.csv', 0, true, 1""",
)
def source_file_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of a run over a file per line status and one without rows; nothing is new for the next run."""
    base, lines = scratch(spark, "audit"), table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus")
    config = settings(f"{base}/staging", "lines", {"l_orderkey": "bigint", "l_linenumber": "int", "l_linestatus": "string"}, raw={"deduplication": True})
    for status in [row[0] for row in lines.select("l_linestatus").distinct().collect()]:
        deliver(spark, lines.where(F.col("l_linestatus") == status), f"{base}/staging/LINES/lines_{status}.csv")
    deliver(spark, lines.limit(0), f"{base}/staging/LINES/empty.csv")
    run_table(spark, config, base)
    files = manifest.listed(spark, f"{base}/staging/LINES")
    earlier = manifest.loaded_before(spark, locations(config, "", base)["manifests"])
    again = files.join(earlier.select(*manifest.FILE), manifest.FILE).count() // files.count()
    new = manifest.new_files(files, earlier).count()
    return earlier.select("file_name", "rows", (F.col("length") > 0).alias("known_size"), F.lit(again - new).alias("listed_again"))


_LINES = {"o_orderkey": "bigint", "o_orderstatus": "string", "o_custkey": "bigint"}


@runs.query(
    "rejected_rows",
    """SELECT o_orderkey, 'loaded' AS fate, CAST(o_custkey AS VARCHAR) AS told FROM orders WHERE o_orderkey % 10 > 1
       UNION ALL SELECT o_orderkey, 'malformed_row', concat(o_orderkey, ',', o_orderstatus, ',', o_custkey, ',surplus') FROM orders WHERE o_orderkey % 10 = 0
       UNION ALL SELECT o_orderkey, 'malformed_row', concat(o_orderkey, ',', o_orderstatus) FROM orders WHERE o_orderkey % 10 = 1""",
)
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a cell too many or too few stay out of the table; their text is in the error records."""
    base, orders = scratch(spark, "rejected"), table(spark, sf_dir, "orders")
    cells = F.concat_ws(",", "o_orderkey", "o_orderstatus", "o_custkey")
    short, digit = F.concat_ws(",", "o_orderkey", "o_orderstatus"), F.col("o_orderkey") % 10
    line = F.when(digit == 0, F.concat(cells, F.lit(",surplus"))).when(digit == 1, short).otherwise(cells)
    # a single column with the whole line; between other separators its commas need no quotes
    orders.select(line.alias(",".join(_LINES))).write.options(header=True, sep="|").csv(f"{base}/staging/ORDERS")
    config = settings(f"{base}/staging", "orders", _LINES, landing={"malformed_rows": "reject"})
    run_table(spark, config, base, now=T1)
    loaded = trusted(spark, config, base).select("o_orderkey", F.lit("loaded").alias("fate"), F.col("o_custkey").cast("string").alias("told"))
    records = spark.read.parquet(locations(config, "", base)["errors"])
    key = F.get_json_object("full_record", "$.o_orderkey").cast("bigint")
    return loaded.unionByName(records.select(key.alias("o_orderkey"), F.col("expectation_type").alias("fate"), F.col("failed_value").alias("told")))


_JOB_TABLES = 8


@runs.query(
    "job_run_log",
    f"""WITH tables AS (SELECT concat('customers_', k) AS table_name, k FROM (SELECT DISTINCT CAST(c_custkey % {_JOB_TABLES} AS INT) AS k FROM customer)),
             rows AS (SELECT CAST(c_custkey % {_JOB_TABLES} AS INT) AS k, CAST(count(*) AS BIGINT) AS n FROM customer GROUP BY 1)
        SELECT attempt, table_name, CASE WHEN attempt = 1 AND k = 3 THEN 'FAILED' ELSE 'SUCCESS' END AS status, 'shop_na_us_daily' AS job_name, n AS loaded, n AS in_table
        FROM tables JOIN rows USING (k), (VALUES (1), (2)) AS a(attempt) WHERE attempt = 1 OR k = 3""",
)
def job_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job of eight tables; one fails after its commit, when the manifest cannot be written, and is run again: its rows are there once.

    The log of each attempt is read by the run id of the job.
    """
    base, customer = scratch(spark, "job"), table(spark, sf_dir, "customer")
    columns = {"c_custkey": "bigint", "c_name": "string"}
    configs, tables = [], [f"customers_{k}" for k in range(_JOB_TABLES)]
    for k, name in enumerate(tables):
        deliver(spark, customer.where(F.col("c_custkey") % _JOB_TABLES == k).select(*columns), f"{base}/staging/{name.upper()}/customers.csv")
        config = settings(f"{base}/staging", name, columns, raw={"deduplication": True})
        configs.append(("shop_na_us_daily", name, json.dumps(config)))
    control = TrustedTable(spark, f"{base}/control")
    jobs.register_configs(spark.createDataFrame(configs, "job_name string, table_name string, config string"), control, T1)
    blocked = locations(json.loads(configs[3][2]), "", base)["manifests"]
    folders.write_text(spark, blocked, "in the way")
    attempts = [jobs.run_job(spark, control.read(), "shop_na_us_daily", base, parallel=4)]
    folders.remove(spark, blocked)
    attempts.append(jobs.run_job(spark, control.read(), "shop_na_us_daily", base, [tables[3]]))
    found = None
    for number, done in enumerate(attempts, 1):
        log = read_log(spark, f"{base}/run_log")
        results = reports.table_results(log, done["job_run_id"]).select("table_name", "status")
        own = log.where((F.col("job_run_id") == done["job_run_id"]) & (F.col("layer") == "raw_trusted"))
        rows = own.groupBy("table_name", "job_name").agg(F.max(F.col("additional_data")["record_count"].cast("bigint")).alias("loaded"))
        part = results.join(rows, "table_name").select(F.lit(number).alias("attempt"), "table_name", "status", "job_name", "loaded")
        found = part if found is None else found.unionByName(part)
    sizes = None
    for name, (_, _, text) in zip(tables, configs, strict=True):
        size = trusted(spark, json.loads(text), base).agg(F.count("*").alias("in_table")).withColumn("table_name", F.lit(name))
        sizes = size if sizes is None else sizes.unionByName(size)
    return found.join(sizes, "table_name")


_KEY = "0123456789abcdef"


@runs.query(
    "pii_dedup_scd2",
    """SELECT c_custkey, c_name, true AS is_current, true AS sealed FROM customer WHERE c_custkey % 3 > 0
       UNION ALL SELECT c_custkey, c_name, false, true FROM customer WHERE c_custkey % 3 = 0
       UNION ALL SELECT c_custkey, concat(c_name, '!'), true, true FROM customer WHERE c_custkey % 3 = 0""",
)
def pii_dedup_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encrypted names, every row sent twice, two deliveries into a history: a name that stays the same starts no version."""
    base, customer = scratch(spark, "pii-history"), table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    config = settings(
        f"{base}/staging",
        "customers",
        {"c_custkey": "bigint", "c_name": "string"},
        raw={"deduplication": True},
        landing={"pii_columns": ["c_name"], "only_new_files": True},
        load_type="scd2",
        primary_key=["c_custkey"],
        validations=["row_count_validation", "primary_key_validation"],
    )
    changed = customer.withColumn("c_name", F.when(F.col("c_custkey") % 3 == 0, F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name")))
    for rows, now in ((customer, T1), (changed, T2)):
        rows.unionByName(rows).write.mode("append").option("header", True).csv(f"{base}/staging/CUSTOMERS")
        run_table(spark, config, base, pii_key=_KEY, now=now)
    rows = trusted(spark, config, base).withColumn("stored", F.col("c_name"))
    plain = decrypt_columns(rows, ["c_name"], _KEY)
    return plain.select("c_custkey", "c_name", F.col(fixed.IS_CURRENT).alias("is_current"), (F.col("stored") != F.col("c_name")).alias("sealed"))


_CADENCES = ["daily", "weekly", "monthly", "quarterly", "yearly"]


@runs.query(
    "table_ages",
    """SELECT concat('region_', r_regionkey) AS table_name, 'SUCCESS' AS status, ['DAILY', 'WEEKLY', 'MONTHLY', 'QUARTERLY', 'YEARLY'][r_regionkey + 1] AS cadence,
              CAST(24 * 31 * r_regionkey + 2 AS DOUBLE) AS data_age_hours, CASE WHEN 24 * 31 * r_regionkey + 2 <= [26, 170, 745, 2208, 8760][r_regionkey + 1] THEN 'FRESH' ELSE 'STALE' END AS freshness_status, CAST(n AS BIGINT) AS customers
       FROM region JOIN (SELECT n_regionkey, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1) ON n_regionkey = r_regionkey""",
)
def table_ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job and a table of customers per region, loaded some months apart; the board takes the ages from the tables."""
    base, now = scratch(spark, "ages"), "2024-06-30 02:00:00"
    customer = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    columns, configs, sizes = {"c_custkey": "bigint", "c_name": "string"}, [], None
    for k, cadence in enumerate(_CADENCES):
        name, job = f"region_{k}", f"shop_na_us_{cadence}"
        customer.where(F.col("n_regionkey") == k).select(*columns).write.option("header", True).csv(f"{base}/staging/{name.upper()}")
        config = settings(f"{base}/staging", name, columns) | {"job_name": job}
        configs.append((job, name, json.dumps(config)))
        loaded = spark.sql(f"SELECT CAST(TIMESTAMP '{now}' - INTERVAL {31 * k} DAYS - INTERVAL 2 HOURS AS string)").first()[0]
        run_table(spark, config, base, job_run_id="one", now=loaded)
        size = trusted(spark, config, base).agg(F.count("*").alias("customers")).withColumn("table_name", F.lit(name))
        sizes = size if sizes is None else sizes.unionByName(size)
    control, board = TrustedTable(spark, f"{base}/control"), TrustedTable(spark, f"{base}/board")
    jobs.register_configs(spark.createDataFrame(configs, "job_name string, table_name string, config string"), control, T1)
    jobs.refresh_board(spark, control.read(), base, board, job_run_id="one", job_id="1", now=now)
    shown = board.read().select("table_name", "status", "cadence", "data_age_hours", "freshness_status")
    return shown.join(sizes, "table_name")


CONFIG_TOLD = "job_name string, table_name string, region string, load_type string, first_column string, places int"


@runs.query(
    "config_files",
    """SELECT concat('nation_', s_nationkey, '_daily') AS job_name, concat('t', s_suppkey) AS table_name, s_name AS region, 'append' AS load_type, 'c' AS first_column, 1 AS places
       FROM supplier""",
)
def config_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A config file per supplier in a folder per job: read, flattened into control rows, and each row back into a config."""
    base, supplier = scratch(spark, "config-files"), table(spark, sf_dir, "supplier")
    ship_package(spark)

    @F.udf("string")
    def config_text(key, name):
        return json.dumps(settings("/in", f"t{key}", {"c": "int"}) | {"region": name, "is_active": True})

    @F.udf(CONFIG_TOLD)
    def told(row):
        c = cfg.config_of_row(row)
        return c["job_name"], c["table_name"], c["region"], c["ingestion_steps"]["raw_trusted"]["load_type"], c["schema"][0]["column_name"], len(c["schema"])

    shown = [F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in ("s_nationkey", "s_suppkey")]
    name = F.concat(F.lit("nation_"), shown[0], F.lit("_daily/t"), shown[1], F.lit(".json"))
    rows = supplier.withColumns({"name": name, "at": F.monotonically_increasing_id()})
    last = rows.groupBy("name").agg(F.max_by(F.struct("s_suppkey", "s_name"), "at").alias("row"))  # of rows for one file
    folders.write_texts(last.select("name", config_text("row.s_suppkey", "row.s_name").alias("content")), base)
    control = cfg.control_rows(cfg.read_config_files(spark, f"{base}/*"), T1)
    return control.select(told(F.struct(*control.columns)).alias("c")).select("c.*")


@runs.query(
    "notify_lookup",
    """SELECT concat('job_', n_nationkey) AS job_name, concat('nation', n_nationkey, '@example.org') AS address
       FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer)""",
)
def notify_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The addresses of each job, from any one of its active rows, whichever Spark meets first: they are the same."""
    active = table(spark, sf_dir, "customer").withColumn("active", F.explode(F.array(F.lit(True), F.lit(False))))
    name = F.when(F.col("active"), F.concat(F.lit("nation"), F.col("c_nationkey"), F.lit("@example.org"))).otherwise(F.lit("off@example.org"))
    control = active.select(
        F.concat(F.lit("job_"), F.col("c_nationkey").cast("string")).alias("job_name"),
        F.col("active").alias("is_active"),
        F.to_json(F.struct(F.array(name).alias("emails"))).alias("notify"),
    )
    names = [row.job_name for row in control.select("job_name").distinct().collect()]
    found = [(job, address) for job in names for address in reports.notify_settings(control, f"MAIL_{job.upper()}", "MAIL_")]
    return spark.createDataFrame(found, "job_name string, address string")


@runs.query(
    "json_rows",
    """SELECT o_orderkey, concat('{"at":"', strftime(o_orderdate, '%Y-%m-%d'), '","none":null,"status":"', o_orderstatus, '","many":[1,', o_custkey, ']}') AS row_text,
              concat('{"at":"', strftime(o_orderdate, '%Y-%m-%d'), 'T01:30:00.000Z"}') AS moment_text FROM orders""",
)
def json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as JSON text, as error records keep them: dates and times spelled out, nulls kept."""
    day = F.col("o_orderdate").cast("date")
    moment = day.cast("timestamp") + F.expr("INTERVAL 90 MINUTES")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        json_text(
            day.alias("at"), F.lit(None).cast("int").alias("none"), F.col("o_orderstatus").alias("status"), F.array(F.lit(1).cast("long"), F.col("o_custkey").cast("long")).alias("many")
        ).alias("row_text"),
        json_text(moment.alias("at")).alias("moment_text"),
    )
