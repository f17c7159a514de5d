"""Cleaning, schemas, repeated rows, checks and error records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import fixed
from strata.catalogue.common import Catalogue, day, moment, scratch, table
from strata.functions.hashing import with_row_hash
from strata.functions.parsing import typed
from strata.operators import checks, clean, errors, schema

quality = Catalogue()

NOW = "2024-03-01 12:00:00"

# ---- headers, rows, columns --------------------------------------------------------------------------------


@quality.query(
    "header_standardize",
    "SELECT c_custkey AS cust_key, c_name AS full_name, c_nationkey AS nation_id_2, c_acctbal AS acct_bal_usd, c_mktsegment AS mkt_segment FROM customer",
)
def header_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.standardize_headers(table(spark, sf_dir, "customer").toDF("custKey", "Full Name", "nationID2", "acct-bal (USD)", "MktSegment"))


@quality.query("drop_null_rows", "SELECT o_orderkey, o_orderstatus, 'x.csv' AS source_file_name FROM orders")
def drop_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order once as it is and once with nothing but its lineage."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    twice = orders.withColumn("real", F.explode(F.array(F.lit(True), F.lit(False))))
    blanked = twice.select(*[F.when(F.col("real"), F.col(c)).alias(c) for c in orders.columns])
    return clean.drop_null_rows(blanked.withColumn(fixed.LINEAGE_COLUMN, F.lit("x.csv")))


@quality.query("drop_empty_headers", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def drop_empty_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nothing = F.lit(None).cast("string")
    widened = table(spark, sf_dir, "supplier").withColumns({"_c4": nothing, "Unnamed: 5": nothing})
    return clean.drop_empty_headers(widened, "supplier")


# ---- schemas -----------------------------------------------------------------------------------------------

LINE_SCHEMA = [
    {"column_name": "l_orderkey", "data_type": "bigint"},
    ["l_linenumber", "int"],
    {"column_name": "l_quantity", "data_type": "decimal(10,2)"},
    {"column_name": "l_discount", "data_type": "double"},
    {"column_name": "l_returnflag", "data_type": "string"},
    {"column_name": "absent", "data_type": "int"},
    {"column_name": "l_linestatus", "data_type": "geography"},
    {"column_name": "l_shipdate", "data_type": "date"},
]


def _line_texts(spark: SparkSession, sf_dir: str, spoilt: bool) -> DataFrame:
    """lineitem as text: null words, percent signs, several date layouts; if spoilt, values that do not parse too."""
    line, key = table(spark, sf_dir, "lineitem"), F.col("l_orderkey")
    ship = F.col("l_shipdate")
    bad = key % 7 == 0 if spoilt else F.lit(False)
    return line.select(
        F.lit("extra").alias("remark"),
        key.cast("string").alias("l_orderkey"),
        F.when(bad, "1.5").otherwise(F.col("l_linenumber").cast("string")).alias("l_linenumber"),
        F.when(key % 5 == 0, "N/A").when(bad, "twelve").otherwise(F.col("l_quantity").cast("string")).alias("l_quantity"),
        F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit(" %")).alias("l_discount"),
        "l_returnflag",
        "l_linestatus",
        F.when(bad, "31/31/2024")
        .when(key % 3 == 0, F.date_format(ship, "dd-MMM-yyyy"))
        .when(key % 3 == 1, F.date_format(ship, "MM/dd/yyyy HH:mm:ss"))
        .otherwise(F.date_format(ship, "yyyy/MM/dd"))
        .alias("l_shipdate"),
    )


@quality.query(
    "enforce_schema",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 5 <> 0 THEN CAST(l_quantity AS DOUBLE) END AS l_quantity,
              round(l_discount * 100) AS l_discount, l_returnflag, l_linestatus,
              strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, 'extra' AS remark FROM lineitem""",
)
def enforce_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = schema.enforce_schema(_line_texts(spark, sf_dir, spoilt=False), LINE_SCHEMA)
    return done.withColumn("l_quantity", F.col("l_quantity").cast("double")).withColumn("l_shipdate", day("l_shipdate"))


@quality.query(
    "cast_failures",
    """SELECT column_name, data_type, CAST(failures AS BIGINT) AS failures FROM (
         SELECT 'l_orderkey' AS column_name, 'bigint' AS data_type, 0 AS failures
         UNION ALL SELECT 'l_linenumber', 'int', count(*) FROM lineitem WHERE l_orderkey % 7 = 0
         UNION ALL SELECT 'l_quantity', 'decimal(10,2)', count(*) FROM lineitem WHERE l_orderkey % 7 = 0 AND l_orderkey % 5 <> 0
         UNION ALL SELECT 'l_discount', 'double', 0
         UNION ALL SELECT 'l_returnflag', 'string', 0
         UNION ALL SELECT 'l_shipdate', 'date', count(*) FROM lineitem WHERE l_orderkey % 7 = 0)""",
)
def cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.cast_failures(_line_texts(spark, sf_dir, spoilt=True), LINE_SCHEMA)


@quality.query(
    "cast_failure_rows",
    """SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(count(*) AS BIGINT) AS row_count,
              CASE WHEN l_orderkey % 5 = 0 THEN 'l_linenumber,l_shipdate' ELSE 'l_linenumber,l_quantity,l_shipdate' END AS failed_columns
       FROM lineitem WHERE l_orderkey % 7 = 0 GROUP BY l_orderkey""",
)
def cast_failure_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = schema.cast_failure_rows(_line_texts(spark, sf_dir, spoilt=True), LINE_SCHEMA)
    named = rows.withColumn("failed_columns", F.array_join("failed_columns", ","))
    return named.groupBy("l_orderkey", "failed_columns").agg(F.count("*").alias("row_count"))


@quality.query(
    "infer_schema",
    """SELECT * FROM (VALUES ('o_orderkey', 'int'), ('big', 'bigint'), ('o_totalprice', 'double'), ('share', 'int'), ('o_orderdate', 'date'),
         ('stamp', 'timestamp'), ('mixed', 'string'), ('blank', 'string'), ('o_orderstatus', 'string')) AS t(column_name, data_type)
       WHERE (SELECT count(*) FROM orders) > 0""",
)
def infer_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types found on all orders written as text: also one column that is a number everywhere but in one late row."""
    orders = table(spark, sf_dir, "orders")
    texts = orders.select(
        F.col("o_orderkey").cast("string"),
        (F.col("o_orderkey") + 3_000_000_000).cast("string").alias("big"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("o_totalprice"),
        F.concat((F.col("o_orderkey") % 100).cast("string"), F.lit("%")).alias("share"),
        F.date_format("o_orderdate", "dd-MMM-yyyy").alias("o_orderdate"),
        F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 90 MINUTES"), "yyyy-MM-dd HH:mm:ss").alias("stamp"),
        F.when(F.col("o_orderkey") == 1400, "n. a.").otherwise(F.col("o_orderkey").cast("string")).alias("mixed"),
        F.when(F.col("o_orderkey") % 2 == 0, " NA ").otherwise("-").alias("blank"),
        "o_orderstatus",
    )
    inferred = schema.infer_schema(texts)
    kinds = [(f.name, f.dataType.simpleString()) for f in inferred.schema.fields]
    return spark.createDataFrame(kinds, "column_name string, data_type string")


@quality.query(
    "infer_values",
    """SELECT o_orderkey, CAST(CAST('123456789012345678901234567890' AS DECIMAL(38,0)) + o_orderkey AS VARCHAR) AS long_number, 'decimal(30,0)' AS long_type,
              CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CAST('1234567890123456.00000001' AS DECIMAL(30,8)) AS VARCHAR) AS exact, 'decimal(24,8)' AS exact_type,
              CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE AS price, 'double' AS price_type, CAST(9007199254740993 + o_orderkey AS BIGINT) AS big, 'bigint' AS big_type,
              concat(repeat('9', 39), o_orderkey) AS too_long, 'string' AS too_long_type, CASE WHEN o_orderkey % 7 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS at
       FROM orders""",
)
def infer_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values that inferred columns hold: no digit of a long number is lost."""
    orders, price = table(spark, sf_dir, "orders"), F.col("o_totalprice").cast("decimal(18,2)")
    texts = orders.select(
        F.col("o_orderkey").cast("string"),
        (F.lit("123456789012345678901234567890").cast("decimal(38,0)") + F.col("o_orderkey")).cast("string").alias("long_number"),
        F.concat((price + F.lit("1234567890123456.00000001").cast("decimal(30,8)")).cast("string"), F.lit(" % ")).alias("exact"),
        price.cast("string").alias("price"),
        (F.lit(9007199254740993) + F.col("o_orderkey")).cast("string").alias("big"),
        F.concat(F.repeat(F.lit("9"), 39), F.col("o_orderkey").cast("string")).alias("too_long"),
        F.when(F.col("o_orderkey") % 7 > 0, F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise(F.lit("n/a")).alias("at"),
    )
    found = schema.infer_schema(texts)
    kinds = {f"{f.name}_type": F.lit(f.dataType.simpleString()) for f in found.schema.fields if f.name not in ("o_orderkey", "at")}
    typed = found.withColumns({k.replace("long_number_type", "long_type"): v for k, v in kinds.items()})
    return typed.withColumns({"o_orderkey": F.col("o_orderkey").cast("bigint"), "long_number": F.col("long_number").cast("string"), "exact": F.col("exact").cast("string"), "at": F.date_format("at", "yyyy-MM-dd")})


@quality.query(
    "parse_dates",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 9 THEN NULL WHEN o_orderkey % 11 IN (2, 4) AND day(o_orderdate) <= 12
              THEN strftime(make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)), '%Y-%m-%d')
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS parsed FROM orders""",
)
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eleven layouts by key. Day-first texts are read month-first when both readings are dates."""
    when = F.col("o_orderdate")
    layouts = [
        "yyyy-MM-dd",
        "MM/dd/yyyy",
        "dd/MM/yyyy",
        "MM-dd-yyyy",
        "dd-MM-yyyy",
        "yyyy/MM/dd",
        "dd-MMM-yyyy",
        "yyyy-MM-dd HH:mm:ss",
        "dd-MMM-yyyy HH:mm:ss",
        "HH:mm:ss",
        "yyyy-MM-dd'T'HH:mm:ss",
    ]
    text = F.coalesce(*[F.when(F.col("o_orderkey") % len(layouts) == i, F.date_format(when, p)) for i, p in enumerate(layouts)])
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("t")).select("o_orderkey", day(typed("t", "date")).alias("parsed"))


@quality.query(
    "parse_timestamps",
    """SELECT event_id, CASE WHEN event_id % 6 = 5 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS parsed
       FROM events WHERE day(ts) > 12 UNION ALL
       SELECT event_id, CASE WHEN event_id % 6 = 5 THEN NULL WHEN event_id % 6 = 2 THEN
              strftime(make_timestamp(year(ts), day(ts), month(ts), hour(ts), minute(ts), floor(second(ts))), '%Y-%m-%d %H:%M:%S')
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END FROM events WHERE day(ts) <= 12""",
)
def parse_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five layouts by key; a bare date out of ISO order is no timestamp."""
    layouts = ["yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm:ss", "yyyy/MM/dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "MM/dd/yyyy"]
    text = F.coalesce(*[F.when(F.col("event_id") % len(layouts) == i, F.date_format("ts", p)) for i, p in enumerate(layouts)])
    return table(spark, sf_dir, "events").select("event_id", text.alias("t")).select("event_id", moment(typed("t", "timestamp")).alias("parsed"))


@quality.query(
    "align_nested",
    """SELECT l_orderkey AS id, CAST(l_linenumber AS VARCHAR) AS number, l_returnflag AS flag, l_orderkey % 2 = 0 AS has_info,
              CAST(l_quantity AS BIGINT) AS first_quantity, CAST(NULL AS VARCHAR) AS added FROM lineitem""",
)
def align_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested rows brought to a target schema: other field order and types, a missing field, null structs kept null."""
    line = table(spark, sf_dir, "lineitem")
    nested = line.select(
        F.when(F.col("l_orderkey") % 2 == 0, F.struct(F.col("l_linenumber").alias("number"), F.col("l_returnflag").alias("flag"))).alias("info"),
        F.array(F.struct(F.col("l_quantity").alias("q"), F.lit(1).alias("unused"))).alias("items"),
        "l_orderkey",
        F.struct(F.col("l_linenumber").alias("number"), F.col("l_returnflag").alias("flag")).alias("always"),
    )
    target = T.StructType.fromDDL(
        "l_orderkey bigint, info struct<flag:string,number:string,added:string>, always struct<flag:string,number:string,added:string>, "
        "items array<struct<q:bigint>>"
    )
    done = schema.align_to(nested, target)
    return done.select(
        F.col("l_orderkey").alias("id"),
        F.col("always.number").alias("number"),
        F.col("always.flag").alias("flag"),
        F.col("info").isNotNull().alias("has_info"),
        F.col("items")[0]["q"].alias("first_quantity"),
        F.col("always.added").alias("added"),
    )


@quality.query(
    "row_hash",
    """SELECT o_orderkey, sha256(concat_ws('|', CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR), o_orderpriority,
              coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, 'NULL'))) AS row_hash FROM orders""",
)
def row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_orderpriority",
        F.col("o_orderdate").alias("Load_Timestamp"),
    )
    return with_row_hash(orders).select("o_orderkey", "row_hash")


# ---- repeated rows -----------------------------------------------------------------------------------------

_FLAGS = ["l_returnflag", "l_linestatus", "l_discount"]


@quality.query("dedup_rows", "SELECT l_returnflag, l_linestatus, l_discount, 'a.csv' AS source_file_name FROM lineitem GROUP BY ALL")
def dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lineage column does not keep copies apart; its smallest value stays."""
    lines = table(spark, sf_dir, "lineitem").select(*_FLAGS)
    files = lines.withColumn(fixed.LINEAGE_COLUMN, F.explode(F.array(F.lit("a.csv"), F.lit("b.csv"))))
    return clean.drop_duplicate_rows(files)


@quality.query(
    "dedup_stats",
    """SELECT CAST(count(*) AS BIGINT) AS before_count, CAST(count(DISTINCT (l_returnflag, l_linestatus, l_discount)) AS BIGINT) AS after_count,
              CAST(count(*) - count(DISTINCT (l_returnflag, l_linestatus, l_discount)) AS BIGINT) AS removed_count FROM lineitem""",
)
def dedup_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.duplicate_statistics(table(spark, sf_dir, "lineitem").select(*_FLAGS))


# ---- checks ------------------------------------------------------------------------------------------------

LINE_KEYS = ["l_orderkey", "l_linenumber"]


def _config(name: str, validations: list[str], keys: list[str], columns: list[str]) -> dict:
    return {
        "table_name": name,
        "ingestion_steps": {"raw_trusted": {"load_type": "append", "validations": validations, "primary_key": keys}},
        "schema": [{"column_name": c, "data_type": "string"} for c in columns],
    }


def _frame(spark: SparkSession, results: list) -> DataFrame:
    return checks.results_frame(spark, results).select("name", "passed", F.array_join("failed_checks", "\n").alias("messages"))


@quality.query(
    "check_duplicates",
    """SELECT 'duplicate_row_validation' AS name, t = d AS passed, CASE WHEN t = d THEN '' ELSE concat('DUPLICATE ROWS FAILED: found ', t - d,
              ' duplicate row(s) (total: ', t, ', distinct: ', d, ')') END AS messages
       FROM (SELECT count(*) AS t, count(DISTINCT (l_returnflag, l_linestatus, l_discount)) AS d FROM lineitem)""",
)
def check_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(spark, [checks.judge_duplicates(checks.count_table(table(spark, sf_dir, "lineitem").select(*_FLAGS)))])


@quality.query(
    "check_row_count",
    """SELECT 'row_count_validation' AS name, count(*) > 0 AS passed, CASE WHEN count(*) > 0 THEN '' ELSE
              'ROW COUNT FAILED: found 0 row(s) but expected at least 1 row(s) -- short by 1 row' END AS messages
       FROM lineitem WHERE l_quantity < 0""",
)
def check_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where("l_quantity < 0")
    return _frame(spark, [checks.judge_row_count(checks.count_table(lines))])


_NULLED = "(SELECT CASE WHEN l_linenumber <> 7 THEN l_linenumber END AS n, l_orderkey AS k FROM lineitem)"


@quality.query(
    "check_primary_key",
    f"""SELECT 'primary_key_validation' AS name, nulls = 0 AND total = uniq AS passed,
               concat('PRIMARY KEY FAILED: column ''l_linenumber'' has ', nulls, ' NULLs', chr(10),
                      'PRIMARY KEY FAILED: composite key [l_orderkey, l_linenumber] has ', total - uniq, ' duplicate rows') AS messages
        FROM (SELECT count(*) AS total, count(*) FILTER (WHERE n IS NULL) AS nulls,
                     count(DISTINCT CASE WHEN n IS NOT NULL THEN (k, n) END) AS uniq FROM {_NULLED})""",
)
def check_primary_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    nulled = lines.withColumn("l_linenumber", F.when(F.col("l_linenumber") != 7, F.col("l_linenumber")))
    return _frame(spark, [checks.judge_key(checks.count_table(nulled, LINE_KEYS), LINE_KEYS)])


@quality.query(
    "check_schema",
    """SELECT 'schema_validation' AS name, false AS passed, string_agg(m, chr(10) ORDER BY o, m) AS messages FROM (
         SELECT 1 AS o, 'SCHEMA FAILED: missing column ''' || c || '''' AS m FROM (VALUES ('channel'), ('currency')) AS want(c)
         WHERE c NOT IN (SELECT column_name FROM (DESCRIBE orders))
         UNION ALL SELECT 2, 'SCHEMA FAILED: unexpected column ''' || column_name || '''' FROM (DESCRIBE orders)
         WHERE column_name NOT IN ('o_orderkey', 'o_custkey', 'o_orderdate'))""",
)
def check_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = table(spark, sf_dir, "orders").columns + [fixed.LINEAGE_COLUMN]
    expected = ["o_orderkey", "o_custkey", "o_orderdate", "currency", "channel"]
    return _frame(spark, [checks.judge_columns(columns, expected)])


@quality.query(
    "check_all",
    """SELECT * FROM (
         SELECT 'duplicate_row_validation' AS name, count(*) = (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS passed FROM lineitem
         UNION ALL SELECT 'row_count_validation', count(*) > 0 FROM lineitem
         UNION ALL SELECT 'primary_key_validation', count(*) = count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
         UNION ALL SELECT 'schema_validation', true)""",
)
def check_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    results = checks.run_checks(lines, _config("lineitem", [], LINE_KEYS, lines.columns))
    return checks.results_frame(spark, results).select("name", "passed")


@quality.query(
    "validation_score",
    """SELECT CASE WHEN u THEN '4/4' ELSE '3/4' END AS validation_score,
              CASE WHEN u THEN 'duplicate_row_validation, primary_key_validation, row_count_validation, schema_validation'
                   ELSE 'duplicate_row_validation, row_count_validation, schema_validation' END AS passed_validations,
              CASE WHEN u THEN '' ELSE 'primary_key_validation' END AS failed_validations
       FROM (SELECT count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS u FROM lineitem)""",
)
def validation_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    results = checks.run_checks(lines, _config("lineitem", [], LINE_KEYS, lines.columns))
    return checks.score(checks.results_frame(spark, results))


# ---- error records -----------------------------------------------------------------------------------------


@quality.query(
    "duplicate_error_rows",
    """SELECT 'duplicate_row_validation' AS expectation_type, 'ALL' AS column_name, 'N/A' AS failed_value,
              concat('{"l_returnflag":"', l_returnflag, '","l_linestatus":"', l_linestatus, '","l_linenumber":', l_linenumber, '}') AS full_record
       FROM lineitem GROUP BY l_returnflag, l_linestatus, l_linenumber HAVING count(*) > 1""",
)
def duplicate_error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    return errors.duplicate_row_records(lines)


@quality.query(
    "pk_error_rows",
    """WITH t AS (SELECT l_orderkey AS k, CASE WHEN l_linenumber <> 7 THEN l_linenumber END AS n, l_partkey AS p FROM lineitem),
            shared AS (SELECT k, n FROM t WHERE n IS NOT NULL GROUP BY k, n HAVING count(*) > 1)
       SELECT DISTINCT 'primary_key_validation' AS expectation_type, 'k, n' AS column_name,
              concat('{"k":', k, ',"n":', coalesce(CAST(n AS VARCHAR), 'null'), '}') AS failed_value,
              concat('{"k":', k, ',"n":', coalesce(CAST(n AS VARCHAR), 'null'), ',"p":', p, '}') AS full_record
       FROM t WHERE n IS NULL OR (k, n) IN (SELECT (k, n) FROM shared)""",
)
def pk_error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"),
        F.when(F.col("l_linenumber") != 7, F.col("l_linenumber")).alias("n"),
        F.col("l_partkey").alias("p"),
    )
    return errors.key_violation_records(rows, ["k", "n"])


@quality.query(
    "error_records",
    """SELECT '2024-03-01 12:00:00' AS error_timestamp, '2024-03-01' AS error_date, 'job 1' AS job_id, 'run 1' AS run_id, 'orders_daily' AS job_name,
              'orders' AS source_table, expectation_type, column_name, 'N/A' AS failed_value, full_record, 'CRITICAL' AS severity FROM (
         SELECT 'duplicate_row_validation' AS expectation_type, 'ALL' AS column_name,
                concat('{"o_orderstatus":"', o_orderstatus, '","o_orderpriority":"', o_orderpriority, '"}') AS full_record
         FROM orders GROUP BY o_orderstatus, o_orderpriority HAVING count(*) > 1
         UNION ALL SELECT 'schema_validation', 'amount', 'SCHEMA FAILED: missing column ''amount'''
         UNION ALL SELECT 'schema_validation', 'o_orderpriority', 'SCHEMA FAILED: unexpected column ''o_orderpriority''')""",
)
def error_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks that fail on orders, recorded in the error table and read back from its day."""
    rows = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority")
    results = checks.run_checks(rows, _config("orders", ["schema_validation"], [], ["o_orderstatus", "amount"]))
    records = errors.with_envelope(
        errors.failure_records(spark, results, rows), now=NOW, job_id="job 1", run_id="run 1", job_name="orders_daily", source_table="orders"
    )
    path = scratch(spark, "errors")
    errors.write_errors(records, path)
    stored = spark.read.parquet(path).where(F.col("error_date") == F.lit("2024-03-01").cast("date"))
    shown = stored.withColumns({"error_timestamp": moment("error_timestamp"), "error_date": day("error_date")})
    return shown.select(*errors.ERROR_COLUMNS)
