"""Table configs, column specs, names and personal data. Each row of part stands for a config, good or broken."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.catalogue.common import Catalogue, moment, scratch, table
from strata.functions import pii
from strata.operators.trusted import TrustedTable
from strata.plans import column_specs, config
from strata.plans.jobs import register_configs

configs = Catalogue()

# One good config and one for every broken rule: (replaced piece, replacement, errors).
_GOOD = (
    '{"region":"NA","market":"US","domain":"D","source_name":"SHOP","is_active":true,"notify":{"emails":["a@b.org"]},'
    '"trigger":{"type":""},"ingestion_steps":{"landing":{"source_path":"/in","file_format":"CSV","csv_options":{"delimiter":","},'
    '"pii_columns":["c"]},"raw":{"schema_config":"enforce","deduplication":true},"raw_trusted":{"load_type":"append",'
    '"schema_evolution":true}},"schema":[{"column_name":"c","data_type":"int"}]}'
)
_VARIANTS: list[tuple[str, str, list[str]]] = [
    ("", "", []),
    ('"region":"NA",', '"region":null,', ["Missing required field: 'region'"]),
    ('"is_active":true', '"is_active":"yes"', ["'is_active' must be boolean, got str"]),
    ('"csv_options":{"delimiter":","},', "", ["Missing 'csv_options' block for format 'csv'"]),
    ('"CSV"', '"xml"', ["Invalid file_format 'xml'"]),
    (',"pii_columns":["c"]', "", ["'pii_columns' is required (use empty list if none)"]),
    ('["c"]}', '["c","d","c"]}', ["'pii_columns' contains duplicates"]),
    ('"pii_columns":["c"]', '"pii_columns":"c"', ["'pii_columns' must be a list"]),
    ('"source_path":"/in","file_format":"CSV"', '"parameters":{"x":1}', ["Missing 'notebook_path' in landing.parameters"]),
    ('"schema_config":"enforce","deduplication":true', '"deduplication":"true"', ["Missing 'schema_config' in 'raw'", "'deduplication' must be boolean, got str"]),
    ('"load_type":"append","schema_evolution":true', '"load_type":"","schema_evolution":1', ["Missing 'load_type' in 'raw_trusted'", "'schema_evolution' must be boolean, got int"]),
    ('["a@b.org"]', "[]", ["'notify.emails' cannot be empty"]),
    ('["a@b.org"]', '["a@b.org",5]', ["'notify.emails' must contain only strings"]),
    ('{"type":""}', '{"type":"hourly"}', ["Invalid trigger.type 'hourly'"]),
    ('{"type":""}', '{"type":"schedule","timezone":"UTC"}', ["'trigger.cron' required for schedule trigger"]),
    ('"data_type":"int"}]', '"data_type":"int"},{"column_name":"d"}]', ["Schema entry 1 missing required fields"]),
    ('{"region"', '{{"region"', ["not valid JSON"]),
    (re.search(r'"ingestion_steps":\{.*\}\},', _GOOD).group(), "", ["Missing required field: 'ingestion_steps'", "Missing 'ingestion_steps'"]),
    ('{"emails":["a@b.org"]}', '"a@b.org"', ["'notify' must be a dict, got str"]),
    ('"source_path":"/in",', "", ["Missing 'source_path' in landing"]),
    ('"csv_options":{"delimiter":","}', '"csv_options":[1]', ["'csv_options' must be a dict"]),
    ('"parameters":', "", []),
    ('"trigger":{"type":""}', '"trigger":"daily"', ["'trigger' must be a dict, got str"]),
    ('{"emails":["a@b.org"]}', "{}", ["'notify.emails' is required"]),
]


def _pick(values: list[str], by: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (by % len(values) + 1).cast("int"))


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = _pick([_GOOD.replace(old, new, 1) if old else _GOOD for old, new, _ in _VARIANTS], F.col("p_partkey"))
    named = F.replace(text, F.lit('"source_name":"SHOP"'), F.concat(F.lit('"source_name":"'), F.col("p_type"), F.lit('"')))
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("job "), "p_brand").alias("job_name"), F.concat(F.lit("t"), F.col("p_partkey").cast("string")).alias("table_name"), named.alias("config")
    )


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_ERRORS = _sql_list(["\n".join(errors) for _, _, errors in _VARIANTS])
_N = len(_VARIANTS)
_UNREADABLE = next(i for i, v in enumerate(_VARIANTS) if v[2] == ["not valid JSON"])


@configs.query(
    "config_rules",
    f"SELECT concat('job ', p_brand) AS job_name, concat('t', p_partkey) AS table_name, {_ERRORS}[p_partkey % {_N} + 1] AS errors FROM part",
)
def config_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = config.config_errors(_texts(spark, sf_dir))
    return checked.select("job_name", "table_name", F.array_join("errors", "\n").alias("errors"))


@configs.query(
    "config_missing",
    f"""SELECT DISTINCT concat('job ', p_partkey) AS job_name FROM part WHERE p_size <= 25 OR p_partkey % {_N} = {_UNREADABLE}""",
)
def config_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of one job per part, those without a config that can be read; parts up to size 25 have none."""
    part = table(spark, sf_dir, "part")
    job = F.concat(F.lit("job "), F.col("p_partkey").cast("string")).alias("job_name")
    big = part.where("p_size > 25").select(F.concat(F.lit("t"), F.col("p_partkey").cast("string")).alias("table_name"), job)
    found = big.join(_texts(spark, sf_dir).select("table_name", "config"), "table_name")
    return config.jobs_without_configs(part.select(job), found)


def _control(spark: SparkSession, sf_dir: str) -> DataFrame:
    return config.control_rows(_texts(spark, sf_dir).where(F.expr("try_parse_json(config)").isNotNull()), "2024-01-01 00:00:00")


_STEPLESS = next(i for i, v in enumerate(_VARIANTS) if "Missing 'ingestion_steps'" in v[2])


@configs.query(
    "config_flatten",
    f"""SELECT concat('job ', p_brand) AS job_name, concat('t', p_partkey) AS table_name, CASE WHEN v <> 1 THEN 'NA' END AS region, p_type AS source_name,
               v <> {_STEPLESS} AS has_steps, CASE WHEN v NOT IN (3, {_STEPLESS}) THEN 'csv_options' END AS format_options_key,
               CASE WHEN v = 20 THEN '[1]' WHEN v NOT IN (3, {_STEPLESS}) THEN '{{"delimiter":","}}' END AS format_options,
               CASE v WHEN 8 THEN '{{"x":1}}' END AS parameters, CASE WHEN v NOT IN (9, {_STEPLESS}) THEN 'enforce' END AS schema_config,
               CASE WHEN v = 6 THEN 'c,d,c' WHEN v = 5 THEN '' WHEN v <> {_STEPLESS} THEN 'c' END AS pii_columns,
               CASE WHEN v = 15 THEN 'c:int,d:' ELSE 'c:int' END AS schema
        FROM (SELECT *, p_partkey % {_N} AS v FROM part) WHERE v <> {_UNREADABLE}""",
)
def config_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Config texts as control-table rows. A lone text in place of the personal-data list is a list of one."""
    rows = _control(spark, sf_dir)
    entry = F.transform("schema", lambda x: F.concat(x["column_name"], F.lit(":"), F.coalesce(x["data_type"], F.lit(""))))
    return rows.select(
        "job_name",
        "table_name",
        "region",
        "source_name",
        F.col("ingestion_steps").isNotNull().alias("has_steps"),
        "ingestion_steps.landing.format_options_key",
        "ingestion_steps.landing.format_options",
        "ingestion_steps.landing.parameters",
        "ingestion_steps.raw.schema_config",
        F.array_join("ingestion_steps.landing.pii_columns", ",").alias("pii_columns"),
        F.array_join(entry, ",").alias("schema"),
    )


@configs.query(
    "active_configs",
    f"""SELECT concat('t', p_partkey) AS table_name, v <> {_STEPLESS} AS landing_on FROM (SELECT *, p_partkey % {_N} AS v FROM part)
        WHERE p_brand = 'Brand#7' AND v <> {_UNREADABLE}""",
)
def active_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active tables of one job, and whether their Landing layer is switched on."""
    rows = config.active_rows(_control(spark, sf_dir).withColumn("is_active", F.coalesce("is_active", F.lit(True))), "job Brand#7")
    landing = F.col("ingestion_steps.landing")
    fields = ["source_path", "file_format", "format_options", "notebook_path", "parameters"]
    return rows.select("table_name", config.layer_enabled(landing, fields).alias("landing_on"))


@configs.query(
    "table_filter",
    f"""SELECT concat('t', p_partkey) AS table_name, p_partkey % {_N} <> {_UNREADABLE} AS found FROM part WHERE p_size < 20
        UNION ALL SELECT concat('x', p_partkey), false FROM part WHERE p_size < 5""",
)
def table_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested tables that have a control row, and those that have none."""
    part, key = table(spark, sf_dir, "part"), F.col("p_partkey").cast("string")
    names = part.where("p_size < 20").select(F.concat(F.lit("t"), key).alias("table_name"))
    names = names.unionByName(part.where("p_size < 5").select(F.concat(F.lit("x"), key).alias("table_name")))
    picked, missing = config.pick_tables(_control(spark, sf_dir), names)
    return picked.select("table_name", F.lit(True).alias("found")).unionByName(missing.withColumn("found", F.lit(False)))


@configs.query(
    "target_paths",
    """SELECT c_custkey, concat('/landing/', r_name, '/', n_name, '/', c_mktsegment, '/Src ', c_nationkey, '/', c_name, '/20240101_000000') AS landing,
              concat('/raw/', r_name, '/', n_name, '/', c_mktsegment, '/Src ', c_nationkey, '/', c_name, '/20240101_000000') AS raw,
              concat('lake.', 'src_', c_nationkey, '_', lower(n_name), '.', c_name) AS raw_trusted
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def target_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation, region = (table(spark, sf_dir, name) for name in ("customer", "nation", "region"))
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    places = joined.select(
        "c_custkey",
        F.col("r_name").alias("region"),
        F.col("n_name").alias("market"),
        F.col("c_mktsegment").alias("domain"),
        F.concat(F.lit("Src "), F.col("c_nationkey").cast("string")).alias("source_name"),
        F.col("c_name").alias("table_name"),
    )
    return config.target_locations(places, "/landing", "/raw", "lake", "20240101_000000").select("c_custkey", "landing", "raw", "raw_trusted")


@configs.query(
    "control_table_sync",
    """SELECT concat('job ', p_brand) AS job_name, concat('t', p_partkey) AS table_name, CASE WHEN p_size > 25 THEN 'M2' ELSE 'US' END AS market,
              CASE WHEN p_size > 25 THEN '2024-01-02 00:00:00' ELSE '2024-01-01 00:00:00' END AS synced, 'append' AS load_type,
              'c:int' AS first_column FROM part""",
)
def control_table_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A good config per part, registered; half of them changed and registered again."""
    part = table(spark, sf_dir, "part")
    named = [F.concat(F.lit("job "), "p_brand").alias("job_name"), F.concat(F.lit("t"), F.col("p_partkey").cast("string")).alias("table_name")]
    control = TrustedTable(spark, scratch(spark, "control"))
    register_configs(part.select(*named, F.lit(_GOOD).alias("config")), control, "2024-01-01 00:00:00")
    changed = part.where("p_size > 25").select(*named, F.lit(_GOOD.replace('"US"', '"M2"')).alias("config"))
    register_configs(changed, control, "2024-01-02 00:00:00")
    entry = F.col("schema")[0]
    return control.read().select(
        "job_name",
        "table_name",
        "market",
        moment("sync_timestamp").alias("synced"),
        "ingestion_steps.raw_trusted.load_type",
        F.concat(entry["column_name"], F.lit(":"), entry["data_type"]).alias("first_column"),
    )


# ---- column specs: twenty parts make one spec --------------------------------------------------------------

_TYPES = ["VARCHAR(20)", "INT", "DECIMAL(10,2)", "DATE", "datetime", "BOOLEAN", "GEOGRAPHY", "text"]
_KINDS = ["string", "double", "double", "date", "timestamp", "string", "string", "string"]


def _spec(key: Column) -> Column:
    return F.floor(key / 20)


def _specs(spark: SparkSession, sf_dir: str):
    part, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    source = F.concat(F.initcap("p_name"), F.lit(" "), key.cast("string"))
    columns = part.select(_spec(key).alias("spec_id"), key.alias("position"), source.alias("source_column"), _pick(_TYPES, F.col("p_size")).alias("sql_type"))
    target = F.concat(F.lit("Col_"), F.when(key % 4 == 0, "email_").otherwise(""), key.cast("string"))
    mapping = part.where("p_partkey % 3 <> 2").select(
        _spec(key).alias("spec_id"), F.when(key % 3 == 1, F.upper(source)).otherwise(source).alias("source_column"), target.alias("target_column")
    )
    spec, first = F.col("spec_id"), F.col("first_column")
    keys = F.when(spec % 3 == 0, "none").when(spec % 3 == 1, F.concat(first, F.lit(" / Unknown Key"))).otherwise(F.concat(F.lower(first), F.lit(",")))
    tables = columns.groupBy("spec_id").agg(F.min_by("source_column", "position").alias("first_column")).select(
        "spec_id",
        F.when(spec % 2 == 0, "/in").otherwise(" ").alias("source_path"),
        F.when(spec % 2 == 0, "North America").otherwise("South East Asia").alias("region"),
        F.lit("US").alias("market"),
        F.lit("Sales").alias("domain"),
        F.lit("Big Shop").alias("source_name"),
        F.concat(F.lit("Table-"), spec.cast("string")).alias("table_name"),
        F.lit("Monthly").alias("cadence"),
        F.when(spec % 2 == 0, "").otherwise("SCD Type1").alias("load_type"),
        keys.alias("primary_key_text"),
    )
    return tables, columns, mapping


_SPEC_SQL = f"""
WITH c AS (SELECT *, p_partkey // 20 AS spec, concat(upper(left(p_name, 1)), substr(split_part(p_name, ' ', 1), 2), ' ', upper(left(split_part(p_name, ' ', 2), 1)),
                  substr(split_part(p_name, ' ', 2), 2), ' ', p_partkey) AS src FROM part),
     d AS (SELECT *, CASE WHEN p_partkey % 3 <> 2 THEN concat('Col_', CASE WHEN p_partkey % 4 = 0 THEN 'email_' ELSE '' END, p_partkey) END AS mapped,
                  regexp_replace(lower(src), '[^a-z0-9]+', '_', 'g') AS slug FROM c),
     t AS (SELECT spec, string_agg(concat(lower(coalesce(mapped, slug)), ':', {_sql_list(_KINDS)}[p_size % 8 + 1]), ',' ORDER BY p_partkey) AS cols,
                  string_agg(CASE WHEN coalesce(mapped, slug) LIKE '%email%' THEN mapped END, ',' ORDER BY p_partkey) AS pii, count(*) AS n,
                  count(mapped) AS m, count(*) FILTER (WHERE mapped IS NULL) + count(*) FILTER (WHERE p_size % 8 IN (5, 6)) AS column_warnings,
                  arg_min(coalesce(mapped, slug), p_partkey) AS first_target, arg_min(mapped IS NULL, p_partkey) AS first_unmapped FROM d GROUP BY spec)
SELECT CASE WHEN spec % 2 = 0 THEN 'big_shop_na_us_monthly' ELSE 'big_shop_sea_us_monthly' END AS job_name, concat('table_', spec) AS table_name,
       concat('A:', chr(CAST(64 + n AS INT))) AS usecols, CASE WHEN spec % 2 = 0 THEN 'append' ELSE 'scd_type1' END AS load_type,
       CASE spec % 3 WHEN 0 THEN '' WHEN 1 THEN concat(first_target, ',unknown_key') ELSE first_target END AS primary_key, coalesce(pii, '') AS pii_columns,
       cols AS schema, CAST(column_warnings + (n <> m)::INT + 2 + (spec % 2) + CASE spec % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 + first_unmapped::INT ELSE first_unmapped::INT END AS BIGINT)
         AS warning_count FROM t"""


@configs.query("column_spec_config", _SPEC_SQL)
def column_spec_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = column_specs.table_configs(*_specs(spark, sf_dir))
    entry = F.transform("schema", lambda x: F.concat(x["column_name"], F.lit(":"), x["data_type"]))
    return made.select(
        "job_name",
        "table_name",
        "usecols",
        "load_type",
        F.array_join("primary_key", ",").alias("primary_key"),
        F.array_join("pii_columns", ",").alias("pii_columns"),
        F.array_join(entry, ",").alias("schema"),
        F.size("warnings").cast("bigint").alias("warning_count"),
    )


@configs.query("spec_configs_are_valid", "SELECT CAST(count(DISTINCT p_partkey // 20) AS BIGINT) AS configs, true AS all_valid FROM part")
def spec_configs_are_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configs made from specs pass the config rules."""
    checked = config.config_errors(column_specs.config_json(column_specs.table_configs(*_specs(spark, sf_dir))))
    return checked.agg(F.count("*").alias("configs"), F.bool_and(F.size("errors") == 0).alias("all_valid"))


# ---- personal data -----------------------------------------------------------------------------------------


@configs.query(
    "pii_detect",
    """SELECT p_partkey, p_size % 4 IN (0, 1) AS personal FROM part""",
)
def pii_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), _pick(["_EMail", "_first_name", "_size", "_name"], F.col("p_size")))
    return table(spark, sf_dir, "part").select("p_partkey", pii.looks_personal(name).alias("personal"))


@configs.query(
    "pii_round_trip", "SELECT c_custkey, CASE WHEN c_nationkey <> 3 THEN c_name END AS back, c_nationkey <> 3 AS hidden, true AS wrong_key_gives_null FROM customer"
)
def pii_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encrypted names differ from the plain ones and come back; blank names give null; another key gives null."""
    plain = table(spark, sf_dir, "customer").withColumn("c_name", F.when(F.col("c_nationkey") == 3, "").otherwise(F.col("c_name")))
    sealed = pii.encrypt_columns(plain.withColumn("plain", F.col("c_name")), ["c_name"], "0123456789abcdef")
    opened = pii.decrypt_columns(sealed.withColumn("sealed", F.col("c_name")), ["c_name"], "0123456789abcdef")
    return opened.select(
        "c_custkey",
        F.col("c_name").alias("back"),
        (F.coalesce(F.col("sealed") != F.col("plain"), F.lit(False))).alias("hidden"),
        pii.decrypted(F.col("sealed"), "another key, 16b").isNull().alias("wrong_key_gives_null"),
    )
