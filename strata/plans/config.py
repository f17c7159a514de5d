"""Table configs: reading them, checking them by rule, keeping them in a control table, turning them into run plans.

Config texts are handled as rows of (job_name, table_name, config), so a folder of any number of configs is checked and
flattened by one DataFrame job. Rules need the JSON type of a value, not just its text, so values are looked up in a
variant and judged by how they are spelled as JSON.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from strata import fixed
from strata.functions.text import namespace

LANDING_TYPE = (
    "struct<source_path:string,file_format:string,format_options:string,format_options_key:string,"
    "notebook_path:string,parameters:string,pii_columns:array<string>>"
)
RAW_TYPE = "struct<schema_config:string,deduplication:boolean>"
TRUSTED_TYPE = (
    "struct<load_type:string,primary_key:array<string>,enable_expiration:boolean,validations:array<string>,"
    "schema_evolution:boolean>"
)
CONTROL_SCHEMA = (
    "job_name string, table_name string, region string, market string, domain string, source_name string, "
    f"ingestion_steps struct<landing:{LANDING_TYPE},raw:{RAW_TYPE},raw_trusted:{TRUSTED_TYPE}>, "
    "notify struct<emails:array<string>>, trigger struct<type:string,cron:string,timezone:string>, "
    "schema array<struct<column_name:string,data_type:string>>, is_active boolean, sync_timestamp timestamp"
)


# ---- reading -----------------------------------------------------------------------------------------------


def read_config_files(spark: SparkSession, folder: str) -> DataFrame:
    """(job_name, table_name, config) of every <folder>/<table>.json; the folder name is the job. A pattern of folders reads
    those of many jobs at once. Files that are not JSON keep their text and fail the rules later, by name."""
    files = spark.read.option("pathGlobFilter", "*.json").text(folder, wholetext=True)
    path = F.split("_metadata.file_path", "/")
    found = files.select(
        F.element_at(path, -2).alias("job_name"),
        F.regexp_replace(F.element_at(path, -1), r"\.json$", "").alias("table_name"),
        F.col("value").alias("config"),
    )
    if found.isEmpty():
        raise FileNotFoundError(f"no config files in {folder}")
    return found


def jobs_without_configs(wanted: DataFrame, configs: DataFrame) -> DataFrame:
    """Requested job names for which there is no readable config."""
    readable = configs.where(F.expr("try_parse_json(config)").isNotNull())
    return wanted.select("job_name").distinct().join(readable.select("job_name"), "job_name", "left_anti")


# ---- rules -------------------------------------------------------------------------------------------------


_LANDING, _RAW, _TRUSTED = "$.ingestion_steps.landing", "$.ingestion_steps.raw", "$.ingestion_steps.raw_trusted"

# Every place the rules look at. Each becomes one column of JSON text, computed once per config.
_PLACES = [
    *[f"$.{name}" for name in fixed.REQUIRED_FIELDS],
    *["$.is_active", "$.notify", "$.notify.emails", "$.trigger", "$.trigger.type", "$.trigger.cron", "$.trigger.timezone", "$.schema"],
    _LANDING,
    *[f"{_LANDING}.{name}" for name in ("parameters", "parameters.notebook_path", "source_path", "file_format", "pii_columns")],
    _RAW,
    *[f"{_RAW}.{name}" for name in ("schema_config", "deduplication")],
    _TRUSTED,
    *[f"{_TRUSTED}.{name}" for name in ("load_type", "schema_evolution")],
]


def _column_of(path: str) -> str:
    return "__at" + path.replace("$", "").replace(".", "_")


def _located(configs: DataFrame) -> DataFrame:
    parsed = configs.withColumn("__v", F.expr("try_parse_json(config)"))
    return parsed.withColumns({_column_of(p): F.to_json(F.try_variant_get(F.col("__v"), F.lit(p), "variant")) for p in _PLACES})


def _without_places(df: DataFrame) -> DataFrame:
    return df.drop("__v", *[_column_of(p) for p in _PLACES])


class _Json:
    """One place in a config: its JSON text, null where there is nothing."""

    def __init__(self, path: str):
        self.path = path
        self.text = F.col(_column_of(path))

    def absent(self) -> Column:
        return self.text.isNull()

    def nothing(self) -> Column:
        return F.coalesce(self.text, F.lit("null")) == "null"

    def empty(self) -> Column:
        """Nothing there, or a value that counts as none."""
        return F.coalesce(self.text, F.lit("null")).isin("null", '""', "0", "0.0", "[]", "{}", "false")

    def _starts(self, *marks: str) -> Column:
        return F.coalesce(F.substring(self.text, 1, 1).isin(*marks), F.lit(False))

    def is_boolean(self) -> Column:
        return F.coalesce(self.text.isin("true", "false"), F.lit(False))

    def is_object(self) -> Column:
        return self._starts("{")

    def is_array(self) -> Column:
        return self._starts("[")

    def is_text(self) -> Column:
        return self._starts('"')

    def string(self) -> Column:
        return F.when(self.is_text(), F.try_variant_get(F.col("__v"), F.lit(self.path), "string"))

    def elements(self) -> Column:
        return F.try_variant_get(F.col("__v"), F.lit(self.path), "array<variant>")

    def type_name(self) -> Column:
        return (
            F.when(self.nothing(), "NoneType")
            .when(self.is_boolean(), "bool")
            .when(self.is_text(), "str")
            .when(self.is_object(), "dict")
            .when(self.is_array(), "list")
            .when(self.text.rlike("[.eE]"), "float")
            .otherwise("int")
        )


def _options_key() -> Column:
    keys = F.json_object_keys(F.get_json_object("config", _LANDING))
    return F.try_element_at(F.filter(keys, lambda k: k.endswith("_options")), F.lit(1))


def _options_block(key: Column) -> Column:
    return F.call_function("get_json_object", F.get_json_object("config", _LANDING), F.concat(F.lit("$."), key))


def _top_rules() -> list[tuple[Column, Column]]:
    rules = [(_Json(f"$.{name}").nothing(), F.lit(f"Missing required field: '{name}'")) for name in fixed.REQUIRED_FIELDS]
    active = _Json("$.is_active")
    rules.append((~active.absent() & ~active.is_boolean(), F.concat(F.lit("'is_active' must be boolean, got "), active.type_name())))
    rules.append((_Json("$.ingestion_steps").empty(), F.lit("Missing 'ingestion_steps'")))
    return rules


def _landing_rules() -> list[tuple[Column, Column]]:
    parameters, notebook = _Json(f"{_LANDING}.parameters"), _Json(f"{_LANDING}.parameters.notebook_path")
    source, file_format = _Json(f"{_LANDING}.source_path"), _Json(f"{_LANDING}.file_format")
    pii = _Json(f"{_LANDING}.pii_columns")
    present = ~_Json(_LANDING).empty()
    api = present & ~parameters.absent()
    file = present & parameters.absent()
    name = F.lower(F.coalesce(file_format.string(), F.lit("")))
    needs_options = file & name.isin(*fixed.FORMATS_WITH_OPTIONS)
    key = _options_key()
    block = _options_block(key)
    entries = F.transform(pii.elements(), lambda e: F.to_json(e))
    return [
        (api & ~parameters.is_object(), F.lit("'parameters' must be a dict (api source)")),
        (api & parameters.is_object() & notebook.empty(), F.lit("Missing 'notebook_path' in landing.parameters")),
        (file & source.empty(), F.lit("Missing 'source_path' in landing")),
        (file & file_format.empty(), F.lit("Missing 'file_format' in landing")),
        (file & (name != "") & ~name.isin(*fixed.CONFIG_FORMATS), F.concat(F.lit("Invalid file_format '"), name, F.lit("'"))),
        (needs_options & key.isNull(), F.concat(F.lit("Missing '"), name, F.lit("_options' block for format '"), name, F.lit("'"))),
        (
            needs_options & key.isNotNull() & ~F.coalesce(block.startswith("{"), F.lit(False)),
            F.concat(F.lit("'"), key, F.lit("' must be a dict")),
        ),
        (file & pii.nothing(), F.lit("'pii_columns' is required (use empty list if none)")),
        (file & ~pii.nothing() & ~pii.is_array(), F.lit("'pii_columns' must be a list")),
        (file & pii.is_array() & (F.size(F.array_distinct(entries)) < F.size(entries)), F.lit("'pii_columns' contains duplicates")),
    ]


def _layer_rules(layer: str, path: str, required: str, flag: str) -> list[tuple[Column, Column]]:
    present, setting = ~_Json(path).empty(), _Json(f"{path}.{flag}")
    return [
        (present & _Json(f"{path}.{required}").empty(), F.lit(f"Missing '{required}' in '{layer}'")),
        (
            present & ~setting.nothing() & ~setting.is_boolean(),
            F.concat(F.lit(f"'{flag}' must be boolean, got "), setting.type_name()),
        ),
    ]


def _notify_rules() -> list[tuple[Column, Column]]:
    notify, emails = _Json("$.notify"), _Json("$.notify.emails")
    inside = notify.is_object()
    not_text = F.exists(emails.elements(), lambda e: ~F.to_json(e).startswith('"'))
    return [
        (~notify.nothing() & ~inside, F.concat(F.lit("'notify' must be a dict, got "), notify.type_name())),
        (inside & emails.nothing(), F.lit("'notify.emails' is required")),
        (inside & ~emails.nothing() & ~emails.is_array(), F.lit("'notify.emails' must be a list")),
        (inside & (emails.text == "[]"), F.lit("'notify.emails' cannot be empty")),
        (inside & emails.is_array() & F.coalesce(not_text, F.lit(False)), F.lit("'notify.emails' must contain only strings")),
    ]


def _trigger_rules() -> list[tuple[Column, Column]]:
    trigger, kind = _Json("$.trigger"), _Json("$.trigger.type")
    inside = trigger.is_object() & ~kind.empty()
    scheduled = inside & F.coalesce(kind.string() == "schedule", F.lit(False))
    known = F.coalesce(kind.string().isin(*fixed.TRIGGER_TYPES), F.lit(False))
    shown = F.coalesce(kind.string(), kind.text)
    return [
        (~trigger.nothing() & ~trigger.is_object(), F.concat(F.lit("'trigger' must be a dict, got "), trigger.type_name())),
        (inside & ~known, F.concat(F.lit("Invalid trigger.type '"), shown, F.lit("'"))),
        (scheduled & _Json("$.trigger.cron").empty(), F.lit("'trigger.cron' required for schedule trigger")),
        (scheduled & _Json("$.trigger.timezone").empty(), F.lit("'trigger.timezone' required for schedule trigger")),
    ]


def _schema_errors() -> Column:
    def judge(entry: Column, i: Column) -> Column:
        keys = F.coalesce(F.json_object_keys(F.to_json(entry)), F.array().cast("array<string>"))
        complete = F.array_contains(keys, "column_name") & F.array_contains(keys, "data_type")
        return F.when(~complete, F.concat(F.lit("Schema entry "), i.cast("string"), F.lit(" missing required fields")))

    return F.coalesce(F.transform(_Json("$.schema").elements(), judge), F.array().cast("array<string>"))


def config_errors(configs: DataFrame) -> DataFrame:
    """``configs`` plus ``errors``: every broken rule of each config, in rule order; an empty array is a good config."""
    parsed = _located(configs)
    always = _top_rules()
    later = [
        *_landing_rules(),
        *_layer_rules("raw", _RAW, "schema_config", "deduplication"),
        *_layer_rules("raw_trusted", _TRUSTED, "load_type", "schema_evolution"),
        *_notify_rules(),
        *_trigger_rules(),
    ]

    def found(rules):
        return F.array_compact(F.array(*[F.when(F.coalesce(broken, F.lit(False)), message) for broken, message in rules]))

    more = F.concat(found(later), F.array_compact(_schema_errors()))
    has_steps = ~_Json("$.ingestion_steps").empty()
    errors = F.when(has_steps, F.concat(found(always), more)).otherwise(found(always))
    unreadable = F.array(F.lit("not valid JSON"))
    return _without_places(parsed.withColumn("errors", F.when(F.col("__v").isNull(), unreadable).otherwise(errors)))


# ---- control table -----------------------------------------------------------------------------------------


def _text_list(path: str, parsed: Column, none: Column) -> Column:
    """The list, empty if nothing is given. A lone text is a list of one: left out, its column would stay readable."""
    given = F.get_json_object("config", path)
    lone = F.when(F.coalesce(F.trim(given), F.lit("")) != "", F.array(F.trim(given)))
    return F.when(given.startswith("["), F.coalesce(parsed, none)).otherwise(F.coalesce(lone, parsed, none))


def control_rows(configs: DataFrame, sync_timestamp) -> DataFrame:
    """Config texts as rows of the control table. Absent layers stay null."""
    v = _located(configs)
    typed = F.from_json(
        "config",
        "region string, market string, domain string, source_name string, is_active boolean, "
        "notify struct<emails:array<string>>, trigger struct<type:string,cron:string,timezone:string>, "
        "schema array<struct<column_name:string,data_type:string>>, "
        "ingestion_steps struct<landing:struct<source_path:string,file_format:string,"
        f"parameters:struct<notebook_path:string>,pii_columns:array<string>>,raw:{RAW_TYPE},raw_trusted:{TRUSTED_TYPE}>",
    )
    c = v.withColumn("c", typed).withColumn("__key", _options_key())
    no_text = F.array().cast("array<string>")
    block = _options_block(F.col("__key"))
    step = "c.ingestion_steps"
    landing = F.when(
        ~_Json(_LANDING).empty(),
        F.struct(
            F.col(f"{step}.landing.source_path"),
            F.col(f"{step}.landing.file_format"),
            block.alias("format_options"),
            F.col("__key").alias("format_options_key"),
            F.col(f"{step}.landing.parameters.notebook_path"),
            F.get_json_object("config", f"{_LANDING}.parameters").alias("parameters"),
            _text_list(f"{_LANDING}.pii_columns", F.col(f"{step}.landing.pii_columns"), no_text).alias("pii_columns"),
        ),
    )
    trusted = F.when(
        ~_Json(_TRUSTED).empty(),
        F.struct(
            F.col(f"{step}.raw_trusted.load_type"),
            F.coalesce(f"{step}.raw_trusted.primary_key", no_text).alias("primary_key"),
            F.col(f"{step}.raw_trusted.enable_expiration"),
            F.coalesce(f"{step}.raw_trusted.validations", no_text).alias("validations"),
            F.col(f"{step}.raw_trusted.schema_evolution"),
        ),
    )
    raw = F.when(~_Json(_RAW).empty(), F.col(f"{step}.raw"))
    steps = F.when(
        F.coalesce(landing.isNotNull() | raw.isNotNull() | trusted.isNotNull(), F.lit(False)),
        F.struct(landing.alias("landing"), raw.alias("raw"), trusted.alias("raw_trusted")),
    )
    notify = F.when(
        ~_Json("$.notify").empty(), F.struct(F.coalesce("c.notify.emails", no_text).alias("emails"))
    )
    trigger = F.when(
        ~_Json("$.trigger").empty(),
        F.struct(
            F.coalesce("c.trigger.type", F.lit("")).alias("type"), F.col("c.trigger.cron"), F.col("c.trigger.timezone")
        ),
    )
    return c.select(
        "job_name",
        "table_name",
        *[F.col(f"c.{name}").alias(name) for name in ("region", "market", "domain", "source_name")],
        steps.alias("ingestion_steps"),
        notify.alias("notify"),
        trigger.alias("trigger"),
        F.coalesce("c.schema", F.array().cast("array<struct<column_name:string,data_type:string>>")).alias("schema"),
        F.coalesce("c.is_active", F.lit(True)).alias("is_active"),
        F.lit(sync_timestamp).cast("timestamp").alias("sync_timestamp"),
    )


def active_rows(control: DataFrame, job_name: str | Column) -> DataFrame:
    job = F.lit(job_name) if isinstance(job_name, str) else job_name
    return control.where(F.col("is_active") & (F.col("job_name") == job))


def layer_enabled(layer: Column, fields: list[str]) -> Column:
    """A layer counts when any of its fields holds something."""
    return F.coalesce(*[F.when(layer[f].isNotNull(), True) for f in fields], F.lit(False))


def pick_tables(control: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Control rows of the named tables, and the names that have none."""
    wanted = names.select("table_name").distinct()
    return control.join(wanted, "table_name", "left_semi"), wanted.join(control.select("table_name"), "table_name", "left_anti")


def config_of_row(row: Row) -> dict:
    """Control row -> config dict; a schema stored as JSON text is parsed, an unreadable one is empty."""
    config = {k: v for k, v in row.asDict(recursive=True).items() if k != "sync_timestamp"}
    schema = config.get("schema")
    if isinstance(schema, str):
        try:
            schema = json.loads(schema)
        except ValueError:
            schema = []
    config["schema"] = schema if isinstance(schema, list) else []
    config["ingestion_steps"] = config.get("ingestion_steps") or {}
    return config


def enabled(layer: dict | None) -> bool:
    return isinstance(layer, dict) and any(v is not None for v in layer.values())



# ---- locations ---------------------------------------------------------------------------------------------


def target_locations(df: DataFrame, landing_base: str, raw_base: str, catalog: str, run_ts: str) -> DataFrame:
    """Adds the Landing and Raw folders and the trusted table name of (region, market, domain, source_name, table_name)."""
    base = F.concat_ws("/", "region", "market", "domain", "source_name", "table_name")
    return df.select(
        "*",
        F.concat_ws("/", F.lit(landing_base), base, F.lit(run_ts)).alias("landing"),
        F.concat_ws("/", F.lit(raw_base), base, F.lit(run_ts)).alias("raw"),
        F.concat_ws(".", F.lit(catalog), namespace(F.col("source_name"), F.col("market")), "table_name").alias("raw_trusted"),
    )


def namespace_of(source_name: str, market: str) -> str:
    return "_".join(text.lower().strip().replace(" ", "_") for text in (source_name, market))


def locations(config: dict, run_ts: str, base: str) -> dict[str, str]:
    """Folders of one table run under ``base``."""
    place = "/".join(str(config.get(k) or "") for k in ("region", "market", "domain", "source_name", "table_name"))
    schema = namespace_of(config.get("source_name") or "", config.get("market") or "")
    root = base.rstrip("/")
    return {
        "landing_runs": f"{root}/landing/{place}",
        "raw_runs": f"{root}/raw/{place}",
        "landing": f"{root}/landing/{place}/{run_ts}",
        "raw": f"{root}/raw/{place}/{run_ts}",
        "raw_trusted": f"{root}/trusted/{schema}/{config['table_name']}",
        "manifests": f"{root}/manifests/{place}",
        "counts": f"{root}/counts/{place}/{run_ts}",
        "trusted_name": f"{schema}.{config['table_name']}",
        "errors": f"{root}/errors/{schema}/{config['table_name']}_errors",
    }
