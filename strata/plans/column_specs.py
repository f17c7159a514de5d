"""Column specs -> table configs.

A spec is a catalog of source columns per table and a mapping of source columns to target names. Many specs are turned
into configs by one job: joins for the names, column functions for types and codes, one grouping per table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import fixed
from strata.functions.naming import region_code
from strata.functions.pii import looks_personal
from strata.functions.text import slug


def type_base(sql_type: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(sql_type, r"\(.*\)", "")))


def normalized_type(sql_type: Column) -> Column:
    """Column type for an SQL type name; every number is a double, anything unknown a string."""
    base, result = type_base(sql_type), None
    for name, members in fixed.SQL_TYPE_GROUPS.items():
        test = base.isin(*members)
        result = F.when(test, name) if result is None else result.when(test, name)
    return result.otherwise("string")


def type_warning(sql_type: Column) -> Column:
    known = [name for members in fixed.SQL_TYPE_GROUPS.values() for name in members]
    base = type_base(sql_type)
    return (
        F.when(base.isin("boolean", "bool"), F.concat(F.lit("type '"), sql_type, F.lit("' has no equivalent, 'string' used")))
        .when(~base.isin(*known), F.concat(F.lit("unknown type '"), sql_type, F.lit("', 'string' used")))
    )


def mapped_names(columns: DataFrame, mapping: DataFrame, keys: list[str], source: str) -> DataFrame:
    """Adds ``target`` (exact match, else without regard to case, else slug) and ``mapped`` to ``columns``.

    ``mapping`` is (*keys, source_column, target_column). Where several source names differ in case only, the first
    by name counts.
    """
    exact = mapping.groupBy(*keys, F.col("source_column").alias(source)).agg(F.min("target_column").alias("__exact"))
    folded = mapping.groupBy(*keys, F.lower("source_column").alias("__low")).agg(
        F.min_by("target_column", "source_column").alias("__folded")
    )
    joined = (
        columns.join(exact, [*keys, source], "left")
        .withColumn("__low", F.lower(source))
        .join(folded, [*keys, "__low"], "left")
    )
    found = F.coalesce("__exact", "__folded")
    return joined.select(
        *columns.columns, F.coalesce(found, slug(F.col(source))).alias("target"), found.isNotNull().alias("mapped")
    )


def key_parts(tables: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., pos, part): the column names in ``primary_key_text``, in order; the words for none give nothing."""
    text = F.trim("primary_key_text")
    named = tables.where(text.isNotNull() & (text != "") & ~F.upper(text).isin(*fixed.NO_KEY_WORDS))
    parts = named.select(*keys, F.posexplode(F.split(text, "[,/]")).alias("pos", "raw"))
    return parts.select(*keys, "pos", F.trim("raw").alias("part")).where("part <> ''")


def table_configs(
    tables: DataFrame, columns: DataFrame, mapping: DataFrame, emails: list[str] = (), file_format: str = "excel"
) -> DataFrame:
    """One config per table.

    ``tables``: spec_id, source_path, region, market, domain, source_name, table_name, cadence, load_type,
    primary_key_text. ``columns``: spec_id, position, source_column, sql_type. ``mapping``: spec_id, source_column,
    target_column.
    """
    named = mapped_names(columns, mapping, ["spec_id"], "source_column")
    entry = F.struct(
        "position",
        F.struct(F.lower("target").alias("column_name"), normalized_type(F.col("sql_type")).alias("data_type")).alias("entry"),
        F.when(looks_personal(F.col("target")), F.col("target")).alias("pii"),
        F.when(~F.col("mapped"), F.concat(F.lit("no mapping for column '"), F.col("source_column"), F.lit("', slug used"))).alias("w1"),
        type_warning(F.col("sql_type")).alias("w2"),
    )
    per_table = named.groupBy("spec_id").agg(F.sort_array(F.collect_list(entry)).alias("cols"))
    mapped = mapping.groupBy("spec_id").agg(F.count_distinct("source_column").alias("mapping_count"))
    parts = mapped_names(key_parts(tables, ["spec_id"]), mapping, ["spec_id"], "part")
    keys = parts.groupBy("spec_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "target", "part", "mapped"))).alias("key_cols")
    )
    joined = tables.join(per_table, "spec_id", "left").join(mapped, "spec_id", "left").join(keys, "spec_id", "left")

    no_text = F.array().cast("array<string>")
    cols = F.coalesce("cols", F.array().cast(per_table.schema["cols"].dataType))
    key_cols = F.coalesce("key_cols", F.array().cast(keys.schema["key_cols"].dataType))
    count = F.size(cols)
    blank_path = F.coalesce(F.trim("source_path"), F.lit("")) == ""
    column_warnings = F.flatten(F.transform(cols, lambda c: F.array_compact(F.array(c["w1"], c["w2"]))))
    key_warnings = F.transform(
        F.filter(key_cols, lambda k: ~k["mapped"]),
        lambda k: F.concat(F.lit("key column '"), k["part"], F.lit("' not in the mapping, slug used")),
    )
    mapping_count = F.coalesce("mapping_count", F.lit(0))
    table_warnings = F.array_compact(
        F.array(
            F.when(count != mapping_count, F.concat(count.cast("string"), F.lit(" column(s) but "), mapping_count.cast("string"), F.lit(" mapping(s)"))),
            F.lit(f"file format '{file_format}' assumed") if file_format in fixed.FORMATS_WITH_OPTIONS else F.lit(None).cast("string"),
            F.when(blank_path, "source path is blank"),
            F.lit(None).cast("string") if emails else F.lit("no addresses given, placeholder used"),
        )
    )
    load_type = slug(F.coalesce("load_type", F.lit("")))
    receivers = F.array(*[F.lit(e) for e in (emails or [fixed.PLACEHOLDER_EMAIL])])
    pii = F.array_compact(F.transform(cols, lambda c: c["pii"]))
    return joined.select(
        "spec_id",
        F.concat_ws("_", slug(F.col("source_name")), region_code(F.col("region")), slug(F.col("market")), slug(F.col("cadence"))).alias("job_name"),
        slug(F.col("table_name")).alias("table_name"),
        "region",
        "market",
        "domain",
        "source_name",
        "source_path",
        F.lit(file_format).alias("file_format"),
        F.concat(F.lit("A:"), _letters(count)).alias("usecols"),
        F.when(load_type == "", "append").otherwise(load_type).alias("load_type"),
        F.coalesce(F.transform(key_cols, lambda k: k["target"]), no_text).alias("primary_key"),
        pii.alias("pii_columns"),
        receivers.alias("emails"),
        F.transform(cols, lambda c: c["entry"]).alias("schema"),
        F.concat(column_warnings, table_warnings, key_warnings).alias("warnings"),
    )


def _letters(count: Column) -> Column:
    """Spreadsheet letters of the count-th column, up to three of them."""
    last = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ")

    def letter(n: Column) -> Column:
        return F.substring(last, (n % 26 + 1).cast("int"), F.lit(1))

    one = letter(count - 1)
    two = F.when(count > 26, letter(F.floor((count - 27) / 26))).otherwise("")
    three = F.when(count > 702, letter(F.floor((count - 703) / 676))).otherwise("")
    return F.concat(three, two, one)


def config_json(configs: DataFrame) -> DataFrame:
    """(job_name, table_name, config): each config as the JSON text the control table is filled from."""
    options = {
        "excel": F.struct(
            F.lit(0).alias("sheet_index"),
            F.lit(1).alias("header_row"),
            F.lit(2).alias("data_start_row"),
            F.lit(fixed.WORKBOOK_LAST_ROW).alias("data_end_row"),
            "usecols",
        ),
        "csv": F.struct(F.lit(",").alias("delimiter")),
    }
    landing = F.struct(
        "source_path",
        "file_format",
        "pii_columns",
        *[F.when(F.col("file_format") == name, block).alias(f"{name}_options") for name, block in options.items()],
    )
    raw = F.struct(F.lit("enforce").alias("schema_config"), F.lit(True).alias("deduplication"))
    trusted = F.struct(
        "load_type",
        "primary_key",
        F.lit(False).alias("enable_expiration"),
        F.array(F.lit(fixed.COUNT_CHECK), F.lit(fixed.SCHEMA_CHECK)).alias("validations"),
        F.lit(True).alias("schema_evolution"),
    )
    config = F.struct(
        "region",
        "market",
        "domain",
        "source_name",
        F.struct("emails").alias("notify"),
        F.struct(F.lit("").alias("type")).alias("trigger"),
        F.struct(landing.alias("landing"), raw.alias("raw"), trusted.alias("raw_trusted")).alias("ingestion_steps"),
        "schema",
    )
    return configs.select("job_name", "table_name", F.to_json(config).alias("config"))
