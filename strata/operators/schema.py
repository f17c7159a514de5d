"""Schema enforcement and inference on landed text.

Both need one pass of counting before anything is cast. The counters are plain aggregate expressions, so callers put
them into one ``agg`` together with whatever else they want to know about the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import fixed
from strata.functions import parsing
from strata.functions.parsing import spark_type, typed
from strata.functions.text import col, quoted
from strata.session import keep_methods_small

# ---- configured schemas ------------------------------------------------------------------------------------


_ENTRY = ("column_name", "data_type")


def schema_entries(schema_config) -> list[dict]:
    """Entries as dicts. A config gives them as mappings, rows or objects with these fields, or as [name, type] lists."""

    def fields(entry) -> dict:
        positional = isinstance(entry, (list, tuple)) and not isinstance(entry, T.Row)
        if positional:
            return dict(zip(_ENTRY, entry))
        return entry.asDict() if isinstance(entry, T.Row) else dict(entry if isinstance(entry, Mapping) else vars(entry))

    return [entry for entry in map(fields, schema_config or []) if "data_type" in entry]


def struct_type(schema_config) -> T.StructType:
    """The Spark schema a config stands for; unknown type names count as string."""
    columns = [(e["column_name"].replace("`", "``"), spark_type(e["data_type"]) or "string") for e in schema_entries(schema_config)]
    return T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in columns))


# ---- enforcement -------------------------------------------------------------------------------------------


def _targets(columns: list[str], entries: list[dict]) -> dict[str, tuple]:
    """(name, type, own date patterns) per configured column that is present and has a known type."""
    targets = {}
    for entry in entries:
        name, target = entry["column_name"], spark_type(entry["data_type"])
        if name in columns and target:
            targets[name] = (name, target, entry.get("formats"))
    return targets


def _casts(columns: list[str], entries: list[dict]) -> dict[str, Column]:
    return {name: typed(*how) for name, how in _targets(columns, entries).items()}


def _failing(columns: list[str], schema_config) -> dict[str, Column]:
    """Per column that can fail: whether a value means something but does not parse."""
    targets = _targets(columns, schema_entries(schema_config))
    return {name: F.expr(parsing.fails_sql(*how)) for name, how in targets.items()}


def enforced(df: DataFrame, schema_config) -> DataFrame:
    """Configured columns first and cast, in config order; the others follow as they are."""
    keep_methods_small(df.sparkSession)
    entries = schema_entries(schema_config)
    casts = _casts(df.columns, entries)
    configured = [e["column_name"] for e in entries if e["column_name"] in df.columns]
    rest = [name for name in df.columns if name not in configured]
    return df.select(*[casts.get(name, col(name)).alias(name) for name in configured + rest])


def failure_counters(columns: list[str], schema_config) -> dict[str, Column]:
    """Per column: how many values mean something but do not parse."""
    return {name: F.count_if(failing) for name, failing in _failing(columns, schema_config).items()}


def raise_on_failures(failures: dict[str, int], schema_config) -> None:
    types = {e["column_name"]: e["data_type"] for e in schema_entries(schema_config)}
    bad = [f"column '{name}': {count} value(s) do not parse as {types[name]}" for name, count in failures.items() if count]
    if bad:
        raise ValueError("; ".join(bad))


def cast_failures(df: DataFrame, schema_config) -> DataFrame:
    """(column_name, data_type, failures), one row per checked column, from one pass."""
    keep_methods_small(df.sparkSession)
    counters = failure_counters(df.columns, schema_config)
    types = {e["column_name"]: e["data_type"] for e in schema_entries(schema_config)}
    counted = df.agg(
        F.array(
            *[
                F.struct(F.lit(name).alias("column_name"), F.lit(types[name]).alias("data_type"), c.alias("failures"))
                for name, c in counters.items()
            ]
        ).alias("checks")
    )
    return counted.select(F.inline("checks"))


def cast_failure_rows(df: DataFrame, schema_config) -> DataFrame:
    """The rows that would fail, unchanged, with the names of the columns that do not parse."""
    keep_methods_small(df.sparkSession)
    named = [F.when(failing, F.lit(name)) for name, failing in _failing(df.columns, schema_config).items()]
    marked = df.withColumn("failed_columns", F.array_compact(F.array(*named)))
    return marked.where(F.size("failed_columns") > 0)


def enforce_schema(df: DataFrame, schema_config, gate: bool = True) -> DataFrame:
    if not schema_entries(schema_config):
        return df
    keep_methods_small(df.sparkSession)
    counters = failure_counters(df.columns, schema_config)
    if gate and counters:
        raise_on_failures(df.agg(*[c.alias(name) for name, c in counters.items()]).first().asDict(), schema_config)
    return enforced(df, schema_config)


# ---- inference ---------------------------------------------------------------------------------------------

# Every value is mapped to the set of types that accept it, one bit per type; AND over a column leaves the types that
# accept all its values. A double accepts every number, but is taken only where it tells all of them apart (_EXACT: at most
# 15 significant digits); else the most digits before and behind the point make a decimal, or the column stays text.
# Three aggregates per column, and nothing is sampled.
_INT, _BIGINT, _DOUBLE, _DATE, _TIMESTAMP, _MIDNIGHT, _EXACT = 1, 2, 4, 8, 16, 32, 64
_MOST_DIGITS = 38


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def with_type_bits(df: DataFrame, names: list[str]) -> DataFrame:
    """Adds, per named text column, the set of types that accept its value (null for a null word) as ``__bits_<i>``, and the
    digits of a number before and behind the point as ``__whole_digits_<i>`` and ``__scale_<i>``.

    Intermediate values get columns of their own step by step; as one expression they would be computed, and compiled,
    once for every use.
    """
    if not names:
        return df
    keep_methods_small(df.sparkSession)
    read, digits, sizes, judged, bits = [], [], [], [], []
    for i, name in enumerate(names):
        read.append(f"{parsing.whole_sql(name)} AS __whole_{i}")
        read.append(f"{parsing.moment_sql(name)} AS __instant_{i}")
        digits.append(f"CASE WHEN __whole_{i} IS NULL AND {parsing.is_real_sql(name)} THEN {parsing.unsigned_sql(name)} END AS __real_{i}")
        sizes.append(
            f"""cast(CASE WHEN __whole_{i} IS NOT NULL THEN length(replace(cast(__whole_{i} AS string), '-', ''))
                     WHEN __real_{i} RLIKE '[A-Za-z]' THEN 99 ELSE length(ltrim('0', split_part(__real_{i}, '.', 1))) END AS smallint) AS __whole_digits_{i}"""
        )
        sizes.append(
            f"""cast(CASE WHEN __whole_{i} IS NOT NULL THEN 0 WHEN __real_{i} RLIKE '[A-Za-z]' THEN 99
                     ELSE length(rtrim('0', split_part(__real_{i}, '.', 2))) END AS smallint) AS __scale_{i}"""
        )
        judged.append(
            f"""CASE WHEN __whole_{i} BETWEEN -2147483648 AND 2147483647 THEN {_INT | _BIGINT | _DOUBLE | _EXACT}
                     WHEN __whole_{i} BETWEEN -{2**53} AND {2**53} THEN {_BIGINT | _DOUBLE | _EXACT}
                     WHEN __whole_{i} IS NOT NULL THEN {_BIGINT | _DOUBLE}
                     WHEN length(trim('0' FROM replace(regexp_replace(__real_{i}, '[eE].*$', ''), '.', ''))) <= 15 THEN {_DOUBLE | _EXACT}
                     WHEN __real_{i} IS NOT NULL THEN {_DOUBLE} ELSE 0 END
                | CASE WHEN __instant_{i} IS NULL THEN 0 ELSE {_DATE}
                     | CASE WHEN contains({quoted(name)}, ':') AND date_trunc('day', __instant_{i}) <> __instant_{i} THEN 0 ELSE {_MIDNIGHT} END
                     | CASE WHEN {parsing.is_timestamp_sql(name)} THEN {_TIMESTAMP} ELSE 0 END END AS __accepted_{i}"""
        )
        bits.append(f"CASE WHEN __accepted_{i} <> 0 OR NOT {parsing.is_null_word_sql(name)} THEN __accepted_{i} END AS __bits_{i}")
    kept = [quoted(name) for name in df.columns]
    accepted = [f"__accepted_{i}" for i in range(len(names))]
    measured = [f"__{kind}_{i}" for i in range(len(names)) for kind in ("whole_digits", "scale")]
    judged_rows = df.selectExpr("*", *read).selectExpr("*", *digits).selectExpr(*kept, *sizes, *judged)
    return judged_rows.selectExpr(*kept, *measured, *accepted, *bits).drop(*accepted)


def type_of_bits(bits: int | None, whole_digits: int | None = None, scale: int | None = None) -> str | None:
    if bits is None:
        return None
    for bit, name in ((_INT, "int"), (_BIGINT, "bigint"), (_DOUBLE | _EXACT, "double")):
        if bits & bit == bit:
            return name
    if bits & _DOUBLE:
        digits = (whole_digits or 0) + (scale or 0)
        return f"decimal({max(digits, 1)},{scale or 0})" if digits <= _MOST_DIGITS else None
    if bits & _DATE and bits & _MIDNIGHT:
        return "date"
    return "timestamp" if bits & _TIMESTAMP else None


def type_counters(names: list[str]) -> dict[str, Column]:
    """Over a DataFrame made by ``with_type_bits``: AND of each column's type bits (an int), and the most digits (smallints)."""
    counters = {}
    for i, name in enumerate(names):
        counters[name] = F.bit_and(F.col(f"__bits_{i}"))
        counters[name, "whole_digits"] = F.max(F.col(f"__whole_digits_{i}"))
        counters[name, "scale"] = F.max(F.col(f"__scale_{i}"))
    return counters


def inferred_entries(measured: dict) -> list[dict]:
    """Schema entries from the values of ``type_counters``."""
    names = [name for name in measured if isinstance(name, str)]
    found = {name: type_of_bits(measured[name], measured[name, "whole_digits"], measured[name, "scale"]) for name in names}
    return [{"column_name": name, "data_type": kind} for name, kind in found.items() if kind]


def infer_types(df: DataFrame, columns_per_pass: int = 200) -> list[dict]:
    """Types of the text columns over all rows."""
    names, measured = text_columns(df), {}
    for start in range(0, len(names), columns_per_pass):
        counters = type_counters(names[start : start + columns_per_pass])
        counted = with_type_bits(df, names[start : start + columns_per_pass]).agg(*[c.alias(f"c{i}") for i, c in enumerate(counters.values())]).first()
        measured |= {name: counted[f"c{i}"] for i, name in enumerate(counters)}
    return inferred_entries(measured)


def infer_schema(df: DataFrame) -> DataFrame:
    casts = _casts(df.columns, infer_types(df))
    return df.select(*[casts.get(name, col(name)).alias(name) for name in df.columns])


# ---- alignment of nested rows to a target schema -----------------------------------------------------------


def _aligned(value: Column, have: T.DataType, want: T.DataType) -> Column:
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        fields = {f.name: f.dataType for f in have.fields}
        built = [
            _aligned(value[f.name], fields[f.name], f.dataType) if f.name in fields else F.lit(None).cast(f.dataType)
            for f in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*[c.alias(f.name) for c, f in zip(built, want.fields)]))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda x: _aligned(x, have.elementType, want.elementType))
    return value.cast(want)


def align_to(df: DataFrame, target: T.StructType) -> DataFrame:
    """Columns of ``target`` in its order and types, nested ones included; null structs stay null."""
    have = {f.name: f.dataType for f in df.schema.fields}
    columns = [
        _aligned(col(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)
        for f in target.fields
    ]
    return df.select(*[c.alias(f.name) for c, f in zip(columns, target.fields)])


# ---- evolution ---------------------------------------------------------------------------------------------

# Wider types a stored column can be read as without rewriting its files.
WIDENINGS = {("int", "bigint"), ("int", "double"), ("float", "double"), ("date", "timestamp_ntz")}

AUDIT_COLUMNS = {fixed.HASH_COLUMN, fixed.VALID_FROM, fixed.VALID_TO, fixed.IS_CURRENT}


def schema_changes(existing: T.StructType, incoming: T.StructType) -> dict:
    """What an incoming schema adds, lacks and retypes, audit columns left aside."""
    old = {f.name: f.dataType.simpleString() for f in existing.fields if f.name not in AUDIT_COLUMNS}
    new = {f.name: f.dataType.simpleString() for f in incoming.fields if f.name not in AUDIT_COLUMNS}
    added = sorted(set(new) - set(old))
    retyped = {name: (old[name], new[name]) for name in sorted(set(old) & set(new)) if old[name] != new[name]}
    return {
        "new_columns": added,
        "removed_columns": sorted(set(old) - set(new)),
        "type_changes": retyped,
        "has_changes": bool(added or any(pair in WIDENINGS for pair in retyped.values())),
    }


def evolved_schema(existing: T.StructType, incoming: T.StructType) -> T.StructType:
    """The existing schema plus new columns, with safe widenings applied. Columns are never removed."""
    changes = schema_changes(existing, incoming)
    fields = []
    for field in existing.fields:
        pair = changes["type_changes"].get(field.name)
        wider = incoming[field.name].dataType if pair in WIDENINGS else field.dataType
        fields.append(T.StructField(field.name, wider, True))
    fields += [T.StructField(name, incoming[name].dataType, True) for name in changes["new_columns"]]
    return T.StructType(fields)


def check_types(target: T.StructType, incoming: T.StructType) -> None:
    """Incoming columns must have the target's type, or one that widens to it."""
    bad = {
        name: pair
        for name, pair in schema_changes(target, incoming)["type_changes"].items()
        if (pair[1], pair[0]) not in WIDENINGS
    }
    if bad:
        raise ValueError(f"incoming column types do not fit the table: {bad}")


def evolve_catalog_table(df: DataFrame, table: str) -> list[str]:
    """Adds the new columns of ``df`` to a catalog table and returns their names."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        return []
    added = schema_changes(spark.table(table).schema, df.schema)["new_columns"]
    if added:
        columns = ", ".join(f"`{name}` {df.schema[name].dataType.simpleString()}" for name in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return added
