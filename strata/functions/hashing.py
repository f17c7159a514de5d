"""Row hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import fixed
from strata.functions.text import col


def hashed_columns(columns: list[str], exclude: list[str] = ()) -> list[str]:
    left_out = {*fixed.HASH_EXCLUDED, *(name.lower() for name in exclude)}
    return sorted(name for name in columns if name.lower() not in left_out)


def row_hash(columns: list[str], exclude: list[str] = ()) -> Column:
    """sha-256 over the business columns as text, in name order, nulls spelled NULL, parted by '|'."""
    names = hashed_columns(columns, exclude)
    if not names:
        return F.lit(None).cast("string")
    texts = [F.coalesce(col(name).cast("string"), F.lit("NULL")) for name in names]
    return F.sha2(F.concat_ws("|", *texts), 256)


def value_digest(schema: T.StructType, columns: list[str]) -> Column:
    """sha-256 that tells any two rows apart: every value with its length, null unlike any text, nested values as JSON."""
    exact = {
        "ignoreNullFields": "false",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    }
    parts = [F.lit("")]
    for name in sorted(columns):
        kind = schema[name].dataType
        nested = isinstance(kind, (T.StructType, T.ArrayType, T.MapType))
        text = F.to_json(col(name), exact) if nested else F.base64(col(name)) if isinstance(kind, T.BinaryType) else col(name).cast("string")
        parts += [F.coalesce(F.char_length(text).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(text, F.lit(""))]
    return F.sha2(F.concat(*parts), 256)


def with_row_hash(df: DataFrame, exclude: list[str] = ()) -> DataFrame:
    return df.withColumn(fixed.HASH_COLUMN, row_hash(df.columns, exclude))
