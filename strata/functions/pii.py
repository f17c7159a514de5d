"""Personal data: finding candidate columns, and reversible encryption inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import fixed
from strata.functions.text import col


def looks_personal(column_name: Column) -> Column:
    """True when a column *name* holds one of the hint words."""
    return F.lower(column_name).rlike("|".join(fixed.PII_HINTS))


def encrypted(c: Column, key: str) -> Column:
    """AES-GCM whose initial vector is a keyed digest of the text: equal texts stay equal, so that repeats, keys and
    changes can be told on the encrypted column. Who sees the column sees which rows are equal, and nothing else."""
    text, raw = c.cast("string"), _checked(key)
    inner = F.sha2(F.concat(F.lit(raw), F.encode(text, "UTF-8")), 256)
    vector = F.unhex(F.substring(F.sha2(F.concat(F.lit(raw), F.encode(inner, "UTF-8")), 256), 1, 24))
    return F.when(text != "", F.base64(F.aes_encrypt(text, F.lit(raw), F.lit("GCM"), F.lit("DEFAULT"), vector)))


def decrypted(c: Column, key: str) -> Column:
    """Plain text; null where the text is not something this key encrypted."""
    cipher = F.try_to_binary(c, F.lit("base64"))
    return F.when(c != "", F.try_aes_decrypt(cipher, F.lit(_checked(key))).cast("string"))


def encrypt_columns(df: DataFrame, columns: list[str], key: str | None) -> DataFrame:
    return df.withColumns({name: encrypted(col(name), key) for name in _present(df, columns)})


def decrypt_columns(df: DataFrame, columns: list[str], key: str | None) -> DataFrame:
    return df.withColumns({name: decrypted(col(name), key) for name in _present(df, columns)})


def _present(df: DataFrame, columns: list[str]) -> list[str]:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"personal-data columns not found: {missing}")
    return list(columns)


def _checked(key: str | None) -> bytes:
    raw = (key or "").encode()
    if len(raw) not in (16, 24, 32):
        raise ValueError("encryption needs a key of 16, 24 or 32 bytes")
    return raw
