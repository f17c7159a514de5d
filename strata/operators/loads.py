"""Loads by config, and loads into versioned tables: append, overwrite, SCD type 1, SCD type 2, whole-row upsert.

A config's loads go to a table of ``strata.operators.trusted`` unless its versions are wanted, to be read back by number or time.

A merge is a few equi joins. The source side of each is its key columns alone, which Spark broadcasts when the written
source is small, so that a small batch is merged without shuffling the table; beyond that size both sides shuffle.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import fixed
from strata.functions.hashing import hashed_columns, value_digest, with_row_hash
from strata.functions.text import col
from strata.operators.schema import align_to, check_types, evolved_schema, schema_changes
from strata.operators.snapshots import LIVE, Commit, SnapshotTable, open_table
from strata.operators.trusted import TrustedTable, require_unique_keys


def load_type_name(load_type: str) -> str:
    name = load_type.lower().strip()
    name = fixed.LOAD_ALIASES.get(name, name)
    if name not in fixed.LOAD_TYPES:
        raise ValueError(f"unsupported load type '{load_type}'; supported: {fixed.LOAD_TYPES}")
    return name


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(microsecond=0)


def _target_schema(commit: Commit | None, df: DataFrame, evolve: bool) -> T.StructType:
    if commit is None:
        return df.schema
    if evolve:
        schema = evolved_schema(commit.schema, df.schema)
    else:
        schema = commit.schema
    check_types(schema, df.schema)
    return schema


def _latest(table: SnapshotTable) -> Commit | None:
    return table.commit() if table.exists() else None


# ---- append and overwrite ----------------------------------------------------------------------------------


def append(table: SnapshotTable, df: DataFrame, evolve: bool = False, batch_id: str | None = None, now=None) -> int:
    """Adds rows. Columns the table does not have are left out unless ``evolve``; columns it has must be there.

    With ``batch_id``, an earlier load of the same batch is replaced, so a batch may be repeated safely.
    """
    commit = _latest(table)
    schema = _target_schema(commit, df, evolve)
    if commit is not None and not evolve:
        missing = [f.name for f in schema.fields if f.name not in df.columns]
        if missing:
            raise ValueError(f"columns of the table not in the source: {missing}")
    parts = [p for p in (commit.parts if commit else ()) if batch_id is None or p.batch != batch_id]
    return table.publish(schema, parts + table.write_part(align_to(df, schema), batch_id), "append", now)


def overwrite(table: SnapshotTable, df: DataFrame, now=None) -> int:
    return table.publish(df.schema, table.write_part(df), "overwrite", now)


# ---- SCD type 1 and whole-row upsert -----------------------------------------------------------------------


def upsert(
    table: SnapshotTable,
    df: DataFrame,
    keys: list[str],
    evolve: bool = False,
    mode: str = "scd_type1",
    keys_checked: bool = False,
    now=None,
) -> int:
    """Source rows replace table rows of the same key and are added otherwise. Table columns the source lacks keep
    their value on replaced rows."""
    if not keys_checked:
        require_unique_keys(df, keys)
    commit = _latest(table)
    if commit is None:
        return table.publish(df.schema, table.write_part(df), mode, now)
    schema = _target_schema(commit, df, evolve)
    touched = table.parts_with(commit, commit.parts, df, keys)
    rows = table.read_parts(schema, touched)
    kept = rows.join(df.select(*[col(k) for k in keys]), keys, "left_anti").select(*rows.columns)
    carried = [f.name for f in schema.fields if f.name not in df.columns]
    source = df
    if carried and touched:
        matched = rows.join(df.select(*[col(k) for k in keys]), keys, "left_semi")
        source = df.join(matched.select(*[col(c) for c in [*keys, *carried]]), keys, "left")
    written = table.write_part(kept.unionByName(align_to(source, schema)))
    untouched = [p for p in commit.parts if p not in touched]
    return table.publish(schema, untouched + written, mode, now)


def upsert_all(table: SnapshotTable, df: DataFrame, keys: list[str], now=None) -> int:
    """Whole-row upsert, for framework tables: columns must be those of the table."""
    commit = _latest(table)
    if commit is not None:
        changes = schema_changes(commit.schema, df.schema)
        if changes["new_columns"] or changes["removed_columns"]:
            raise ValueError(f"columns differ from the table: {changes}")
    return upsert(table, df, keys, mode="upsert_all", now=now)


# ---- SCD type 2 --------------------------------------------------------------------------------------------


def scd2(
    table: SnapshotTable,
    df: DataFrame,
    keys: list[str],
    evolve: bool = False,
    expire_only: bool = False,
    expire_missing: bool = False,
    keys_checked: bool = False,
    now: str | datetime | None = None,
    compare_exclude: list[str] = (fixed.LINEAGE_COLUMN,),
) -> int:
    """History load. A changed row ends the current version of its key and starts a new one; equal rows change nothing;
    unknown keys are added. Rows are compared by their values in the columns that source and table share, except those
    in ``compare_exclude``; a new version has null in columns that the source lacks.

    ``expire_only`` ends every matched version and starts a new one only in the next load. ``expire_missing`` takes
    the source for a full snapshot and ends versions whose key is not in it. Closed versions are never read again.
    """
    if not keys_checked:
        require_unique_keys(df, keys)
    moment = F.lit(now or _now()).cast("timestamp")
    fresh = df.withColumns(
        {fixed.VALID_FROM: moment, fixed.VALID_TO: F.lit(None).cast("timestamp"), fixed.IS_CURRENT: F.lit(True)}
    )
    commit = _latest(table)
    if commit is None:
        return table.publish(fresh.schema, table.write_part(fresh), "scd_type2", now)
    schema = _target_schema(commit, fresh, evolve)
    live = [p for p in commit.parts if p.role == LIVE]
    touched = live if expire_missing else table.parts_with(commit, live, df, keys)
    current = table.read_parts(schema, touched)

    offers = {name.lower() for name in df.columns}
    shared = [n for n in hashed_columns([f.name for f in schema.fields], compare_exclude) if n.lower() in offers]
    digest = value_digest(schema, shared)
    aligned = align_to(fresh, schema).withColumn("__values", digest)
    current = current.withColumn("__values", digest)
    offered = aligned.select(*[col(k) for k in keys], F.col("__values").alias("__offered"), F.lit(True).alias("__hit"))
    joined = current.join(offered, keys, "left")
    ends = F.coalesce(F.col("__hit"), F.lit(False))
    if not expire_only:
        ends = ends & (F.col("__values") != F.col("__offered"))
    if expire_missing:
        ends = ends | F.col("__hit").isNull()
    settled = joined.withColumn("__ends", ends).select(
        *[
            F.when(F.col("__ends"), moment).otherwise(col(f.name)).alias(f.name)
            if f.name == fixed.VALID_TO
            else (col(f.name) & ~F.col("__ends")).alias(f.name)
            if f.name == fixed.IS_CURRENT
            else col(f.name)
            for f in schema.fields
        ]
    )
    held = current.select(*[col(k) for k in keys], "__values").join(offered.select(*[col(k) for k in keys]), keys, "left_semi")
    same = reduce(and_, [aligned[k] == held[k] for k in keys])
    if not expire_only:
        same = same & (aligned["__values"] == held["__values"])
    added = aligned.join(held, same, "left_anti").drop("__values")

    written = table.write_split(settled.unionByName(added), col(fixed.IS_CURRENT))
    untouched = [p for p in commit.parts if p not in touched]
    return table.publish(schema, untouched + written, "scd_type2", now)


# ---- by config ---------------------------------------------------------------------------------------------


def load(
    spark: SparkSession,
    df: DataFrame,
    target: str,
    load_type: str = "append",
    keys: list[str] = (),
    *,
    evolve: bool = False,
    expire_missing: bool = False,
    expire_only: bool = False,
    batch_id: str | None = None,
    hash_exclude: list[str] = (fixed.LINEAGE_COLUMN,),
    keys_checked: bool = False,
    buckets: int | None = None,
    name: str | None = None,
    versioned: bool = False,
    now=None,
) -> int:
    """Adds ``row_hash`` (by default without lineage, which changes with every file) and loads ``df`` into the table at ``target``
    (a path or catalog.schema.table; ``name`` gives a path a name in the catalog). Returns the number of the load, from 0.
    ``keys_checked`` says that a check has found the keys unique, so that they need not be counted again. ``buckets`` is how
    many parts of the table a merge can replace on their own. ``versioned`` keeps every load readable."""
    kind, keys = load_type_name(load_type), list(keys or [])
    if kind.startswith("scd") and not keys:
        raise ValueError("an SCD load needs a primary key")
    hashed = with_row_hash(df, hash_exclude)
    if versioned:
        return _load_version(open_table(spark, target), hashed, kind, keys, evolve, expire_missing, expire_only, batch_id, hash_exclude, keys_checked, now)
    table = TrustedTable(spark, target, name)
    if kind == "append":
        return table.append(hashed, evolve, batch_id, now)
    if kind == "overwrite":
        return table.overwrite(hashed, now)
    if kind == "scd_type1":
        return table.upsert(hashed, keys, evolve, buckets, keys_checked, now)
    return table.scd2(hashed, keys, evolve, expire_only, expire_missing, buckets, keys_checked, now, hash_exclude)


def _load_version(table, hashed, kind, keys, evolve, expire_missing, expire_only, batch_id, hash_exclude, keys_checked, now) -> int:
    if kind == "append":
        return append(table, hashed, evolve, batch_id, now)
    if kind == "overwrite":
        return overwrite(table, hashed, now)
    if kind == "scd_type1":
        return upsert(table, hashed, keys, evolve, keys_checked=keys_checked, now=now)
    return scd2(table, hashed, keys, evolve, expire_only, expire_missing, keys_checked, now, hash_exclude)
