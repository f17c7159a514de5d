"""Trusted tables: external Parquet tables of the catalog, partitioned so that a load replaces what it touches.

=========  ===========================  ==========================================================================
layout     partitions                   a load
=========  ===========================  ==========================================================================
append     load_batch                   adds rows, or replaces those of its own batch
keyed      load_bucket                  rewrites the buckets that hold a key of the source
history    load_bucket, load_state      as keyed, in the open state only
=========  ===========================  ==========================================================================

The bucket is a hash of the key, so a key's rows lie in one partition. All changes of a load are one insert that overwrites
partitions dynamically: Spark writes aside and replaces the partitions when the job commits, so a load that fails
changes nothing and one that is repeated gives the same rows. The open state holds the current versions and those that
ended in the month of the latest load; older ones are moved out to a state of their own and never read or written again.

An overwrite, another layout and another number of buckets write a new folder below the table's and then point the table
to it. The folder before the last one is removed. A definition beside the data makes the table again in a catalog that
does not keep tables. One load writes a table at a time; a second one is refused.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import asdict, dataclass, replace
from datetime import datetime, timezone
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import fixed
from strata.functions.hashing import hashed_columns
from strata.functions.text import col
from strata.operators.schema import align_to, check_types, evolved_schema, schema_changes
from strata.operators.snapshots import ensure_namespace, is_table_name, location_of
from strata.session import LAYER_CODEC
from strata.sources import folders

BUCKET, BATCH, STATE = "load_bucket", "load_batch", "load_state"
LAYOUTS = {"append": [BATCH], "keyed": [BUCKET], "history": [BUCKET, STATE]}
PARTITION_TYPES = {BUCKET: T.IntegerType(), BATCH: T.StringType(), STATE: T.StringType()}
NO_BATCH, OPEN = "-", "open"
_SOURCE, _VERSION, _PAST = 0, 1, 2  # where a row of a history load comes from

LEAST_BUCKETS, MOST_BUCKETS, BUCKET_BYTES = 8, 4096, 64 * 2**20

DEFINITION = "definition.json"
_PROPERTY = "strata.table"
_PATHS = "spark_catalog.strata_paths"  # namespace of tables that are known by their folder only


@dataclass(frozen=True)
class Definition:
    """What a table is. ``loads`` counts the loads so far, ``loaded_at`` is when the last one was committed."""

    root: str
    location: str
    layout: str
    keys: tuple[str, ...]
    buckets: int
    loads: int
    loaded_at: str | None = None
    before: str | None = None


def require_unique_keys(df: DataFrame, keys: list[str]) -> None:
    """Two source rows for one key leave no right answer. Null keys match nothing and are let through."""
    complete = df.where(reduce(and_, [col(k).isNotNull() for k in keys]))
    shared = complete.groupBy(*[col(k) for k in keys]).agg(F.count("*").alias("__n")).where(F.col("__n") > 1)
    count = shared.count()
    if count:
        raise ValueError(f"{count} key value(s) of {keys} occur more than once in the source")


def buckets_for(df: DataFrame) -> int:
    """A number of buckets for a table that begins with these rows, by Spark's estimate of their size, where it has one."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, size // BUCKET_BYTES)) if size < 2**62 else LEAST_BUCKETS


def _slices(rows: DataFrame, buckets: int) -> int:
    """In how many parts to deal out each bucket of these rows, by Spark's estimate of their size: a part of about BUCKET_BYTES."""
    size = int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return 1 + min(MOST_BUCKETS, size // (max(1, buckets) * BUCKET_BYTES)) if size < 2**62 else LEAST_BUCKETS


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


class TrustedTable:
    """A table at ``target``, a folder or ``catalog.schema.table``; a folder may be given a ``name`` in the catalog."""

    def __init__(self, spark: SparkSession, target: str, name: str | None = None):
        self.spark = spark
        named = is_table_name(target)
        self.root = location_of(spark, target).rstrip("/")
        hidden = f"{_PATHS}.t_{hashlib.md5(self.root.encode()).hexdigest()[:20]}"
        self.name = target if named else name or hidden
        if self.name != hidden:
            ensure_namespace(spark, self.name)
            self._take_over(hidden)
        self._recover()

    # ---- the table in the catalog ------------------------------------------------------------------------------

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def definition(self) -> Definition:
        for row in self.spark.sql(f"SHOW TBLPROPERTIES {_quoted(self.name)}").collect():
            if row.key == _PROPERTY:
                told = json.loads(row.value)
                return Definition(**told | {"keys": tuple(told["keys"])})
        raise ValueError(f"{self.name} is no table of trusted rows")

    def _define(self, told: Definition, schema: T.StructType) -> None:
        """Makes the table anew in the catalog; its files stay where they are."""
        ensure_namespace(self.spark, self.name)
        partitions = LAYOUTS[told.layout]
        fields = [T.StructField(f.name, f.dataType, True) for f in schema.fields]
        columns = T.StructType(fields + [T.StructField(p, PARTITION_TYPES[p], True) for p in partitions]).toDDL()
        self.spark.sql(f"DROP TABLE IF EXISTS {_quoted(self.name)}")
        self.spark.sql(
            f"CREATE TABLE {_quoted(self.name)} ({columns}) USING parquet OPTIONS ('partitionOverwriteMode' = 'dynamic', 'compression' = '{LAYER_CODEC}') "
            f"PARTITIONED BY ({', '.join(partitions)}) LOCATION '{_literal(told.location)}'"
        )
        self.spark.sql(f"MSCK REPAIR TABLE {_quoted(self.name)}")
        self._tell(told, T.StructType(fields))

    def _tell(self, told: Definition, schema: T.StructType) -> None:
        text = json.dumps(asdict(told))
        self.spark.sql(f"ALTER TABLE {_quoted(self.name)} SET TBLPROPERTIES ('{_PROPERTY}' = '{_literal(text)}')")
        folders.write_text(self.spark, f"{self.root}/{DEFINITION}", json.dumps({"table": asdict(told), "schema": schema.jsonValue()}))

    def _recover(self) -> None:
        if self.exists():
            if (at := self.definition().root) != self.root:
                raise ValueError(f"{self.name} is the table in {at}, not in {self.root}")
        elif text := folders.read_text(self.spark, f"{self.root}/{DEFINITION}"):
            kept = json.loads(text)
            told = Definition(**kept["table"] | {"keys": tuple(kept["table"]["keys"])})
            self._define(told, T.StructType.fromJson(kept["schema"]))

    def _take_over(self, hidden: str) -> None:
        """A folder that was loaded without a name gets one."""
        if self.spark.catalog.tableExists(hidden) and not self.exists():
            self._recover()
            self.spark.sql(f"DROP TABLE {_quoted(hidden)}")

    # ---- reading -------------------------------------------------------------------------------------------------

    def rows(self) -> DataFrame:
        """All rows with the partition columns."""
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(_quoted(self.name))

    def schema(self) -> T.StructType:
        hidden = LAYOUTS[self.definition().layout]
        return T.StructType([f for f in self.spark.table(_quoted(self.name)).schema.fields if f.name not in hidden])

    def read(self) -> DataFrame:
        if not self.exists():
            raise FileNotFoundError(f"no table at {self.root}")
        return self.rows().drop(*LAYOUTS[self.definition().layout])

    # ---- writing -------------------------------------------------------------------------------------------------

    def _begin(self, df: DataFrame, layout: str, keys: list[str], buckets: int | None) -> Definition:
        """The definition a first load starts from."""
        number = (buckets or buckets_for(df)) if keys else 0
        return Definition(self.root, "", layout, tuple(keys), number, -1)

    def _placed(self, df: DataFrame, told: Definition, **values: Column) -> DataFrame:
        """``df`` with the partition columns of the layout; a bucket comes from the keys."""
        if BUCKET in LAYOUTS[told.layout]:
            values[BUCKET] = F.pmod(F.xxhash64(*[col(k) for k in told.keys]), F.lit(told.buckets)).cast("int")
        return df.withColumns({p: values[p].alias(p) for p in LAYOUTS[told.layout]})

    def _rewrite(self, placed: DataFrame, told: Definition, now) -> int:
        """All rows into a new folder, to which the table then points."""
        partitions = LAYOUTS[told.layout]
        location = f"{self.root}/{uuid.uuid4().hex[:12]}"
        _balanced(placed, partitions).write.partitionBy(*partitions).parquet(location, compression=LAYER_CODEC)
        schema = T.StructType([f for f in placed.schema.fields if f.name not in partitions])
        told = replace(told, location=location, before=told.location or None, loads=told.loads + 1, loaded_at=_moment_text(now))
        outdated = self.definition().before if self.exists() else None
        self._define(told, schema)
        if outdated:
            folders.remove(self.spark, outdated)
        return told.loads

    def _replace(self, placed: DataFrame, told: Definition, now, mode: str = "overwrite", balanced: bool = False) -> int:
        """The partitions that ``placed`` has rows for become these rows; with mode append they are added. ``balanced`` says that
        few tasks have rows of a bucket."""
        columns = [f.name for f in self.spark.table(_quoted(self.name)).schema.fields]
        rows = placed.select(*[col(c) for c in columns])
        (rows if balanced else _balanced(rows, LAYOUTS[told.layout])).write.mode(mode).insertInto(_quoted(self.name))
        told = replace(told, loads=told.loads + 1, loaded_at=_moment_text(now))
        self._tell(told, self.schema())
        return told.loads

    def _widen(self, df: DataFrame, evolve: bool) -> T.StructType:
        """The schema for a load of ``df``, and the table's from now on."""
        own = self.schema()
        schema = evolved_schema(own, df.schema) if evolve else own
        check_types(schema, df.schema)
        if [(f.name, f.dataType) for f in schema.fields] != [(f.name, f.dataType) for f in own.fields]:
            self._define(self.definition(), schema)
        return schema

    def _laid_out(self, layout: str, keys: list[str], buckets: int | None, now) -> Definition:
        """The definition once the table has this layout for these keys; its rows are rewritten if it has not."""
        told = self.definition()
        same = told.layout == layout and list(told.keys) == list(keys)
        if same and buckets in (None, told.buckets):
            return told
        rows = self.read()
        if layout == "history" and fixed.IS_CURRENT not in rows.columns:
            raise ValueError(f"{self.name} has no history: its rows have no {fixed.IS_CURRENT}")
        wanted = replace(told, layout=layout, keys=tuple(keys), buckets=buckets or (told.buckets if same else buckets_for(rows)))
        past = F.when(F.coalesce(col(fixed.IS_CURRENT), F.lit(False)), F.lit(OPEN)).otherwise(F.lit(_closed())) if layout == "history" else F.lit(None)
        loads = self._rewrite(self._placed(rows, wanted, **{STATE: past, BATCH: F.lit(NO_BATCH)}), replace(wanted, loads=told.loads - 1), now)
        return replace(self.definition(), loads=loads)

    def rebucket(self, buckets: int) -> None:
        """Rewrites the table with another number of buckets, when they have become too large."""
        with folders.one_writer(self.spark, self.root):
            told = self.definition()
            self._laid_out(told.layout, list(told.keys), buckets, told.loaded_at)

    # ---- loads -----------------------------------------------------------------------------------------------------

    def append(self, df: DataFrame, evolve: bool = False, batch_id: str | None = None, now=None) -> int:
        """Adds rows. Columns the table does not have are left out unless ``evolve``; columns it has must be there.

        With ``batch_id``, an earlier load of the same batch is replaced, so a batch may be repeated safely.
        """
        batch = F.lit(batch_id or NO_BATCH)
        with folders.one_writer(self.spark, self.root):
            if not self.exists():
                told = self._begin(df, "append", [], None)
                return self._rewrite(self._placed(df, told, **{BATCH: batch}), told, now)
            schema = self._widen(df, evolve)
            missing = [f.name for f in schema.fields if f.name not in df.columns]
            if missing and not evolve:
                raise ValueError(f"columns of the table not in the source: {missing}")
            told = self.definition()
            if told.layout != "append" and batch_id is not None:
                raise ValueError(f"{self.name} keeps rows by key; a batch of it cannot be replaced")
            placed = self._placed(align_to(df, schema), told, **{BATCH: batch, STATE: F.lit(OPEN)})
            if batch_id is not None and placed.isEmpty():
                self._drop_batch(batch_id)
            return self._replace(placed, told, now, "append" if batch_id is None else "overwrite")

    def _drop_batch(self, batch_id: str) -> None:
        gone = self.rows().where(F.col(BATCH) == batch_id).select("_metadata.file_path").limit(1).collect()
        if gone:
            self.spark.sql(f"ALTER TABLE {_quoted(self.name)} DROP PARTITION ({BATCH} = '{_literal(batch_id)}')")
            folders.remove(self.spark, gone[0][0].rsplit("/", 1)[0])

    def overwrite(self, df: DataFrame, now=None) -> int:
        with folders.one_writer(self.spark, self.root):
            told = replace(self._begin(df, "append", [], None), **self._earlier())
            return self._rewrite(self._placed(df, told, **{BATCH: F.lit(NO_BATCH)}), told, now)

    def _earlier(self) -> dict:
        if not self.exists():
            return {}
        told = self.definition()
        return {"loads": told.loads, "location": told.location}

    def upsert(self, df: DataFrame, keys: list[str], evolve: bool = False, buckets: int | None = None, keys_checked: bool = False, now=None) -> int:
        """Source rows replace table rows of the same key and are added otherwise. Table columns the source lacks keep
        their value on replaced rows. Only buckets that hold a key of the source are read and written."""
        if not keys_checked:
            require_unique_keys(df, keys)
        with folders.one_writer(self.spark, self.root):
            if not self.exists():
                told = self._begin(df, "keyed", keys, buckets)
                return self._rewrite(self._placed(df, told), told, now)
            schema = self._widen(df, evolve)
            told = self._laid_out("keyed", keys, buckets, now)
            source = self._placed(align_to(df, schema), told)
            current = self.rows().where(F.col(BUCKET).isin(_buckets(source)))
            wanted = source.select(*[col(k) for k in keys])
            kept = current.join(wanted, keys, "left_anti").select(*current.columns)
            carried = [f.name for f in schema.fields if f.name not in df.columns]
            if carried:
                matched = current.join(wanted, keys, "left_semi").select(*[col(c) for c in [*keys, *carried]])
                source = source.drop(*carried).join(matched, keys, "left")
            return self._replace(kept.unionByName(source.select(*current.columns)), told, now)

    def upsert_all(self, df: DataFrame, keys: list[str], now=None) -> int:
        """Whole-row upsert, for framework tables: columns must be those of the table."""
        if self.exists():
            changes = schema_changes(self.schema(), df.schema)
            if changes["new_columns"] or changes["removed_columns"]:
                raise ValueError(f"columns differ from the table: {changes}")
        return self.upsert(df, keys, now=now)

    def scd2(
        self,
        df: DataFrame,
        keys: list[str],
        evolve: bool = False,
        expire_only: bool = False,
        expire_missing: bool = False,
        buckets: int | None = None,
        keys_checked: bool = False,
        now: str | datetime | None = None,
        compare_exclude: list[str] = (fixed.LINEAGE_COLUMN,),
    ) -> int:
        """History load. A changed row ends the current version of its key and starts a new one; equal rows change nothing;
        unknown keys are added. Rows are compared by their values in the columns that source and table share, except those
        in ``compare_exclude``; a new version has null in columns that the source lacks.

        ``expire_only`` ends every matched version and starts a new one only in the next load. ``expire_missing`` takes
        the source for a full snapshot and ends versions whose key is not in it.
        """
        if not keys_checked:
            require_unique_keys(df, keys)
        now = now or datetime.now(timezone.utc).replace(microsecond=0)
        moment = F.lit(now).cast("timestamp")
        fresh = df.withColumns({fixed.VALID_FROM: moment, fixed.VALID_TO: F.lit(None).cast("timestamp"), fixed.IS_CURRENT: F.lit(True)})
        with folders.one_writer(self.spark, self.root):
            if not self.exists():
                told = self._begin(df, "history", keys, buckets)
                return self._rewrite(self._placed(fresh, told, **{STATE: F.lit(OPEN)}), told, now)
            schema = self._widen(fresh, evolve)
            told = self._laid_out("history", keys, buckets, now)
            source = self._placed(align_to(fresh, schema), told, **{STATE: F.lit(OPEN)})
            is_open = self.rows().where(F.col(STATE) == OPEN)
            touched = _buckets(source.select(BUCKET).union(is_open.where(col(fixed.IS_CURRENT)).select(BUCKET)) if expire_missing else source)
            is_open = is_open.where(F.col(BUCKET).isin(touched))
            columns = is_open.columns

            # versions and source meet in one shuffle, which is also that of the write: a bucket's slices go to a task each
            complete = reduce(and_, [col(k).isNotNull() for k in keys])
            side = F.when(F.coalesce(col(fixed.IS_CURRENT), F.lit(False)), F.lit(_VERSION)).otherwise(F.lit(_PAST))
            rows = is_open.withColumn("__side", side).unionByName(source.select(*columns).withColumn("__side", F.lit(_SOURCE)))
            rows = rows.withColumn("__alone", F.when(~complete, F.monotonically_increasing_id()))  # null keys match nothing
            dealt = F.when(complete, F.hash(*[col(k) for k in keys])).otherwise(F.xxhash64("__alone"))
            rows = rows.withColumn("__slice", F.pmod(dealt, F.lit(_slices(is_open, told.buckets)))).repartition(BUCKET, "__slice")
            key = Window.partitionBy(BUCKET, "__slice", *[col(k) for k in keys], "__alone")

            offers = {name.lower() for name in df.columns}
            names = [f.name for f in schema.fields]
            shared = [n for n in hashed_columns(names, compare_exclude) if n.lower() in offers and n not in keys]
            offer = F.struct(F.lit(1).alias("hit"), *[_comparable(schema, n) for n in shared])
            rows = rows.withColumn("__offer", F.first(F.when(F.col("__side") == _SOURCE, offer), ignorenulls=True).over(key))
            same = reduce(and_, [_comparable(schema, n).eqNullSafe(F.col("__offer")[n]) for n in shared], F.lit(True))
            version, hit = F.col("__side") == _VERSION, F.col("__offer").isNotNull()
            rows = rows.withColumn("__known", F.bool_or(version if expire_only else version & same).over(key))
            ends = hit if expire_only else hit & ~same
            if expire_missing:
                ends = ends | ~hit
            older = F.date_trunc("month", col(fixed.VALID_TO)) < F.date_trunc("month", moment)
            changed = {
                fixed.VALID_TO: F.when(version & F.col("__ends"), moment).otherwise(col(fixed.VALID_TO)),
                fixed.IS_CURRENT: F.when(version, ~F.col("__ends")).otherwise(col(fixed.IS_CURRENT)),
                STATE: F.when((F.col("__side") == _PAST) & older, F.lit(_closed())).otherwise(F.lit(OPEN)),
            }
            kept = rows.where((F.col("__side") != _SOURCE) | ~F.col("__known")).withColumn("__ends", ends)
            return self._replace(kept.withColumns(changed).select(*[col(c) for c in columns]), told, now, balanced=True)


def table_exists(spark: SparkSession, target: str) -> bool:
    return TrustedTable(spark, target).exists()


def _literal(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _closed() -> str:
    """A state of its own for each time that versions are moved out, so that none is written twice."""
    return f"closed-{uuid.uuid4().hex[:12]}"


def _moment_text(now) -> str:
    return str(now or datetime.now(timezone.utc).isoformat(timespec="seconds"))


def _balanced(df: DataFrame, partitions: list[str]) -> DataFrame:
    """One task for each bucket of the table; a large one gets several, several small ones share one. A batch is written by the
    tasks that have it, without a shuffle."""
    return df.hint("rebalance", *[F.col(p) for p in partitions]) if BUCKET in partitions else df


def _buckets(placed: DataFrame) -> list[int]:
    """The buckets that rows lie in: no more than the table has."""
    return sorted(row[0] for row in placed.select(BUCKET).distinct().collect())


def _comparable(schema: T.StructType, name: str) -> Column:
    """The value as something that can be compared: maps as JSON."""
    return (F.to_json(col(name)) if "map<" in schema[name].dataType.simpleString() else col(name)).alias(name)
