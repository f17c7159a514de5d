"""Versioned tables as plain Parquet folders.

    <table>/data/<name>/...            Parquet written by one load
    <table>/commits/version=<n>/...    one JSON row: schema, time, mode and the data folders version n consists of

A load writes its folders first and becomes visible with its commit row. Folders are never changed afterwards, so a
failed or repeated load harms nothing and every earlier version stays readable. One writer per table at a time. Loads
name only the folders they replace: an append adds one, a merge rewrites those that hold matching keys.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.text import col
from strata.sources import folders

_COMMIT = "committed_at timestamp, mode string, table_schema string, parts array<struct<folder:string,role:string,batch:string>>"

LIVE, CLOSED = "live", "closed"
COPIES = 32_768


@dataclass(frozen=True)
class Part:
    folder: str
    role: str = LIVE
    batch: str | None = None


@dataclass(frozen=True)
class Commit:
    version: int
    schema: T.StructType
    parts: tuple[Part, ...]


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ---- reading -------------------------------------------------------------------------------------------

    def versions(self) -> list[int]:
        found = folders.matching(self.spark, f"{self.path}/commits/version=*/_SUCCESS")
        return sorted(int(f.rsplit("/", 2)[1].split("=")[1]) for f in found)

    def exists(self) -> bool:
        return bool(self.versions())

    def history(self) -> DataFrame:
        """version, committed_at and mode of every commit."""
        rows = self.spark.read.schema(f"version int, {_COMMIT}").json(f"{self.path}/commits")
        return rows.where(F.col("version").isin(self.versions())).select("version", "committed_at", "mode")

    def commit(self, version: int | None = None) -> Commit:
        known = self.versions()
        if not known:
            raise FileNotFoundError(f"no table at {self.path}")
        version = known[-1] if version is None else int(version)
        if version not in known:
            raise ValueError(f"version {version} not found; versions are {known[0]} to {known[-1]}")
        row = self.spark.read.schema(_COMMIT).json(f"{self.path}/commits/version={version}").first()
        parts = tuple(Part(p["folder"], p["role"], p["batch"]) for p in row["parts"])
        return Commit(version, T.StructType.fromJson(json.loads(row["table_schema"])), parts)

    def version_at(self, moment: str | datetime) -> int:
        row = self.history().where(F.col("committed_at") <= F.lit(moment).cast("timestamp")).agg(F.max("version")).first()
        if row[0] is None:
            raise ValueError(f"the table has no version as of {moment}")
        return row[0]

    def read(self, version: int | None = None, as_of: str | datetime | None = None) -> DataFrame:
        if as_of is not None:
            version = self.version_at(as_of)
        commit = self.commit(version)
        return self.read_parts(commit.schema, commit.parts)

    def read_parts(self, schema: T.StructType, parts) -> DataFrame:
        """Rows of some data folders under one schema; columns a folder lacks are null."""
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{p.folder}" for p in parts])

    def parts_with(self, commit: Commit, parts, wanted: DataFrame, keys: list[str]) -> list[Part]:
        """Those of ``parts`` that hold a key of ``wanted``: a scan of the key columns alone."""
        if len(parts) < 2:
            return list(parts)
        # names are of our making, so they are told from any other /data/ the table's path may have
        folder = F.regexp_extract("_metadata.file_path", r"/data/([0-9a-f]{16}(?:/part=[a-z]+)?)/[^/]+$", 1).alias("__folder")
        held = self.read_parts(commit.schema, parts).select(*[col(k) for k in keys], folder)
        hit = held.join(wanted.select(*[col(k) for k in keys]), keys, "left_semi").select("__folder").distinct()
        names = {row[0] for row in hit.collect()}
        if strange := names - {p.folder for p in parts}:
            raise RuntimeError(f"files outside the folders of version {commit.version}: {sorted(strange)}")
        return [p for p in parts if p.folder in names]

    # ---- writing -------------------------------------------------------------------------------------------

    def write_part(self, df: DataFrame, batch: str | None = None) -> list[Part]:
        """Writes rows as one new data folder."""
        name = uuid.uuid4().hex[:16]
        df.write.parquet(f"{self.path}/data/{name}")
        return [Part(name, LIVE, batch)]

    def write_split(self, df: DataFrame, live) -> list[Part]:
        """Writes rows as two new data folders in one job: those for which ``live`` holds, and the closed rest."""
        name = uuid.uuid4().hex[:16]
        marked = df.withColumn("part", F.when(live, LIVE).otherwise(CLOSED))
        marked.write.partitionBy("part").parquet(f"{self.path}/data/{name}")
        written = folders.matching(self.spark, f"{self.path}/data/{name}/part=*")
        return [Part(f"{name}/part={role}", role) for role in (LIVE, CLOSED) if any(f.endswith(f"part={role}") for f in written)]

    def publish(self, schema: T.StructType, parts, mode: str, now: datetime | str | None = None) -> int:
        """Makes the data folders the next version. ``now`` as text is read in the session's time zone."""
        # a commit that died half-way keeps its number, so the next one takes another
        taken = folders.matching(self.spark, f"{self.path}/commits/version=*")
        version = max([int(f.rsplit("=", 1)[1]) for f in taken], default=-1) + 1
        nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
        moment = F.lit(now or datetime.now(timezone.utc)).cast("timestamp")
        row = self.spark.createDataFrame(
            [(mode, nullable.json(), [(p.folder, p.role, p.batch) for p in parts])],
            "mode string, table_schema string, parts array<struct<folder:string,role:string,batch:string>>",
        )
        target = f"{self.path}/commits/version={version}"
        row.withColumn("committed_at", moment).coalesce(1).write.mode("errorifexists").json(target)
        if version not in self.versions():
            raise RuntimeError(f"{target} has no _SUCCESS mark; mapreduce.fileoutputcommitter.marksuccessfuljobs must be on")
        return version

    # ---- changes -------------------------------------------------------------------------------------------

    def changes(self, keys: list[str], from_version: int | None = None, to_version: int | None = None) -> DataFrame:
        """Row changes between two versions as insert, delete, update_preimage and update_postimage.

        Data folders both versions share hold equal rows and are not read. The others are compared by counting each
        distinct row on either side, so repeated rows and hot keys need no pairing.
        """
        new = self.commit(to_version)
        if from_version is None:
            earlier = [v for v in self.versions() if v < new.version]
            if not earlier:
                raise ValueError("the table has no earlier version to compare with")
            from_version = earlier[-1]
        old = self.commit(from_version)
        schema = new.schema
        before = self.read_parts(schema, [p for p in old.parts if p not in new.parts]).withColumn("__side", F.lit(-1))
        after = self.read_parts(schema, [p for p in new.parts if p not in old.parts]).withColumn("__side", F.lit(1))
        rows = [f.name for f in schema.fields]
        net = before.unionByName(after).groupBy(*[col(c) for c in rows]).agg(F.sum("__side").alias("__net")).where("__net <> 0")
        by_key = net.groupBy(*[col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(
            ((F.max("__net") > 0) & (F.min("__net") < 0)).alias("__updated")
        )
        same_key = reduce(and_, [col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
        kind = (
            F.when(F.col("__updated") & (F.col("__net") > 0), "update_postimage")
            .when(F.col("__updated"), "update_preimage")
            .when(F.col("__net") > 0, "insert")
            .otherwise("delete")
        )
        labelled = net.join(by_key, same_key).select(*[col(c) for c in rows], kind.alias("_change_type"), F.abs("__net").alias("__n"))
        # in two steps, so that a row repeated a billion times is no array of a billion
        chunks = labelled.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / COPIES))))
        left = F.least(F.lit(COPIES).cast("long"), F.col("__n") - F.col("__chunk") * COPIES)
        copies = chunks.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), left)))
        return copies.select(*[col(c) for c in rows], "_change_type")


def location_of(spark: SparkSession, target: str) -> str:
    """Folder of a target given as a path or as ``catalog.schema.table``."""
    if not is_table_name(target):
        return target
    ensure_namespace(spark, target)
    catalog, schema, table = target.split(".")
    return f"{spark.catalog.getDatabase(f'{catalog}.{schema}').locationUri.rstrip('/')}/{table}"


def is_table_name(target: str) -> bool:
    return "." in target and "/" not in target


def ensure_namespace(spark: SparkSession, table_name: str) -> None:
    """Creates the schema of ``catalog.schema.table`` if need be."""
    parts = table_name.split(".")
    if len(parts) != 3:
        raise ValueError(f"expected catalog.schema.table, got '{table_name}'")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{parts[0]}`.`{parts[1]}`")


def open_table(spark: SparkSession, target: str) -> SnapshotTable:
    return SnapshotTable(spark, location_of(spark, target))
