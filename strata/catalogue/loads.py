"""Loads into trusted and into versioned tables. Every query loads orders twice and reads the result back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import fixed
from strata.catalogue.common import Catalogue, moment, scratch, table
from strata.functions.hashing import with_row_hash
from strata.operators.loads import load
from strata.operators.schema import evolve_catalog_table
from strata.operators.snapshots import SnapshotTable, ensure_namespace, open_table
from strata.operators.trusted import TrustedTable
from strata.sources.readers import reader_for

loads = Catalogue()

T1, T2, T3 = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"
COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus"]

# The second delivery: every third order again, of those the even ones with status X; and as many new orders.
_CHANGED = "o_orderkey % 3 = 0"
_BASE_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders"
_DELTA_SQL = f"""SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus
                 FROM orders WHERE {_CHANGED}
                 UNION ALL SELECT -1 - o_orderkey, o_custkey, 'N' FROM orders WHERE {_CHANGED}"""


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(*COLUMNS)


def _delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    again = _base(spark, sf_dir).where(_CHANGED)
    changed = again.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 2 == 0, "X").otherwise(F.col("o_orderstatus")))
    new = again.select((F.lit(-1) - F.col("o_orderkey")).alias("o_orderkey"), "o_custkey", F.lit("N").alias("o_orderstatus"))
    return changed.unionByName(new)


def _twice(spark: SparkSession, sf_dir: str, kind: str, versioned: bool = False, **options) -> str:
    target = scratch(spark, kind)
    load(spark, _base(spark, sf_dir), target, kind, ["o_orderkey"], versioned=versioned, now=T1)
    load(spark, _delta(spark, sf_dir), target, kind, ["o_orderkey"], versioned=versioned, now=T2, **options)
    return target


def _twice_trusted(spark: SparkSession, sf_dir: str, kind: str, **options) -> DataFrame:
    return TrustedTable(spark, _twice(spark, sf_dir, kind, **options)).read()


def _twice_versioned(spark: SparkSession, sf_dir: str, kind: str) -> SnapshotTable:
    return open_table(spark, _twice(spark, sf_dir, kind, versioned=True))


@loads.query(
    "load_append",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, sha256(concat_ws('|', o_custkey, o_orderkey, o_orderstatus)) AS row_hash
        FROM ({_BASE_SQL} UNION ALL {_DELTA_SQL})""",
)
def load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second delivery has a column more, in another order; the table keeps its own columns."""
    target = scratch(spark, "append")
    load(spark, _base(spark, sf_dir), target, now=T1)
    delta = _delta(spark, sf_dir).select("o_orderstatus", F.lit("web").alias("channel"), "o_custkey", "o_orderkey")
    load(spark, delta, target, "Append ", hash_exclude=["channel"], now=T2)
    return TrustedTable(spark, target).read()


@loads.query("load_overwrite", _DELTA_SQL)
def load_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _twice_trusted(spark, sf_dir, "overwrite").select(*COLUMNS)


_SCD1_SQL = f"{_BASE_SQL} WHERE NOT ({_CHANGED}) UNION ALL {_DELTA_SQL}"


@loads.query("load_scd1", _SCD1_SQL)
def load_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _twice_trusted(spark, sf_dir, "scd1").select(*COLUMNS)


@loads.query("upsert_all", _SCD1_SQL)
def upsert_whole_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = TrustedTable(spark, scratch(spark, "upsert"))
    target.upsert_all(_base(spark, sf_dir), ["o_orderkey"], now=T1)
    target.upsert_all(_delta(spark, sf_dir), ["o_orderkey"], now=T2)
    return target.read()


def _history(rows: DataFrame) -> DataFrame:
    return rows.select(
        *COLUMNS, moment(fixed.VALID_FROM).alias("valid_from"), moment(fixed.VALID_TO).alias("valid_to"), F.col(fixed.IS_CURRENT).alias("is_current")
    )


@loads.query(
    "load_scd2",
    f"""SELECT *, '{T1}' AS valid_from, NULL AS valid_to, true AS is_current FROM ({_BASE_SQL}) WHERE NOT ({_CHANGED} AND o_orderkey % 2 = 0)
        UNION ALL SELECT *, '{T1}', '{T2}', false FROM ({_BASE_SQL}) WHERE {_CHANGED} AND o_orderkey % 2 = 0
        UNION ALL SELECT *, '{T2}', NULL, true FROM ({_DELTA_SQL}) WHERE o_orderstatus IN ('X', 'N')""",
)
def load_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed rows get a new version, equal rows keep theirs, new keys are added."""
    return _history(_twice_trusted(spark, sf_dir, "scd2"))


@loads.query(
    "load_scd2_expire_only",
    f"""SELECT *, '{T1}' AS valid_from, CASE WHEN {_CHANGED} THEN '{T2}' END AS valid_to, NOT ({_CHANGED}) AS is_current FROM ({_BASE_SQL})
        UNION ALL SELECT *, '{T2}', NULL, true FROM ({_DELTA_SQL}) WHERE o_orderstatus = 'N'""",
)
def load_scd2_expire_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every matched version ends, changed or not; new versions would come with the next load."""
    return _history(_twice_trusted(spark, sf_dir, "scd_type2", expire_only=True))


@loads.query(
    "load_scd2_full_snapshot",
    f"""SELECT *, '{T1}' AS valid_from, CASE WHEN {_CHANGED} AND o_orderkey % 2 = 1 THEN NULL ELSE '{T2}' END AS valid_to,
               {_CHANGED} AND o_orderkey % 2 = 1 AS is_current FROM ({_BASE_SQL})
        UNION ALL SELECT *, '{T2}', NULL, true FROM ({_DELTA_SQL}) WHERE o_orderstatus IN ('X', 'N')""",
)
def load_scd2_full_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second delivery is the whole truth: keys it lacks end."""
    return _history(_twice_trusted(spark, sf_dir, "scd2", expire_missing=True))


@loads.query(
    "scd2_current_rows",
    f"SELECT o_orderkey, CAST(count(*) AS BIGINT) AS current_versions FROM ({_SCD1_SQL}) GROUP BY o_orderkey",
)
def scd2_current_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads, the last a repeat of the second: one current version per key."""
    target = scratch(spark, "scd2-thrice")
    for rows, now in ((_base(spark, sf_dir), T1), (_delta(spark, sf_dir), T2), (_delta(spark, sf_dir), T3)):
        load(spark, rows, target, "scd2", ["o_orderkey"], now=now)
    current = TrustedTable(spark, target).read().where(F.col(fixed.IS_CURRENT))
    return current.groupBy("o_orderkey").agg(F.count("*").alias("current_versions"))


@loads.query("batch_replay", f"{_BASE_SQL} UNION ALL {_DELTA_SQL}")
def batch_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that is loaded again, as after a failure, replaces its earlier rows."""
    target = scratch(spark, "replay")
    load(spark, _base(spark, sf_dir), target, batch_id="1", now=T1)
    load(spark, _base(spark, sf_dir), target, batch_id="2", now=T2)
    load(spark, _delta(spark, sf_dir), target, batch_id="2", now=T3)
    return TrustedTable(spark, target).read().select(*COLUMNS)


@loads.query(
    "trusted_by_name",
    f"""SELECT *, 3 AS loads, 'keyed' AS layout, true AS one_bucket FROM ({_SCD1_SQL})""",
)
def trusted_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge into a table of the catalog, read by its name; then one order alone, which rewrites one bucket."""
    name = f"spark_catalog.strata_lake.orders_{uuid.uuid4().hex[:12]}"
    load(spark, _base(spark, sf_dir), name, "scd1", ["o_orderkey"], buckets=16, now=T1)
    load(spark, _delta(spark, sf_dir), name, "scd1", ["o_orderkey"], now=T2)
    files = F.col("_metadata.file_path").alias("file")
    before = {r.file for r in spark.table(name).select(files).distinct().collect()}
    load(spark, _delta(spark, sf_dir).orderBy("o_orderkey").limit(1), name, "scd1", ["o_orderkey"], now=T3)
    after = spark.table(name)
    changed = after.select(files, "load_bucket").where(~files.isin(before)).agg(F.count_distinct("load_bucket")).first()[0]
    told = TrustedTable(spark, name).definition()
    return after.select(*COLUMNS, F.lit(told.loads + 1).alias("loads"), F.lit(told.layout).alias("layout"), F.lit(changed == 1).alias("one_bucket"))


@loads.query(
    "scd2_null_to_text",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE 'a|b' END AS note, CASE WHEN o_orderkey % 2 = 0 THEN 'x' ELSE 'c' END AS more,
              false AS is_current FROM orders
       UNION ALL SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'NULL' ELSE 'a' END, CASE WHEN o_orderkey % 2 = 0 THEN 'x' ELSE 'b|c' END, true FROM orders""",
)
def scd2_null_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes that row hashes do not see: null becomes the text NULL, text moves across a '|'. The last load repeats the second."""
    target, even = scratch(spark, "scd2-values"), F.col("o_orderkey") % 2 == 0
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    first = orders.withColumns({"note": F.when(~even, F.lit("a|b")), "more": F.when(even, F.lit("x")).otherwise(F.lit("c"))})
    second = orders.withColumns({"note": F.when(even, F.lit("NULL")).otherwise(F.lit("a")), "more": F.when(even, F.lit("x")).otherwise(F.lit("b|c"))})
    for rows, now in ((first, T1), (second, T2), (second, T3)):
        load(spark, rows, target, "scd2", ["o_orderkey"], now=now)
    return TrustedTable(spark, target).read().select("o_orderkey", "note", "more", F.col(fixed.IS_CURRENT).alias("is_current"))


@loads.query(
    "schema_evolution",
    """SELECT o_orderkey, CAST(NULL AS VARCHAR) AS channel, CAST(o_custkey % 1000 AS BIGINT) AS amount, false AS second FROM orders
       UNION ALL SELECT -1 - o_orderkey, 'web', 5000000000 + o_orderkey, true FROM orders""",
)
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second delivery adds a column and widens another; rows of the first are read under the new schema."""
    target, orders = scratch(spark, "evolution"), table(spark, sf_dir, "orders")
    first = orders.select("o_orderkey", (F.col("o_custkey") % 1000).cast("int").alias("amount"))
    second = orders.select(
        (F.lit(-1) - F.col("o_orderkey")).alias("o_orderkey"), F.lit("web").alias("channel"), (F.lit(5_000_000_000) + F.col("o_orderkey")).alias("amount")
    )
    load(spark, first, target, evolve=True, now=T1)
    load(spark, second, target, evolve=True, now=T2)
    rows = TrustedTable(spark, target).read()
    return rows.select("o_orderkey", "channel", "amount", (F.col("o_orderkey") < 0).alias("second"))


@loads.query(
    "catalog_table_evolution",
    "SELECT s_suppkey, s_name, CAST(NULL AS INT) AS s_nationkey FROM supplier UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier",
)
def catalog_table_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of the catalog gets the new column before rows that have it are added."""
    location = scratch(spark, "catalog")
    name = "supplier_" + location.rsplit("strata-catalog-", 1)[1].replace("/out", "").replace("-", "_")
    qualified, supplier = f"spark_catalog.strata_demo.{name}", table(spark, sf_dir, "supplier")
    ensure_namespace(spark, qualified)
    supplier.select("s_suppkey", "s_name").write.option("path", location).saveAsTable(f"strata_demo.{name}")
    evolve_catalog_table(supplier.select("s_suppkey", "s_name", "s_nationkey"), qualified)
    supplier.select("s_suppkey", "s_name", "s_nationkey").write.mode("append").insertInto(f"strata_demo.{name}")
    return spark.table(qualified)


@loads.query("snapshot_as_of", f"SELECT 1 AS asked, * FROM ({_BASE_SQL}) UNION ALL SELECT 2, * FROM ({_SCD1_SQL})")
def snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as it was by version, and as it is by a later time."""
    target = _twice_versioned(spark, sf_dir, "scd1")
    read = reader_for("delta")
    first = read(spark, target.path, versionAsOf=0).select(F.lit(1).alias("asked"), *COLUMNS)
    second = read(spark, target.path, timestampAsOf="2024-01-02 18:00:00").select(F.lit(2).alias("asked"), *COLUMNS)
    return first.unionByName(second)


@loads.query(
    "snapshot_diff",
    f"""SELECT *, 'update_preimage' AS change FROM ({_BASE_SQL}) WHERE {_CHANGED} AND o_orderkey % 2 = 0
        UNION ALL SELECT *, CASE WHEN o_orderstatus = 'X' THEN 'update_postimage' ELSE 'insert' END FROM ({_DELTA_SQL}) WHERE o_orderstatus IN ('X', 'N')
        UNION ALL SELECT *, 'delete' FROM ({_BASE_SQL}) WHERE NOT ({_CHANGED})""",
)
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes from the first delivery to the second, which replaced it."""
    target = _twice_versioned(spark, sf_dir, "overwrite")
    changes = reader_for("delta")(spark, target.path, readChangeFeed=True, keys=["o_orderkey"], startingVersion=0, endingVersion=1)
    return changes.select(*COLUMNS, F.col("_change_type").alias("change"))


@loads.query(
    "table_history", "SELECT v AS version, m AS mode, t AS committed_at FROM (VALUES (0, 'scd_type1', '2024-01-01 00:00:00'), (1, 'scd_type1', '2024-01-02 00:00:00')) AS x(v, m, t)"
)
def table_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = _twice_versioned(spark, sf_dir, "scd1").history()
    return history.select("version", "mode", moment("committed_at").alias("committed_at"))


@loads.query("hash_of_loaded_rows", "SELECT CAST(count(*) AS BIGINT) AS row_count, true AS all_match FROM orders")
def hash_of_loaded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored hash is the one computed from the rows as read back."""
    target = scratch(spark, "hash")
    load(spark, table(spark, sf_dir, "orders"), target, now=T1)
    stored = TrustedTable(spark, target).read().withColumnRenamed(fixed.HASH_COLUMN, "stored")
    again = with_row_hash(stored, exclude=["stored"])
    return again.agg(F.count("*").alias("row_count"), F.bool_and(F.col("stored") == F.col(fixed.HASH_COLUMN)).alias("all_match"))
