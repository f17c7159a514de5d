"""Manifests: which files a run loaded, and how many rows came from each.

A manifest is a folder of Parquet per run, written once the load is committed: run, table, path, name, size, modification time
and rows of every source file. It tells which files are new, and its token names a delivery, so that a delivery that is
loaded again after a failure replaces its own rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import fixed
from strata.sources import folders
from strata.sources.readers import format_name

SCHEMA = "run_id string, table_name string, path string, file_name string, length long, modified timestamp, rows long"
FILE = ["path", "length", "modified"]
SUFFIXES = {"csv": r"(?i)\.csv$", "excel": r"(?i)\.(xlsx|xlsm|xls)$"}


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """path, file_name, length and modified of the files in a folder, hidden ones left out. Lists, reads nothing."""
    files = spark.read.format("binaryFile").load(folder)
    return files.select("path", F.col("_metadata.file_name").alias("file_name"), "length", F.col("modificationTime").alias("modified"))


def is_read(file_format: str) -> Column:
    """Whether the reader of this format takes the file: text and workbook readers go by its suffix."""
    suffix = SUFFIXES.get(format_name(file_format))
    return F.col("file_name").rlike(suffix) if suffix else F.lit(True)


def require_read(files: DataFrame, file_format: str) -> None:
    """Fails when the folder holds files that the reader would pass over, naming some."""
    others = files.where(~is_read(file_format))
    shown = [row.file_name for row in others.select("file_name").orderBy("file_name").limit(5).collect()]
    if shown:
        raise ValueError(f"{others.count()} file(s) would not be read as {file_format}: {', '.join(shown)}; set 'other_files' to 'skip' to pass over them")


def loaded_before(spark: SparkSession, folder: str) -> DataFrame:
    """Files in the manifests of a table's earlier runs."""
    if not folders.matching(spark, f"{folder}/*/_SUCCESS"):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(f"{folder}/*")


def new_files(files: DataFrame, earlier: DataFrame) -> DataFrame:
    """Files that no earlier run loaded as they are now."""
    return files.join(earlier.select(*FILE).distinct(), FILE, "left_anti")


def token_of(files: DataFrame) -> str:
    """A name for these files as they are: the same files give the same token in any order."""
    told = [F.xxhash64(F.lit(seed), *FILE).cast("decimal(20,0)") for seed in ("a", "b")]
    row = files.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(t), F.lit(0)).alias(f"s{i}") for i, t in enumerate(told)]).first()
    return f"files-{row.n}-" + "".join(f"{int(row[f's{i}']) % 2**64:016x}" for i in range(2))


def counted(files: DataFrame, per_file: DataFrame, run_id: str, table_name: str) -> DataFrame:
    """The manifest of a run: every file with the rows that Landing has of it (source_file_name, rows)."""
    told = files.join(per_file.withColumnRenamed(fixed.LINEAGE_COLUMN, "file_name"), "file_name", "left").withColumns({"run_id": F.lit(run_id), "table_name": F.lit(table_name)})
    return told.select("run_id", "table_name", "path", "file_name", "length", "modified", F.coalesce("rows", F.lit(0).cast("long")).alias("rows"))
