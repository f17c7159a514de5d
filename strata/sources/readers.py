"""Readers by format name, and the writers of the Landing and Raw layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import fixed
from strata.functions.text import col
from strata.operators.snapshots import SnapshotTable
from strata.session import LAYER_CODEC
from strata.sources.workbook import read_workbooks

# One option set for writing and reading Landing CSV, so that what comes back is what went in: quotes doubled, null
# apart from the empty string, blanks kept. Line breaks and backslashes are spelled with a backslash and a letter, so a line
# of the file is a row, a file may be read by many tasks, and no text is spelled like null.
LANDING_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def _plain(options: dict) -> dict:
    return {k: v for k, v in options.items() if v is not None}


def read_csv(spark: SparkSession, path, **options) -> DataFrame:
    """All columns as text. Files are matched as *.csv in any case."""
    merged = {**fixed.CSV_READ_DEFAULTS, "enforceSchema": True, "pathGlobFilter": "*.[cC][sS][vV]", **options}
    return spark.read.format("csv").options(**_plain(merged)).load(path)


def read_csv_with_malformed(spark: SparkSession, path, malformed: str, **options) -> DataFrame:
    """As ``read_csv``, and the whole line of each row that has more or fewer cells than there are columns."""
    columns = read_csv(spark, path, **options).schema
    merged = {**fixed.CSV_READ_DEFAULTS, "enforceSchema": True, "pathGlobFilter": "*.[cC][sS][vV]", **options, "columnNameOfCorruptRecord": malformed}
    schema = T.StructType([*columns.fields, T.StructField(malformed, T.StringType(), True)])
    return spark.read.format("csv").schema(schema).options(**_plain(merged)).load(path)


def read_json(spark: SparkSession, path, **options) -> DataFrame:
    return spark.read.format("json").options(**_plain({**fixed.JSON_READ_DEFAULTS, **options})).load(path)


def read_parquet(spark: SparkSession, path, **options) -> DataFrame:
    return spark.read.format("parquet").options(**_plain({**fixed.PARQUET_READ_DEFAULTS, **options})).load(path)


def jdbc_options(url: str | None = None, dbtable: str | None = None, **options) -> dict:
    """Reader options of a database table. Name ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` to read it in many tasks; without them a database is read by one."""
    if not url or not dbtable:
        raise ValueError("a database source needs 'url' and 'dbtable'")
    bounds = {"partitionColumn", "lowerBound", "upperBound", "numPartitions"}
    given = bounds & set(options)
    if "partitionColumn" in given and given != bounds:
        raise ValueError(f"a partitioned database read also needs {sorted(bounds - given)}")
    return _plain({"url": url, "dbtable": dbtable, **fixed.JDBC_READ_DEFAULTS, **options})


def read_database(spark: SparkSession, path=None, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def read_snapshots(spark: SparkSession, path, versionAsOf=None, timestampAsOf=None, readChangeFeed=False, **options):
    """A versioned table: latest, by version, by time, or as a feed of changes between two versions."""
    table = SnapshotTable(spark, path)
    if readChangeFeed:
        return table.changes(options["keys"], options.get("startingVersion"), options.get("endingVersion"))
    return table.read(version=versionAsOf, as_of=timestampAsOf)


def read_excel(spark: SparkSession, path, excel_options: dict | None = None, **options) -> DataFrame:
    """Every workbook under ``path``; one task per workbook, never the driver."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", options.pop("pathGlobFilter", "*.[xX][lL][sS][xXmM]"))
        .load(path)
        .select("path", "content")
    )
    return read_workbooks(files, {**(excel_options or {}), **options})


READERS = {
    "excel": read_excel,
    "csv": read_csv,
    "parquet": read_parquet,
    "json": read_json,
    "delta": read_snapshots,
    "database": read_database,
}
ALIASES = {"xlsx": "excel", "jdbc": "database", "snapshots": "delta"}


def format_name(file_format: str) -> str:
    name = file_format.lower().strip()
    return ALIASES.get(name, name)


def reader_for(file_format: str):
    name = format_name(file_format)
    if name not in READERS:
        raise ValueError(f"no reader for '{file_format}'; supported: {sorted(READERS)}")
    return READERS[name]


SPELLED = {"\\": "\\b", "\n": "\\n", "\r": "\\r"}

# Landing files where each task has a slice of the source. Rows are counted too, as lineage makes short ones many times longer.
SLICE_ROWS = 1_000_000
SMALL_FILES = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", sliced: bool = False) -> None:
    """Landing CSV. ``sliced`` says that no task has more than a slice of a source file: then it writes small files, which
    are compressed, since a compressed file is read by one task. Others may be large and stay plain, so that they can be split."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    told = [_replaced(name, SPELLED.items()) if name in texts else col(name) for name in df.columns]
    small = {**SMALL_FILES, "maxRecordsPerFile": SLICE_ROWS} if sliced else {}
    df.select(*told).write.mode(mode).options(**LANDING_CSV, emptyValue='""', **small).csv(path)


def read_landing_csv(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.options(**LANDING_CSV, emptyValue="", maxCharsPerColumn=-1).csv(path)
    back = [(spelled, text) for text, spelled in reversed(SPELLED.items())]  # the backslash last: it may stand before any letter
    return df.select(*[_replaced(name, back) for name in df.columns])


def _replaced(name: str, pairs) -> Column:
    out = col(name)
    for old, new in pairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out.alias(name)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path, compression=LAYER_CODEC)
