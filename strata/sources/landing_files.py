"""Multi-file sources: options out of a table config, one scan over a folder, lineage, header drift."""

from __future__ import annotations

import csv
import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import fixed
from strata.sources import folders
from strata.sources.readers import format_name, read_csv, read_csv_with_malformed, reader_for
from strata.sources.workbook import PATH_COLUMN


def _from_json_text(value):
    """JSON text of an object becomes a dict; any other text stays text."""
    if not isinstance(value, str):
        return value
    try:
        parsed = json.loads(value)
    except ValueError:
        return value
    return parsed if isinstance(parsed, dict) else value


def reader_options(landing: dict) -> dict:
    """Options for the reader named by ``landing['file_format']``: engine keys and nulls dropped."""
    options = {
        key: _from_json_text(value)
        for key, value in landing.items()
        if key not in fixed.RESERVED_LANDING_KEYS and not key.endswith("_options") and value is not None
    }
    name = format_name(landing.get("file_format") or "")
    given = landing.get("format_options") or landing.get(f"{name}_options")
    given = _from_json_text(given)
    if not isinstance(given, dict) or not given:
        return options
    if name == "excel":
        return {**options, "excel_options": given}
    if name == "csv" and "delimiter" in given:
        given = {**{k: v for k, v in given.items() if k != "delimiter"}, "sep": given["delimiter"]}
    return {**options, **given}


SETTINGS = ("header_drift", "malformed_rows", "other_files", "only_new_files")


def landing_settings(landing: dict) -> tuple[dict, dict]:
    """Reader options of a landing config, and this engine's own settings among them. Control rows have no columns for the
    latter, so they may stand among the format's options."""
    options = reader_options(landing)
    return {k: v for k, v in options.items() if k not in SETTINGS}, {k: options[k] for k in SETTINGS if k in options}


def reads_slices(landing: dict) -> bool:
    """Whether each task reads a slice of a file, as of CSV with a row a line. Compressed CSV is not read at all."""
    options = {k.lower(): v for k, v in landing_settings(landing)[0].items()}
    return format_name(landing.get("file_format") or "") == "csv" and str(options.get("multiline")).lower() != "true"


def read_source_files(
    spark: SparkSession,
    folder: str,
    file_format: str,
    options: dict | None = None,
    drift: str = "error",
    malformed: str | None = None,
    files: list[str] | None = None,
) -> DataFrame:
    """All files of one folder, or those named, as one DataFrame with ``source_file_name``. ``malformed`` names a column for the
    lines of CSV rows that have more or fewer cells than their file has columns.

    ``drift`` says what to do when CSV or workbook headers differ between files: 'error' fails, 'by_name' accepts
    another column order, 'allow' also accepts missing columns, which become null. CSV under 'error' is one scan, in
    which Spark itself compares every file's header; for the others, and for files with blank headers, the lines of all
    files are read first to find the headers. Files without headers are matched by position.
    """
    if drift not in ("error", "by_name", "allow"):
        raise ValueError(f"unknown drift policy '{drift}'")
    options = dict(options or {})
    places = folder if files is None else files
    files = folders.source_files(spark, folder) if files is None else files
    if not files:
        raise FileNotFoundError(f"no input files in {folder}")
    name = format_name(file_format)
    if name == "csv":
        files = [f for f in files if f.lower().endswith(".csv")]
    if name == "excel":
        workbook = {**options.pop("excel_options", {}), "drift": drift}
        df = reader_for(name)(spark, places, workbook, **options)
        file_name = F.element_at(F.split(F.col(PATH_COLUMN), "/"), -1)
        return df.withColumn(fixed.LINEAGE_COLUMN, file_name).drop(PATH_COLUMN)
    if name == "csv" and len(files) > 1 and _has_header(options):
        if drift != "error" or not _headers_comparable(spark, files[0], options):
            return _csv_by_header(spark, places, options, drift, malformed)
        options["enforceSchema"] = False
    df = _read_csv(spark, places, options, malformed) if name == "csv" else reader_for(name)(spark, places, **options)
    return df.select("*", F.col("_metadata.file_name").alias(fixed.LINEAGE_COLUMN))


def _read_csv(spark: SparkSession, places, options: dict, malformed: str | None) -> DataFrame:
    return read_csv_with_malformed(spark, places, malformed, **options) if malformed else read_csv(spark, places, **options)


def _has_header(options: dict) -> bool:
    return str({**fixed.CSV_READ_DEFAULTS, **options}.get("header")).lower() == "true"


def _headers_comparable(spark: SparkSession, file: str, options: dict) -> bool:
    """Whether Spark's own header comparison applies: it renames blank and repeated headers and then objects to them."""
    written = read_csv(spark, file, **{**options, "header": False}).first()
    return written is None or list(written) == read_csv(spark, file, **options).columns


def _csv_by_header(spark: SparkSession, places, options: dict, drift: str, malformed: str | None) -> DataFrame:
    settings = {**fixed.CSV_READ_DEFAULTS, **options}
    commented = F.col("value").startswith(settings["comment"]) if settings.get("comment") else F.lit(False)
    lines = (
        spark.read.option("pathGlobFilter", "*.[cC][sS][vV]")
        .text(places)
        .select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
        .where((F.col("start") == 0) & (F.trim("value") != "") & ~commented)
        .withColumn("at", F.monotonically_increasing_id())
    )
    first_lines = lines.groupBy("path").agg(F.min_by("value", "at").alias("header"))
    groups = first_lines.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("paths")
    parts, expected = [], None
    for row in groups.collect():
        names = next(csv.reader([row["header"]], delimiter=settings["sep"], quotechar=settings["quote"]))
        names = [n.strip() for n in names]
        expected = expected or names
        same = sorted(names) == sorted(expected) if drift == "by_name" else names == expected or drift == "allow"
        if not same:
            raise ValueError(f"columns differ between files: {expected} and {names} in {row['paths'][0]}")
        part = _read_csv(spark, row["paths"], options, malformed)
        parts.append(part.select("*", F.col("_metadata.file_name").alias(fixed.LINEAGE_COLUMN)))
    if not parts:
        raise FileNotFoundError(f"no file in {places} has a header")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=drift == "allow"), parts)
