"""One table through its layers: Landing -> Raw -> trusted.

Every layer is written once and the next one starts from what was written, so the source is read once and nothing is
computed twice. What has to be known beforehand (row counts, values that do not parse, column types, empty columns) is
counted in one pass per layer. Counts that matter come from such passes or from the written files, never from metrics
of a shuffle stage, which a lost executor would count again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import fixed
from strata.functions.pii import encrypt_columns
from strata.functions.text import col
from strata.operators import clean, errors, schema
from strata.operators.checks import ChecksFailed, run_checks
from strata.operators.loads import load, load_type_name
from strata.plans.config import enabled, locations
from strata.plans.run_log import RunLog
from strata.session import keep_methods_small, lean_shuffles
from strata.sources import manifest
from strata.sources.folders import latest_run, move_into, source_files
from strata.sources.landing_files import landing_settings, read_source_files, reads_slices
from strata.sources.producers import run_producer
from strata.sources.readers import format_name, read_landing_csv, write_csv, write_parquet

LAYERS = ["landing", "raw", "raw_trusted"]


@dataclass
class RunContext:
    spark: SparkSession
    config: dict
    paths: dict[str, str]
    log: RunLog
    pii_key: str | None = None
    batch_id: str | None = None
    now: str | None = None
    catalog: str | None = None
    files: DataFrame | None = None
    counted: bool = False

    @property
    def table(self) -> str:
        return self.config["table_name"]

    def layer(self, name: str) -> dict:
        return (self.config.get("ingestion_steps") or {}).get(name) or {}


# ---- Landing -----------------------------------------------------------------------------------------------


def source_folder(run: RunContext) -> str:
    return f"{run.layer('landing')['source_path'].rstrip('/')}/{run.table.upper()}"


def source_listing(run: RunContext) -> DataFrame | None:
    """The files this run is to load, or None for a source that is not files. Files that the reader would pass over are an
    error, unless ``other_files`` is 'skip'; with ``only_new_files`` those that an earlier run has loaded are left out."""
    landing = run.layer("landing")
    if not landing.get("source_path"):
        return None
    if not source_files(run.spark, source_folder(run)):
        raise FileNotFoundError(f"no input files in {source_folder(run)}")
    files = manifest.listed(run.spark, source_folder(run))
    settings = landing_settings(landing)[1]
    if (settings.get("other_files") or "fail") != "skip":
        manifest.require_read(files, landing["file_format"])
    files = files.where(manifest.is_read(landing["file_format"]))
    if settings.get("only_new_files"):
        files = manifest.new_files(files, manifest.loaded_before(run.spark, run.paths["manifests"]))
    return files


def source_rows(run: RunContext, files: DataFrame | None) -> DataFrame:
    """Rows of the source with lineage: files when a source path is configured, else a producer."""
    landing = run.layer("landing")
    if files is not None:
        options, settings = landing_settings(landing)
        drift = settings.get("header_drift") or "error"
        named = [row.path for row in files.select("path").collect()] if settings.get("only_new_files") else None
        malformed = None if str(options.get("mode") or "PERMISSIVE").upper() != "PERMISSIVE" else fixed.MALFORMED_COLUMN
        return read_source_files(run.spark, source_folder(run), landing["file_format"], options, drift, malformed, named)
    if landing.get("notebook_path"):
        return run_producer(run.spark, landing, run.table, run.log.run_id, run.paths["landing"] + "-produced")
    raise ValueError(f"landing of '{run.table}' names neither source_path nor notebook_path; it has {sorted(landing)}")


def flat_text(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, since CSV holds text only."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(*[F.to_json(col(f.name)).alias(f.name) if isinstance(f.dataType, nested) else col(f.name) for f in df.schema.fields])


def land(run: RunContext, rows: DataFrame | None = None) -> DataFrame:
    """Source -> Landing CSV in one scan; returns the Landing rows as read back."""
    landing = run.layer("landing")
    if rows is None:
        run.files = source_listing(run)
        rows = source_rows(run, run.files)
    df = flat_text(rows)
    if landing.get("pii_columns"):
        lines = [fixed.MALFORMED_COLUMN] if fixed.MALFORMED_COLUMN in df.columns else []  # they hold the same data
        df = encrypt_columns(df, [*landing["pii_columns"], *lines], run.pii_key)
    write_csv(df, run.paths["landing"], sliced=run.files is not None and reads_slices(landing))
    run.log.event(
        "INFO",
        f"landed {run.table}",
        function="process_landing",
        status="success",
        table=run.table,
        layer="landing",
        path=run.paths["landing"],
        format=format_name(landing.get("file_format") or "producer"),
        pii_columns=landing.get("pii_columns") or [],
    )
    return read_landing_csv(run.spark, run.paths["landing"])


# ---- Raw ---------------------------------------------------------------------------------------------------


def _count_landing(df: DataFrame, filled: Column, suspects: list[str], counters: dict[str, Column], path: str):
    """All Raw needs to know about Landing in one scan: per source file first, which is written for the manifest, then over all."""
    lineage = fixed.LINEAGE_COLUMN if fixed.LINEAGE_COLUMN in df.columns else None
    measures = {"__total": F.count("*"), "__filled": F.count_if(filled), "__malformed": F.count(col(fixed.MALFORMED_COLUMN))}
    measures |= {f"__suspect_{i}": F.count(col(n)) for i, n in enumerate(suspects)}
    measures |= {f"__c_{i}": c for i, c in enumerate(counters.values())}
    if lineage is None:
        return df.agg(*[c.alias(name) for name, c in measures.items()], F.lit(0).alias("__files"), F.lit("").alias("__names")).first()
    # counters are counts, which add up, or type bits (int), which are ANDed, or digits (smallint), of which the most counts
    per_file = df.groupBy(lineage).agg(*[c.alias(name) for name, c in measures.items()])
    write_parquet(per_file, path)
    per_file = df.sparkSession.read.schema(per_file.schema).parquet(path)
    merge = {"bigint": lambda name: F.coalesce(F.sum(name), F.lit(0)), "int": F.bit_and, "smallint": F.max}
    kinds = {name: per_file.schema[name].dataType.simpleString() for name in measures}
    return per_file.agg(
        *[merge[kinds[name]](name).alias(name) for name in measures],
        F.count("*").alias("__files"),
        # the manifest has all names
        F.when(F.count("*") > 2, F.concat_ws(" ... ", F.min(lineage), F.max(lineage))).otherwise(F.concat_ws(", ", F.min(lineage), F.when(F.count("*") > 1, F.max(lineage)))).alias("__names"),
    ).first()


def refine(run: RunContext, landed: DataFrame) -> DataFrame:
    """Landing -> Raw Parquet: empty rows and columns out, headers in snake_case, types enforced or inferred, repeats
    removed. Two scans of Landing: one that counts, one that writes."""
    keep_methods_small(run.spark)
    settings, entries = run.layer("raw"), schema.schema_entries(run.config.get("schema"))
    # lines of malformed rows are no column of the source
    malformed = fixed.MALFORMED_COLUMN in landed.columns
    landed = landed if malformed else landed.withColumn(fixed.MALFORMED_COLUMN, F.lit(None).cast("string"))
    business = clean.business_columns(landed)
    suspects = clean.headerless_columns(business)
    plain = [n for n in landed.columns if n not in suspects and n != fixed.MALFORMED_COLUMN]
    renamed = landed.select(
        *[col(n).alias(new) for n, new in zip(plain, clean.standard_names(plain))], *[col(n) for n in suspects], col(fixed.MALFORMED_COLUMN)
    )
    business = [n for n in clean.business_columns(renamed) if n not in suspects]
    filled = clean.any_filled(business + suspects)
    enforce = settings.get("schema_config", "infer") == "enforce"
    if enforce:
        counters, counted_rows = schema.failure_counters(business, entries), renamed
    else:
        names = schema.text_columns(renamed.select(*[col(n) for n in business]))
        counters, counted_rows = schema.type_counters(names), schema.with_type_bits(renamed, names)
    counted = _count_landing(counted_rows, filled, suspects, counters, run.paths["counts"])
    run.counted = True
    measured = {name: counted[f"__c_{i}"] for i, name in enumerate(counters)}

    run.log.event(
        "INFO",
        f"{run.table}: {counted['__files']} source file(s)",
        function="log_source_files",
        status="success",
        table=run.table,
        record_count=counted["__total"],
        layer="landing",
        file_count=counted["__files"],
        file_names=counted["__names"],
    )
    clean.settle_headerless(renamed, {n: counted[f"__suspect_{i}"] for i, n in enumerate(suspects)}, run.table)
    if enforce:
        schema.raise_on_failures(measured, entries)
    else:
        entries = schema.inferred_entries(measured)
    rejected = _malformed_rows(run, renamed, counted["__malformed"])
    kept = renamed.where(filled & col(fixed.MALFORMED_COLUMN).isNull() if rejected else filled).drop(*suspects, fixed.MALFORMED_COLUMN)
    typed = schema.enforced(kept, entries) if enforce else schema.enforced(kept, entries).select(*kept.columns)
    dedup = clean.dedup_enabled(settings.get("deduplication"))
    with lean_shuffles(landed):
        write_parquet(clean.drop_duplicate_rows(typed) if dedup else typed, run.paths["raw"])

    raw = run.spark.read.parquet(run.paths["raw"])
    final, total = raw.count(), counted["__total"]
    share = round(final / total, 4) if total else None
    run.log.event(
        "INFO" if share == 1.0 else "WARNING",
        f"{run.table}: {final}/{total} rows kept",
        function="process_raw",
        status="success" if share == 1.0 else "warning",
        table=run.table,
        layer="dq_completeness",
        passed_count=final,
        total_count=total,
        empty_rows_dropped=total - counted["__filled"],
        malformed_rows=counted["__malformed"],
        duplicate_rows_dropped=counted["__filled"] - final - (counted["__malformed"] if rejected else 0),
    )
    return raw


def _malformed_rows(run: RunContext, rows: DataFrame, count: int) -> bool:
    """Records the rows that had more or fewer cells than their file has columns. By ``malformed_rows`` they are loaded all
    the same ('report': missing cells are null, surplus cells are in the record only), left out ('reject'; says so by True), or
    stop the run ('fail')."""
    policy = landing_settings(run.layer("landing"))[1].get("malformed_rows") or "report"
    if policy not in ("report", "reject", "fail"):
        raise ValueError(f"unknown policy '{policy}' for malformed rows")
    if not count:
        return False
    write_error_records(run, errors.malformed_records(rows))
    run.log.event(
        "WARNING", f"{run.table}: {count} malformed row(s)", function="process_raw", status="warning", table=run.table, record_count=count, layer="landing"
    )
    if policy == "fail":
        raise ValueError(f"{count} row(s) of {run.table} have more or fewer cells than their files have columns")
    return policy == "reject"


def write_error_records(run: RunContext, records: DataFrame) -> None:
    stamped = errors.with_envelope(
        records,
        now=run.now or datetime.now(timezone.utc).replace(microsecond=0),
        job_id=run.log.job_run_id,
        run_id=run.log.run_id,
        job_name=run.log.job_name,
        source_table=run.table,
    )
    errors.write_errors(stamped, run.paths["errors"])


# ---- trusted -----------------------------------------------------------------------------------------------


def promote(run: RunContext, raw: DataFrame) -> int:
    """Raw -> trusted table: checks in one pass, error records when one fails, then the load. Returns the load's number."""
    settings = run.layer("raw_trusted")
    keys = settings.get("primary_key") or []
    with lean_shuffles(raw):
        results = run_checks(raw, run.config)
    for result in results:
        run.log.event(
            "INFO" if result.passed else "ERROR",
            f"[{result.name}] {result.details}",
            function="process_raw_trusted",
            status="success" if result.passed else "failed",
            table=run.table,
            layer="validation",
            validation_name=result.name,
        )
    if not all(r.passed for r in results):
        write_error_records(run, errors.failure_records(run.spark, results, raw, keys))
        raise ChecksFailed(run.table, results)
    version = load(
        run.spark,
        raw,
        run.paths["raw_trusted"],
        settings.get("load_type") or "append",
        keys,
        evolve=bool(settings.get("schema_evolution")),
        expire_missing=bool(settings.get("enable_expiration")),
        batch_id=run.batch_id or delivery_token(run),
        keys_checked=any(r.name == fixed.KEY_CHECK for r in results) and bool(keys),
        buckets=settings.get("merge_buckets"),
        name=run.catalog and f"{run.catalog}.{run.paths['trusted_name']}",
        now=run.now,
    )
    run.log.event(
        "INFO",
        f"loaded {run.table}, load {version}",
        function="process_raw_trusted",
        status="success",
        table=run.table,
        record_count=raw.count(),
        layer="raw_trusted",
        load_type=settings.get("load_type") or "append",
        path=run.paths["raw_trusted"],
    )
    return version


def delivery_token(run: RunContext) -> str | None:
    """Names the delivery of an append from files: loaded again, say because the log could not be written or a file not be
    moved after the commit, it replaces its own rows."""
    appends = load_type_name(run.layer("raw_trusted").get("load_type") or "append") == "append"
    return manifest.token_of(run.files) if run.files is not None and appends else None


# ---- the run -----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Outcome:
    """How a run ended. ``reason`` and ``findings`` are cut to what a report shows, ``whole`` is all that is known."""

    reason: str | None = None
    findings: str | None = None
    whole: dict[str, str] = field(default_factory=dict)

    @staticmethod
    def of(failure: Exception | None) -> Outcome:
        if failure is None:
            return Outcome()
        if isinstance(failure, ChecksFailed):
            shown, every = fixed.SHOWN_CHECKS, failure.failed_checks
            return Outcome("Validation failed", " | ".join(every[:shown]), {"failed_checks": " | ".join(every)})
        kind = type(failure).__name__
        return Outcome(f"{kind}: {str(failure)[: fixed.SHOWN_ERROR]}", None, {"error_type": kind, "error_text": str(failure)})

    def tell(self, log: RunLog, table: str) -> None:
        if self.reason:
            log.event("ERROR", f"{table}: {self.reason}", function="run", status="failed", table=table, **self.whole)
        log.summary(table, not self.reason, self.reason, self.findings)
        log.flush()


def _run_layers(run: RunContext, rows: DataFrame | None) -> int | None:
    wanted = [name for name in LAYERS if enabled(run.layer(name))]
    df = None
    if "landing" in wanted or rows is not None:
        df = land(run, rows)
        run.log.flush()
    elif "raw" in wanted:
        df = read_landing_csv(run.spark, latest_run(run.spark, run.paths["landing_runs"]))
    elif "raw_trusted" in wanted:
        df = run.spark.read.option("mergeSchema", True).parquet(latest_run(run.spark, run.paths["raw_runs"]))
    if "raw" in wanted:
        df = refine(run, df)
        run.log.flush()
    return promote(run, df) if "raw_trusted" in wanted else None


def write_manifest(run: RunContext) -> None:
    if run.counted:  # by the pass that Raw starts with
        per_file = run.spark.read.parquet(run.paths["counts"]).select(fixed.LINEAGE_COLUMN, F.col("__total").alias("rows"))
    else:
        per_file = read_landing_csv(run.spark, run.paths["landing"]).groupBy(fixed.LINEAGE_COLUMN).agg(F.count("*").alias("rows"))
    files = manifest.counted(run.files, per_file, run.log.run_id, run.table)
    files.write.mode("overwrite").parquet(f"{run.paths['manifests']}/{run.log.run_id}")


def archive_sources(run: RunContext, folder: str) -> None:
    """Moves the source files that the manifest has rows of. Files without rows, or that came meanwhile, stay."""
    loaded = run.spark.read.schema(manifest.SCHEMA).parquet(f"{run.paths['manifests']}/{run.log.run_id}").where("rows > 0")
    move_into(run.spark, [row.path for row in loaded.select("path").toLocalIterator()], folder)


def run_table(
    spark: SparkSession,
    config: dict,
    base: str,
    *,
    rows: DataFrame | None = None,
    run_ts: str | None = None,
    job_run_id: str | None = None,
    pii_key: str | None = None,
    batch_id: str | None = None,
    now: str | None = None,
    archive: str | None = None,
    catalog: str | None = None,
) -> int | None:
    """Runs the enabled layers of one table under ``base`` and logs the outcome.

    Layers that are switched off are skipped; a run without Landing starts from the newest completed Landing folder,
    one without Raw from the newest completed Raw folder. ``rows`` stands in for the source (a stream's batch).
    With ``catalog``, the trusted table is there under its schema and name. With ``archive``, source files whose rows were landed are moved below it once the load is committed, so that the
    next run does not load them again. The manifest of the files is written after the commit, then the log, then files move;
    whatever of this fails, the run may be repeated: its delivery is loaded once.
    """
    run_ts = run_ts or datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
    log = RunLog(spark, f"{base.rstrip('/')}/run_log", config.get("job_name") or "", f"{run_ts}-{uuid.uuid4().hex[:8]}", job_run_id)
    run = RunContext(spark, config, locations(config, run_ts, base), log, pii_key, batch_id, now, catalog)
    try:
        version = _run_layers(run, rows)
        if run.files is not None:
            write_manifest(run)
    except Exception as failure:
        try:
            Outcome.of(failure).tell(log, run.table)
        except Exception as unlogged:  # the run's own error is the one to see
            failure.add_note(f"the run log could not be written: {unlogged}")
        raise
    Outcome.of(None).tell(log, run.table)
    if archive and run.files is not None:
        archive_sources(run, f"{archive.rstrip('/')}/{run.table.upper()}/{run_ts}")
    return version
