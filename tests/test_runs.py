import json

import pytest
from pyspark.sql import functions as F

from strata import fixed
from strata.catalogue import registry
from strata.catalogue.arrivals import COLUMNS, events_config
from strata.operators.checks import ChecksFailed
from strata.operators.trusted import TrustedTable
from strata.plans import config as cfg
from strata.plans import jobs, reports
from strata.plans.run_log import LOG_SCHEMA, read_log
from strata.plans.table_run import run_table
from strata.sources import folders
from strata.streaming.arrivals import ingest_arrivals

CSV = 'Order Id,Amount %,when,\n1,5 %,05-Mar-2024,\n2,N/A,2024-03-06,\n2,N/A,2024-03-06,\n,,,\n'


def settings(source, **trusted):
    return {
        "job_name": "shop_na_us_daily",
        "table_name": "orders",
        "region": "NA",
        "market": "U S",
        "domain": "D",
        "source_name": "Shop",
        "ingestion_steps": {
            "landing": {"source_path": str(source), "file_format": "csv", "pii_columns": []},
            "raw": {"schema_config": "enforce", "deduplication": "true"},
            "raw_trusted": {"load_type": "append", "primary_key": ["order_id"], **trusted},
        },
        "schema": [["order_id", "int"], ["amount", "double"], ["when", "date"]],
    }


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "staging" / "ORDERS"
    folder.mkdir(parents=True)
    (folder / "one.csv").write_text(CSV)
    return tmp_path / "staging"


def trusted(spark, config, base):
    df = TrustedTable(spark, cfg.locations(config, "", base)["raw_trusted"]).read()
    return sorted(tuple(r) for r in df.selectExpr("order_id", "amount", "CAST(when AS STRING)", fixed.LINEAGE_COLUMN).collect())


ROWS = [(1, 5.0, "2024-03-05", "one.csv"), (2, None, "2024-03-06", "one.csv")]


def test_full_run_and_its_report(spark, source, tmp_path):
    base, config = str(tmp_path / "lake"), settings(source)
    assert run_table(spark, config, base, job_run_id="j1") == 0
    assert trusted(spark, config, base) == ROWS
    log = read_log(spark, f"{base}/run_log")
    result = reports.table_results(log, "j1").first()
    assert (result.status, result.rows_ingested, result.dq_score) == ("SUCCESS", 2, 0.5)
    files = log.where("function_name = 'log_source_files'").first().additional_data
    assert (files["file_count"], files["file_names"], files["record_count"]) == ("1", "one.csv", "4")
    kept = log.where("layer = 'dq_completeness'").first().additional_data
    assert (kept["empty_rows_dropped"], kept["duplicate_rows_dropped"]) == ("1", "1")


def test_resume_from_raw_and_from_landing(spark, source, tmp_path):
    base, config = str(tmp_path / "lake"), settings(source, load_type="scd1")
    run_table(spark, config, base)
    for off in (["landing"], ["landing", "raw"]):
        partial = json.loads(json.dumps(config))
        for layer in off:
            partial["ingestion_steps"][layer] = {"source_path": None}
        run_table(spark, partial, base)
    assert trusted(spark, config, base) == ROWS


def test_failed_checks_leave_records_and_a_reason(spark, source, tmp_path):
    base, config = str(tmp_path / "lake"), settings(source)
    (source / "ORDERS" / "two.csv").write_text("Order Id,Amount %,when,\n1,7,2024-03-05,\n")
    with pytest.raises(ChecksFailed):
        run_table(spark, config, base, job_run_id="j1")
    errors = spark.read.parquet(cfg.locations(config, "", base)["errors"])
    assert errors.where("column_name = 'order_id'").count() == 2
    row = reports.table_status(read_log(spark, f"{base}/run_log"), "j1").first()
    assert row.status == "FAILED" and "duplicate rows" in row.error_message
    assert not TrustedTable(spark, cfg.locations(config, "", base)["raw_trusted"]).exists()


def test_values_that_do_not_parse_stop_the_run(spark, source, tmp_path):
    (source / "ORDERS" / "one.csv").write_text("Order Id,Amount %,when\nx,1,2024-01-01\n")
    with pytest.raises(ValueError, match="order_id"):
        run_table(spark, settings(source), str(tmp_path / "lake"))


def test_inference_and_pii(spark, source, tmp_path):
    base, config = str(tmp_path / "lake"), settings(source, validations=["row_count_validation"])
    config["ingestion_steps"]["raw"] = {"schema_config": "infer", "deduplication": True}
    config["ingestion_steps"]["landing"]["pii_columns"] = ["when"]
    with pytest.raises(ValueError, match="key"):
        run_table(spark, config, base)
    (source / "ORDERS" / "one.csv").write_text("Order Id,Amount %,when\n1,5 %,05-Mar-2024\n2,N/A,2024-03-06\n")
    run_table(spark, config, base, pii_key="0123456789abcdef")
    df = TrustedTable(spark, cfg.locations(config, "", base)["raw_trusted"]).read()
    assert dict(df.dtypes)["order_id"] == "int" and dict(df.dtypes)["when"] == "string"
    assert df.where(F.col("when").contains("2024")).count() == 0


def test_no_source_configured(spark, tmp_path):
    config = settings("x")
    config["ingestion_steps"]["landing"] = {"file_format": "csv"}
    with pytest.raises(ValueError, match="neither"):
        run_table(spark, config, str(tmp_path))


def test_arrivals_are_taken_once_and_archived(spark, tmp_path):
    staging, base, archive = tmp_path / "staging" / "EVENTS", str(tmp_path / "lake"), tmp_path / "archive"
    staging.mkdir(parents=True)
    config = events_config(str(tmp_path / "staging"))

    def run():
        query = ingest_arrivals(spark, config, base, f"{base}/cp", COLUMNS, archive=str(archive), available_now=True)
        query.awaitTermination()

    (staging / "a.csv").write_text("eventId,at,Event Type,value\n1,2024-01-01 10:00:00,x,1.5\n")
    run()
    (staging / "b.csv").write_text("eventId,at,Event Type,value\n2,2024-01-02 10:00:00,y,2\n")
    run()
    run()
    df = TrustedTable(spark, cfg.locations(config, "", base)["raw_trusted"]).read()
    assert sorted(r.event_id for r in df.collect()) == [1, 2]
    assert list(archive.rglob("a.csv"))


def test_config_files(spark, tmp_path):
    folder = tmp_path / "shop_daily"
    folder.mkdir()
    (folder / "good.json").write_text(json.dumps(settings("/in")))
    (folder / "bad.json").write_text("{")
    configs = cfg.read_config_files(spark, str(folder))
    errors = {r.table_name: r.errors for r in cfg.config_errors(configs).collect()}
    assert errors["bad"] == ["not valid JSON"]
    assert errors["good"] == [
        "Missing 'csv_options' block for format 'csv'",
        "'deduplication' must be boolean, got str",
        *[f"Schema entry {i} missing required fields" for i in range(3)],
    ]
    jobs = spark.createDataFrame([("shop_daily",), ("other",)], "job_name string")
    assert [r.job_name for r in cfg.jobs_without_configs(jobs, configs).collect()] == ["other"]
    with pytest.raises(FileNotFoundError):
        cfg.read_config_files(spark, str(tmp_path))


def test_control_row_back_to_config(spark):
    text = json.dumps({**settings("/in"), "schema": [{"column_name": "a", "data_type": "int"}]})
    rows = cfg.control_rows(spark.createDataFrame([("j", "t", text)], "job_name string, table_name string, config string"), "2024-01-01")
    config = cfg.config_of_row(rows.first())
    assert config["schema"] == [{"column_name": "a", "data_type": "int"}]
    assert config["ingestion_steps"]["raw_trusted"]["primary_key"] == ["order_id"]
    assert config["ingestion_steps"]["landing"]["format_options"] is None and "sync_timestamp" not in config
    assert cfg.enabled({"a": None}) is False and cfg.enabled({"a": False}) is True


def test_notify_settings(spark):
    control = spark.sql("SELECT 'shop' AS job_name, true AS is_active, '{\"emails\": [\"a@b.c\"]}' AS notify")
    assert reports.notify_settings(control, "JOB_SHOP", "JOB_") == ["a@b.c"]
    with pytest.raises(ValueError, match="no notify"):
        reports.notify_settings(control, "other")


def test_run_job_and_control_table(spark, source, tmp_path):
    base = str(tmp_path / "lake")
    good = settings(source)
    good["ingestion_steps"]["landing"]["csv_options"] = {"delimiter": ","}
    good["ingestion_steps"]["raw"]["deduplication"] = True
    good["schema"] = [{"column_name": c, "data_type": t} for c, t in good["schema"]]
    texts = [("shop", "orders", json.dumps(good)), ("shop", "empty", json.dumps(good))]
    configs = spark.createDataFrame(texts, "job_name string, table_name string, config string")
    control = TrustedTable(spark, str(tmp_path / "control"))
    jobs.register_configs(configs, control, "2024-01-01 00:00:00")
    jobs.register_configs(configs.where("table_name = 'orders'"), control, "2024-01-02 00:00:00")
    assert control.read().count() == 2
    done = jobs.run_job(spark, control.read(), "shop", base, ["orders", "empty", "other"], job_run_id="j1")
    assert done["missing"] == ["other"] and done["tables"]["orders"] == 0
    assert isinstance(done["tables"]["empty"], FileNotFoundError)
    report = {r.table_name: r.status for r in reports.table_results(read_log(spark, f"{base}/run_log"), "j1").collect()}
    assert report == {"orders": "SUCCESS", "empty": "FAILED"}
    with pytest.raises(ValueError, match="no active config"):
        jobs.run_job(spark, control.read(), "other", base)


def test_broken_configs_are_not_registered(spark, tmp_path):
    configs = spark.createDataFrame([("shop", "orders", "{")], "job_name string, table_name string, config string")
    with pytest.raises(ValueError, match="1 broken config.*shop/orders: not valid JSON"):
        jobs.register_configs(configs, TrustedTable(spark, str(tmp_path / "control")), "2024-01-01")


def test_framework_tables(spark):
    for _ in range(2):
        jobs.ensure_table(spark, "spark_catalog.strata_frame.control", cfg.CONTROL_SCHEMA)
        jobs.ensure_table(spark, "spark_catalog.strata_frame.log", LOG_SCHEMA)
    assert spark.table("strata_frame.log").columns[0] == "timestamp"


def test_config_files_are_written_by_tasks(spark, tmp_path, monkeypatch):
    rows = [(1, "a", 7), (2, "b", 7), (2, "c", 7), (3, None, 8), (None, "d", None)]
    spark.createDataFrame(rows, "s_suppkey int, s_name string, s_nationkey int").coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    monkeypatch.setattr(folders, "write_text", None)  # the driver writes none
    told = registry.all_queries()["config_files"](spark, str(tmp_path))
    expected = {("nation_7_daily", "t1", "a"), ("nation_7_daily", "t2", "c"), ("nation_8_daily", "t3", None), ("nation_None_daily", "tNone", "d")}
    assert {(r.job_name, r.table_name, r.region) for r in told.collect()} == expected


def test_texts_are_written_below_paths_and_uris(spark, tmp_path):
    files = spark.createDataFrame([("a/x y.json", "1"), ("b%20.json", "é")], "name string, content string")
    folders.write_texts(files, str(tmp_path / "by tasks"))
    folders.write_texts(files, f"file:{tmp_path}/uri")
    for folder in ("by tasks", "uri"):
        assert (tmp_path / folder / "a" / "x y.json").read_text() == "1"
        assert (tmp_path / folder / "b%20.json").read_text() == "é"
