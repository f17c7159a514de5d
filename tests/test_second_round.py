"""Faults that small probes found: times outside UTC, boards of several jobs, CSV without headers, clashing names."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import Row
from pyspark.sql import functions as F

from strata.operators.loads import append
from strata.operators.schema import schema_entries
from strata.operators.snapshots import SnapshotTable
from strata.plans import reports, table_run
from strata.plans.run_log import RunLog, read_log
from strata.session import session_like
from strata.sources import folders
from strata.sources.landing_files import read_source_files
from strata.sources.readers import read_landing_csv, write_csv
from strata.sources.workbook import _header_names


def test_commits_and_events_are_instants_in_any_zone(spark, tmp_path):
    away = session_like(spark)
    away.conf.set("spark.sql.session.timeZone", "America/New_York")
    table = SnapshotTable(away, str(tmp_path / "t"))
    append(table, away.range(1))
    log = RunLog(away, str(tmp_path / "log"), "job", "r")
    log.summary("t", True)
    log.flush()
    now = datetime.now(timezone.utc).timestamp()
    for moment in (table.history().select(F.unix_timestamp("committed_at")).first()[0], read_log(away, log.path).select(F.unix_timestamp("timestamp")).first()[0]):
        assert abs(now - moment) < 600
    assert table.read(as_of=datetime.now(timezone.utc)).count() == 1


def test_sessions_keep_settings_made_at_run_time(spark):
    away = session_like(spark)
    away.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    assert session_like(away).conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"


def test_repeated_rows_in_the_change_feed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("strata.operators.snapshots.COPIES", 4)
    table = SnapshotTable(spark, str(tmp_path / "t"))
    append(table, spark.createDataFrame([(0,)], "k int"))
    append(table, spark.createDataFrame([(1,)] * 9 + [(2,)], "k int"))
    counts = {r.k: r.n for r in table.changes(["k"]).groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert counts == {1: 9, 2: 1}


def test_the_board_tells_jobs_apart(spark):
    control = spark.createDataFrame(
        [("a_daily", "t", "r", "m", "d", "s"), ("b_daily", "t", "r", "m", "d", "s")],
        "job_name string, table_name string, region string, market string, domain string, source_name string",
    ).withColumn("sync_timestamp", F.current_timestamp())
    statuses = spark.createDataFrame([("1", "a_daily", "t", "FAILED", "x")], "job_run_id string, job_name string, table_name string, status string, error_message string")
    none = spark.createDataFrame([], "job_name string, table_name string, last_table_update_time timestamp")
    board = reports.monitoring_rows(control, statuses, none, job_id="1", trigger_type="M", run_url="", now="2024-01-01").collect()
    assert [(r.job_name, r.status) for r in board] == [("a_daily", "FAILED")]


def test_the_run_completed_last_is_the_newest(spark, tmp_path):
    for name in ("batch_000000000000", "20991231_000000"):
        spark.range(1).write.parquet(str(tmp_path / name))
    assert folders.latest_run(spark, str(tmp_path)).endswith("/20991231_000000")


def test_csv_without_headers_and_without_comments(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,x\n")
    (tmp_path / "b.csv").write_text("2,y\n")
    rows = read_source_files(spark, str(tmp_path), "csv", {"header": False}).collect()
    assert sorted(tuple(r)[:2] for r in rows) == [("1", "x"), ("2", "y")]
    rows = read_source_files(spark, str(tmp_path), "csv", {"comment": None}, "allow")
    assert sorted(rows.columns) == ["1", "2", "source_file_name", "x", "y"]


def test_landing_keeps_texts_that_look_like_null(spark, tmp_path):
    texts = ["\\N", "\\\\N", "\\", "N", "\\N ", "", None, 'a"b', "line\nbreak"]
    write_csv(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string"), str(tmp_path / "l"))
    back = read_landing_csv(spark, str(tmp_path / "l"))
    assert [r.t for r in back.orderBy(F.col("i").cast("int")).collect()] == texts


def test_clashing_workbook_headers():
    assert list(_header_names({0: "a", 1: "a", 2: "a.1"}, None, 3).values()) == ["a", "a.1", "a.1.1"]
    assert list(_header_names({0: "a.1", 1: "a", 2: "a"}, None, 4).values()) == ["a.1", "a", "a.2", "col_3"]


def test_schema_entries_of_any_shape():
    wanted = [{"column_name": "c", "data_type": "int"}]
    for given in ({"column_name": "c", "data_type": "int"}, ["c", "int"], ("c", "int"), Row(column_name="c", data_type="int")):
        assert schema_entries([given]) == wanted
    assert schema_entries([["c"]]) == schema_entries(None) == []


def test_the_whole_error_is_logged_and_the_log_never_hides_it(spark, tmp_path, monkeypatch):
    def fails(run, rows):
        raise ValueError("x" * 500)

    monkeypatch.setattr(table_run, "_run_layers", fails)
    config = {"table_name": "t", "job_name": "j", "ingestion_steps": {}}
    for broken in (False, True):
        if broken:
            monkeypatch.setattr(RunLog, "flush", lambda self: 1 / 0)
        try:
            table_run.run_table(spark, config, str(tmp_path))
        except ValueError as seen:
            assert broken == bool(getattr(seen, "__notes__", None))
    event = read_log(spark, f"{tmp_path}/run_log").where("function_name = 'run'").first()
    assert json.dumps(event.additional_data["error_text"]) == json.dumps("x" * 500)
    assert len(event.message) < 200
