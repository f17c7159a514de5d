"""What a source folder holds and what becomes of it: manifests, other files, malformed rows, repeated runs, split files."""

import gzip
import json
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strata import session
from strata.catalogue import flagship
from strata.catalogue.runs import settings
from strata.operators.trusted import TrustedTable
from strata.plans import config as cfg
from strata.plans import table_run
from strata.plans.run_log import read_log
from strata.plans.table_run import run_table
from strata.sources import manifest, readers
from strata.sources.landing_files import read_source_files

COLUMNS = {"a": "int", "b": "string"}


@pytest.fixture
def staging(tmp_path):
    folder = tmp_path / "staging" / "T"
    folder.mkdir(parents=True)
    (folder / "one.csv").write_text("a,b\n1,x\n2,y\n")
    return folder


def config(staging, **landing):
    return settings(str(staging.parent), "t", COLUMNS, landing=landing)


def rows(spark, told, base, *columns):
    df = TrustedTable(spark, cfg.locations(told, "", base)["raw_trusted"]).read()
    return sorted((tuple(r) for r in df.select(*(columns or ("a", "b"))).collect()), key=repr)


def manifests(spark, told, base):
    df = manifest.loaded_before(spark, cfg.locations(told, "", base)["manifests"])
    return sorted((r.file_name, r.rows) for r in df.collect())


def test_files_the_reader_would_pass_over_are_an_error(spark, staging, tmp_path):
    (staging / "b.txt").write_text("a,b\n3,z\n")
    (staging / "_hidden").write_text("x")
    (staging / "sub").mkdir()
    (staging / "sub" / "c.csv").write_text("a,b\n9,q\n")
    base = str(tmp_path / "lake")
    with pytest.raises(ValueError, match=r"1 file\(s\) would not be read as csv: b.txt"):
        run_table(spark, config(staging), base)
    told = config(staging, other_files="skip")
    run_table(spark, told, base)
    assert rows(spark, told, base) == [(1, "x"), (2, "y")]
    assert manifests(spark, told, base) == [("one.csv", 2)]


def test_the_manifest_lists_files_without_rows(spark, staging, tmp_path):
    (staging / "two.CSV").write_text("a,b\n")
    (staging / "näme 3.csv").write_text("a,b\n3,z\n")
    base, told = str(tmp_path / "lake"), config(staging)
    run_table(spark, told, base)
    assert sorted(rows for _, rows in manifests(spark, told, base)) == [0, 1, 2]


def test_only_new_files(spark, staging, tmp_path):
    base, told = str(tmp_path / "lake"), config(staging, only_new_files=True)
    run_table(spark, told, base)
    (staging / "two.csv").write_text("a,b\n3,z\n")
    run_table(spark, told, base)
    assert rows(spark, told, base) == [(1, "x"), (2, "y"), (3, "z")]
    with pytest.raises(FileNotFoundError):
        run_table(spark, told, base)
    (staging / "two.csv").write_text("a,b\n4,changed\n")
    run_table(spark, told, base)
    assert rows(spark, told, base)[-1] == (4, "changed")


@pytest.mark.parametrize("step", ["write_manifest", "archive_sources"])
def test_a_delivery_that_is_loaded_again_is_there_once(spark, staging, tmp_path, monkeypatch, step):
    base, told = str(tmp_path / "lake"), config(staging)

    def fails(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(table_run, step, fails)
        with pytest.raises(OSError, match="lost"):
            run_table(spark, told, base, archive=str(tmp_path / "archive"))
    assert rows(spark, told, base) == [(1, "x"), (2, "y")]
    run_table(spark, told, base, archive=str(tmp_path / "archive"))
    assert rows(spark, told, base) == [(1, "x"), (2, "y")]
    assert not list(staging.glob("*.csv")) and len(list((tmp_path / "archive").rglob("one.csv"))) == 1
    (staging / "one.csv").write_text("a,b\n1,x\n2,y\n")
    run_table(spark, told, base)
    assert len(rows(spark, told, base)) == 4


def test_malformed_rows(spark, staging, tmp_path):
    (staging / "one.csv").write_text('a,b\n1,x\n2,y,EXTRA\n3\n"4","p,q"\n\n')
    for policy, wanted in (("report", [(1, "x"), (2, "y"), (3, None), (4, "p,q")]), ("reject", [(1, "x"), (4, "p,q")])):
        base, told = str(tmp_path / policy), config(staging, malformed_rows=policy)
        run_table(spark, told, base)
        assert rows(spark, told, base) == wanted
        records = spark.read.parquet(cfg.locations(told, "", base)["errors"])
        assert sorted(r.failed_value for r in records.collect()) == ["2,y,EXTRA", "3"]
        assert json.loads(records.where("failed_value = '3'").first().full_record)["a"] == "3"
        kept = read_log(spark, f"{base}/run_log").where("layer = 'dq_completeness'").first().additional_data
        assert kept["malformed_rows"] == "2" and kept["duplicate_rows_dropped"] == "0"
    with pytest.raises(ValueError, match="2 row.* more or fewer"):
        run_table(spark, config(staging, malformed_rows="fail"), str(tmp_path / "fail"))
    with pytest.raises(ValueError, match="unknown policy"):
        run_table(spark, config(staging, malformed_rows="lose"), str(tmp_path / "lose"))


def test_malformed_rows_by_header(spark, staging):
    (staging / "two.csv").write_text("b,a\ny,3,EXTRA\n")
    df = read_source_files(spark, str(staging), "csv", {}, "by_name", "bad")
    assert sorted((r.a, r.b, r.bad) for r in df.collect()) == [("1", "x", None), ("2", "y", None), ("3", "y", "y,3,EXTRA")]


def test_personal_data_in_malformed_rows_is_sealed(spark, staging, tmp_path):
    (staging / "one.csv").write_text("a,b\n1,secret,EXTRA\n")
    base, told = str(tmp_path / "lake"), config(staging, pii_columns=["b"])
    run_table(spark, told, base, pii_key="0123456789abcdef")
    written = "".join(p.read_text() for p in (tmp_path / "lake" / "landing").rglob("*.csv"))
    record = spark.read.parquet(cfg.locations(told, "", base)["errors"]).first()
    assert "secret" not in written and "secret" not in record.failed_value + record.full_record


def test_a_landing_file_is_read_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "landing")
    texts = spark.range(20_000).select("id", F.concat(F.lit('line\nbreak, "quote" \\ \r\n'), F.repeat(F.lit("x"), 40), "id").alias("t"))
    readers.write_csv(texts.coalesce(1), path)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        back = readers.read_landing_csv(spark, path)
        parts = back.select(F.spark_partition_id()).distinct().count()
        assert parts > 4
        assert back.select(F.col("id").cast("bigint").alias("id"), "t").exceptAll(texts).count() == 0 and back.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_landing_spells_every_text(spark, tmp_path):
    texts = ["\\", "\\b", "\\n", "\\\\n", "\n", "\r", "\r\n", "\\\n", "n\\", "\\N", "\\\\N", "", None, " ", '"', ',"', " ", "\x85"]
    readers.write_csv(spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1), str(tmp_path / "l"))
    back = readers.read_landing_csv(spark, str(tmp_path / "l"))
    assert [r.t for r in back.orderBy(F.col("i").cast("int")).collect()] == texts


def test_the_same_files_give_the_same_token(spark, staging):
    files = manifest.listed(spark, str(staging))
    one = manifest.token_of(files)
    assert one == manifest.token_of(manifest.listed(spark, str(staging)).repartition(3)) and one.startswith("files-1-")
    (staging / "two.csv").write_text("a,b\n")
    assert manifest.token_of(manifest.listed(spark, str(staging))) != one


def test_tables_of_a_job_share_its_run_id(spark, staging, tmp_path):
    from strata.plans import jobs

    told = config(staging)
    table = TrustedTable(spark, str(tmp_path / "control"))
    configs = spark.createDataFrame([("j", "t", json.dumps(told))], "job_name string, table_name string, config string")
    jobs.register_configs(configs, table, "2024-01-01 00:00:00")
    ids = [jobs.run_job(spark, table.read(), "j", str(tmp_path / "lake"))["job_run_id"] for _ in range(2)]
    logged = {r.job_run_id for r in read_log(spark, str(tmp_path / "lake" / "run_log")).select("job_run_id").distinct().collect()}
    assert len(set(ids)) == 2 and logged == set(ids)


def test_settings_may_stand_among_the_formats_options(spark, staging, tmp_path):
    (staging / "b.txt").write_text("x")
    (staging / "one.csv").write_text("a,b\n1,x\n2\n")
    told = config(staging)
    told["ingestion_steps"]["landing"]["csv_options"] = json.dumps({"delimiter": ",", "other_files": "skip", "malformed_rows": "reject"})
    base = str(tmp_path / "lake")
    run_table(spark, told, base)
    assert rows(spark, told, base) == [(1, "x")]


def test_ages_come_from_the_tables(spark, staging, tmp_path):
    from strata.plans import reports

    base, told = str(tmp_path / "lake"), config(staging)
    control = spark.createDataFrame(
        [("j", "t", "SHOP", "US"), ("j", "never", "SHOP", "US")], "job_name string, table_name string, source_name string, market string"
    )
    assert reports.last_updates(spark, control, base).count() == 0
    for now in ("2024-01-01 00:00:00", "2024-01-02 03:00:00"):
        run_table(spark, told, base, now=now)
    found = reports.last_updates(spark, control, base).collect()
    assert [(r.job_name, r.table_name, str(r.last_table_update_time)) for r in found] == [("j", "t", "2024-01-02 03:00:00")]


def landed_files(base):
    return sorted((base / "landing").rglob("part-*"))


def test_landing_of_slices_is_compressed_in_files_of_few_rows(spark, staging, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "SLICE_ROWS", 2)
    (staging / "one.csv").write_text("a,b\n" + "".join(f'{i},"say {i}, ä"\n' for i in range(6)))
    base, told = tmp_path / "lake", config(staging)
    run_table(spark, told, str(base))
    files = landed_files(base)
    assert len(files) == 3 and all(f.name.endswith(".csv.gz") for f in files)
    assert all(len(gzip.decompress(f.read_bytes()).splitlines()) == 3 for f in files)  # a header and two rows
    assert rows(spark, told, str(base)) == [(i, f"say {i}, ä") for i in range(6)]


def test_compressed_landing_spells_every_text(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "SLICE_ROWS", 3)
    texts = ["\\", "\\b", "\\n", "\n", "\r\n", "\\N", "", None, " ", '"', ',"', "\x85"]
    readers.write_csv(spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1), str(tmp_path / "l"), sliced=True)
    back = readers.read_landing_csv(spark, str(tmp_path / "l"))
    assert [r.t for r in back.orderBy(F.col("i").cast("int")).collect()] == texts


@pytest.mark.parametrize("options", [{"multiLine": True}, {"multiline": "true"}])
def test_landing_of_whole_files_stays_plain(spark, staging, tmp_path, options):
    told = config(staging)
    told["ingestion_steps"]["landing"]["csv_options"] = options
    run_table(spark, told, str(tmp_path / "lake"))
    assert {f.name.rsplit("c000", 1)[1] for f in landed_files(tmp_path / "lake")} == {".csv"}


def test_personal_data_is_sealed_in_compressed_landing(spark, staging, tmp_path):
    (staging / "one.csv").write_text("a,b\n1,secret,EXTRA\n")
    run_table(spark, config(staging, pii_columns=["b"]), str(tmp_path / "lake"), pii_key="0123456789abcdef")
    written = b"".join(gzip.decompress(f.read_bytes()) for f in landed_files(tmp_path / "lake"))
    assert b"one.csv" in written and b"secret" not in written


def test_a_run_from_compressed_landing(spark, staging, tmp_path):
    base, told = str(tmp_path / "lake"), config(staging)
    for off in (["raw", "raw_trusted"], ["landing"]):
        steps = {n: {**s, "enabled": n not in off} for n, s in told["ingestion_steps"].items()}
        run_table(spark, {**told, "ingestion_steps": steps}, base)
    assert rows(spark, told, base) == [(1, "x"), (2, "y")]


def test_raw_and_trusted_files_are_small(spark, staging, tmp_path):
    base, told = tmp_path / "lake", config(staging)
    run_table(spark, told, str(base))
    (staging / "one.csv").write_text("a,b\n3,z\n")
    run_table(spark, told, str(base))
    for layer in ("raw", "trusted"):
        files = list((base / layer).rglob("*.parquet"))
        assert len(files) > 1
        assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
    assert rows(spark, told, str(base)) == [(1, "x"), (2, "y"), (3, "z")]


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_layers_leave_no_shuffles_behind(spark, staging, tmp_path, monkeypatch):
    (staging / "one.csv").write_text("a,b\n" + "".join(f"{i % 700},{i % 700}\n" for i in range(1000)))
    told, seen = config(staging), {}
    told["ingestion_steps"]["raw"]["deduplication"] = True

    def writes(df, path, write=table_run.write_parquet):
        before = shuffle_files(spark)
        write(df, path)
        until = time.time() + 10
        while (left := shuffle_files(spark) - before) and path.find("/raw/") > 0 and time.time() < until:
            time.sleep(0.1)
        seen[path.split("/lake/")[1].split("/")[0]] = left

    monkeypatch.setattr(table_run, "write_parquet", writes)
    run_table(spark, told, str(tmp_path / "lake"))
    assert seen["raw"] == set() and len(rows(spark, told, str(tmp_path / "lake"))) == 700


CLEANED, PARTS = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_lean_shuffles_are_for_a_while_and_leave_the_sessions_own_values(spark):
    df = spark.range(1000)
    assert spark.conf.get(CLEANED, None) is spark.conf.get(PARTS, None) is None
    with pytest.raises(KeyError), session.lean_shuffles(df):
        assert spark.conf.get(CLEANED) == "true"
        twice = df.groupBy((F.col("id") % 7).alias("k")).count()
        assert sorted(twice.collect()) == sorted(twice.collect())
        raise KeyError
    assert spark.conf.get(CLEANED, None) is spark.conf.get(PARTS, None) is None
    spark.conf.set(CLEANED, "false")
    try:
        with session.lean_shuffles(df):
            assert spark.conf.get(CLEANED) == "false"
        assert spark.conf.get(CLEANED) == "false"
    finally:
        spark.conf.unset(CLEANED)


def test_a_large_layer_is_dealt_to_more_parts(spark, staging, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "PART_BYTES", 100)
    (staging / "one.csv").write_text("a,b\n" + "".join(f"{i % 700},{i % 700}\n" for i in range(1000)))
    told, dealt = config(staging), {}
    told["ingestion_steps"]["raw"]["deduplication"] = True

    def writes(df, path, write=table_run.write_parquet):
        dealt[path.split("/lake/")[1].split("/")[0]] = int(spark.conf.get(PARTS, None) or 0)
        write(df, path)

    monkeypatch.setattr(table_run, "write_parquet", writes)
    run_table(spark, told, str(tmp_path / "lake"))
    assert dealt["raw"] > int(spark.conf.get("spark.sql.shuffle.partitions")) and not dealt["counts"]
    assert len(rows(spark, told, str(tmp_path / "lake"))) == 700


def test_the_flagships_layers_take_less_room_than_its_delivery(spark, tmp_path):
    lines = spark.range(20_000).selectExpr(
        "id div 4 AS l_orderkey", "id * 7919 % 2000 AS l_partkey", "id * 31 % 100 AS l_suppkey", "int(id % 4) AS l_linenumber",
        "double(id % 50 + 1) AS l_quantity", "double(id * 104729 % 9999999) / 100 AS l_extendedprice", "double(id % 11) / 100 AS l_discount",
        "double(id % 9) / 100 AS l_tax", "substr('ANR', int(id % 3) + 1, 1) AS l_returnflag", "'O' AS l_linestatus",
        "timestamp(date_add(date'1995-01-02', int(id % 2500))) AS l_shipdate",
    )
    flagship.messy_lineitem(lines).write.option("header", True).csv(str(tmp_path / "staging" / "LINE_ITEMS"))
    trusted = flagship.ingest(spark, flagship.config(str(tmp_path / "staging")), str(tmp_path))
    assert trusted.count() == lines.distinct().count() == 20_000

    def room(folder):
        return sum(f.stat().st_size for f in (tmp_path / folder).rglob("part-*"))

    assert room("landing") < room("staging") / 2
    assert room("trusted") < room("staging")
