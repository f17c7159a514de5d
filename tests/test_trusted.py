"""Trusted tables: what a load touches, and what a second writer, a failure or another session finds."""

import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata import fixed
from strata.operators.loads import load
from strata.operators.trusted import BUCKET, OPEN, STATE, TrustedTable, table_exists
from strata.sources import folders


@pytest.fixture
def target(tmp_path):
    return str(tmp_path / "lake" / "data" / "t's")


def frame(spark, *rows, ddl="k int, v string"):
    return spark.createDataFrame(list(rows), ddl)


def found(spark, target, *columns):
    return sorted((tuple(r) for r in TrustedTable(spark, target).read().select(*(columns or ("k", "v"))).collect()), key=repr)


def files(spark, target):
    return {(r[0], r[1]) for r in TrustedTable(spark, target).rows().select("_metadata.file_path", BUCKET).distinct().collect()}


@pytest.mark.parametrize("kind", ["scd1", "scd2"])
def test_one_key_of_200000_rewrites_one_bucket(spark, target, kind):
    rows = spark.range(200_000).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    load(spark, rows, target, kind, ["k"], buckets=64, now="2024-01-01 00:00:00")
    before = files(spark, target)
    load(spark, rows.where("k = 77777").withColumn("v", F.lit("b")), target, kind, ["k"], now="2024-01-02 00:00:00")
    after = files(spark, target)
    assert len({b for _, b in before}) == 64
    assert len({b for _, b in after - before}) == 1 and len(before - after) == 1
    assert TrustedTable(spark, target).read().count() == 200_000 + (kind == "scd2")
    assert TrustedTable(spark, target).read().where("v = 'b'").count() == 1


def test_a_merge_reads_the_touched_buckets_only(spark, target, monkeypatch):
    rows = spark.range(1000).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    load(spark, rows, target, "scd1", ["k"], buckets=16)
    plans = []
    monkeypatch.setattr(TrustedTable, "_replace", lambda self, placed, told, now: plans.append(placed._jdf.queryExecution().toString()) or 1)
    load(spark, rows.where("k = 5").withColumn("v", F.lit("b")), target, "scd1", ["k"])
    scans = [line for line in plans[0].splitlines() if "PartitionFilters" in line and BUCKET in line]
    assert scans and all(f"{BUCKET}#" in line.split("PartitionFilters")[1].split("]")[0] for line in scans)


def test_versions_that_ended_earlier_are_moved_out_once(spark, target):
    for value, now in (("a", "2024-01-05"), ("b", "2024-01-20"), ("c", "2024-02-03"), ("d", "2024-03-01"), ("d", "2024-03-02")):
        load(spark, frame(spark, (1, value)), target, "scd2", ["k"], now=f"{now} 00:00:00")
    rows = TrustedTable(spark, target).rows().select("v", STATE, fixed.IS_CURRENT).collect()
    states = {r.v: r[STATE] for r in rows}
    assert len(rows) == 4 and states["d"] == states["c"] == OPEN
    assert states["a"].startswith("closed-") and states["b"].startswith("closed-") and states["a"] != states["b"]
    assert [r.v for r in rows if r[fixed.IS_CURRENT]] == ["d"]


def test_all_versions_of_a_bucket_may_end(spark, target):
    rows = spark.range(20).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v"))
    load(spark, rows, target, "scd2", ["k"], buckets=8, now="2024-01-01 00:00:00")
    for now in ("2024-01-31 00:00:00", "2024-02-01 00:00:00"):
        load(spark, frame(spark, (100, "z")), target, "scd2", ["k"], expire_missing=True, now=now)
    shown = TrustedTable(spark, target).read()
    assert shown.where(F.col(fixed.IS_CURRENT)).select("k").collect()[0].k == 100
    assert shown.where(~F.col(fixed.IS_CURRENT)).count() == 20 and shown.count() == 21


def test_a_loads_own_batch_is_replaced(spark, target):
    load(spark, frame(spark, (1, "a")), target, batch_id="1/x")
    load(spark, frame(spark, (2, "b")), target, batch_id="2")
    load(spark, frame(spark, (3, "c")), target)
    load(spark, frame(spark, (4, "d"), (5, "e")), target, batch_id="1/x")
    assert found(spark, target) == [(2, "b"), (3, "c"), (4, "d"), (5, "e")]
    load(spark, frame(spark, (2, "b")).where("false"), target, batch_id="2")
    assert found(spark, target) == [(3, "c"), (4, "d"), (5, "e")]


def test_a_second_writer_is_refused(spark, target):
    load(spark, frame(spark, (0, "a")), target)
    outcomes = []

    def write(k):
        try:
            outcomes.append(load(spark, frame(spark, (k, "a")), target))
        except folders.ConcurrentLoad:
            outcomes.append("refused")

    threads = [threading.Thread(target=write, args=(k,)) for k in range(1, 7)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    written = sum(o != "refused" for o in outcomes)
    assert TrustedTable(spark, target).read().count() == 1 + written and written >= 1
    with folders.one_writer(spark, target):
        with pytest.raises(folders.ConcurrentLoad, match="another load"):
            load(spark, frame(spark, (9, "a")), target, "scd1", ["k"])
    load(spark, frame(spark, (9, "a")), target)


@pytest.mark.parametrize("kind", ["append", "overwrite", "scd1", "scd2"])
def test_a_load_that_fails_changes_nothing(spark, target, kind):
    load(spark, frame(spark, (1, "a"), (2, "b")), target, kind, ["k"])
    told = TrustedTable(spark, target).definition()
    broken = frame(spark, (1, "x"), (2, "y"), (3, "z")).withColumn("v", F.when(F.col("k") == 3, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        load(spark, broken, target, kind, ["k"], keys_checked=True)
    assert found(spark, target) == [(1, "a"), (2, "b")] and TrustedTable(spark, target).definition() == told
    assert load(spark, frame(spark, (1, "x")), target, kind, ["k"]) == 1


def test_a_repeated_merge_gives_the_same_rows(spark, target):
    load(spark, frame(spark, (1, "a"), (2, "b")), target, "scd2", ["k"], now="2024-01-01 00:00:00")
    for now in ("2024-01-02 00:00:00", "2024-01-02 00:00:01"):
        load(spark, frame(spark, (2, "c"), (3, "d")), target, "scd2", ["k"], now=now)
    assert found(spark, target, "k", "v", fixed.IS_CURRENT) == [(1, "a", True), (2, "b", False), (2, "c", True), (3, "d", True)]


def test_a_table_is_found_by_its_name(spark, target):
    load(spark, frame(spark, (1, "a")), target, "scd1", ["k"])
    assert not table_exists(spark, "spark_catalog.strata_trusted.t1")
    name = "spark_catalog.strata_trusted.t2"
    load(spark, frame(spark, (2, "b")), target, "scd1", ["k"], name=name)
    assert spark.catalog.tableExists(name)
    assert sorted(r.k for r in spark.table(name).collect()) == [1, 2]
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 2
    with pytest.raises(ValueError, match="is the table in"):
        load(spark, frame(spark, (2, "b")), target + "2", name=name)
    by_name = "spark_catalog.strata_trusted.t3"
    load(spark, frame(spark, (1, "a")), by_name)
    assert table_exists(spark, by_name) and spark.table(by_name).count() == 1


def test_a_catalog_that_forgot_the_table_learns_it_again(spark, target):
    load(spark, frame(spark, (1, "a")), target, "scd2", ["k"], now="2024-01-01 00:00:00")
    load(spark, frame(spark, (1, "b")), target, "scd2", ["k"], now="2024-02-01 00:00:00")
    told = TrustedTable(spark, target).definition()
    spark.sql(f"DROP TABLE {TrustedTable(spark, target).name}")
    assert TrustedTable(spark, target).definition() == told
    assert load(spark, frame(spark, (1, "c")), target, "scd2", ["k"], now="2024-03-01 00:00:00") == 2
    assert found(spark, target, "v", fixed.IS_CURRENT) == [("a", False), ("b", False), ("c", True)]


def test_another_layout_and_other_buckets(spark, target):
    load(spark, frame(spark, (1, "a"), (2, "b"), (None, "n")), target)
    load(spark, frame(spark, (2, "c"), (3, "d")), target, "scd1", ["k"], buckets=4)
    assert TrustedTable(spark, target).definition().layout == "keyed"
    TrustedTable(spark, target).rebucket(32)
    assert TrustedTable(spark, target).definition().buckets == 32
    load(spark, frame(spark, (3, "e")), target, "scd1", ["k"])
    load(spark, frame(spark, (4, "f")), target)
    assert found(spark, target) == sorted([(1, "a"), (2, "c"), (3, "e"), (4, "f"), (None, "n")], key=repr)
    with pytest.raises(ValueError, match="no history"):
        load(spark, frame(spark, (3, "e")), target, "scd2", ["k"])
    load(spark, frame(spark, (7, "x", 1), ddl="k int, w string, n int"), target, "overwrite")
    assert found(spark, target, "k", "w", "n") == [(7, "x", 1)]


def test_new_and_wider_columns(spark, target):
    load(spark, frame(spark, (1, 5), ddl="k int, n int"), target, "scd1", ["k"])
    wider = frame(spark, (2, 5_000_000_000, {"a": 1}), ddl="k int, n bigint, m map<string,int>")
    with pytest.raises(ValueError, match="do not fit"):
        load(spark, wider, target, "scd1", ["k"])
    load(spark, wider, target, "scd1", ["k"], evolve=True)
    assert found(spark, target, "k", "n", "m") == [(1, 5, None), (2, 5_000_000_000, {"a": 1})]


def test_history_compares_values_of_any_type(spark, target):
    ddl = "k int, m map<string,int>, a array<double>, s struct<x:timestamp,y:binary>"
    one = (1, {"a": 1}, [1.0, float("nan")], (datetime(2024, 1, 1), b"z"))
    for day, row in enumerate([one, one, (1, {"a": 2}, *one[2:]), (1, {"a": 2}, None, one[3]), (1, {"a": 2}, None, (None, b"z"))], 1):
        load(spark, frame(spark, row, ddl=ddl), target, "scd2", ["k"], now=f"2024-01-0{day} 00:00:00")
    assert TrustedTable(spark, target).read().count() == 4


def test_history_load_shuffles_its_rows_once(spark, tmp_path, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans, replace = [], TrustedTable._replace

        def seen(self, placed, *args, **kwargs):
            plans.append(placed._jdf.queryExecution().optimizedPlan().toString())
            return replace(self, placed, *args, **kwargs)

        monkeypatch.setattr(TrustedTable, "_replace", seen)
        table = TrustedTable(spark, str(tmp_path / "t"))
        schema = "k int, v string"
        table.scd2(spark.createDataFrame([(1, None), (2, "b"), (None, "x"), (None, "x")], schema), ["k"], now="2024-01-01 00:00:00")
        table.scd2(spark.createDataFrame([(1, "NULL"), (2, "b"), (3, "c"), (None, "x")], schema), ["k"], now="2024-03-01 00:00:00")
        table.scd2(spark.createDataFrame([(1, "new")], schema), ["k"], expire_missing=True, now="2024-03-02 00:00:00")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rows = [(r.k, r.v, r[fixed.IS_CURRENT], str(r[fixed.VALID_TO])[:10]) for r in table.read().collect()]
    ended = [(None, "x", False, "2024-03-02")] * 3 + [(1, "NULL", False, "2024-03-02"), (2, "b", False, "2024-03-02"), (3, "c", False, "2024-03-02")]
    assert sorted(rows, key=str) == sorted([(1, None, False, "2024-03-01"), (1, "new", True, "None"), *ended], key=str)
    assert len(plans) == 2 and not any("Join" in p for p in plans) and all(p.count("RepartitionByExpression") == 1 for p in plans)
