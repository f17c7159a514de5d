import pytest
from pyspark.sql import functions as F

from strata import fixed
from strata.operators import loads
from strata.operators.snapshots import SnapshotTable, location_of, open_table
from strata.operators.trusted import TrustedTable

T1, T2, T3 = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"


@pytest.fixture
def target(tmp_path):
    return str(tmp_path / "table")


@pytest.fixture
def frame(spark):
    return lambda *rows, ddl="k int, v string": spark.createDataFrame(list(rows), ddl)


@pytest.fixture(params=[False, True], ids=["trusted", "versioned"])
def versioned(request):
    return request.param


@pytest.fixture
def rows(spark, versioned):
    return lambda target: (open_table if versioned else TrustedTable)(spark, target).read()


@pytest.fixture
def load(versioned):
    """Loads of both kinds of table give the same rows."""
    return lambda *given, **named: loads.load(*given, versioned=versioned, **named)


def load_version(*given, **named):
    return loads.load(*given, versioned=True, **named)


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_load_types(spark, frame, target, load, rows):
    with pytest.raises(ValueError, match="unsupported"):
        load(spark, frame((1, "a")), target, "merge")
    with pytest.raises(ValueError, match="primary key"):
        load(spark, frame((1, "a")), target, "scd1")


def test_append_keeps_the_tables_columns(spark, frame, target, load, rows):
    load(spark, frame((1, "a")), target)
    load(spark, frame(("b", "x", 2), ddl="v string, more string, k int"), target)
    assert values(rows(target), "k", "v") == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="not in the source"):
        load(spark, frame((1,), ddl="k int"), target)
    with pytest.raises(ValueError, match="do not fit"):
        load(spark, frame(("1", "a"), ddl="k string, v string"), target)


def test_scd1_twice_is_once(spark, frame, target, load, rows):
    load(spark, frame((1, "a"), (2, "b")), target, "scd1", ["k"])
    for _ in range(2):
        load(spark, frame((2, "c"), (3, "d")), target, "scd1", ["k"])
    assert values(rows(target), "k", "v") == [(1, "a"), (2, "c"), (3, "d")]


def test_null_keys_match_nothing(spark, frame, target, load, rows):
    for _ in range(2):
        load(spark, frame((None, "a")), target, "scd1", ["k"])
    assert rows(target).count() == 2


def test_source_keys_must_be_unique(spark, frame, target, load, rows):
    with pytest.raises(ValueError, match="more than once"):
        load(spark, frame((1, "a"), (1, "b")), target, "scd2", ["k"])


def test_upsert_keeps_columns_the_source_lacks(spark, frame, target, load, rows):
    load(spark, frame((1, "a", 10), (2, "b", 20), ddl="k int, v string, n int"), target, "scd1", ["k"])
    load(spark, frame((2, "c"), (3, "d")), target, "scd1", ["k"])
    assert values(rows(target), "k", "v", "n") == [(1, "a", 10), (2, "c", 20), (3, "d", None)]


def test_merge_rewrites_only_folders_with_matching_keys(spark, frame, target):
    load_version(spark, frame((1, "a")), target)
    load_version(spark, frame((2, "b")), target)
    table = open_table(spark, target)
    before = table.commit().parts
    load_version(spark, frame((2, "c")), target, "scd1", ["k"])
    after = table.commit().parts
    assert before[0] in after and before[1] not in after
    assert values(table.read(), "k", "v") == [(1, "a"), (2, "c")]


def test_scd2_history(spark, frame, target, load, rows):
    load(spark, frame((1, "a"), (2, "b")), target, "scd2", ["k"], now=T1)
    load(spark, frame((1, "a"), (2, "c"), (3, "d")), target, "scd2", ["k"], now=T2)
    load(spark, frame((2, "e")), target, "scd2", ["k"], now=T3)
    shown = rows(target).withColumn("f", F.col(fixed.VALID_FROM).cast("string")).withColumn("t", F.col(fixed.VALID_TO).cast("string"))
    assert values(shown, "k", "v", "f", "t", fixed.IS_CURRENT) == [
        (1, "a", T1, None, True),
        (2, "b", T1, T2, False),
        (2, "c", T2, T3, False),
        (2, "e", T3, None, True),
        (3, "d", T2, None, True),
    ]


def test_scd2_back_to_an_earlier_value(spark, frame, target, load, rows):
    for value, now in (("a", T1), ("b", T2), ("a", T3)):
        load(spark, frame((1, value)), target, "scd2", ["k"], now=now)
    assert values(rows(target), "v", fixed.IS_CURRENT) == [("a", False), ("a", True), ("b", False)]


def test_expire_only_needs_another_load_for_the_new_version(spark, frame, target, load, rows):
    load(spark, frame((1, "a")), target, "scd2", ["k"], now=T1)
    load(spark, frame((1, "b")), target, "scd2", ["k"], expire_only=True, now=T2)
    assert values(rows(target), "v", fixed.IS_CURRENT) == [("a", False)]
    load(spark, frame((1, "b")), target, "scd2", ["k"], expire_only=True, now=T3)
    assert values(rows(target), "v", fixed.IS_CURRENT) == [("a", False), ("b", True)]


def test_lineage_does_not_make_a_new_version(spark, frame, target, load, rows):
    ddl = f"k int, v string, {fixed.LINEAGE_COLUMN} string"
    load(spark, frame((1, "a", "f1"), ddl=ddl), target, "scd2", ["k"], now=T1)
    load(spark, frame((1, "a", "f2"), ddl=ddl), target, "scd2", ["k"], now=T2)
    assert rows(target).count() == 1


def test_time_travel(spark, frame, target):
    load_version(spark, frame((1, "a")), target, now=T1)
    load_version(spark, frame((2, "b")), target, "overwrite", now=T2)
    table = open_table(spark, target)
    assert values(table.read(version=0), "k") == [(1,)]
    assert values(table.read(as_of="2024-01-01 12:00:00"), "k") == [(1,)]
    assert values(table.read(), "k") == [(2,)]
    with pytest.raises(ValueError, match="no version as of"):
        table.read(as_of="2023-01-01")
    with pytest.raises(ValueError, match="not found"):
        table.read(version=7)


def test_changes_count_repeated_rows(spark, frame, target):
    load_version(spark, frame((1, "a"), (1, "a"), (2, "b"), (3, "c")), target)
    load_version(spark, frame((1, "a"), (2, "x"), (4, "d"), (4, "d")), target, "overwrite")
    changes = open_table(spark, target).changes(["k"])
    assert values(changes, "k", "v", "_change_type") == [
        (1, "a", "delete"),
        (2, "b", "update_preimage"),
        (2, "x", "update_postimage"),
        (3, "c", "delete"),
        (4, "d", "insert"),
        (4, "d", "insert"),
    ]


def test_failed_load_leaves_the_table_as_it_was(spark, frame, target):
    load_version(spark, frame((1, "a")), target)
    table = open_table(spark, target)
    table.write_part(frame((9, "z")))
    assert values(table.read(), "k") == [(1,)]
    assert table.versions() == [0]


def test_upsert_all_wants_equal_columns(spark, frame, target):
    table = SnapshotTable(spark, target)
    loads.upsert_all(table, frame((1, "a")), ["k"])
    with pytest.raises(ValueError, match="columns differ"):
        loads.upsert_all(table, frame((1,), ddl="k int"), ["k"])


def test_named_targets(spark, frame, load, rows, versioned):
    with pytest.raises(ValueError, match="catalog.schema.table"):
        location_of(spark, "schema.table")
    name = f"spark_catalog.strata_named.t_{versioned}".lower()
    load(spark, frame((1, "a")), name)
    assert values(rows(name), "k", "v") == [(1, "a")]


def test_commit_that_died_is_passed_over(spark, frame, target, tmp_path):
    load_version(spark, frame((1, "a")), target, now=T1)
    (tmp_path / "table" / "commits" / "version=1").mkdir()
    load_version(spark, frame((2, "b")), target, now=T2)
    table = open_table(spark, target)
    assert table.versions() == [0, 2]
    assert values(table.read(), "k") == [(1,), (2,)]
    assert values(table.read(as_of=T1), "k") == [(1,)]
    assert values(table.changes(["k"]), "k", "_change_type") == [(2, "insert")]


def test_merges_below_another_data_folder(frame, spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "data" / "lake" / "tbl"))
    loads.append(table, frame((1, "a")))
    loads.append(table, frame((2, "b")))
    loads.upsert(table, frame((2, "c")), ["k"])
    assert sorted((r.k, r.v) for r in table.read().collect()) == [(1, "a"), (2, "c")]


def test_closed_versions_stay_where_they_are(spark, frame, target):
    for rows, now in (((1, "a"), T1), ((1, "b"), T2), ((1, "c"), T3)):
        load_version(spark, frame(rows), target, "scd2", ["k"], now=now)
    table = open_table(spark, target)
    closed = {p.folder for p in table.commit(1).parts if p.role == "closed"}
    assert closed and closed <= {p.folder for p in table.commit(2).parts}
