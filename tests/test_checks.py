import pytest
from pyspark.sql import functions as F

from strata import fixed
from strata.operators import checks, errors

KEYS = ["k1", "k2"]


@pytest.fixture(scope="module")
def table(spark):
    rows = [(1, 1, "a"), (1, 1, "a"), (1, 1, "b"), (2, None, "c"), (2, None, "c"), (3, 1, "d")]
    return spark.createDataFrame(rows, "k1 int, k2 int, v string")


def config(validations=(), keys=(), columns=()):
    return {
        "table_name": "t",
        "ingestion_steps": {"raw_trusted": {"validations": list(validations), "primary_key": list(keys)}},
        "schema": [{"column_name": c, "data_type": "int"} for c in columns],
    }


def test_counts_with_and_without_keys(table):
    by_key = checks.count_table(table, KEYS)
    assert (by_key.total, by_key.distinct_rows, by_key.distinct_keys) == (6, 4, 2)
    assert by_key.key_nulls == {"k1": 0, "k2": 2}
    by_hash = checks.count_table(table)
    assert (by_hash.total, by_hash.distinct_rows) == (6, 4)


def test_equal_hashes_of_unequal_rows_are_not_duplicates(spark):
    """xxhash64 skips nulls, so these two rows collide."""
    df = spark.createDataFrame([(None, 1), (1, None)], "a int, b int")
    assert df.select(F.xxhash64("a", "b")).distinct().count() == 1
    counts = checks.count_table(df)
    assert (counts.total, counts.distinct_rows) == (2, 2)


def test_default_checks_and_messages(table):
    results = {r.name: r for r in checks.run_checks(table, config(keys=KEYS, columns=["k1", "k2", "x"]))}
    assert list(results) == [fixed.DUPLICATE_CHECK, fixed.COUNT_CHECK, fixed.KEY_CHECK, fixed.SCHEMA_CHECK]
    assert [r.passed for r in results.values()] == [False, True, False, False]
    assert results[fixed.KEY_CHECK].failed_checks == [
        "PRIMARY KEY FAILED: column 'k2' has 2 NULLs",
        "PRIMARY KEY FAILED: composite key [k1, k2] has 4 duplicate rows",
    ]
    assert len(results[fixed.SCHEMA_CHECK].failed_checks) == 2


def test_skipped_checks_pass(table):
    results = checks.run_checks(table.where("k1 = 3"), config())
    assert all(r.passed for r in results)


def test_strict_raises_with_all_messages(table):
    with pytest.raises(checks.ChecksFailed) as failure:
        checks.run_checks(table, config(["primary_key_validation"], ["k1"]), strict=True)
    assert len(failure.value.failed_checks) == 2
    assert "column 'k1' has 3 duplicate rows (unique: 3, total: 6)" in str(failure.value)


def test_empty_table(table):
    result = checks.run_checks(table.where("k1 > 9"), config(["row_count_validation"]))
    assert [r.passed for r in result] == [True, False]


def test_own_columns_are_never_unexpected():
    result = checks.judge_columns(["a", "row_hash", fixed.LINEAGE_COLUMN, "__is_current"], ["a"])
    assert result.passed


def test_violations_and_good_rows_make_up_the_input(table):
    bad = errors.key_violations(table, KEYS)
    assert bad.count() == 5
    assert table.exceptAll(bad).collect() == table.where("k1 = 3").collect()


def test_error_records(spark, table):
    results = checks.run_checks(table, config(keys=KEYS, columns=["k1", "k2", "v", "x"]))
    records = errors.failure_records(spark, results, table, KEYS)
    found = {}
    for r in records.collect():
        found.setdefault(r.expectation_type, []).append(r)
    assert sorted(r.full_record for r in found[fixed.DUPLICATE_CHECK]) == ['{"k1":1,"k2":1,"v":"a"}', '{"k1":2,"k2":null,"v":"c"}']
    assert len(found[fixed.KEY_CHECK]) == 3
    assert {r.failed_value for r in found[fixed.KEY_CHECK]} == {'{"k1":1,"k2":1}', '{"k1":2,"k2":null}'}
    assert [(r.column_name, r.failed_value) for r in found[fixed.SCHEMA_CHECK]] == [("x", "N/A")]


def test_no_failures_no_records(spark, table):
    results = checks.run_checks(table.where("k1 = 3"), config())
    assert errors.failure_records(spark, results) is None


def test_messages_stand_in_for_rows(spark, table):
    results = checks.run_checks(table, config(keys=KEYS))
    records = errors.failure_records(spark, results).collect()
    assert {r.column_name for r in records} == {"N/A", "k2"}


def test_one_hot_key_and_one_hot_row(spark):
    """A third of all rows share a key, another third are copies of one row; nothing is lost or capped."""
    n = 30_000
    df = spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN -1 WHEN id % 3 = 1 THEN -2 ELSE id END AS k",
        "CASE WHEN id % 3 = 1 THEN 'copy' ELSE concat('v', id) END AS v",
    )
    counts = checks.count_table(df, ["k"])
    assert (counts.total, counts.distinct_keys, counts.distinct_rows) == (n, n // 3 + 2, n - n // 3 + 1)
    assert checks.count_table(df) == checks.TableCounts(n, counts.distinct_rows)
    records = errors.key_violation_records(df, ["k"])
    assert records.count() == n // 3 + 1
    assert errors.duplicate_row_records(df).count() == 1
