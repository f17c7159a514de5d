"""Changes are told by values, and encrypted columns stay comparable."""

import pytest
from pyspark.sql import functions as F

from strata.functions import pii
from strata.operators.loads import load
from strata.operators.trusted import TrustedTable
from strata.plans import config

KEY = "0123456789abcdef"


def versions(spark, target):
    rows = TrustedTable(spark, target).read().orderBy("k", "__effective_from")
    return [tuple(r) for r in rows.select("k", "a", "b", "__is_current").collect()]


@pytest.mark.parametrize("before, after", [((None, "c"), ("NULL", "c")), (("a|b", "c"), ("a", "b|c"))])
def test_scd2_sees_changes_that_the_row_hash_does_not(spark, tmp_path, before, after):
    target = str(tmp_path / "t")
    for day, values in enumerate([before, before, after], 1):
        df = spark.createDataFrame([(1, *values), (2, "x", "y")], "k int, a string, b string")
        load(spark, df, target, "scd2", ["k"], now=f"2024-01-0{day} 00:00:00")
    assert versions(spark, target) == [(1, *before, False), (1, *after, True), (2, "x", "y", True)]


def test_encrypted_columns_are_equal_where_the_texts_are(spark, tmp_path):
    plain = spark.createDataFrame([(1, "ann", "y"), (2, "ann", "y"), (3, "bob", None), (4, "", "z")], "k int, a string, b string")
    sealed = pii.encrypt_columns(plain, ["a"], KEY)
    assert sealed.where("a is not null").select("a").distinct().count() == 2
    back = pii.decrypt_columns(sealed, ["a"], KEY).orderBy("k").collect()
    assert [r.a for r in back] == ["ann", "ann", "bob", None]
    target = str(tmp_path / "t")
    for day in (1, 2):
        load(spark, pii.encrypt_columns(plain, ["a"], KEY), target, "scd2", ["k"], now=f"2024-01-0{day} 00:00:00")
    assert TrustedTable(spark, target).read().count() == 4


def test_a_lone_personal_data_column_is_kept(spark):
    texts = ['"c"', '["c","d"]', "[]", '""', "null"]
    body = '{"ingestion_steps":{"landing":{"source_path":"p","file_format":"csv","pii_columns":%s}}}'
    df = spark.createDataFrame([("j", f"t{i}", body % t) for i, t in enumerate(texts)], "job_name string, table_name string, config string")
    rows = config.control_rows(df, "2024-01-01 00:00:00").select("table_name", "ingestion_steps.landing.pii_columns")
    assert [r.pii_columns for r in rows.orderBy("table_name").collect()] == [["c"], ["c", "d"], [], [], []]
