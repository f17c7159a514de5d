"""Plans of the registered queries, and a few of them against their SQL on the smallest tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from strata.catalogue import registry
from strata.catalogue.common import table
from strata.catalogue.quality import LINE_KEYS
from strata.operators import errors
from strata.plans.reports import latest_per

SF = "/root/testdata/sf0.001"
SAMPLE = ["check_all", "pk_error_rows", "load_scd2", "run_report", "config_rules", "column_spec_config", "parse_dates"]


def plan(df):
    return df._jdf.queryExecution().toString()


def test_every_sql_has_its_query():
    queries, sql = registry.all_queries(), registry.all_sql()
    assert set(sql) == set(queries) and len(queries) >= 60


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events".split():
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = __spark_entry__.queries()[name](spark, SF)
    wanted = connection.execute(__spark_entry__.oracle_sql()[name])
    columns = [d[0] for d in wanted.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(repr, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(repr, wanted.fetchall()))


def test_newest_row_is_picked_before_the_shuffle(spark):
    df = latest_per(table(spark, SF, "events"), ["user_id"], [F.col("ts").desc()])
    assert plan(df).count("WindowGroupLimit") >= 2


def test_key_violations_need_no_window_and_no_pairs(spark):
    text = plan(errors.key_violation_records(table(spark, SF, "lineitem"), LINE_KEYS))
    physical = text[text.index("== Physical Plan ==") :]
    assert "LeftSemi" in physical and "Window" not in physical and "Cartesian" not in physical and "NestedLoop" not in physical
