import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata import fixed
from strata.functions import naming, pii
from strata.functions.hashing import hashed_columns, with_row_hash
from strata.functions.parsing import spark_type, typed
from strata.functions.text import json_text, slug, snake_case


@pytest.mark.parametrize(
    "header, name",
    [
        ("userId", "user_id"),
        ("HTMLParser2", "html_parser_2"),
        ("Click %", "click"),
        ("Sales (Units)", "sales_units"),
        ("revenueUSD2024", "revenue_usd_2024"),
        ("__already_snake__", "already_snake"),
        ("Ad Group ID", "ad_group_id"),
    ],
)
def test_snake_case(header, name):
    assert snake_case(header) == name
    assert snake_case(name) == name


def one(df):
    return [row[0] for row in df.collect()]


def test_dates(texts):
    cases = {
        "2024-03-05": dt.date(2024, 3, 5),
        "05/06/2024": dt.date(2024, 5, 6),
        "13/05/2024": dt.date(2024, 5, 13),
        "05-06-2024": dt.date(2024, 5, 6),
        "13-05-2024": dt.date(2024, 5, 13),
        "2024/03/05": dt.date(2024, 3, 5),
        "05-Mar-24": dt.date(2024, 3, 5),
        "05-MAR-2024": dt.date(2024, 3, 5),
        "05/06/2024 23:59:59": dt.date(2024, 5, 6),
        "05-Mar-24 23:59:59": dt.date(2024, 3, 5),
        "2024-03-05T10:00:00": dt.date(2024, 3, 5),
        "02/30/2024": None,
        "1/5/2024": None,
        "05/06-2024": None,
        "05-Foo-2024": None,
        "05/06/2024 1:2:3": None,
        "10:11:12": None,
        "T10:11": None,
        "n/a": None,
        "": None,
    }
    df = texts(["c"], *[(c,) for c in cases]).select(typed("c", "date"))
    assert one(df) == list(cases.values())


def test_own_patterns_settle_ambiguity(texts):
    df = texts(["c"], ("05/06/2024",)).select(typed("c", "date", ["dd/MM/yyyy"]))
    assert one(df) == [dt.date(2024, 6, 5)]


def test_timestamps(texts):
    cases = {
        "2024-03-05 10:11:12": dt.datetime(2024, 3, 5, 10, 11, 12),
        "05/06/2024 10:11:12": dt.datetime(2024, 5, 6, 10, 11, 12),
        "2024-03-05": dt.datetime(2024, 3, 5),
        "05/06/2024": None,
        "2024/03/05": None,
        "05-Mar-2024 10:11:12": None,
        "10:11:12": None,
    }
    df = texts(["c"], *[(c,) for c in cases]).select(typed("c", "timestamp"))
    assert one(df) == list(cases.values())


digits = st.text("0123456789", min_size=2, max_size=2)
date_like = st.one_of(
    st.builds(lambda a, s, b, y: f"{a}{s}{b}{s}20{y}", digits, st.sampled_from("/-"), digits, digits),
    st.builds(lambda y, s, a, b: f"20{y}{s}{a}{s}{b}", digits, st.sampled_from("/-"), digits, digits),
    st.builds(lambda a, m, y: f"{a}-{m}-{y}", digits, st.sampled_from(["Jan", "feb", "SEP", "Dez"]), digits),
    st.builds(lambda a, m, y: f"{a}-{m}-20{y}", digits, st.sampled_from(["Jan", "feb", "SEP", "Dez"]), digits),
)
clock = st.one_of(st.just(""), st.builds(lambda h, m, s: f" {h}:{m}:{s}", digits, digits, digits))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.builds(lambda d, c: d + c, date_like, clock), min_size=100, max_size=100))
def test_dates_equal_the_ordered_pattern_list(texts, values):
    """One cast after rearranging gives what trying all patterns in turn gives."""
    c = F.col("c")
    tries = [F.try_to_date(c, p) for p in fixed.DATE_PATTERNS]
    tries.append(c.try_cast("timestamp").try_cast("date"))
    tries += [F.try_to_timestamp(c, F.lit(f"{p} HH:mm:ss")).try_cast("date") for p in fixed.DATE_PATTERNS]
    stamps = [c.try_cast("timestamp")] + [F.try_to_timestamp(c, F.lit(p)) for p in fixed.TIMESTAMP_PATTERNS]
    df = texts(["c"], *[(v,) for v in values])
    both = df.select("c", typed("c", "date").alias("d"), F.coalesce(*tries).alias("dd"), typed("c", "timestamp").alias("t"), F.coalesce(*stamps).alias("tt"))
    assert both.where("NOT (d <=> dd) OR NOT (t <=> tt)").collect() == []


def test_numbers(texts):
    df = texts(["c"], ("12 %",), ("12%",), ("1.5",), ("12%%",), ("12s%",), ("NaN",), (" 7 ",))
    assert one(df.select(typed("c", "double"))) == [12.0, 12.0, 1.5, None, None, None, 7.0]
    assert one(df.select(typed("c", "int")))[:3] == [12, 12, None]


def test_types():
    assert spark_type(" Decimal ") == "decimal(38,18)"
    assert spark_type("decimal(10, 2)") == "decimal(10,2)"
    assert spark_type("boolean") is None


def test_row_hash(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, "NULL", "x")], "b int, a string, Updated_At string")
    assert hashed_columns(df.columns) == ["a", "b"]
    hashes = one(with_row_hash(df).select("row_hash"))
    assert hashes[0] == hashes[1] and len(hashes[0]) == 64
    only_audit = with_row_hash(df.select("Updated_At"))
    assert one(only_audit.select("row_hash")) == [None, None]


def test_json_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert one(df.select(json_text("a", "b"))) == ['{"a":1,"b":null}']


def test_names(spark):
    df = spark.createDataFrame([("South East Asia",), ("North America",), ("APAC",)], "r string")
    assert one(df.select(naming.region_code(F.col("r")))) == ["sea", "na", "apac"]
    assert one(df.select(slug(F.lit("  Big -- Shop! ")))) == ["big_shop"] * 3


def test_freshness_bounds(spark):
    df = spark.createDataFrame([(26.0, 26), (26.01, 26), (1.0, None)], "age double, lim int")
    at = F.lit("2024-01-01").cast("timestamp")
    assert one(df.select(naming.freshness(at, F.col("age"), F.col("lim")))) == ["FRESH", "STALE", "UNKNOWN"]


def test_pii_needs_a_key(spark):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(ValueError, match="needs a key"):
        pii.encrypt_columns(df, ["a"], None)
    with pytest.raises(ValueError, match="not found"):
        pii.encrypt_columns(df, ["b"], "0123456789abcdef")
    assert one(df.select(pii.decrypted(F.lit("no cipher text"), "0123456789abcdef"))) == [None]
