import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import fixed
from strata.operators import clean, schema


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_header_clash_is_an_error(texts):
    with pytest.raises(ValueError, match="userId"):
        clean.standardize_headers(texts(["userId", "user_id"]))


def test_null_rows_ignore_lineage(texts):
    df = texts(["a", "b", fixed.LINEAGE_COLUMN], (None, None, "f"), ("1", None, "f"))
    assert clean.drop_null_rows(df).count() == 1
    assert clean.drop_null_rows(df, df.columns).count() == 2


def test_headerless_columns(texts):
    df = texts(["a", "_c1", "Unnamed: 2"], ("1", None, None))
    assert clean.drop_empty_headers(df).columns == ["a"]
    with pytest.raises(ValueError, match="_c1"):
        clean.drop_empty_headers(texts(["a", "_c1"], ("1", "x")))


@pytest.mark.parametrize("value, on", [(True, True), (" TRUE ", True), ("yes", False), (False, False), (None, False)])
def test_dedup_setting(value, on):
    assert clean.dedup_enabled(value) is on


def test_dedup_setting_of_wrong_type():
    with pytest.raises(TypeError):
        clean.dedup_enabled(1)


def test_dedup_is_idempotent_and_ignores_lineage(texts):
    df = texts(["a", fixed.LINEAGE_COLUMN], ("1", "g"), ("1", "f"), (None, "f"), (None, "f"))
    once = clean.drop_duplicate_rows(df)
    assert rows(once) == [("1", "f"), (None, "f")]
    assert rows(clean.drop_duplicate_rows(once)) == rows(once)
    assert tuple(clean.duplicate_statistics(df).first()) == (4, 2, 2)


SCHEMA = [
    {"column_name": "n", "data_type": "int"},
    ["d", "date"],
    {"column_name": "gone", "data_type": "int"},
    {"column_name": "odd", "data_type": "geometry"},
]


def test_enforce_order_and_null_words(texts):
    df = texts(["odd", "extra", "d", "n"], ("o", "e", "nat", " N/A "), ("o", "e", "2024-01-02", "5 %"))
    done = schema.enforce_schema(df, SCHEMA)
    assert done.columns == ["n", "d", "odd", "extra"]
    assert [f.dataType.simpleString() for f in done.schema.fields] == ["int", "date", "string", "string"]
    assert [r.n for r in done.collect()] == [None, 5]


def test_enforce_reports_all_failures(texts):
    df = texts(["n", "d"], ("x", "y"), ("1.5", "2024-01-01"))
    with pytest.raises(ValueError, match="'n': 2 value.*'d': 1 value"):
        schema.enforce_schema(df, SCHEMA)
    bad = schema.cast_failure_rows(df, SCHEMA)
    assert [r.failed_columns for r in bad.collect()] == [["n", "d"], ["n"]]


def test_enforce_of_text_form_is_a_round_trip(spark):
    typed = spark.sql("SELECT CAST(id AS INT) AS n, DATE'2024-01-01' + CAST(id AS INT) AS d, id * 1.25D AS x FROM range(200)")
    wanted = [("n", "int"), ("d", "date"), ("x", "double")]
    text = typed.select(*[F.col(c).cast("string") for c in typed.columns])
    back = schema.enforce_schema(text, [list(p) for p in wanted])
    assert back.dtypes == typed.dtypes
    assert rows(back) == rows(typed)


def kinds(df):
    return {e["column_name"]: e["data_type"] for e in schema.infer_types(df)}


def test_inference_sees_all_rows(spark):
    df = spark.range(3000).select(F.when(F.col("id") == 2999, "x").otherwise(F.col("id").cast("string")).alias("late"))
    assert kinds(df) == {}


def test_long_whole_numbers_keep_their_digits(texts):
    df = texts(["n"], ("9007199254740993".zfill(40),), ("-12",))
    assert kinds(df) == {"n": "bigint"}
    assert {r.n for r in schema.infer_schema(df).collect()} == {9007199254740993, -12}


@pytest.mark.parametrize(
    "values, kind",
    [
        (["1", "-2", "NA"], "int"),
        (["1", "3000000000"], "bigint"),
        (["1", "1.5", "2e3", "5%"], "double"),
        (["99999999999999999999999"], "decimal(23,0)"),
        (["2024-01-01", "05-Mar-24"], "date"),
        (["2024-01-01 00:00:00", "2024-01-02"], "date"),
        (["2024-01-01 10:00:00", "2024-01-02"], "timestamp"),
        (["2024-01-01 10:00:00", "05-Mar-24"], None),
        (["2024", "2024-01-02"], "date"),
        (["10:30", "11:00"], None),
        (["-", " "], None),
        (["1", "x"], None),
    ],
)
def test_inferred_type(texts, values, kind):
    assert kinds(texts(["c"], *[(v,) for v in values])).get("c") == kind


def test_align_keeps_null_structs(spark):
    df = spark.sql("SELECT CAST(NULL AS STRUCT<a: INT>) AS s, array(named_struct('a', 1)) AS l")
    target = T.StructType.fromDDL("s struct<b:string,a:bigint>, l array<struct<a:string,b:int>>, more int")
    done = schema.align_to(df, target).first()
    assert done.s is None and done.more is None
    assert done.l[0].asDict() == {"a": "1", "b": None}


def test_schema_changes():
    old = T.StructType.fromDDL("a int, b string, row_hash string")
    new = T.StructType.fromDDL("a bigint, c string")
    changes = schema.schema_changes(old, new)
    assert changes["new_columns"] == ["c"] and changes["removed_columns"] == ["b"]
    assert changes["type_changes"] == {"a": ("int", "bigint")}
    assert schema.evolved_schema(old, new).simpleString() == "struct<a:bigint,b:string,row_hash:string,c:string>"
    with pytest.raises(ValueError, match="do not fit"):
        schema.check_types(old, T.StructType.fromDDL("a string"))
    schema.check_types(T.StructType.fromDDL("a bigint"), T.StructType.fromDDL("a int"))


def test_struct_type_from_entries():
    made = schema.struct_type([["a", "int"], {"column_name": "b", "data_type": "odd"}, ["short"]])
    assert made.simpleString() == "struct<a:int,b:string>"
