import io
import zipfile
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from strata import fixed
from strata.catalogue.workbook_maker import workbook_bytes
from strata.session import scratch_dir
from strata.sources import folders, readers, workbook
from strata.sources.landing_files import read_source_files, reader_options
from strata.sources.payload import weather_rows
from strata.sources.producers import producer, producer_parameters, run_producer


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_unknown_format_lists_the_known():
    with pytest.raises(ValueError, match="excel.*json"):
        readers.reader_for("avro")


def test_csv_defaults(spark, tmp_path):
    write(tmp_path, "X.CSV", "a,b\n# note\n NA , x \n1,\n")
    df = readers.read_csv(spark, str(tmp_path))
    assert df.dtypes == [("a", "string"), ("b", "string")]
    assert rows(df, "a", "b") == [("1", None), (None, "x")]


def test_jdbc_options():
    with pytest.raises(ValueError, match="'url' and 'dbtable'"):
        readers.jdbc_options(url="jdbc:x")
    with pytest.raises(ValueError, match="lowerBound"):
        readers.jdbc_options("jdbc:x", "t", partitionColumn="id")
    options = readers.jdbc_options("jdbc:x", "t", driver="d", numPartitions=None)
    assert options == {"url": "jdbc:x", "dbtable": "t", "fetchsize": "10000", "driver": "d"}


def test_reader_options():
    landing = {
        "source_path": "/in",
        "file_format": "csv",
        "format_options": '{"delimiter": ";"}',
        "pii_columns": [],
        "extra": '{"a": 1}',
        "plain": "text",
        "nothing": None,
    }
    assert reader_options(landing) == {"extra": {"a": 1}, "plain": "text", "sep": ";"}
    assert reader_options({"file_format": "XLSX", "excel_options": {"header_row": 1}}) == {"excel_options": {"header_row": 1}}
    assert reader_options({"file_format": "json", "format_options": "not json"}) == {}


def test_header_drift(spark, tmp_path):
    write(tmp_path, "a.csv", "x,y\n1,2\n")
    write(tmp_path, "b.csv", "y,x\n4,3\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_source_files(spark, str(tmp_path), "csv").collect()
    df = read_source_files(spark, str(tmp_path), "csv", drift="by_name")
    assert rows(df, "x", "y", fixed.LINEAGE_COLUMN) == [("1", "2", "a.csv"), ("3", "4", "b.csv")]
    write(tmp_path, "c.csv", "x,y,z\n5,6,7\n")
    with pytest.raises(ValueError, match="differ"):
        read_source_files(spark, str(tmp_path), "csv", drift="by_name")
    df = read_source_files(spark, str(tmp_path), "csv", drift="allow")
    assert rows(df, "x", "z") == [("1", None), ("3", None), ("5", "7")]


def test_no_input_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no input files"):
        read_source_files(spark, str(tmp_path), "csv")
    with pytest.raises(FileNotFoundError, match="no completed run"):
        folders.latest_run(spark, str(tmp_path))


def test_sheet_choice():
    assert workbook.sheet_choice({"sheet_name": " 2 "}) == 2
    assert workbook.sheet_choice({"sheet_name": "Data", "sheet_index": 4}) == "Data"
    assert workbook.sheet_choice({"sheet_name": "", "sheet_index": "1"}) == 1
    assert workbook.sheet_choice({}) == 0
    with pytest.raises(ValueError, match="header_row"):
        workbook.row_window({})
    assert workbook.wanted_columns("A:C, AA") == {0, 1, 2, 26}
    assert [workbook.column_letters(n) for n in (1, 26, 27, 703)] == ["A", "Z", "AA", "AAA"]


@pytest.fixture
def book(spark):
    return lambda *contents: spark.createDataFrame([(f"b{i}.xlsx", c) for i, c in enumerate(contents)], "path string, content binary")


def test_workbook_cells_and_windows(book):
    sheet = [["title"], ["id", "", "at", "ok", "empty", "id"], ["gap"], [1, "u", (45292, 1), True, "", 2.5], [None, " "], [3.0, None, None, False, "NA"], ["end"]]
    files = book(workbook_bytes({"First": [["x"]], "Data": sheet}))
    options = {"sheet_name": "Data", "header_row": 2, "data_start_row": 4, "data_end_row": 6}
    df = workbook.read_workbooks(files, options)
    assert df.columns == ["id", "col_1", "at", "ok", "id.1", "__path"]
    assert rows(df, *df.columns[:4], "`id.1`") == [("1", "u", "2024-01-01 00:00:00", "True", "2.5"), ("3", None, None, "False", None)]
    only = workbook.read_workbooks(files, {**options, "usecols": "A,C"})
    assert only.columns == ["id", "at", "__path"]
    with pytest.raises(Exception, match="sheet 'Other' not found"):
        workbook.read_workbooks(files, {**options, "sheet_name": "Other"}).collect()


def test_shared_strings(book):
    plain = zipfile.ZipFile(io.BytesIO(workbook_bytes({"S": [["a"], ["x"]]})))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name in plain.namelist():
            text = plain.read(name).decode()
            if name.endswith("sheet1.xml"):
                text = text.replace('t="inlineStr"><is><t xml:space="preserve">x</t></is>', 't="s"><v>1</v>')
            z.writestr(name, text)
        z.writestr("xl/sharedStrings.xml", "<sst><si><t>no</t></si><si><r><t>two </t></r><r><t>runs</t></r></si></sst>")
    df = workbook.read_workbooks(book(out.getvalue()), {"header_row": 1})
    assert rows(df, "a") == [("two runs",)]


def test_workbook_drift(book):
    files = book(workbook_bytes({"S": [["a", "b"], [1, 2]]}), workbook_bytes({"S": [["b", "a", "c"], [4, 3, 5]]}))
    with pytest.raises(ValueError, match="differ"):
        workbook.read_workbooks(files, {"header_row": 1})
    df = workbook.read_workbooks(files, {"header_row": 1, "drift": "allow"})
    assert rows(df, "a", "b", "c") == [("1", "2", None), ("3", "4", "5")]


def test_workbook_files_with_lineage(spark, tmp_path):
    (tmp_path / "in.xlsx").write_bytes(workbook_bytes({"S": [["a"], ["x"]]}))
    df = read_source_files(spark, str(tmp_path), "xlsx", {"excel_options": {"header_row": 1}})
    assert rows(df, "a", fixed.LINEAGE_COLUMN) == [("x", "in.xlsx")]


def test_payload_stops_at_the_shortest_array(texts):
    text = (
        '{"latitude": 1.0, "longitude": 2, "daily": {"time": ["d1", "d2", "d3"], "temperature_2m_max": [1, null], '
        '"temperature_2m_min": [1, 2], "precipitation_sum": [0, 0], "windspeed_10m_max": [3.5, 4]}}'
    )
    df = weather_rows(texts(["p"], (text,), ("broken",)), F.col("p"))
    assert rows(df, "date", "temperature_max", "longitude") == [("d1", 1.0, 2.0), ("d2", None, 2.0)]


def test_producers(spark, tmp_path):
    @producer("writes itself")
    def writes_itself(session, params):
        readers.write_csv(session.createDataFrame([(params["n"],)], "n string"), params["output_path"])

    landing = {"notebook_path": "writes itself", "parameters": {"n": 5, "run_id": "own"}}
    assert producer_parameters(landing, "t", "r", "/o") == {"table_name": "t", "run_id": "own", "output_path": "/o", "n": "5"}
    assert producer_parameters({"parameters": "{bad"}, "t", "r", "/o")["run_id"] == "r"
    df = run_producer(spark, landing, "t", "r", str(tmp_path / "out"))
    assert rows(df, "n", fixed.LINEAGE_COLUMN) == [("5", "notebook")]
    with pytest.raises(ValueError, match="no producer"):
        run_producer(spark, {"notebook_path": "unknown"}, "t", "r", "/o")


def test_scratch_folder():
    def session(shared, master):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: shared), sparkContext=SimpleNamespace(master=master))

    assert scratch_dir(session("hdfs:///cp/", "yarn"), "x").startswith("hdfs:///cp/strata-x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(session(None, "yarn"), "x")
    assert scratch_dir(session(None, "local[2]"), "x").endswith("out")
