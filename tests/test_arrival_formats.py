"""Streams by file format, and inferred types that keep every digit."""

import pytest

from strata.catalogue.arrivals import COLUMNS, events_config
from strata.operators import schema
from strata.operators.errors import MALFORMED
from strata.operators.trusted import TrustedTable
from strata.plans import config as cfg
from strata.streaming.arrivals import arriving_rows, ingest_arrivals


def test_formats_without_a_stream(spark, tmp_path):
    config = events_config(str(tmp_path))
    for kind in ("database", "delta"):
        config["ingestion_steps"]["landing"]["file_format"] = kind
        with pytest.raises(ValueError, match="no stream"):
            arriving_rows(spark, config)
    config["ingestion_steps"]["landing"]["file_format"] = "json"
    with pytest.raises(ValueError, match="needs columns or a schema"):
        arriving_rows(spark, config | {"schema": None})


def test_parquet_streams_have_the_configs_types(spark, tmp_path):
    (tmp_path / "EVENTS").mkdir()
    config = events_config(str(tmp_path))
    config["ingestion_steps"]["landing"]["file_format"] = "parquet"
    kinds = dict(arriving_rows(spark, config).dtypes)
    assert kinds == {"event_id": "bigint", "at": "timestamp", "event_type": "string", "value": "double", "source_file_name": "string"}


def test_malformed_rows_of_a_stream_are_recorded(spark, tmp_path):
    staging, base = tmp_path / "staging" / "EVENTS", str(tmp_path / "lake")
    staging.mkdir(parents=True)
    config = events_config(str(tmp_path / "staging"))
    (staging / "a.csv").write_text("eventId,at,Event Type,value\n1,2024-01-01 10:00:00,x,1.5,surplus\n2,2024-01-01 10:00:00,y\n")
    ingest_arrivals(spark, config, base, f"{base}/cp", COLUMNS, available_now=True).awaitTermination()
    where = cfg.locations(config, "", base)
    assert sorted(r.event_id for r in TrustedTable(spark, where["raw_trusted"]).read().collect()) == [1, 2]
    records = spark.read.parquet(where["errors"])
    assert sorted(r.failed_value for r in records.where(f"expectation_type = '{MALFORMED}'").collect()) == ["1,2024-01-01 10:00:00,x,1.5,surplus", "2,2024-01-01 10:00:00,y"]


@pytest.mark.parametrize(
    ("values", "kind"),
    [
        (["1", "2147483647"], "int"),
        (["1", "2147483648", "9223372036854775807"], "bigint"),
        (["123456789012345678901234567890", "1"], "decimal(30,0)"),
        (["9223372036854775807", "0.5"], "decimal(20,1)"),
        (["1.5", "2"], "double"),
        (["123456789012.345", "0.000000000000001"], "double"),
        (["1234567890123.456", "-.5", "+7 %"], "decimal(16,3)"),
        (["0.1234567890123456789", "12"], "decimal(21,19)"),
        (["1" * 39], None),
        (["12345678901234567.5", "1e3"], None),
        (["12345678901234567.5", "1.5d"], None),
        (["1e3", "2.5E-7"], "double"),
        (["9007199254740993", "0.5"], "decimal(17,1)"),
        (["00000000000000000001.50", "NA", None], "double"),
        (["1.50", "x"], None),
        (["n/a", "-"], None),
        (["2024-01-05", "01/06/2024"], "date"),
    ],
)
def test_inferred_types_keep_every_digit(texts, values, kind):
    df = texts(["c"], *[(v,) for v in values])
    found = {e["column_name"]: e["data_type"] for e in schema.infer_types(df)}
    assert found.get("c") == kind
    if kind and kind.startswith("decimal"):
        back = [r.c for r in schema.infer_schema(df).collect()]
        from decimal import Decimal

        assert sorted(back) == sorted(Decimal(v.replace(" %", "")) for v in values)
