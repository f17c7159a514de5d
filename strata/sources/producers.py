"""Producers: user callables that deliver a table the engine then lands."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import fixed
from strata.sources.readers import read_landing_csv

_PRODUCERS: dict[str, Callable] = {}
PRODUCER_LINEAGE = "notebook"


def producer(name: str):
    """Registers ``fn(spark, params) -> DataFrame | None`` under ``name``. None says that the callable wrote Landing
    CSV to ``params['output_path']`` itself."""

    def register(fn):
        _PRODUCERS[name] = fn
        return fn

    return register


def producer_parameters(landing: dict, table_name: str, run_id: str, output_path: str) -> dict[str, str]:
    """System parameters, overlaid by the configured ones, all as text."""
    given = landing.get("parameters") or {}
    if isinstance(given, str):
        try:
            given = json.loads(given)
        except ValueError:
            given = {}
    given = given if isinstance(given, dict) else {}
    return {
        "table_name": table_name,
        "run_id": run_id,
        "output_path": output_path,
        **{key: str(value) for key, value in given.items()},
    }


def run_producer(spark: SparkSession, landing: dict, table_name: str, run_id: str, output_path: str) -> DataFrame:
    name = landing["notebook_path"]
    if name not in _PRODUCERS:
        raise ValueError(f"no producer '{name}'; registered: {sorted(_PRODUCERS)}")
    params = producer_parameters(landing, table_name, run_id, output_path)
    made = _PRODUCERS[name](spark, params)
    if made is None:
        made = read_landing_csv(spark, output_path)
    return made.withColumn(fixed.LINEAGE_COLUMN, F.lit(PRODUCER_LINEAGE))
