"""API payloads: one JSON text with parallel arrays -> one row per position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten_parallel(
    df: DataFrame,
    payload: Column,
    group: str,
    arrays: dict[str, tuple[str, str]],
    scalars: dict[str, tuple[str, str]],
    keep: list[str] = (),
) -> DataFrame:
    """``arrays`` and ``scalars`` map an output column to (key in the payload, type); arrays live under ``group``.

    As many rows come out as the shortest array has entries. Columns named in ``keep`` are carried along.
    """
    inner = ", ".join(f"`{key}`: array<{kind}>" for key, kind in arrays.values())
    outer = ", ".join(f"`{key}`: {kind}" for key, kind in scalars.values())
    parsed = df.select(*keep, F.from_json(payload, f"struct<`{group}`: struct<{inner}>{', ' + outer if outer else ''}>").alias("p"))
    columns = [F.col(f"p.`{group}`.`{key}`") for key, _ in arrays.values()]
    sizes = [F.size(c) for c in columns]
    shortest = F.least(*sizes) if len(sizes) > 1 else sizes[0]
    zipped = F.slice(F.arrays_zip(*[c.alias(out) for c, out in zip(columns, arrays)]), F.lit(1), F.greatest(shortest, F.lit(0)))
    outside = [F.col(f"p.`{key}`").alias(out) for out, (key, _) in scalars.items()]
    return parsed.select(*keep, *outside, F.inline(zipped).alias(*arrays)).select(*keep, *arrays, *scalars)


WEATHER_ARRAYS = {
    "date": ("time", "string"),
    "temperature_max": ("temperature_2m_max", "double"),
    "temperature_min": ("temperature_2m_min", "double"),
    "precipitation_sum": ("precipitation_sum", "double"),
    "windspeed_max": ("windspeed_10m_max", "double"),
}
WEATHER_SCALARS = {"latitude": ("latitude", "double"), "longitude": ("longitude", "double")}


def weather_rows(df: DataFrame, payload: Column) -> DataFrame:
    return flatten_parallel(df, payload, "daily", WEATHER_ARRAYS, WEATHER_SCALARS)
