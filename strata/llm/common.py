"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import functools
from collections.abc import Callable
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_dir, ship_package
from strata.sources import folders


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_TEMPORARY: ContextVar[list[str] | None] = ContextVar("temporary", default=None)


def written(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: cuts the lineage, and survives lost executors. ``codec``: of
    the Parquet files, the session's if none is named."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    if (folders_of := _TEMPORARY.get()) is not None:
        folders_of.append(path)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, make: Callable[[], DataFrame], label: str, codec: str | None = None) -> DataFrame:
    """``make()`` written, and all folders that were written on the way to it removed: only the result takes room."""
    token = _TEMPORARY.set(steps := [])
    try:
        result = make()
        out = scratch_dir(spark, label)
        result.write.parquet(out, compression=codec)
    finally:
        _TEMPORARY.reset(token)
        for path in steps:
            folders.remove(spark, path)
    return spark.read.schema(result.schema).parquet(out)


ROW = "__row"
TEXT_CODEC = "zstd"  # for copies of whole texts, which stay on disk beside the shuffles of a step


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, or one like it that no column of ``df`` has in any letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def with_row_keys(df: DataFrame, row: str = ROW) -> DataFrame:
    """``df`` and a key ``row`` of each row, written once: the key tells rows apart whatever their ids and texts."""
    return written(df.withColumn(row, F.monotonically_increasing_id()), "rows", TEXT_CODEC)


def tasks_need_package(df: DataFrame) -> None:
    """Python in tasks imports this package; executors get it once per application."""
    ship_package(df.sparkSession)


def give_back() -> None:
    """Gives memory that is not in use back to the system. Workers live on, and what their allocators keep would add up over
    the steps of an application."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU library has it
        ctypes.CDLL(None).malloc_trim(0)


def thrifty(function):
    """For functions over a task's batches: gives unused memory back when the task ends."""

    @functools.wraps(function)
    def run(batches):
        try:
            yield from function(batches)
        finally:
            give_back()

    return run


def thrifty_group(function):
    """For functions over one group's table: gives back what the group took, as a task may go on to smaller ones."""

    @functools.wraps(function)
    def run(table):
        try:
            return function(table)
        finally:
            give_back()

    return run


def byte_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary Arrow column, one after the other, and where each value starts; null is empty."""
    values = column.cast(pa.large_binary())
    if values.null_count:
        values = pc.fill_null(values, b"")
    _, offsets, data = values.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[values.offset : values.offset + len(values) + 1]
    if data is None or starts[0] == starts[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(values) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def slices(starts: np.ndarray, most: int):
    """Runs [lo, hi) of values that hold about ``most`` bytes; a longer value makes a run of its own."""
    lo, n = 0, len(starts) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + most, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def binary_column(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, type=pa.binary())


HASH_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2^64
HASH_INVERSE = pow(HASH_BASE, -1, 2**64)


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)
