"""Session and scratch-folder helpers."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

import strata

_SHIPPED: set[str] = set()

LAYER_CODEC = "zstd"  # of Raw and trusted tables, on which row hashes take the most room
MOST_PARTS, PART_BYTES = 4096, 16 * 2**20  # of a layer that is shuffled, by its size as written


def local_session(app_name: str = "strata", cpus: int | str = 8, **conf) -> SparkSession:
    """A session for tests and for bench.py. A cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach.

    It lies under ``spark.checkpoint.dir``, the shared folder a cluster names. Only a local master, where driver and
    executors are one machine, may fall back to the temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/strata-{label}-{uuid.uuid4().hex[:12]}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix=f"strata-{label}-") + os.sep + "out"


def keep_methods_small(spark: SparkSession) -> None:
    """Lowers the size up to which a query stage becomes one Java method to what the JVM's compiler takes (8000 bytes
    of bytecode), unless the session has its own value.

    A projection that parses dozens of columns exceeds that. As one method it would be interpreted, several times
    slower; beyond the limit Spark generates many small methods instead.
    """
    name, default = "spark.sql.codegen.hugeMethodLimit", "65535"
    if spark.conf.get(name, default) == default:
        spark.conf.set(name, "8000")


def small_batches(spark: SparkSession, small: bool) -> None:
    """Lets 4 MB go to Python at a time, or Spark's 64 MB again, unless the session has its own value.

    An executor holds a batch of texts twice, in the JVM and in the worker, and again for each of its tasks. Steps that
    combine the rows of a batch before a shuffle write less with large ones.
    """
    name, default, few = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "4194304b"
    if spark.conf.get(name, default) in (default, few):
        spark.conf.set(name, few if small else default)


@contextmanager
def lean_shuffles(df: DataFrame):
    """For the queries over ``df`` that are started within, unless the session has its own values: what each has shuffled is
    removed when it ends, and it is dealt to so many parts that a part fits a task.

    Otherwise shuffles stay on the executors' disks, beside the next layers of a run, until the driver's JVM collects
    garbage, and parts that are too large are spilled there once more. Spark puts small parts together again.
    """
    spark = df.sparkSession
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_PARTS, size // PART_BYTES) if size < 2**62 else 0)
    wanted = {
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
    }
    ours = {name: value for name, value in wanted.items() if spark.conf.get(name, None) is None}
    for name, value in ours.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in ours:
            spark.conf.unset(name)


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, for operators with Python in their tasks."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.abspath(strata.__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="strata-package-"), "strata")
        context.addPyFile(shutil.make_archive(archive, "zip", root_dir=root, base_dir="strata"))
        _SHIPPED.add(context.applicationId)


def session_like(spark: SparkSession) -> SparkSession:
    """A new session with the settings made at run time in ``spark``, the time zone among them."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    return session
