"""Folder metadata: which run folders and files exist. Names only, never data."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def matching(spark: SparkSession, pattern: str, files_only: bool = False) -> list[str]:
    """Paths that match a glob, sorted; an empty list when nothing does."""
    return sorted(status.getPath().toString() for status in _statuses(spark, pattern) if status.isFile() or not files_only)


def _statuses(spark: SparkSession, pattern: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []


def source_files(spark: SparkSession, folder: str) -> list[str]:
    """Files lying in a source folder itself; hidden ones and folders do not count."""
    files = matching(spark, f"{folder.rstrip('/')}/*", files_only=True)
    return [f for f in files if not f.rsplit("/", 1)[1].startswith(("_", "."))]


def move_into(spark: SparkSession, files: list[str], folder: str) -> None:
    """Moves files into ``folder`` of the same file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(target)
    for file in files:
        if not system.rename(spark._jvm.org.apache.hadoop.fs.Path(file), target):
            raise OSError(f"{file} could not be moved to {folder}")


def rename(spark: SparkSession, file: str, path: str) -> None:
    """Moves one file to ``path``; its folder is made."""
    place, system = _system(spark, path)
    system.mkdirs(place.getParent())
    if not system.rename(spark._jvm.org.apache.hadoop.fs.Path(file), place):
        raise OSError(f"{file} could not be moved to {path}")


def latest_run(spark: SparkSession, base: str) -> str:
    """The run folder under ``base`` that was completed last; names, which may be of several kinds, settle ties."""
    markers = _statuses(spark, f"{base.rstrip('/')}/*/_SUCCESS")
    finished = [(marker.getModificationTime(), marker.getPath().getParent().toString()) for marker in markers]
    if not finished:
        raise FileNotFoundError(f"no completed run under {base}")
    return max(finished)[1]


def _system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    write_bytes(spark, path, text.encode())


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file in one go: written beside its place and moved there."""
    beside, system = _system(spark, f"{path}.{uuid.uuid4().hex[:8]}")
    out = system.create(beside, False)
    out.write(bytearray(content))
    out.close()
    place, _ = _system(spark, path)
    system.delete(place, False)
    if not system.rename(beside, place):
        raise OSError(f"{beside.toString()} could not be moved to {path}")


def write_texts(files: DataFrame, folder: str) -> None:
    """Many small new files below ``folder``: their ``name`` there and ``content``. Each is written beside its place by the task that
    has its row, and moved there. Names must differ. Where Arrow does not know the store, the driver writes them one by one."""
    try:
        fs.FileSystem.from_uri(folder)
    except (pa.ArrowException, OSError):
        for row in files.select("name", "content").toLocalIterator():
            write_text(files.sparkSession, f"{folder}/{row.name}", row.content)
        return

    def write(batches):
        system, root = fs.FileSystem.from_uri(folder)
        made = set()
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist(), strict=True):
                place = f"{root}/{name}"
                parent, beside = place.rsplit("/", 1)[0], f"{place}.{uuid.uuid4().hex[:8]}"
                if parent not in made:
                    system.create_dir(parent, recursive=True)
                    made.add(parent)
                with system.open_output_stream(beside) as out:
                    out.write(content.encode())
                system.move(beside, place)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["files"])

    files.select("name", "content").mapInArrow(write, "files long").write.format("noop").mode("overwrite").save()


def read_text(spark: SparkSession, path: str) -> str | None:
    place, system = _system(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    place, system = _system(spark, path)
    system.delete(place, True)


@contextmanager
def one_writer(spark: SparkSession, folder: str):
    """Lets one writer at a time into ``folder``; a second one is refused at once. The mark is a file beside the folder, which a
    writer that was killed leaves behind: ``remove`` it when no writer runs."""
    parent, leaf = folder.rstrip("/").rsplit("/", 1)
    mark = f"{parent}/_{leaf}.writer"
    place, system = _system(spark, mark)
    try:
        system.create(place, False).close()
    except Py4JJavaError as refused:
        if not system.exists(place):
            raise
        raise ConcurrentLoad(f"another load writes {folder}; if none runs, remove {mark}") from refused
    try:
        yield
    finally:
        system.delete(place, False)


class ConcurrentLoad(RuntimeError):
    """Two loads of one table at once."""
