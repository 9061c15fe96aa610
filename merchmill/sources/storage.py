"""Paths on any Hadoop file system, and the shared scratch folder."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a table folder holds committed data, as opposed to only marker or unfinished files."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return False
    return any(not entry.getPath().getName().startswith(("_", ".")) for entry in fs.listStatus(hadoop_path))


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop_path = _file_system(spark, path)
    return [entry.getPath().getName() for entry in fs.listStatus(hadoop_path)] if fs.exists(hadoop_path) else []


def data_summary(spark: SparkSession, path: str) -> list:
    """What tells one state of a table folder from another: files, bytes, and when its parts last changed.

    Files whose name starts with ``_`` or ``.`` don't count. No file is opened; there is one call for each
    folder in the table.
    """
    fs, hadoop_path = _file_system(spark, path)
    files, size, changed = 0, 0, hashlib.md5()
    entries = fs.listStatus(hadoop_path) if fs.exists(hadoop_path) else []
    for name, entry in sorted((entry.getPath().getName(), entry) for entry in entries):
        if name.startswith(("_", ".")):
            continue
        whole = fs.getContentSummary(entry.getPath())
        files, size = files + whole.getFileCount(), size + whole.getLength()
        changed.update(f"{name}:{entry.getModificationTime()};".encode())
    return [files, size, changed.hexdigest()]


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's content, None where there is none."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return None
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, replace: bool = True) -> None:
    """Write a small file; without ``replace`` an existing one is an error."""
    fs, hadoop_path = _file_system(spark, path)
    stream = fs.create(hadoop_path, replace)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def file_bytes(spark: SparkSession, df: DataFrame) -> int:
    """Bytes of the files behind a DataFrame; 0 where there are none."""
    total = 0
    for file in df.inputFiles():
        fs, path = _file_system(spark, file)
        total += fs.getFileStatus(path).getLen()
    return total


#: codec of all stored tables: ids are hex digests, of which Spark's default codec saves nothing
COMPRESSION = "zstd"

Result = TypeVar("Result")


def side_by_side(threads: int, steps: dict[str, Callable[[], Result]]) -> dict[str, Result]:
    """Run independent writes at the same time, so that one table's last tasks do not idle the cluster."""
    with ThreadPoolExecutor(threads) as pool:
        running = {name: pool.submit(step) for name, step in steps.items()}
        return {name: step.result() for name, step in running.items()}


def fingerprint(spark: SparkSession, sources: dict[str, DataFrame]) -> str:
    """Changes when the files behind some DataFrames change, or the DataFrames themselves."""
    seen = hashlib.md5()
    for name in sorted(sources):
        seen.update(f"{name}:{sources[name].semanticHash()}".encode())
        for file in sorted(sources[name].inputFiles()):
            fs, path = _file_system(spark, file)
            status = fs.getFileStatus(path)
            seen.update(f"{file}:{status.getLen()}:{status.getModificationTime()}".encode())
    return seen.hexdigest()


#: scratch folders of this process
_made: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor can reach.

    It lies in the folder the cluster names in ``spark.checkpoint.dir``. Only where that is not set,
    as in local tests, is it a new temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="merchmill-")
    path = f"{shared.rstrip('/')}/merchmill-{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


@contextmanager
def own_scratch(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end of a job whose result doesn't read them, the scratch folders made since its start."""
    before = len(_made)
    try:
        yield
    finally:
        for path in _made[before:]:
            delete(spark, path)
        del _made[before:]


def clear_scratch(spark: SparkSession) -> None:
    """Delete the scratch folders this process made; for the end of a job, when no result is read any more."""
    while _made:
        delete(spark, _made.pop())


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to shared scratch and read it back: lineage ends there, and it is read cheaply."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
