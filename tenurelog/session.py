"""The shared scratch folder, small files on any file system, and independent jobs side by side."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import datetime
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


_own: dict[str, str] = {}  # by application


def scratch_when_unset(spark: SparkSession, folder: str) -> None:
    """The folder for this application, which has no ``spark.checkpoint.dir``; for one machine only."""
    _own[spark.conf.get("spark.app.id")] = folder


def scratch_dir(spark: SparkSession, name: str = "run") -> str:
    """A fresh folder for intermediate tables that every executor can reach.

    It lies under the session's ``spark.checkpoint.dir``, which must be set: a
    machine-local folder would lose data with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or _own.get(spark.conf.get("spark.app.id", None))
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/tenurelog/{name}-{uuid.uuid4().hex}"


_held: dict[tuple[int, str], list] = {}  # by session and setting: holders, value before
_holding = Lock()


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session for a while; of steps side by side that hold one, the last puts it back."""
    with _holding:
        for name, value in values.items():
            held = _held.setdefault((id(spark), name), [0, spark.conf.get(name, None)])
            held[0] += 1
            spark.conf.set(name, value)
    try:
        yield
    finally:
        with _holding:
            for name in values:
                held = _held[id(spark), name]
                held[0] -= 1
                if not held[0]:
                    del _held[id(spark), name]
                    spark.conf.unset(name) if held[1] is None else spark.conf.set(name, held[1])


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system and path for a location."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, where = file_system(spark, path)
    return fs.exists(where)


def file_names(spark: SparkSession, folder: str) -> list[str]:
    fs, where = file_system(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def create_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; fails if there is one already."""
    fs, where = file_system(spark, path)
    out = fs.create(where, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def drop_path(spark: SparkSession, path: str) -> None:
    fs, where = file_system(spark, path)
    fs.delete(where, True)


def drop_unchanged(spark: SparkSession, path: str, length: int, changed: datetime) -> bool:
    """Delete a file if it still has this length and change time."""
    fs, where = file_system(spark, path)
    if not fs.exists(where):
        return False
    status = fs.getFileStatus(where)
    same = status.getLen() == length and status.getModificationTime() == round(changed.timestamp() * 1000)
    return same and fs.delete(where, False)


def side_by_side(spark: SparkSession, steps: dict[str, Callable], threads: int = 4) -> dict:
    """Run steps that do not depend on each other; results in the order of the steps."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=threads) as pool:
        running = {name: pool.submit(inherit(step)) for name, step in steps.items()}
        return {name: job.result() for name, job in running.items()}
