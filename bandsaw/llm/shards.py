"""Binary files in a shared folder, written by tasks and named by a manifest.

A task writes under a name of its own (a random token), so that repeated,
speculative and lost tasks never touch another's file. The rows it returns name
its files; they are saved as a Parquet table, whose commit decides which files
count. Files that no row names are never read.
"""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from bandsaw.session import shared_dir


def new_folder(spark: SparkSession, kind: str) -> str:
    """A new path in the session's shared folder, with its scheme."""
    root = shared_dir(spark)
    if "://" not in root and not root.startswith("file:"):
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        root = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return f"{root.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def opened(uri: str) -> tuple[Any, str]:
    """(file system, path) of a file or folder."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def create(folder: str, ending: str) -> tuple[Any, str]:
    """(output stream, URI) of a new file in ``folder``."""
    store, path = opened(folder)
    store.create_dir(path, recursive=True)
    name = f"{uuid.uuid4().hex}{ending}"
    return store.open_output_stream(f"{path}/{name}"), f"{folder}/{name}"


def saved(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again."""
    path = new_folder(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``saved`` for tables that nothing reads after the block: they are deleted at its end."""
    paths: list[str] = []

    def keep(df: DataFrame, kind: str) -> DataFrame:
        paths.append(new_folder(spark, kind))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield keep
    finally:
        for name in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task function that gives freed memory back to the system when the task ends.

    Python workers stay for the next task, and several stand by while a plan has
    several Python steps; what their allocators hold back adds up.
    """

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            import ctypes

            import pyarrow

            pyarrow.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim:
                trim(0)

    return wrapped


def kept_in_worker(key: str, make: Callable[[], Any]) -> Any:
    """The object ``make`` gives, made once in a Python worker, which runs many tasks."""
    holder = sys.modules.setdefault("bandsaw_worker", types.ModuleType("bandsaw_worker"))
    if not hasattr(holder, key):
        setattr(holder, key, make())
    return getattr(holder, key)
