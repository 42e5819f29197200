"""Files of a shared store as tasks see them."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession


# Schemes that tasks can open by themselves. Others are left to Spark's readers.
REACHABLE = ("file", "hdfs", "s3", "gs", "gcs", "abfs", "abfss")


def reachable(uri: str) -> bool:
    return uri.partition(":")[0] in REACHABLE


def opened(uri: str) -> tuple[Any, str]:
    """(file system, path) of a file or folder; the path is not percent-encoded."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if "://" not in uri:
        raise ValueError(f"{uri} has no scheme, so each machine would take its own disk")
    scheme, _, rest = uri.partition("://")
    authority, _, path = rest.partition("/")
    store, _ = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return store, "/" + path if scheme in ("hdfs", "viewfs") else f"{authority}/{path}"


def prefix(uri: str) -> str:
    """What stands before a store's paths in a URI."""
    if uri.startswith("file:"):
        return "file:"
    scheme, _, rest = uri.partition("://")
    return f"{scheme}://{rest.partition('/')[0]}" if scheme in ("hdfs", "viewfs") else f"{scheme}://"


def _hadoop(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, uri: str) -> bool:
    store, path = _hadoop(spark, uri)
    return store.exists(path)


def remove(spark: SparkSession, uri: str) -> None:
    """Delete a file or a folder with all in it, if it is there."""
    store, path = _hadoop(spark, uri)
    store.delete(path, True)


def rename(spark: SparkSession, uri: str, other: str) -> None:
    store, path = _hadoop(spark, uri)
    if not store.rename(path, _hadoop(spark, other)[1]):
        raise OSError(f"{uri} could not be renamed to {other}")


def create_folder(spark: SparkSession, uri: str) -> None:
    store, path = _hadoop(spark, uri)
    store.mkdirs(path)
