"""Where iterative jobs may put intermediate tables."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_SCOPES: list[list[DataFrame]] = []
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by the session (``spark.checkpoint.dir``).

    Only a local-mode session without the setting gets a folder of its own.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="bandsaw-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def shuffle_partitions(spark: SparkSession) -> int:
    """How many partitions to ask for by number: the session's setting, or two per core."""
    chosen = spark.conf.get("spark.sql.shuffle.partitions", None)
    return int(chosen) if chosen else 2 * spark.sparkContext.defaultParallelism


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of ``BATCH_BYTES`` go to the Python workers, unless the session has a setting of its own.

    A chain of maps has a worker for each, four tasks run in an executor, and each worker holds two
    batches; Spark's default of 64 MB takes gigabytes then.
    """
    if ARROW_BYTES not in spark.conf.getAll:
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))


@contextmanager
def keeping() -> Iterator[list[DataFrame]]:
    """Release what operators keep in caches when the block ends."""
    held: list[DataFrame] = []
    _SCOPES.append(held)
    try:
        yield held
    finally:
        _SCOPES.remove(held)
        for df in held:
            df.unpersist()


def cached(df: DataFrame) -> DataFrame:
    """Cache an input that is read more than once, until the block of ``keeping`` ends.

    Without such a block the cache stays until ``spark.catalog.clearCache()``.
    """
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    if _SCOPES:
        _SCOPES[-1].append(df)
    return df


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the session's default file system if it has none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()
