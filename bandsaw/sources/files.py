"""File listings, binary content and manifests."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandsaw.functions import paths
from bandsaw.session import cut_lineage, qualified, shuffle_partitions
from bandsaw.sources.store import opened, prefix, reachable

MANIFEST = "old_name string, new_name string"
LISTING = "path string, is_folder boolean, length bigint, modificationTime timestamp"
# Fixed value: the largest content of a row.
MOST_BYTES = 2**31 - 16


def extension_glob(named_set: str, but: tuple[str, ...] = ()) -> str:
    """Glob for the source, so that other files are not even listed as input."""
    words = [w for w in paths.EXTENSIONS[named_set] if w not in but]
    if named_set not in paths.CASE_SENSITIVE:
        words = ["".join(f"[{c}{c.upper()}]" for c in w) for w in words]
    return "*.{" + ",".join(words) + "}"


def _with_parts(files: DataFrame, root: str) -> DataFrame:
    path = F.col("path")
    relative = paths.relative_path(path, root)
    return files.withColumns(
        {
            "rel_path": relative,
            "category": paths.category(relative),
            "stem": paths.stem(path),
            "ext": paths.extension(path),
        }
    )


def read_files(spark: SparkSession, root: str, recursive: bool = True, named_set: str | None = None) -> DataFrame:
    """Path, time, length and content of every file, read by the executors; content that does not fit a row is null."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if named_set:
        reader = reader.option("pathGlobFilter", extension_glob(named_set))
    files = reader.load(root)
    held, large = files.filter(F.col("length") <= MOST_BYTES), files.filter(F.col("length") > MOST_BYTES)
    if not large.isEmpty():  # told by the listing; no content is read
        held = held.unionByName(large.withColumn("content", F.lit(None).cast("binary")))
    return _with_parts(held, root)


def list_files(spark: SparkSession, root: str, recursive: bool = True, named_set: str | None = None) -> DataFrame:
    """Path, time and length of every file, also of empty and hidden ones, which Spark's file sources leave out.

    Tasks list folders, level by level; a folder is listed by one task. A store
    that only Spark can open is listed by Spark, without those files.
    """
    if not reachable(qualified(spark, root)):
        return read_files(spark, root, recursive, named_set).drop("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                store, path = opened(folder)
                found = store.get_file_info(fs.FileSelector(path, recursive=False))
                for first in range(0, len(found), 10_000):
                    some = found[first : first + 10_000]
                    columns = [
                        pa.array([prefix(folder) + f.path for f in some], pa.string()),
                        pa.array([f.type == fs.FileType.Directory for f in some], pa.bool_()),
                        pa.array([f.size for f in some], pa.int64()),
                        pa.array([f.mtime for f in some], pa.timestamp("us", "UTC")),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["path", "is_folder", "length", "modificationTime"])

    level = spark.createDataFrame([(qualified(spark, root),)], "folder string")
    files = None
    while True:
        rows = cut_lineage(level.repartition(shuffle_partitions(spark), "folder").mapInArrow(run, LISTING))
        here = rows.filter("NOT is_folder").drop("is_folder")
        files = here if files is None else files.unionByName(here)
        level = rows.filter("is_folder").select(F.col("path").alias("folder"))
        if not recursive or level.isEmpty():
            break
    if named_set:
        files = files.filter(paths.has_extension(F.col("path"), named_set))
    return _with_parts(files.select("path", "modificationTime", "length"), root)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A rename manifest: CSV with the header ``Old Name,New Name``."""
    return spark.read.schema(MANIFEST).option("header", True).option("enforceSchema", True).csv(path)


def append_manifest(manifest: DataFrame, path: str) -> None:
    """Append to a manifest directory; every part file has its own header."""
    named = manifest.select(F.col("old_name").alias("Old Name"), F.col("new_name").alias("New Name"))
    named.write.mode("append").option("header", True).csv(path)
