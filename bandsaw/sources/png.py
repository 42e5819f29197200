"""Image files as a Spark sink, committed in two phases.

Rows are bands (image_id, rel_dir, name, width, height, n_channels, band, content).
Each file is streamed by one task, band after band, so a task never holds an image. Its format is
that of its name's extension: PNG, BMP or JPEG, else PNG.
Tasks write drafts into a folder of their own beside the tree, and a table, which Spark
commits as a whole, says which drafts count: those of lost, repeated and speculative tasks do not.
Only then drafts take their names, and files of the tree's previous run that this one has not written
go. Until then the tree is as it was, whatever fails. Two images of one name are an error.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandsaw.operators.bands import rows_of
from bandsaw.session import bounded_batches, qualified, shuffle_partitions
from bandsaw.sources.formats import encoder_of
from bandsaw.sources.store import create_folder, exists, opened, remove, rename

ROWS = 10_000  # files whose names a task holds

MANIFEST = "rel string, draft string"


def _drafting(folder: str):
    """Task function: streams files to drafts below ``folder`` and gives a row for each, when it is whole."""

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str]]:
        store, base = opened(folder)
        sink = encoder = current = draft = None

        def closed() -> tuple[str, str]:
            sink.write(encoder.end())
            sink.close()
            return current[0], draft

        try:
            for row in rows_of(batches):
                rel = f"{row['rel_dir']}/{row['name']}" if row["rel_dir"] else row["name"]
                if (rel, row["image_id"]) != current:
                    if current:
                        if current[0] == rel:
                            raise ValueError(f"two images are to be written to {rel}")
                        yield closed()
                    current, draft = (rel, row["image_id"]), uuid.uuid4().hex
                    encoder = encoder_of(row["name"])(row["width"], row["height"], row["n_channels"])
                    store.create_dir(base, recursive=True)
                    sink = store.open_output_stream(f"{base}/{draft}")
                    sink.write(encoder.head)
                sink.write(encoder.rows(row["content"]))
            if current:
                yield closed()
        finally:
            if sink and not sink.closed:
                sink.close()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[str, str]] = []
        for one in files(batches):
            held.append(one)
            if len(held) >= ROWS:
                yield _rows(held)
                held = []
        if held:
            yield _rows(held)

    return run


def _rows(held: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([h[i] for h in held], pa.string()) for i in (0, 1)], ["rel", "draft"])


def _publishing(drafts: str, root: str):
    """Task function: drafts take their names; what an earlier attempt has moved stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        (store, source), (_, base) = opened(drafts), opened(root)
        for batch in batches:
            for rel, draft in zip(batch.column("rel").to_pylist(), batch.column("draft").to_pylist(), strict=True):
                target = f"{base}/{rel}"
                if store.get_file_info(f"{source}/{draft}").type == fs.FileType.NotFound:
                    if store.get_file_info(target).type == fs.FileType.NotFound:
                        raise FileNotFoundError(f"neither {rel} nor its draft is there")
                    continue
                store.create_dir(target.rpartition("/")[0], recursive=True)
                if store.get_file_info(target).type != fs.FileType.NotFound:
                    store.delete_file(target)  # some stores do not rename onto a file
                store.move(f"{source}/{draft}", target)
            yield batch

    return run


def _removing(root: str):
    """Task function: deletes files of the tree that are still there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = opened(root)
        for batch in batches:
            for rel in batch.column("rel").to_pylist():
                if store.get_file_info(f"{base}/{rel}").type != fs.FileType.NotFound:
                    store.delete_file(f"{base}/{rel}")
            yield batch

    return run


def _done(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def write_png_tree(rows: DataFrame, root: str) -> None:
    """Write band rows as image files (PNG unless the name says BMP or JPEG) below ``root``, in place of what an earlier call has written there.

    Other files of the tree stay, unless a new one has their name. A file's bands stay together: they are
    sorted by directory, name, image and band. ``{root}.manifest`` lists the files of the last run.
    A ``root`` without a scheme lies in the session's default file system.
    """
    spark = rows.sparkSession
    root = qualified(spark, root).rstrip("/")
    token = uuid.uuid4().hex
    drafts, manifest, known = f"{root}.drafts-{token}", f"{root}.manifest-{token}", f"{root}.manifest"
    columns = ["image_id", "rel_dir", "name", "band", "width", "height", "n_channels", "content"]
    # by file, not by directory: one directory may hold most files
    placed = rows.select(*columns).repartition(F.col("rel_dir"), F.col("name"))
    ordered = placed.sortWithinPartitions("rel_dir", "name", "image_id", "band")
    create_folder(spark, root)
    bounded_batches(spark)
    try:
        ordered.mapInArrow(_drafting(drafts), MANIFEST).write.parquet(manifest)
        made = spark.read.schema(MANIFEST).parquet(manifest)
        _done(made.repartition(shuffle_partitions(spark), "rel").mapInArrow(_publishing(drafts, root), MANIFEST))
        if exists(spark, known):
            gone = spark.read.schema(MANIFEST).parquet(known).join(made, "rel", "left_anti")
            _done(gone.mapInArrow(_removing(root), MANIFEST))
            remove(spark, known)
        rename(spark, manifest, known)
    finally:
        remove(spark, drafts)
        remove(spark, manifest)
