"""Batch jobs over directory trees.

Every job writes ``target/artifacts`` (a table, partitioned by category and kind) and
``target/status`` (a row per file), and with ``as_files`` PNG files in ``target/files``.
The status is read off what was written. Caches are released when a job ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandsaw.functions import paths
from bandsaw.operators import naming
from bandsaw.operators.bands import map_block
from bandsaw.operators.evaluate import confusion_of_masks, score
from bandsaw.operators.kernels import gray
from bandsaw.operators.resize import resize
from bandsaw.plans.segment import ERROR_KIND, KINDS, errors_in, segment_bands
from bandsaw.session import cached, cut_lineage, keeping
from bandsaw.sources.artifacts import file_rows, ingest_images, read_table, status_of, write_artifacts, written_images
from bandsaw.sources.files import list_files
from bandsaw.sources.images import mask_owner, read_bands
from bandsaw.sources.png import write_png_tree

CARRY = ("category", "rel_path")


def _identified(files: DataFrame) -> DataFrame:
    return files.withColumn("image_id", F.xxhash64("rel_path"))


def _finish(
    spark: SparkSession, artifacts: DataFrame, files: DataFrame, target: str, as_files: bool, kinds: int, errors: DataFrame | None = None
) -> DataFrame:
    """Write the table, the files and the status; gives the table as written, without its rows of errors."""
    write_artifacts(artifacts, f"{target}/artifacts")
    written = read_table(spark, f"{target}/artifacts", artifacts.schema)
    told = errors_in(written)
    errors = told if errors is None else errors.unionByName(told)
    written = written.filter(F.col("kind") != ERROR_KIND)
    if as_files:
        rows = written if "name" in written.columns else file_rows(written)
        write_png_tree(rows.withColumn("rel_dir", F.col("category")), f"{target}/files")
    status_of(files, written_images(written, kinds), errors).write.mode("overwrite").parquet(f"{target}/status")
    return written


def segment_dataset(
    spark: SparkSession, source: str, target: str, as_files: bool = False, named_set: str | None = "images", band_rows: int | None = None, **options
) -> DataFrame:
    """Segment a tree of images; gives the status table.

    ``target/originals`` holds every input file as it is, readable or not. Files that
    cannot be decoded, and images on which a step fails, get a status row that names the stage
    and the reason, and never stop the job; the latter have rows of the kind ``error`` in the table.
    """
    named_set = named_set or "images"
    with keeping():
        ingest_images(spark, source, f"{target}/originals", named_set)
        files = list_files(spark, source, named_set=named_set)
        cut = [read_bands(spark, source, _identified(files), named_set, rows=band_rows, carry=CARRY, several=several) for several in (False, True)]
        result = segment_bands(*cut, **options)
        _finish(spark, result.artifacts(), files, target, as_files, len(KINDS), result.errors)
    return spark.read.parquet(f"{target}/status")


def evaluate_dataset(
    spark: SparkSession, source: str, named_set: str = "images", target: str | None = None, band_rows: int | None = None, **options
) -> DataFrame:
    """Segment a labelled tree and score it against its masks: one row per image with a mask.

    With a ``target`` the scores are written to ``target/scores`` and a row for every image
    and mask file to ``target/status``: scored, without a mask or an image, or why it could not be read.
    """
    files = list_files(spark, source, named_set=named_set)
    is_mask = paths.is_mask(F.col("path"))
    image_files = _identified(files.filter(~is_mask))
    mask_files = files.filter(is_mask).withColumn("image_id", F.xxhash64(mask_owner("rel_path")))
    with keeping():
        cut = [read_bands(spark, source, image_files, named_set, only="images", rows=band_rows, several=several) for several in (False, True)]
        result = segment_bands(*cut, **options)
        truth = cached(read_bands(spark, source, mask_files, named_set, only="masks", rows=band_rows, as_gray=True))
        whole = truth.filter("band >= 0").drop("message")
        # a row per image, computed while the caches are there
        scored = cut_lineage(score(confusion_of_masks(result.masks, whole, band_rows, result.done)))
        unread = truth.filter("band < 0").select("image_id", "message")
        errors, unread = cut_lineage(result.errors.unionByName(result.unmasked)), cut_lineage(unread)
    scored = scored.join(image_files.select("image_id", "category"), "image_id")
    if target:
        scored.write.mode("overwrite").parquet(f"{target}/scores")
        _evaluation_status(scored, image_files, mask_files, errors, unread).write.mode("overwrite").parquet(f"{target}/status")
    return scored


def _evaluation_status(scored: DataFrame, image_files: DataFrame, mask_files: DataFrame, errors: DataFrame, unread: DataFrame) -> DataFrame:
    done = scored.select("image_id", F.lit(True).alias("scored"))
    has_mask, has_image = (f.select("image_id").distinct().withColumn("paired", F.lit(True)) for f in (mask_files, image_files))
    told = {"image": errors, "mask": unread.select("image_id", F.lit("decode").alias("stage"), "message")}
    parts = []
    for what, files, other in (("image", image_files, has_mask), ("mask", mask_files, has_image)):
        rows = files.join(done, "image_id", "left").join(other, "image_id", "left").join(told[what].dropDuplicates(["image_id"]), "image_id", "left")
        reason = F.coalesce(
            F.when(F.col("scored"), F.lit("scored")), F.col("message"),
            F.when(F.col("paired").isNull(), F.lit("no mask" if what == "image" else "no image")),
            F.lit("not scored"),
        )
        stage = F.coalesce(F.when(F.col("scored"), F.lit("score")), F.col("stage"), F.lit("score"))
        parts.append(rows.select("path", F.coalesce("scored", F.lit(False)).alias("ok"), stage.alias("stage"), reason.alias("message")))
    return parts[0].unionByName(parts[1])


def grayscale_dataset(
    spark: SparkSession, source: str, target: str, named_set: str | None = "images", as_files: bool = False
) -> DataFrame:
    """Gray versions of the images directly in ``source``, named ``processed_{name}``; gives the table."""
    named_set = named_set or "images"
    with keeping():
        files = list_files(spark, source, False, named_set)
        cut = cached(read_bands(spark, source, _identified(files), named_set, recursive=False, halo=0, carry=CARRY))
        bands = map_block(cut.filter("band >= 0"), lambda a, top, bottom: gray(a), carry=CARRY)
        return _finish(spark, _named(bands, "gray", 1, "processed"), files, target, as_files, 1, _unread(cut))


def _unread(cut: DataFrame) -> DataFrame:
    return cut.filter("band < 0").select("image_id", F.lit("decode").alias("stage"), "message")


def _named(bands: DataFrame, kind: str, channels: int, prefix: str, keep_format: bool = False) -> DataFrame:
    naming_rule = paths.kept_prefixed if keep_format else paths.png_prefixed
    return bands.drop("e0", "e1").withColumnRenamed("data", "content").withColumns(
        {
            "kind": F.lit(kind),
            "n_channels": F.lit(channels),
            "name": naming_rule(F.col("rel_path"), prefix),
        }
    )


def resize_dataset(
    spark: SparkSession,
    source: str,
    target: str,
    height: int = 256,
    width: int = 256,
    method: str = "bicubic",
    manifest: DataFrame | None = None,
    named_set: str | None = "images",
    as_files: bool = False,
    keep_format: bool = False,
) -> DataFrame:
    """Resize a tree of images, or only the files that a manifest names; gives the table.

    A manifest selects rows of the listing, before any file is opened. With ``keep_format``
    PNG, BMP and JPEG files stay what they are (JPEG at quality 95); all others become PNG.
    """
    named_set = named_set or "images"
    with keeping():
        files = list_files(spark, source, named_set=named_set)
        if manifest is not None:
            files = cut_lineage(naming.in_manifest(files, manifest))
        cut = cached(read_bands(spark, source, _identified(files), named_set, halo=0, carry=CARRY))
        bands = resize(cut.filter("band >= 0").drop("message"), height, width, method, carry=CARRY)
        return _finish(spark, _named(bands, "resized", 3, "resized", keep_format), files, target, as_files, 1, _unread(cut))
