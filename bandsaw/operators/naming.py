"""File naming as columns: numbering, flattening, clean names, image and mask pairs.

Nothing is renamed in place; each function gives the target name beside the path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bandsaw.functions import paths
from bandsaw.operators.skew import lookup, semi_join
from bandsaw.session import cut_lineage, shuffle_partitions

_INDEX_BITS = 33  # of monotonically_increasing_id


def number_files(files: DataFrame, partitions: int | None = None) -> DataFrame:
    """(old_name, new_name): ``image_0001.jpg`` and so on, in path order.

    Paths are range-partitioned and sorted; a file's number is its place in its
    partition plus the sizes of the partitions before, so no task sees all files.
    """
    n = partitions or shuffle_partitions(files.sparkSession)
    ordered = files.select("path").repartitionByRange(n, "path").sortWithinPartitions("path")
    # frozen, because places must not change between the two uses
    placed = cut_lineage(ordered.withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", _INDEX_BITS).alias("part")
    sizes = placed.groupBy(part).agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.orderBy("part")) - F.col("size")
    offsets = sizes.select("part", before.alias("before"))  # one row per partition, at most n
    numbered = placed.withColumn("part", part).join(F.broadcast(offsets), "part")
    index = F.col("before") + F.col("place").bitwiseAND((1 << _INDEX_BITS) - 1) + 1
    path = F.col("path")
    return numbered.select(path.alias("old_name"), paths.numbered(index, paths.extension(path)).alias("new_name"))


def flatten_names(files: DataFrame) -> DataFrame:
    """(path, flat_name): one flat directory without losing files of the same name.

    The first path of a name keeps it; the others get the path's digest as a
    suffix. The join is on the path, which is unique, so a name that most files
    share does not gather in one task.
    """
    named = files.select("path", paths.file_name(F.col("path")).alias("name"))
    firsts = named.groupBy("name").agg(F.min("path").alias("path")).select("path", F.lit(True).alias("is_first"))
    path = F.col("path")
    spare = F.concat(paths.stem(path), F.lit("_"), F.md5(path.cast("binary")), paths.extension(path))
    return named.join(firsts, "path", "left").select(
        "path", F.when(F.col("is_first"), F.col("name")).otherwise(spare).alias("flat_name")
    )


def clean_names(files: DataFrame) -> DataFrame:
    """(path, clean_path, collides): spaces become underscores, in directories too."""
    cleaned = files.select("path", paths.underscored(F.col("path")).alias("clean_path"))
    taken = cleaned.groupBy("clean_path").agg(F.count("*").alias("n")).filter("n > 1")
    hits = taken.select("clean_path", F.lit(True).alias("hit"))
    joined = lookup(cleaned, hits, ["clean_path"], "left")
    return joined.select("path", "clean_path", F.coalesce("hit", F.lit(False)).alias("collides"))


def _keyed(files: DataFrame, root: str) -> DataFrame:
    path = F.col("path")
    relative = paths.relative_path(path, root)
    return files.select(
        "path",
        paths.category(relative).alias("category"),
        paths.image_stem(path).alias("stem"),
        paths.extension(path).alias("ext"),
        paths.is_mask(path).alias("is_mask"),
    )


def pair_masks(files: DataFrame, root: str, named_set: str = "images") -> DataFrame:
    """(category, stem, image_path, mask_path) of the images that have a mask."""
    keyed = _keyed(files.filter(paths.has_extension(F.col("path"), named_set)), root)
    images = keyed.filter(~F.col("is_mask")).select("category", "stem", "ext", F.col("path").alias("image_path"))
    masks = keyed.filter("is_mask").select("category", "stem", "ext", F.col("path").alias("mask_path"))
    return images.join(masks, ["category", "stem", "ext"]).drop("ext")


def images_without_mask(files: DataFrame, root: str, named_set: str = "images") -> DataFrame:
    keyed = _keyed(files.filter(paths.has_extension(F.col("path"), named_set)), root)
    images = keyed.filter(~F.col("is_mask"))
    return images.join(keyed.filter("is_mask"), ["category", "stem", "ext"], "left_anti").select("category", "path")


def in_manifest(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose name the manifest lists as a new name.

    Many directories may hold a file of the same name, so frequent names are
    handled apart.
    """
    wanted = manifest.select(F.col("new_name").alias("name")).distinct()
    named = files.withColumn("name", paths.file_name(F.col("path")))
    return semi_join(named, wanted, "name").drop("name")


def listing_summary(files: DataFrame, root: str) -> DataFrame:
    """Files and bytes per category and extension."""
    path = F.col("path")
    keyed = files.select(
        paths.category(paths.relative_path(path, root)).alias("category"),
        F.lower(paths.extension(path)).alias("ext"),
        "length",
    )
    return keyed.groupBy("category", "ext").agg(
        F.count("*").alias("n_files"), F.sum("length").alias("bytes"), F.avg("length").alias("mean_bytes")
    )


def first_image(files: DataFrame) -> DataFrame:
    """The first web image in path order (a top-1 report)."""
    return files.filter(paths.has_extension(F.col("path"), "images_web")).orderBy("path").limit(1)
