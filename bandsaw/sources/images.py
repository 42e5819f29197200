"""Image files to the ``images`` table, with masks and class labels."""

from __future__ import annotations

from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandsaw.functions import paths
from bandsaw.operators.bands import HALO, to_bands
from bandsaw.session import qualified
from bandsaw.sources.decode import EXTENSIONS, decode_bands, is_rowwise
from bandsaw.sources.files import extension_glob
from bandsaw.sources.headers import TOO_LARGE, header, problem, with_headers
from bandsaw.sources.store import opened, reachable

MOST_NAMES = 10_000


def _forms(path: str) -> list[str]:
    """How a path may be spelled: with one slash or three, percent-encoded or not."""
    scheme, _, rest = path.partition(":")
    plain = "/" + rest.lstrip("/") if scheme == "file" else rest
    spelled = [plain, "//" + plain] if scheme == "file" else [plain]
    return [f"{scheme}:{s}" for x in spelled for s in (x, quote(x))]


def _is_deep(paths_: pd.Series) -> pd.Series:
    """Whether a gray file has more than 8 bits, of which the decoder keeps the low ones; null paths are not opened."""

    def deep(path: str | None) -> bool:
        if path is None or not reachable(path):
            return False
        store, name = opened(path)
        with store.open_input_file(name) as source:
            return (header(source.read(64))[4] or 8) > 8

    return paths_.map(deep).astype(bool)


def read_images(
    spark: SparkSession,
    root: str,
    named_set: str | None = "images",
    recursive: bool = True,
    only: str | None = None,
    names: list[str] | None = None,
    without: list[str] | None = None,
    but: tuple[str, ...] = (),
) -> DataFrame:
    """Decode a tree of image files on the executors.

    A file that cannot be decoded keeps its row with height -1, and so does gray
    of more than 8 bits; a file that makes the decoder throw has no row. ``only``
    may be "images" or "masks"; ``names`` are file names and ``without`` paths, at most
    ``MOST_NAMES``; files with extensions of ``but`` are left out. All four filter before files are opened.
    """
    reader = spark.read.format("image").option("recursiveFileLookup", recursive).option("ignoreCorruptFiles", True)
    if named_set:
        reader = reader.option("pathGlobFilter", extension_glob(named_set, but))
    files = reader.load(root)
    if only:
        mask = paths.is_mask(F.col("_metadata.file_name"))
        files = files.filter(mask if only == "masks" else ~mask)
    if names is not None:
        files = files.filter(F.col("_metadata.file_name").isin(names + [quote(n) for n in names]))
    if without:
        files = files.filter(~F.col("_metadata.file_path").isin([form for path in without for form in _forms(path)]))
    # a plus sign in a file name must survive unescaping
    origin = F.url_decode(F.replace(F.col("image.origin"), F.lit("+"), F.lit("%2B")))
    relative = paths.relative_path(origin, root)
    gray_png = (F.col("image.nChannels") == 1) & paths.has_extension(origin, "png")
    deep = F.pandas_udf(_is_deep, "boolean")(F.when(gray_png, origin))
    return files.select(
        F.xxhash64(relative).alias("image_id"),
        paths.path_only(origin).alias("path"),
        relative.alias("rel_path"),
        paths.category(relative).alias("category"),
        F.when(deep, -1).otherwise(F.col("image.height")).alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("n_channels"),
        F.col("image.mode").alias("mode"),
        F.col("image.data").alias("data"),
    )


def read_bands(
    spark: SparkSession,
    root: str,
    files: DataFrame,
    named_set: str = "images",
    recursive: bool = True,
    only: str | None = None,
    rows: int | None = None,
    halo: int = HALO,
    as_gray: bool = False,
    carry: tuple[str, ...] = (),
    several: bool | None = None,
) -> DataFrame:
    """Bands of the files of a listing (image_id, path, length, rel_path, category), with ``message`` for those that fail.

    PNG and BMP are decoded on the listing's rows. Other formats are left to Spark's
    image source, which opens whole trees: it reads the files below ``root`` with other
    extensions, by name if the listing has at most ``MOST_NAMES`` of them, and its rows are joined to the
    listing. Such a file that would overrun the decoder is not given to it; more than
    ``MOST_NAMES`` of these are an error. A store that tasks cannot open is left to that source altogether.
    ``several`` keeps only the images of several bands and files without a readable header, or only the others.
    """
    if reachable(qualified(spark, root)):
        by_row = files.filter(is_rowwise(F.col("path")))
        others, but = files.filter(~is_rowwise(F.col("path")) & paths.has_extension(F.col("path"), named_set)), EXTENSIONS
        made = decode_bands(by_row, rows, halo, as_gray, carry, several)
        if others.isEmpty() or not set(paths.EXTENSIONS[named_set]) - set(but):
            return made
        heads = with_headers(others.select("path", "length")).filter(problem() == TOO_LARGE).select("path")
        large = [r.path for r in heads.limit(MOST_NAMES + 1).collect()]
        if len(large) > MOST_NAMES:
            raise ValueError(f"more than {MOST_NAMES} files are too large for the decoder of their format")
    else:
        others, but, made, large = files, (), None, []
    named = [r.name for r in others.select(paths.file_name(F.col("path")).alias("name")).distinct().limit(MOST_NAMES + 1).collect()]
    names = named if len(named) <= MOST_NAMES else None
    images = read_images(spark, root, named_set, recursive, only, names, large, but)
    images = images.filter(decoded()).drop("image_id", "path")
    cut = to_bands(images.withColumn("image_id", F.xxhash64("rel_path")), rows, halo, as_gray, carry, several)
    # the listing decides, and knows the id under which a file is wanted
    wanted = others.select(F.xxhash64("rel_path").alias("own_id"), "image_id").hint("shuffle_hash")
    cut = cut.withColumnRenamed("image_id", "own_id").join(wanted, "own_id").drop("own_id")
    cut = cut.withColumn("message", F.lit(None).cast("string"))
    return cut if made is None else made.unionByName(cut)


def decoded():
    """Whether a row of the image source holds an image whose channels can be normalised."""
    size = F.col("height").cast("long") * F.col("width") * F.col("n_channels")
    known = F.col("n_channels").isin(1, 3, 4)
    return (F.col("height") > 0) & (F.col("width") > 0) & known & (F.length("data") == size)


def mask_owner(relative):
    """Relative path of the image that a mask ``{stem}_mask{ext}`` belongs to."""
    return F.regexp_replace(relative, paths.MASK_SUFFIX + r"(\.[^./]*)$", "$1")


def read_labelled(spark: SparkSession, root: str, named_set: str = "images") -> tuple[DataFrame, DataFrame]:
    """(images, masks) of a tree with one folder per class.

    A mask is ``{stem}_mask{ext}`` beside its image and gets its image_id, which
    is a hash of the image's relative path, so no join is needed here. Masks
    meet their images when they are scored.
    """
    images = read_images(spark, root, named_set, only="images")
    masks = read_images(spark, root, named_set, only="masks")
    return images, masks.withColumn("image_id", F.xxhash64(mask_owner("rel_path")))
