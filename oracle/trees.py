"""Directory trees of image files, written by Spark from the fixture images."""

from __future__ import annotations

import struct
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandsaw.operators.bands import map_rows
from bandsaw.session import qualified, shared_dir
from bandsaw.sources.formats import SIGNATURE, encode_png
from bandsaw.sources.png import write_png_tree
from bandsaw.sources.store import opened
from oracle.images import category_of, fixture_images, fixture_masks

TREE = "image_id bigint, rel_dir string, name string, band int, width int, height int, n_channels int, content binary"


def new_folder(spark: SparkSession) -> str:
    """A folder of its own below the shared one."""
    return qualified(spark, f"{shared_dir(spark).rstrip('/')}/bandsaw-{uuid.uuid4().hex}")


def file_rows(images: DataFrame, suffix: str = "") -> DataFrame:
    return images.select(
        "image_id",
        category_of().alias("rel_dir"),
        F.format_string(f"scan %d{suffix}.png", "image_id").alias("name"),
        F.lit(0).alias("band"),
        "width",
        "height",
        "n_channels",
        F.col("data").alias("content"),
    )


def write_tree(spark: SparkSession, sf_dir: str) -> str:
    """``{category}/scan {id}.png`` for every image."""
    root = new_folder(spark)
    write_png_tree(file_rows(fixture_images(spark, sf_dir), ""), root)
    return root


def write_labelled_tree(spark: SparkSession, sf_dir: str) -> str:
    """The same with ``_mask`` files; every seventh image has none."""
    root = new_folder(spark)
    masks = fixture_masks(spark, sf_dir).filter("image_id % 7 <> 0")
    rows = file_rows(fixture_images(spark, sf_dir), "").unionByName(file_rows(masks, "_mask"))
    write_png_tree(rows, root)
    return root


def write_damaged_tree(spark: SparkSession, sf_dir: str) -> str:
    """PNG files of all images; every tenth is cut in half and cannot be decoded."""
    root = new_folder(spark)

    def damage(row: dict) -> dict:
        import numpy as np

        png = encode_png(row["data"], row["width"], row["height"], row["n_channels"])
        keep = len(png) // 2 if row["image_id"] % 10 == 0 else len(png)
        return {"image_id": np.array([row["image_id"]]), "png": [png[:keep]]}

    encoded = map_rows(fixture_images(spark, sf_dir), damage, "image_id bigint, png binary")
    named = encoded.select(F.format_string("scan %d.png", "image_id").alias("name"), F.col("png").alias("content"))
    named.foreachPartition(_save(root))
    return root


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def _deep_png(width: int, height: int) -> bytes:
    """Gray of 16 bits, 0x80FF everywhere."""
    head = _chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 16, 0, 0, 0, 0))
    return SIGNATURE + head + _chunk(b"IDAT", zlib.compress((b"\0" + b"\x80\xff" * width) * height)) + _chunk(b"IEND", b"")


def _huge_png() -> bytes:
    """The beginning of a file of 19,000 x 19,000 pixels."""
    return SIGNATURE + _chunk(b"IHDR", struct.pack(">IIBBBBB", 19_000, 19_000, 8, 2, 0, 0, 0)) + _chunk(b"IEND", b"")


def _bmp(content: bytes, width: int, height: int) -> bytes:
    """24 bits a pixel, rows from the bottom up, each filled up to four bytes."""
    line = 3 * width
    rows = [content[y * line : (y + 1) * line] + b"\0" * (-line % 4) for y in reversed(range(height))]
    body = b"".join(rows)
    return b"BM" + struct.pack("<IHHI", 54 + len(body), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, width, height, 1, 24, 0, len(body), 0, 0, 0, 0) + body


def _jpeg(spark: SparkSession) -> bytes:
    """A gray square on black, written by the JVM."""
    jvm = spark._jvm
    image = jvm.java.awt.image.BufferedImage(64, 64, 1)
    pen = image.createGraphics()
    pen.setColor(jvm.java.awt.Color(200, 200, 200))
    pen.fillRect(16, 16, 32, 32)
    out = jvm.java.io.ByteArrayOutputStream()
    jvm.javax.imageio.ImageIO.write(image, "jpg", out)
    return bytes(out.toByteArray())


def write_mixed_tree(spark: SparkSession, sf_dir: str) -> str:
    """One file per image, of seven sorts: PNG, 16-bit, cut off, empty, hidden, JPEG, and of a huge size."""
    root, jpeg = new_folder(spark), _jpeg(spark)

    def make(row: dict) -> dict:
        i = row["image_id"]
        png = encode_png(row["data"], row["width"], row["height"], row["n_channels"])
        contents = [png, _deep_png(row["width"], row["height"]), png[: len(png) // 2], b"", png, jpeg, _huge_png()]
        name = f"_scan {i}.png" if i % 7 == 4 else f"scan {i}.jpg" if i % 7 == 5 else f"scan {i}.png"
        return {"name": [name], "content": [contents[i % 7]]}

    map_rows(fixture_images(spark, sf_dir), make, "name string, content binary").foreachPartition(_save(root))
    return root


def write_twin_tree(spark: SparkSession, sf_dir: str) -> str:
    """For every image ``scan {id}.png``, and its mask as ``scan {id}.bmp`` beside it."""
    root = new_folder(spark)

    def png(row: dict) -> dict:
        return {"name": [f"scan {row['image_id']}.png"], "content": [encode_png(row["data"], row["width"], row["height"], 3)]}

    def bmp(row: dict) -> dict:
        import numpy as np

        pixels = np.repeat(np.frombuffer(row["data"], np.uint8), 3).tobytes()
        return {"name": [f"scan {row['image_id']}.bmp"], "content": [_bmp(pixels, row["width"], row["height"])]}

    schema = "name string, content binary"
    both = map_rows(fixture_images(spark, sf_dir), png, schema).unionByName(map_rows(fixture_masks(spark, sf_dir), bmp, schema))
    both.foreachPartition(_save(root))
    return root


def write_text_tree(spark: SparkSession, sf_dir: str) -> str:
    """No images: a text file for every image."""
    root = new_folder(spark)
    names = fixture_images(spark, sf_dir).select(F.format_string("notes %d.txt", "image_id").alias("name"), F.lit(b"text").alias("content"))
    names.foreachPartition(_save(root))
    return root


def _save(root: str):
    def save(rows) -> None:
        store, base = opened(root)
        store.create_dir(base, recursive=True)
        for row in rows:
            with store.open_output_stream(f"{base}/{row.name}") as sink:
                sink.write(row.content)

    return save
