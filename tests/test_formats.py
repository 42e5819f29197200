"""Encoders: files of several bands, of odd sizes, decoded again by Spark's image source and by the library."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from bandsaw.functions import paths
from bandsaw.sources import formats
from bandsaw.sources.decode import decode_bands

SIZES = [(1, 1, 3), (8, 8, 1), (13, 21, 3), (64, 64, 3), (100, 37, 1), (33, 300, 3)]


def smooth(height, width, channels):
    y, x = np.mgrid[:height, :width]
    planes = [np.clip(127 + 100 * np.sin(x / 9 + k) + 20 * np.cos(y / 7), 0, 255) for k in range(channels)]
    return np.stack(planes, axis=-1).astype(np.uint8)


def in_bands(kind, a, rows):
    encoder = formats.ENCODERS[kind](a.shape[1], a.shape[0], a.shape[2])
    return encoder.head + b"".join(encoder.rows(a[i : i + rows].tobytes()) for i in range(0, len(a), rows)) + encoder.end()


@pytest.mark.parametrize("kind", formats.ENCODERS)
def test_files_decode_again(spark, tmp_path, kind):
    drawn = {f"{h}_{w}_{c}{kind}": smooth(h, w, c) for h, w, c in SIZES}
    drawn[f"noise{kind}"] = np.random.default_rng(5).integers(0, 256, (50, 61, 3), dtype=np.uint8)
    for name, a in drawn.items():
        (tmp_path / name).write_bytes(in_bands(kind, a, 5))
    got = spark.read.format("image").load(str(tmp_path)).select("image.*").collect()
    assert len(got) == len(drawn)
    for r in got:
        a = drawn[r.origin.rsplit("/", 1)[1]]
        b = np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, r.nChannels)
        assert b.shape[:2] == a.shape[:2]
        error = np.abs(b.astype(int) - a)
        assert error.max() == 0 if kind in (".png", ".bmp") else error.mean() < (4 if "noise" in r.origin else 1)


@pytest.mark.parametrize("kind", [".png", ".bmp"])
def test_own_files_are_read_by_the_library(spark, tmp_path, kind):
    for h, w, c in SIZES:
        (tmp_path / f"{h}_{w}_{c}{kind}").write_bytes(in_bands(kind, smooth(h, w, c), 7))
    files = spark.createDataFrame([(i, f"file:{tmp_path}/{h}_{w}_{c}{kind}", 1) for i, (h, w, c) in enumerate(SIZES)], "image_id bigint, path string, length bigint")
    got = decode_bands(files, as_gray=False).filter("band >= 0").collect()
    assert len(got) == len(SIZES)
    for r in got:
        a = smooth(*SIZES[r.image_id])
        b = np.frombuffer(r.data, np.uint8).reshape(a.shape[0], a.shape[1], -1)
        assert (b == a).all()


def test_bands_do_not_change_the_file():
    a = smooth(75, 90, 3)
    for kind in (".bmp", ".jpg"):
        assert in_bands(kind, a, 75) == in_bands(kind, a, 1) == in_bands(kind, a, 8)
    # a block of bits at a time gives the same too
    formats.BLOCK_PIXELS, before = 1, formats.BLOCK_PIXELS
    try:
        small = in_bands(".jpg", a, 75)
    finally:
        formats.BLOCK_PIXELS = before
    assert small == in_bands(".jpg", a, 75)


def test_tables_and_limits():
    assert len(formats.AC_SYMBOLS) == len(set(formats.AC_SYMBOLS)) == sum(formats.AC_COUNTS) == 162
    assert sorted(formats.ZIGZAG) == list(range(64)) and formats.ZIGZAG[:6].tolist() == [0, 1, 8, 16, 9, 2]
    with pytest.raises(ValueError, match="65535"):
        formats.JpegEncoder(70_000, 1, 3)
    with pytest.raises(ValueError, match="four gigabytes"):
        formats.BmpEncoder(100_000, 20_000, 3)


def test_names_that_keep_their_format(spark):
    names = ["a/x.JPG", "x.jpeg", "x.bmp", "x.png", "x.gif", "x"]
    got = spark.createDataFrame([(n,) for n in names], "p string").select(paths.kept_prefixed(F.col("p"), "r").alias("n")).collect()
    assert [r.n for r in got] == ["r_x.JPG", "r_x.jpeg", "r_x.bmp", "r_x.png", "r_x.gif.png", "r_x.png"]
