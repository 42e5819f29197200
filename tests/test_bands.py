import numpy as np
import pytest
from pyspark.sql import functions as F

from bandsaw.operators import components, neighborhood, resize
from bandsaw.operators.bands import from_pixels, recut, to_bands, to_pixels
from bandsaw.operators.kernels import gray
from bandsaw.plans.segment import segment
from tests.helpers import areas, filled, image_table, rebuild, spiral

RNG = np.random.default_rng(7)
COLOUR = [RNG.integers(0, 256, (h, w, 3)).astype(np.uint8) for h, w in [(64, 20), (37, 33), (5, 9), (1, 1), (90, 3)]]
BLOBS = [(RNG.random((70, 40)) < p).astype(np.uint8) * 255 for p in (0.4, 0.55, 0.7)]
BLOBS += [spiral(61) * 255, 255 - spiral(61) * 255, np.zeros((40, 8), np.uint8), np.full((50, 8), 255, np.uint8)]


def test_bands_cover_images(spark):
    images = image_table(spark, COLOUR)
    for rows in (None, 12, 20):
        got = rebuild(to_bands(images, rows), 3)
        assert all((got[i] == a).all() for i, a in enumerate(COLOUR))


def test_channels_are_normalised(spark):
    flat = RNG.integers(0, 256, (6, 5)).astype(np.uint8)
    alpha = RNG.integers(0, 256, (6, 5, 4)).astype(np.uint8)
    got = rebuild(to_bands(image_table(spark, [flat, alpha])), 3)
    assert (got[0] == flat[..., None]).all() and (got[1] == alpha[..., :3]).all()
    single = rebuild(to_bands(image_table(spark, [flat, alpha]), as_gray=True))
    assert (single[0] == flat).all() and (single[1] == gray(alpha[..., :3])).all()


def test_recut_and_pixels_round_trip(spark):
    images = image_table(spark, COLOUR)
    bands = to_bands(images, 12, 3)
    again = rebuild(neighborhood.gaussian_blur(recut(bands, 15, 5)), 3)
    whole = rebuild(neighborhood.gaussian_blur(to_bands(images)), 3)
    assert all((again[i] == whole[i]).all() for i in whole)
    sizes = images.select("image_id", "height", "width")
    pixels = to_pixels(bands).join(sizes, "image_id")
    back = rebuild(from_pixels(pixels, rows=14, halo=2), 3)
    assert all((back[i] == a).all() for i, a in enumerate(COLOUR))


def test_bands_are_put_together_without_pandas_groups(spark):
    """Pixels in any order, in small record batches; a pixel that no row gives is zero."""
    images = image_table(spark, COLOUR)
    sized = to_pixels(to_bands(images, 12, 3)).join(images.select("image_id", "height", "width"), "image_id")
    some = sized.filter("NOT (image_id = 0 AND y = 17 AND x = 4)").repartition(7, "x").sortWithinPartitions(F.xxhash64("image_id", "y", "x"))
    again = recut(from_pixels(some, rows=14, halo=2), 13, 5)
    assert "Pandas" not in again._jdf.queryExecution().executedPlan().toString()
    back = rebuild(again, 3)
    wanted = [a.copy() for a in COLOUR]
    wanted[0][17, 4] = 0
    assert all((back[i] == a).all() for i, a in enumerate(wanted))
    one = to_pixels(to_bands(image_table(spark, [COLOUR[1][..., 0]]), 12, as_gray=True), ("v",))
    flat = from_pixels(one.selectExpr("*", "37 AS height", "33 AS width"), ("v",), 12, 4)
    assert (rebuild(flat)[0] == COLOUR[1][..., 0]).all()


def test_missing_halo_is_an_error(spark):
    bands = to_bands(image_table(spark, COLOUR), 12, 1)
    with pytest.raises(Exception, match="halo rows"):
        neighborhood.gaussian_blur(bands).collect()
    with pytest.raises(ValueError, match="halo"):
        from_pixels(to_pixels(bands), rows=4, halo=12)


@pytest.mark.parametrize("rows", [12, 25])
def test_components_do_not_depend_on_the_cut(spark, rows):
    masks = to_bands(image_table(spark, BLOBS), rows, as_gray=True)
    got = {}
    for r in components.components(masks).collect():
        got.setdefault(r.image_id, {})[r.comp_id] = r.area
    for i, blob in enumerate(BLOBS):
        assert got.get(i, {}) == areas(blob), i
    holes = rebuild(components.fill_holes(masks))
    for i, blob in enumerate(BLOBS):
        assert (holes[i] == filled(blob) * 255).all(), i
    large = rebuild(components.keep_large(masks, 30.0))
    one = rebuild(components.keep_large(to_bands(image_table(spark, BLOBS), as_gray=True), 30.0))
    assert all((large[i] == one[i]).all() for i in one)


def test_segmentation_does_not_depend_on_the_cut(spark):
    y, x = np.mgrid[0:70, 0:50]
    disk = ((y - 35) ** 2 + (x - 25) ** 2 < 500) * 90 + ((y - 30) ** 2 + (x - 25) ** 2 < 250) * 60 + 60
    noise = RNG.integers(0, 20, (70, 50, 3))
    images = image_table(spark, [disk[..., None] + noise, disk[..., None] + noise[::-1], np.zeros((30, 30, 3))])
    results = {}
    for rows in (None, 12, 30):
        done = segment(images, band_rows=rows, min_area=100.0)
        results[rows] = {
            (r.image_id, c): b"".join(bytes(p[c]) for p in sorted(rows_, key=lambda p: p.band))
            for c in ("original", "segmented", "selected", "mask")
            for r, rows_ in _by_image(done.bands.collect())
        }
        done.release()
    assert results[None] == results[12] == results[30]
    assert sum(results[None][(0, "mask")]) > 0


def _by_image(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r.image_id, []).append(r)
    return [(g[0], g) for g in groups.values()]


def test_resize_does_not_depend_on_the_cut(spark):
    images = image_table(spark, COLOUR)
    for method in ("nearest", "area", "bilinear", "bicubic", "lanczos"):
        one = rebuild(resize.resize(to_bands(images), 17, 23, method), 3)
        cut = rebuild(resize.resize(to_bands(images, 12), 17, 23, method), 3)
        assert all((one[i] == cut[i]).all() for i in one), method


def test_resize_known_values(spark):
    a = np.array([[0, 10], [20, 30]], np.uint8)
    same = rebuild(resize.resize(to_bands(image_table(spark, [a])), 2, 2, "bicubic"), 3)[0]
    assert (same[..., 0] == a).all()
    mean = rebuild(resize.resize(to_bands(image_table(spark, [a])), 1, 1, "area"), 3)[0]
    assert mean.tolist() == [[[15, 15, 15]]]
    near = rebuild(resize.resize(to_bands(image_table(spark, [a])), 4, 4, "nearest"), 3)[0]
    assert (near[..., 0] == a.repeat(2, 0).repeat(2, 1)).all()
