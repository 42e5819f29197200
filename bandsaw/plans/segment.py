"""The segmentation job: images in, four artefacts, centres and status out."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandsaw.operators import cluster
from bandsaw.operators.bands import (
    BANDS,
    GEOMETRY,
    GEOMETRY_NAMES,
    at_frame,
    block,
    carried,
    geometry,
    map_rows,
    shrink,
    spread,
    to_bands,
    trim,
    with_per_image,
)
from bandsaw.operators.components import (
    MIN_AREA,
    area_test,
    fill_block,
    fill_holes,
    has_seams,
    seam_holes,
    seam_large,
    with_choice,
)
from bandsaw.operators.kernels import dilate5, erode5, gaussian5, gray, lab_histogram, lab_labels, lab_to_bgr
from bandsaw.operators.neighborhood import threshold
from bandsaw.session import cached
from bandsaw.sources.images import decoded

ROI_LEVEL = 127
SELECTED_LEVEL = 1
CARRY = ("category", "rel_path")
KINDS = ("original", "segmented_kmeans", "selected_cluster", "ground_truth_mask")


def valid(images: DataFrame) -> DataFrame:
    """Images that were decoded, with a channel count that can be normalised."""
    return images.filter(decoded())


def roi_bands(bands: DataFrame, holes: DataFrame | None) -> DataFrame:
    """Keep the pixels inside the filled outline of everything brighter than the level."""

    def keep(row: dict) -> dict:
        a = block(row)
        inside = fill_block(row, gray(a) > ROI_LEVEL)
        return geometry(row) | {"data": [(a * inside[..., None]).tobytes()]}

    return map_rows(with_choice(bands, holes), keep, BANDS)


def region_of_interest(bands: DataFrame) -> DataFrame:
    """ROI masking as an operator of its own."""
    bands = cached(bands)
    holes = seam_holes(threshold(bands, ROI_LEVEL))
    return roi_bands(bands if holes is None else spread(bands), holes)


def _prepare(row: dict, preprocess: bool) -> tuple[dict, np.ndarray, np.ndarray]:
    """Geometry, original pixels, and the pixels to cluster (after ROI masking and blur)."""
    a = block(row)
    if not preprocess:
        return row, a, a
    inside = fill_block({**row, "chosen": row["roi_holes"]}, gray(a) > ROI_LEVEL)
    out = shrink(row, 2)
    blurred = gaussian5(a * inside[..., None], *at_frame(row))
    return out, a[out["e0"] - row["e0"] : out["e1"] - row["e0"]], blurred


# Called in the tasks with a stage and the row of a band before the stage's work; what it raises fails the image.
Inspect = Callable[[str, dict], None]
ERRORS = "image_id bigint, stage string, message string"
ERROR_KIND = "error"


class StageFailed(Exception):
    """A stage could not do its work on one image."""

    def __init__(self, stage: str, reason: Exception | None = None, message: str | None = None):
        super().__init__(stage, message if reason is None else f"{type(reason).__name__}: {reason}")
        self.stage, self.message = self.args


@contextmanager
def _at(stage: str, row: dict, inspect: Inspect | None) -> Iterator[None]:
    try:
        if inspect:
            inspect(stage, row)
        yield
    except MemoryError:
        raise
    except Exception as reason:
        raise StageFailed(stage, reason) from reason


def _reason(error: Exception) -> tuple[str, str]:
    return (error.stage, error.message) if isinstance(error, StageFailed) else ("write", f"{type(error).__name__}: {error}")


def _lab_colours(bands: DataFrame, preprocess: bool, inspect: Inspect | None = None, failed=None) -> DataFrame:
    """L*a*b* histogram per image of the pixels to cluster."""
    rows = bands.select(*GEOMETRY_NAMES, "data", "roi_holes")
    return cluster.summed(map_rows(rows, _counting(preprocess, inspect), cluster.COLOURS, failed))


def _counting(preprocess: bool, inspect: Inspect | None) -> Callable[[dict], dict]:
    def count(row: dict) -> dict:
        with _at("preprocess", row, inspect):
            out, _, pixels = _prepare(row, preprocess)
            values, w = lab_histogram(trim(out, pixels))
        return cluster.colour_columns(row["image_id"], *values.T, w)

    return count


def _uncounted(row: dict, reason: Exception) -> dict:
    """What stands for an image that fails: a colour -1 of no weight."""
    return cluster.colour_columns(row["image_id"], [-1], [-1], [-1], [0])


def _split_failures(bands: DataFrame, colours: DataFrame, preprocess: bool, inspect: Inspect | None) -> tuple[DataFrame, DataFrame | None]:
    """(colours of the images that could be prepared, errors of the others). The reasons are found by preparing those again."""
    bad = colours.filter("c0 < 0").select("image_id").distinct()
    if bad.isEmpty():
        return colours, None
    count = _counting(preprocess, inspect)

    def explain(row: dict) -> dict | None:
        try:
            count(row)
        except StageFailed as reason:
            return {"image_id": [row["image_id"]], "stage": [reason.stage], "message": [reason.message]}
        return None

    again = bands.select(*GEOMETRY_NAMES, "data", "roi_holes").join(bad, "image_id", "left_semi")
    return colours.filter("c0 >= 0").join(bad, "image_id", "left_anti"), cached(map_rows(again, explain, ERRORS))


def lab_colours(bands: DataFrame, preprocess: bool = True) -> DataFrame:
    """The weighted colours that k-means gets: L*a*b*, after ROI masking and blur."""
    bands = cached(bands)
    holes = seam_holes(threshold(bands, ROI_LEVEL)) if preprocess else None
    bands = bands if holes is None else spread(bands)
    return _lab_colours(with_choice(bands, holes, "roi_holes"), preprocess)


def _centres(row: dict, k: int) -> np.ndarray:
    values = [row[f"k{i}_{j}"] for i in range(k) for j in range(3)]
    return np.array([np.inf if v is None else v for v in values]).reshape(k, 3)


def _select(row: dict, preprocess: bool, k: int, inspect: Inspect | None = None) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray]:
    """Geometry, original pixels, labels, and the pixels of the chosen cluster."""
    with _at("preprocess", row, None):
        out, pixels, prepared = _prepare(row, preprocess)
    with _at("cluster", row, inspect):
        labels = lab_labels(prepared, _centres(row, k))
        return out, pixels, labels, pixels * (labels == row["best"])[..., None]


@dataclass(frozen=True)
class _Clustering:
    """How the images of one band are clustered in the task that decodes them."""

    k: int
    preprocess: bool
    cluster_index: int | None
    n_init: int
    max_iter: int
    inspect: Inspect | None

    def centres(self, row: dict) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray, bool, int]:
        """Geometry, original and prepared pixels, centres (missing ones NaN), whether they converged, the chosen one."""
        if row.get("message") is not None:
            raise StageFailed("decode", message=row["message"])
        with _at("preprocess", row, self.inspect):
            out, pixels, prepared = _prepare({**row, "roi_holes": None}, self.preprocess)
            values, w = lab_histogram(trim(out, prepared))
        with _at("cluster", row, self.inspect):
            values = values.astype(np.int64)
            packed, same = np.unique(values[:, 0] << 16 | values[:, 1] << 8 | values[:, 2], return_inverse=True)
            weights = np.bincount(same, w, packed.size).astype(np.int64)
            centres, converged = cluster.cluster_colours(packed, weights, self.k, self.max_iter, self.n_init)
            best = cluster.best_of(centres) if self.cluster_index is None else self.cluster_index
        return out, pixels, prepared, centres, converged, best

    def select(self, row: dict) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What ``_select`` gives, and the centres, missing ones infinite."""
        out, pixels, prepared, centres, _, best = self.centres(row)
        with _at("cluster", row, None):
            centres = np.where(np.isnan(centres), np.inf, centres)
            labels = lab_labels(prepared, centres)
            return out, pixels, labels, pixels * (labels == best)[..., None], centres

    def centre_row(self, row: dict) -> dict:
        _, _, _, centres, converged, best = self.centres(row)
        values = {f"k{i}_{j}": [None if np.isnan(v) else float(v)] for (i, j), v in np.ndenumerate(centres)}
        return {"image_id": [row["image_id"]]} | values | {"converged": [converged], "best": [best]}


def clean_mask(mask: np.ndarray, top: bool, bottom: bool) -> np.ndarray:
    """Opening, then closing, of a 0/255 mask; uses eight halo rows."""
    for step in (erode5, dilate5, dilate5, erode5):
        mask = step(mask, top, bottom)
    return mask


def _closed(row: dict, selected: np.ndarray) -> tuple[dict, np.ndarray]:
    mask = np.where(gray(selected) > SELECTED_LEVEL, np.uint8(255), np.uint8(0))
    return shrink(row, 8), clean_mask(mask, *at_frame(row))


def postprocess(bands: DataFrame, min_area: float = MIN_AREA) -> DataFrame:
    """Selected-cluster bands to the cleaned mask: open, close, fill, keep large components."""

    def close(row: dict) -> dict:
        out, mask = _closed(row, block(row))
        return geometry(out) | {"data": [mask.tobytes()]}

    closed = spread(map_rows(bands.select(*GEOMETRY_NAMES, "data"), close, BANDS))
    closed = cached(closed)
    holes, large = _across_seams(closed, min_area)
    return _finish(closed, holes, large, min_area)


def _across_seams(closed: DataFrame, min_area: float) -> tuple[DataFrame | None, DataFrame | None]:
    """Hole and large-component lists of the images with several bands; ``closed`` is kept and spread."""
    if not has_seams(closed):
        return None, None
    multi = closed.filter("bands > 1")
    holes = seam_holes(multi)
    filled = cached(fill_holes(multi, holes))
    large = seam_large(filled, min_area)
    filled.unpersist()
    return holes, large


def _with_seams(bands: DataFrame, holes: DataFrame | None, large: DataFrame | None) -> DataFrame:
    return with_choice(with_choice(bands, holes, "holes"), large, "large")


def _final(row: dict, closed: np.ndarray, min_area: float) -> np.ndarray:
    """Filled mask of the large components, core rows, 0/255."""
    filled = fill_block({**row, "chosen": row["holes"]}, closed)
    kept = area_test({**row, "chosen": row["large"]}, filled, min_area)
    return trim(row, kept) * np.uint8(255)


def _finish(closed: DataFrame, holes: DataFrame | None, large: DataFrame | None, min_area: float) -> DataFrame:
    def last(row: dict) -> dict:
        mask = _final(row, block(row), min_area)
        return geometry(row, e0=row["y0"], e1=row["y1"]) | {"data": [mask.tobytes()]}

    return map_rows(_with_seams(closed, holes, large), last, BANDS)


@dataclass
class Segmentation:
    """Result of :func:`segment`.

    ``bands``    geometry (core rows), original, segmented, selected, mask, and
                 the category and rel_path of the image where it has them
    ``masks``    the cleaned masks alone, as bands, spread by (image, band) and kept once something reads them
    ``centres``  image_id, k{i}_{j}, converged, best; made again when read, for images of one band
    ``done``     image_id, height, width, bands of the images that have a mask
    ``errors``   image_id, stage, message of the images of several bands that failed before their result was made,
                 and of files without a readable header
    ``unmasked`` image_id, stage, message of the images of one band that have no mask

    Bands whose result failed have a ``stage`` and a ``message`` and no pixels; so have files of one
    band with damaged pixels.
    """

    bands: DataFrame
    masks: DataFrame
    centres: DataFrame
    done: DataFrame
    held: list[DataFrame]
    errors: DataFrame
    unmasked: DataFrame

    def artifacts(self) -> DataFrame:
        """Four rows per band, one per kind; a band that failed has one of the kind ``error``."""
        return artifact_rows(self.bands)

    def release(self) -> None:
        for df in self.held:
            df.unpersist()


def artifact_rows(bands: DataFrame) -> DataFrame:
    """Fan the four results of a band out into rows (kind, n_channels, content)."""
    columns = zip(KINDS, ("original", "segmented", "selected", "mask"), (3, 3, 3, 1))
    kinds = [
        F.struct(F.lit(kind).alias("kind"), F.lit(n).alias("n_channels"), F.col(c).alias("content"))
        for kind, c, n in columns
    ]
    rest = ["image_id", "band", "bands", "height", "width", "y0", "y1", *[c for c in CARRY if c in bands.columns]]
    made = F.array(*kinds)
    if "message" in bands.columns:
        told = F.concat_ws("\n", "stage", "message").cast("binary")
        made = F.when(F.col("message").isNull(), made).otherwise(F.array(F.struct(F.lit(ERROR_KIND).alias("kind"), F.lit(0).alias("n_channels"), told.alias("content"))))
    return bands.select(*rest, F.explode(made).alias("a")).select(*rest, "a.*")


def errors_in(artifacts: DataFrame) -> DataFrame:
    """(image_id, stage, message) from the rows of the kind ``error``, one per image."""
    told = F.split(F.decode("content", "UTF-8"), "\n", 2)
    rows = artifacts.filter(F.col("kind") == ERROR_KIND).select("image_id", told[0].alias("stage"), told[1].alias("message"))
    return rows.groupBy("image_id").agg(F.min(F.struct("stage", "message")).alias("e")).select("image_id", "e.*")


def segment(images: DataFrame, band_rows: int | None = None, **options) -> Segmentation:
    """Segment every image of ``images`` (image_id, height, width, n_channels, data); options as for ``segment_bands``."""
    carry = tuple(c for c in CARRY if c in images.columns)
    whole, parts = (to_bands(valid(images), band_rows, carry=carry, several=several) for several in (False, True))
    return segment_bands(whole, parts, **options)


def segment_bands(
    whole: DataFrame,
    parts: DataFrame,
    k: int = 3,
    preprocess: bool = True,
    cluster_index: int | None = None,
    as_bgr: bool = False,
    min_area: float = MIN_AREA,
    n_init: int = 20,
    max_iter: int = 300,
    partitions: int | None = None,
    inspect: Inspect | None = None,
) -> Segmentation:
    """Segment images of one band (``whole``) and bands of images of several (``parts``), of the same columns;
    rows with a ``message`` tell of files that could not be decoded.

    An image of one band is bounded, so everything happens in the task that decodes it, k-means included: its
    pixels are neither shuffled nor kept. Bands of larger images are shuffled once, on (image, band),
    and kept; everything that follows reads them where they are. Only small tables move: hole lists,
    colour histograms and centres. Region of interest, blur and colour conversion run once for the
    histogram and once more for the result, which is cheaper than storing them. Both ways give the same
    results. ``segmented`` holds truncated centres in L*a*b*, or converted back with ``as_bgr``.

    An image that makes a step raise does not stop the others: it is in ``errors``
    or, where its result was to be made, a row with ``message``. ``inspect`` may refuse images: it is
    called with the stages preprocess, cluster, postprocess and write, and a row's geometry and data.
    """
    cluster.check_clusters(k)
    carry = tuple(c for c in CARRY if c in whole.columns)
    way = _Clustering(k, preprocess, cluster_index, n_init, max_iter, inspect)
    schema = GEOMETRY + ", original binary, segmented binary, selected binary, mask binary, stage string, message string" + carried(carry)
    mask_schema = BANDS + ", stage string, message string"

    def mask_of(row: dict, out: dict, selected: np.ndarray) -> np.ndarray:
        with _at("postprocess", row, inspect):
            narrow, closed = _closed(out, selected)
            return _final(narrow, closed, min_area)

    def results(row: dict, out: dict, pixels: np.ndarray, labels: np.ndarray, selected: np.ndarray, centres: np.ndarray) -> dict:
        painted = np.floor(centres).clip(0, 255).astype(np.uint8)[trim(out, labels)]
        if as_bgr:
            painted = lab_to_bgr(painted)
        mask = mask_of(row, out, selected)
        with _at("write", row, inspect):
            return geometry(row, e0=row["y0"], e1=row["y1"]) | {
                "original": [trim(out, pixels).tobytes()],
                "segmented": [painted.tobytes()],
                "selected": [trim(out, selected).tobytes()],
                "mask": [mask.tobytes()],
                "stage": [None],
                "message": [None],
                **{c: [row[c]] for c in carry},
            }

    def failed(row: dict, reason: Exception) -> dict:
        stage, message = _reason(reason)
        nothing = dict.fromkeys(("original", "segmented", "selected", "mask"), [None])
        return geometry(row, e0=row["y0"], e1=row["y1"]) | nothing | {"stage": [stage], "message": [message], **{c: [row[c]] for c in carry}}

    def unlisted(row: dict) -> dict:
        return {**row, "holes": None, "large": None}

    def finish_whole(row: dict) -> dict:
        row = unlisted(row)
        return results(row, *way.select(row))

    def mask_whole(row: dict) -> dict:
        row = unlisted(row)
        out, _, _, selected, _ = way.select(row)
        mask = mask_of(row, out, selected)
        return geometry(row, e0=row["y0"], e1=row["y1"]) | {"data": [mask.tobytes()], "stage": [None], "message": [None]}

    def unmasked(row: dict, reason: Exception) -> dict:
        stage, message = _reason(reason)
        return geometry(row) | {"data": [None], "stage": [stage], "message": [message]}

    result = map_rows(whole, finish_whole, schema, failed)
    masks = map_rows(whole, mask_whole, mask_schema, unmasked)
    names = ", ".join(f"k{i}_{j} double" for i in range(k) for j in range(3))
    centres = map_rows(whole, way.centre_row, f"image_id bigint, {names}, converged boolean, best int", lambda row, reason: None)

    kept = cached(spread(parts, partitions))
    errors = whole.sparkSession.createDataFrame([], ERRORS)
    released = [kept]
    if kept.count():
        large_images = _segment_parts(kept, way, min_area, partitions, results, failed, schema)
        result = result.unionByName(large_images.bands)
        nothing = F.lit(None).cast("string")
        masks = masks.unionByName(large_images.masks.withColumns({"stage": nothing, "message": nothing}))
        centres = centres.unionByName(large_images.centres)
        errors = large_images.errors
        released += large_images.held
    masks = cached(spread(masks, partitions))
    made, told = masks.filter("message IS NULL"), masks.filter("message IS NOT NULL")
    done = made.filter("band = 0").select("image_id", "height", "width", "bands")
    told = told.select("image_id", "stage", "message")
    return Segmentation(result, made.drop("stage", "message"), centres, done, [*released, masks], errors, told)


@dataclass
class _Parts:
    bands: DataFrame
    masks: DataFrame
    centres: DataFrame
    held: list[DataFrame]
    errors: DataFrame


def _segment_parts(kept: DataFrame, way: _Clustering, min_area: float, partitions: int | None, results, failed, schema: str) -> _Parts:
    """Segment the bands of images of several bands; ``kept`` is kept and spread."""
    k, preprocess, inspect = way.k, way.preprocess, way.inspect
    held, errors = kept, kept.sparkSession.createDataFrame([], ERRORS)
    if "message" in kept.columns:
        held = kept.filter("band >= 0").drop("message")
        errors = errors.unionByName(kept.filter("band < 0").select("image_id", F.lit("decode").alias("stage"), "message"))
    roi_holes = seam_holes(threshold(held, ROI_LEVEL)) if preprocess else None
    bands = with_choice(held, roi_holes, "roi_holes")
    colours = cached(_lab_colours(bands, preprocess, inspect, _uncounted))
    prepared, unprepared = _split_failures(bands, colours, preprocess, inspect)
    if unprepared is not None:
        errors = errors.unionByName(unprepared.dropDuplicates(["image_id"]))
    centres = cluster.with_best(cluster.kmeans(prepared, k, way.max_iter, way.n_init), k)
    if way.cluster_index is not None:
        centres = centres.withColumn("best", F.lit(way.cluster_index))
    centres = cached(centres)
    placed = with_per_image(bands, centres.drop("converged"))

    def close(row: dict) -> dict:
        out, _, _, selected = _select(row, preprocess, k, inspect)
        with _at("postprocess", row, inspect):
            out, mask = _closed(out, selected)
        return geometry(out) | {"data": [mask.tobytes()], "message": [None]}

    def unclosed(row: dict, reason: Exception) -> dict:
        return geometry(row) | {"data": [b""], "message": [str(reason)]}

    whole = cached(spread(map_rows(placed, close, BANDS + ", message string", unclosed), partitions))
    closed = whole.filter("message IS NULL").drop("message")
    bad = whole.filter("message IS NOT NULL").select("image_id").distinct()
    if not bad.isEmpty():  # their other bands have no result either
        closed = closed.join(bad, "image_id", "left_anti")
    holes, large = _across_seams(closed, min_area)

    def finish(row: dict) -> dict:
        return results(row, *_select(row, preprocess, k, inspect), _centres(row, k))

    result = map_rows(_with_seams(placed, holes, large), finish, schema, failed)
    return _Parts(result, _finish(closed, holes, large, min_area), centres, [colours, centres, whole], errors)
