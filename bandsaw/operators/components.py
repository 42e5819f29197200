"""Runs, connected components, hole filling and area on binary bands.

Each band labels its own rows. Bands of one image share halo rows, and a run in
a shared row is the same run in both, so equal runs link their components. Only
those links form a graph, which star contraction resolves for all images at
once. Images with a single band never enter the graph.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bandsaw.operators.bands import BANDS, GEOMETRY_NAMES, KEY, block, geometry, map_rows, spread, trim
from bandsaw.operators.graph import connected_components
from bandsaw.operators.kernels import corner_area, label_runs, paint_runs, runs
from bandsaw.operators.skew import lookup
from bandsaw.session import cached, cut_lineage

FOREGROUND, BACKGROUND = 1, 0
MIN_AREA = 500.0
_BAND_BITS = 40

PARTS = (
    "image_id bigint, band int, node bigint, first bigint, frame boolean, area2 bigint, n_pixels bigint, "
    "x0 int, y0 int, x1 int, y1 int, anchors array<bigint>"
)


class Parts(NamedTuple):
    """The components of one band; run arrays and one entry per component."""

    y: np.ndarray  # run rows, counted from the top of the image
    x0: np.ndarray
    x1: np.ndarray
    of_run: np.ndarray  # component number of each run
    first: np.ndarray  # first pixel of each component, as y * width + x
    frame: np.ndarray  # touches the image frame
    shared: np.ndarray  # has a run in a row that a neighbouring band holds too
    in_shared_row: np.ndarray  # per run


def parts_of(row: dict, mask: np.ndarray, value: int) -> Parts:
    """Components of set (8-connected) or clear (4-connected) pixels of a block."""
    y, x0, x1 = runs(mask != 0 if value == FOREGROUND else mask == 0)
    width, height = row["width"], row["height"]
    root = label_runs(y, x0, x1, width, reach=1 if value == FOREGROUND else 0)
    heads, of_run = np.unique(root, return_inverse=True)
    y = y + row["e0"]
    last = row["bands"] - 1
    halo = row["e1"] - row["y1"] if row["band"] < last else row["y0"] - row["e0"]
    in_shared_row = np.zeros(y.size, np.bool_)
    if row["band"] > 0:
        in_shared_row |= y < row["y0"] + halo
    if row["band"] < last:
        in_shared_row |= y >= row["y1"] - halo
    on_frame = (y == 0) | (y == height - 1) | (x0 == 0) | (x1 == width - 1)
    frame = np.bincount(of_run, on_frame, heads.size) > 0
    shared = np.bincount(of_run, in_shared_row, heads.size) > 0
    return Parts(y, x0, x1, of_run, y[heads].astype(np.int64) * width + x0[heads], frame, shared, in_shared_row)


def _halo_rows(row: dict) -> None:
    if row["bands"] > 1 and row["e0"] == row["y0"] and row["e1"] == row["y1"]:
        raise ValueError("components need bands that share at least one halo row; use recut()")


def _pixel_labels(row: dict, parts: Parts) -> np.ndarray:
    """Component number + 1 per held pixel, 0 where there is none."""
    width = row["width"]
    length = parts.x1 - parts.x0 + 1
    out = np.zeros((row["e1"] - row["e0"]) * width, np.int32)
    start = (parts.y - row["e0"]) * width + parts.x0
    index = np.repeat(start - np.cumsum(length) + length, length) + np.arange(length.sum())
    out[index] = np.repeat(parts.of_run + 1, length)
    return out.reshape(-1, width)


def _area_per_part(row: dict, mask: np.ndarray, parts: Parts) -> np.ndarray:
    """Doubled contour area per component, from the 2x2 windows that start in core rows."""
    n = parts.first.size
    core0, core1 = row["y0"] - row["e0"], min(row["y1"], row["height"] - 1) - row["e0"]
    if row["width"] < 2 or core1 <= core0:
        return np.zeros(n, np.int64)
    held = mask[core0 : core1 + 1]
    weight = corner_area(held)
    label = _pixel_labels(row, parts)[core0 : core1 + 1]
    # a window with three set pixels has one on its main diagonal
    owner = np.maximum(label[:-1, :-1], label[1:, 1:])
    hit = weight > 0
    return np.bincount(owner[hit] - 1, weight[hit], n).astype(np.int64)


def band_components(masks: DataFrame, value: int = FOREGROUND) -> DataFrame:
    """The components that each band sees in its own rows, one row per band and component.

    ``area2`` (twice the contour area), ``n_pixels`` and the bounding box count
    core rows only, so that they add up over bands. ``anchors`` are the runs in
    shared rows.
    """

    def label(row: dict) -> dict:
        _halo_rows(row)
        mask = block(row)
        parts = parts_of(row, mask, value)
        n = parts.first.size
        core = (parts.y >= row["y0"]) & (parts.y < row["y1"])
        who, y = parts.of_run[core], parts.y[core]
        x0, x1 = parts.x0[core], parts.x1[core]
        big = np.iinfo(np.int32).max
        box = [np.full(n, big), np.full(n, big), np.full(n, -1), np.full(n, -1)]
        np.minimum.at(box[0], who, x0)
        np.minimum.at(box[1], who, y)
        np.maximum.at(box[2], who, x1)
        np.maximum.at(box[3], who, y)
        area2 = _area_per_part(row, mask, parts) if value == FOREGROUND else np.zeros(n, np.int64)
        anchor = parts.y[parts.in_shared_row].astype(np.int64) * row["width"] + parts.x0[parts.in_shared_row]
        owner = parts.of_run[parts.in_shared_row]
        order = np.argsort(owner, kind="stable")
        split = np.searchsorted(owner[order], np.arange(1, n)) if n else []
        return {
            "image_id": np.full(n, row["image_id"], np.int64),
            "band": np.full(n, row["band"], np.int32),
            "node": (np.int64(row["band"]) << _BAND_BITS) | parts.first,
            "first": parts.first,
            "frame": parts.frame,
            "area2": area2,
            "n_pixels": np.bincount(who, x1 - x0 + 1, n).astype(np.int64),
            "x0": box[0].astype(np.int32),
            "y0": box[1].astype(np.int32),
            "x1": box[2].astype(np.int32),
            "y1": box[3].astype(np.int32),
            "anchors": np.split(anchor[order], split) if n else [],
        }

    return map_rows(masks.select(*GEOMETRY_NAMES, "data"), label, PARTS)


def _links(parts: DataFrame) -> DataFrame:
    """Edges between components of different bands that own the same run."""
    owners = parts.select("image_id", "node", F.explode("anchors").alias("anchor"))
    # at most three bands hold one row
    shared = owners.groupBy("image_id", "anchor").agg(F.collect_set("node").alias("nodes"))
    edges = shared.select("image_id", F.array_min("nodes").alias("u"), F.explode("nodes").alias("v"))
    return edges.filter("u <> v").distinct()


def _rooted(parts: DataFrame) -> DataFrame:
    """``parts`` with the root node of the whole component."""
    roots = connected_components(_links(parts))
    joined = parts.join(roots, ["image_id", "node"], "left")
    return joined.withColumn("root", F.coalesce("root", "node"))


def has_seams(bands: DataFrame) -> bool:
    """Does any image have more than one band?"""
    return not bands.filter("bands > 1").isEmpty()


def _across_bands(masks: DataFrame, value: int, keep: str, aggregates: list) -> DataFrame | None:
    """Per band, the ``first`` pixels of shared components that satisfy ``keep``.

    ``None`` when no image has more than one band.
    """
    if not has_seams(masks):
        return None
    parts = band_components(masks.filter("bands > 1"), value).filter(F.size("anchors") > 0).persist(StorageLevel.MEMORY_AND_DISK)
    rooted = _rooted(parts)
    whole = rooted.groupBy("image_id", "root").agg(*aggregates).filter(keep)
    nodes = rooted.select("image_id", "band", "first", "root")
    chosen = lookup(nodes, whole.select("image_id", "root"), ["image_id", "root"])
    per_band = cut_lineage(chosen.groupBy(*KEY).agg(F.collect_set("first").alias("chosen")))
    parts.unpersist()
    return per_band


def with_choice(bands: DataFrame, per_band: DataFrame | None, name: str = "chosen") -> DataFrame:
    """Bring the small per-band lists to the bands; the pixel bytes are not sorted or moved."""
    if per_band is None:
        return bands.withColumn(name, F.lit(None).cast("array<bigint>"))
    return bands.join(per_band.withColumnRenamed("chosen", name).hint("shuffle_hash"), KEY, "left")


def seam_holes(masks: DataFrame) -> DataFrame | None:
    """Background components that cross bands and never reach the frame."""
    return _across_bands(masks, BACKGROUND, "NOT frame", [F.max("frame").alias("frame")])


def seam_large(masks: DataFrame, min_area: float = MIN_AREA) -> DataFrame | None:
    """Foreground components that cross bands and whose whole area is above the limit."""
    return _across_bands(masks, FOREGROUND, f"area2 > {2 * min_area}", [F.sum("area2").alias("area2")])


def fill_block(row: dict, mask: np.ndarray) -> np.ndarray:
    """0/1 mask with every hole filled; ``chosen`` lists the holes that cross bands."""
    parts = parts_of(row, mask, BACKGROUND)
    hole = np.where(parts.shared, np.isin(parts.first, row["chosen"] or []), ~parts.frame)
    take = hole[parts.of_run]
    filled = paint_runs(mask.shape, parts.y[take] - row["e0"], parts.x0[take], parts.x1[take])
    return ((mask != 0) | (filled != 0)).astype(np.uint8)


def area_test(row: dict, mask: np.ndarray, min_area: float) -> np.ndarray:
    """0/1 mask of the components above ``min_area``; ``chosen`` lists those that cross bands."""
    parts = parts_of(row, mask, FOREGROUND)
    own = _area_per_part(row, mask, parts) > 2 * min_area
    large = np.where(parts.shared, np.isin(parts.first, row["chosen"] or []), own)
    take = large[parts.of_run]
    return paint_runs(mask.shape, parts.y[take] - row["e0"], parts.x0[take], parts.x1[take])


def fill_holes(masks: DataFrame, holes: DataFrame | None = None) -> DataFrame:
    """Fill every hole, as drawing all external contours filled does.

    With ``holes`` given, ``masks`` should be spread on (image, band) already.
    """

    def fill(row: dict) -> dict:
        return geometry(row) | {"data": [(fill_block(row, block(row)) * np.uint8(255)).tobytes()]}

    if holes is None:
        masks = cached(masks)  # read twice: seams first, then all
        holes = seam_holes(masks)
        masks = masks if holes is None else spread(masks)
    return map_rows(with_choice(masks, holes), fill, BANDS)


def keep_large(masks: DataFrame, min_area: float = MIN_AREA) -> DataFrame:
    """Keep components whose contour area is above ``min_area``. Gives core rows only."""

    def keep(row: dict) -> dict:
        _halo_rows(row)
        core = trim(row, area_test(row, block(row), min_area)) * np.uint8(255)
        return geometry(row, e0=row["y0"], e1=row["y1"]) | {"data": [core.tobytes()]}

    masks = cached(masks)
    large = seam_large(masks, min_area)
    return map_rows(with_choice(masks if large is None else spread(masks), large), keep, BANDS)


def components(masks: DataFrame) -> DataFrame:
    """One row per connected component: first pixel, contour area, size, bounding box.

    ``comp_id`` is the component's first pixel in row order, ``y * width + x``.
    """
    masks = cached(masks)
    inside = F.size("anchors") == 0
    local = band_components(masks).filter(inside).withColumn("root", F.col("node"))
    if has_seams(masks):
        local = local.unionByName(_rooted(band_components(masks.filter("bands > 1")).filter(~inside)))
    return local.groupBy("image_id", "root").agg(
        F.min("first").alias("comp_id"),
        (F.sum("area2") / 2.0).alias("area"),
        F.sum("n_pixels").alias("n_pixels"),
        *[F.min(c).alias(c) for c in ("x0", "y0")],
        *[F.max(c).alias(c) for c in ("x1", "y1")],
    ).drop("root")


def external_components(masks: DataFrame) -> DataFrame:
    """Components as external contours give them: holes are filled first."""
    return components(fill_holes(masks))


def run_table(masks: DataFrame) -> DataFrame:
    """Maximal runs of equal pixels, foreground and background."""

    def encode(row: dict) -> dict:
        core = trim(row, block(row))
        sides = [(1, *runs(core)), (0, *runs(core == 0))]
        count = sum(s[1].size for s in sides)
        return {
            "image_id": np.full(count, row["image_id"], np.int64),
            "y": np.concatenate([s[1] for s in sides]).astype(np.int32) + np.int32(row["y0"]),
            "v": np.concatenate([np.full(s[1].size, s[0], np.int32) for s in sides]),
            "x0": np.concatenate([s[2] for s in sides]).astype(np.int32),
            "x1": np.concatenate([s[3] for s in sides]).astype(np.int32),
        }

    schema = "image_id bigint, y int, v int, x0 int, x1 int"
    return map_rows(masks.select(*GEOMETRY_NAMES, "data"), encode, schema)


def runs_from_pixels(pixels: DataFrame, flag: str) -> DataFrame:
    """The same runs from pixel rows, as gaps and islands; a window is one image row."""
    line = Window.partitionBy("image_id", "y")
    island = F.row_number().over(line.orderBy("x")) - F.row_number().over(
        Window.partitionBy("image_id", "y", flag).orderBy("x")
    )
    grouped = pixels.withColumn("island", island).groupBy("image_id", "y", F.col(flag).alias("v"), "island")
    return grouped.agg(F.min("x").alias("x0"), F.max("x").alias("x1")).drop("island")


def touching_runs(run_rows: DataFrame, reach: int = 1, bucket: int = 16) -> DataFrame:
    """Pairs of foreground runs in adjacent rows that touch.

    Runs are spread over x buckets first, so a crowded row never pairs all its
    runs with all runs of the next; a pair counts in the bucket where it starts.
    """
    own = run_rows.filter("v = 1")
    bucket_of = lambda c: F.floor(c / bucket).cast("int")
    upper = own.select("image_id", "y", F.col("x0").alias("ux0"), F.col("x1").alias("ux1")).withColumn(
        "cell", F.explode(F.sequence(bucket_of(F.col("ux0") - reach), bucket_of(F.col("ux1") + reach)))
    )
    lower = own.select("image_id", (F.col("y") - 1).alias("y"), F.col("x0").alias("lx0"), F.col("x1").alias("lx1"))
    lower = lower.withColumn("cell", F.explode(F.sequence(bucket_of(F.col("lx0")), bucket_of(F.col("lx1")))))
    touch = (F.col("lx0") <= F.col("ux1") + reach) & (F.col("lx1") >= F.col("ux0") - reach)
    start = bucket_of(F.greatest(F.col("ux0") - reach, F.col("lx0")))
    # estimates cannot see how many runs a band holds
    pairs = upper.join(lower.hint("merge"), ["image_id", "y", "cell"]).filter(touch & (F.col("cell") == start))
    return pairs.select("image_id", "y", "ux0", "ux1", "lx0", "lx1")
