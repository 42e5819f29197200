"""Resampling of bands to a fixed size, as weighted sums that add up over bands.

Filters stretch with the reduction factor (antialiasing). Weights are 22-bit
integers; columns are resampled and rounded first, then rows. Each band adds its
own rows' share, so the result does not depend on how the image was cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, pi, sin

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from bandsaw.operators.bands import (
    BANDS,
    FLUSH_BYTES,
    GEOMETRY_NAMES,
    band_count,
    block,
    carried,
    map_rows,
    rows_of,
    trim,
    with_per_image,
)
from bandsaw.operators.kernels import PerTask
from bandsaw.session import shuffle_partitions

BITS = 22


def _cubic(x: float) -> float:
    x, a = abs(x), -0.5
    if x < 1:
        return ((a + 2) * x - (a + 3)) * x * x + 1
    return (((x - 5) * x + 8) * x - 4) * a if x < 2 else 0.0


def _sinc(x: float) -> float:
    return sin(pi * x) / (pi * x) if x else 1.0


# Filter shapes and how far they reach.
FILTERS = {
    "area": (lambda x: 1.0 if -0.5 < x <= 0.5 else 0.0, 0.5),
    "bilinear": (lambda x: max(0.0, 1.0 - abs(x)), 1.0),
    "bicubic": (_cubic, 2.0),
    "lanczos": (lambda x: _sinc(x) * _sinc(x / 3) if -3 <= x < 3 else 0.0, 3.0),
}


_WEIGHTS = PerTask()


def weights(source: int, target: int, method: str) -> np.ndarray:
    """(target, taps, 2): source index and integer weight of each tap."""
    key = (source, target, method)
    if key not in _WEIGHTS:
        if len(_WEIGHTS) >= 64:
            _WEIGHTS.clear()
        _WEIGHTS[key] = _weights(*key)
    return _WEIGHTS[key]


def _weights(source: int, target: int, method: str) -> np.ndarray:
    if method == "nearest":
        at = np.arange(target) * source // target
        return np.stack([at, np.full(target, 1 << BITS)], axis=-1)[:, None, :]
    shape, reach = FILTERS[method]
    ratio = source / target
    stretch = max(ratio, 1.0)
    reach *= stretch
    taps = np.zeros((target, ceil(reach) * 2 + 1, 2), np.int64)
    for t in range(target):
        centre = (t + 0.5) * ratio
        low = max(0, int(centre - reach + 0.5))
        high = min(source, int(centre + reach + 0.5))
        w = np.array([shape((s - centre + 0.5) / stretch) for s in range(low, high)])
        w = w / w.sum() * (1 << BITS)
        taps[t, : high - low, 0] = np.arange(low, high)
        taps[t, : high - low, 1] = np.where(w < 0, np.ceil(w - 0.5), np.floor(w + 0.5))
    return taps


def _rounded(sums: np.ndarray) -> np.ndarray:
    return np.clip((sums + (1 << (BITS - 1))) >> BITS, 0, 255).astype(np.uint8)


def _columns(core: np.ndarray, target: int, method: str) -> np.ndarray:
    """Resample every row to ``target`` columns."""
    taps = weights(core.shape[1], target, method)
    out = np.zeros((core.shape[0], target, core.shape[2]), np.int64)
    for j in range(taps.shape[1]):
        out += core[:, taps[:, j, 0]].astype(np.int64) * taps[:, j, 1][:, None]
    return _rounded(out)


def _row_sums(core: np.ndarray, y0: int, height: int, target: int, method: str) -> tuple[int, np.ndarray]:
    """First target row touched by these source rows, and the share of each."""
    taps = weights(height, target, method)
    own = (taps[..., 0] >= y0) & (taps[..., 0] < y0 + core.shape[0]) & (taps[..., 1] != 0)
    touched = np.flatnonzero(own.any(axis=1))
    if touched.size == 0:
        return 0, np.zeros((0, *core.shape[1:]), np.int64)
    first, last = touched[0], touched[-1] + 1
    out = np.zeros((last - first, *core.shape[1:]), np.int64)
    for j in range(taps.shape[1]):
        use = own[first:last, j]
        rows, factor = taps[first:last, j, 0][use] - y0, taps[first:last, j, 1][use]
        out[use] += core[rows].astype(np.int64) * factor[:, None, None]
    return int(first), out


def resize_to(
    bands: DataFrame, sizes: DataFrame, method: str = "bicubic", rows: int | None = None, channels: int = 3
) -> DataFrame:
    """Resize every image to its own target; ``sizes`` has image_id, height, width.

    A band is resampled where it is and sends pieces of the target's bands: final
    pixels if it is the whole image, else sums that add up over the bands. The
    input is read once for both.
    """
    targets = sizes.select("image_id", F.col("height").alias("t_height"), F.col("width").alias("t_width"))
    return _resize(with_per_image(bands, targets), method, rows, channels, ())


def resize(
    bands: DataFrame,
    height: int,
    width: int,
    method: str = "bicubic",
    rows: int | None = None,
    channels: int = 3,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Resize every image to one fixed size, ignoring the aspect ratio."""
    sized = bands.withColumns({"t_height": F.lit(height), "t_width": F.lit(width)})
    return _resize(sized, method, rows, channels, carry)


def _resize(sized: DataFrame, method: str, rows: int | None, channels: int, carry: tuple[str, ...]) -> DataFrame:
    if method != "nearest" and method not in FILTERS:
        raise ValueError(f"unknown resize method {method!r}")
    sized = sized.select(*GEOMETRY_NAMES, "data", "t_height", "t_width", *carry)
    piece = "image_id bigint, part int, height int, width int, first int, whole boolean, data binary" + carried(carry)

    def pieces(row: dict) -> dict:
        height, width = row["t_height"], row["t_width"]
        core = trim(row, block(row))
        columns = _columns(core.reshape(*core.shape[:2], channels), width, method)
        whole = row["bands"] == 1
        first, sums = _row_sums(columns, 0 if whole else row["y0"], row["height"], height, method)
        values = _rounded(sums) if whole else sums
        n = band_count(height, width, rows, 0)
        out: dict[str, list] = {name: [] for name in ("image_id", "part", "height", "width", "first", "whole", "data", *carry)}
        for part in range(n):
            y0, y1 = part * height // n, (part + 1) * height // n
            start, stop = max(first, y0), min(first + len(values), y1)
            if start < stop:
                data = values[start - first : stop - first].tobytes()
                for name, value in zip(out, [row["image_id"], part, height, width, start, whole, data, *[row[c] for c in carry]], strict=True):
                    out[name].append(value)
        return out

    struct = T.StructType.fromDDL(BANDS + carried(carry))
    arrow = to_arrow_schema(struct)

    def band(row: dict, data: bytes) -> dict:
        height, n, part = row["height"], band_count(row["height"], row["width"], rows, 0), row["part"]
        y0, y1 = part * height // n, (part + 1) * height // n
        values = [row["image_id"], part, n, height, row["width"], y0, y1, y0, y1, data, *[row[c] for c in carry]]
        return dict(zip(struct.names, values, strict=True))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces in order of (image, part): final ones pass, sums of a part are added up."""
        done: list[dict] = []
        size = 0
        open_ = total = None
        for row in rows_of(batches):
            if open_ and (row["image_id"], row["part"]) != (open_["image_id"], open_["part"]):
                done.append(band(open_, _rounded(total).tobytes()))
                open_ = None
            if row["whole"]:
                done.append(band(row, row["data"]))
            else:
                share = np.frombuffer(row["data"], np.int64).reshape(-1, row["width"], channels)
                if open_ is None:
                    open_, total = row, np.zeros((_part_rows(row, rows)[1], row["width"], channels), np.int64)
                at = row["first"] - _part_rows(row, rows)[0]
                total[at : at + len(share)] += share
            size += len(row["data"])
            if size >= FLUSH_BYTES:
                yield pa.RecordBatch.from_pylist(done, schema=arrow)
                done, size = [], 0
        if open_:
            done.append(band(open_, _rounded(total).tobytes()))
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=arrow)

    parts = shuffle_partitions(sized.sparkSession)
    placed = map_rows(sized, pieces, piece).repartition(parts, "image_id", "part").sortWithinPartitions("image_id", "part")
    return placed.mapInArrow(merge, struct)


def _part_rows(row: dict, rows: int | None) -> tuple[int, int]:
    """(first row, number of rows) of a piece's target band."""
    n = band_count(row["height"], row["width"], rows, 0)
    first = row["part"] * row["height"] // n
    return first, (row["part"] + 1) * row["height"] // n - first
