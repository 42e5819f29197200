"""Array arithmetic for one band. Every function sees a bounded block of rows.

Arrays are uint8, shaped (rows, width) or (rows, width, 3) in B, G, R order.
``top`` / ``bottom`` say whether the block's first / last row is the real image
frame; where it is not, the block carries halo rows, and a neighbourhood
operator returns that many rows less on that side.
"""

from __future__ import annotations

from functools import cache, lru_cache

import numpy as np

# 8-bit gray weights for B, G, R (15-bit fixed point).
GRAY_B, GRAY_G, GRAY_R = 3735, 19235, 9798
# sRGB to XYZ (D65) rows for R, G, B, and the white point.
XYZ_R = (0.412453, 0.212671, 0.019334)
XYZ_G = (0.357580, 0.715160, 0.119193)
XYZ_B = (0.180423, 0.072169, 0.950227)
WHITE_X, WHITE_Z = 0.950456, 1.088754


def gray(bgr: np.ndarray) -> np.ndarray:
    b, g, r = (bgr[..., i].astype(np.uint32) for i in range(3))
    return ((GRAY_B * b + GRAY_G * g + GRAY_R * r + 16384) >> 15).astype(np.uint8)


@cache
def _linear_light() -> np.ndarray:
    scale = [v / 255.0 for v in range(256)]
    return np.array([((c + 0.055) / 1.055) ** 2.4 if c > 0.04045 else c / 12.92 for c in scale])


def _lab_curve(t: np.ndarray) -> np.ndarray:
    return np.where(t > 0.008856, np.cbrt(t), 7.787 * t + 16.0 / 116.0)


def _lab_colours(b: np.ndarray, g: np.ndarray, r: np.ndarray) -> np.ndarray:
    light = _linear_light()
    rl, gl, bl = light[r], light[g], light[b]
    x = (XYZ_R[0] * rl + XYZ_G[0] * gl + XYZ_B[0] * bl) / WHITE_X
    y = XYZ_R[1] * rl + XYZ_G[1] * gl + XYZ_B[1] * bl
    z = (XYZ_R[2] * rl + XYZ_G[2] * gl + XYZ_B[2] * bl) / WHITE_Z
    lum = np.where(y > 0.008856, 116.0 * np.cbrt(y) - 16.0, 903.3 * y)
    fx, fy, fz = _lab_curve(x), _lab_curve(y), _lab_curve(z)
    lab = np.stack([lum * 255.0 / 100.0, 500.0 * (fx - fy) + 128.0, 200.0 * (fy - fz) + 128.0], axis=-1)
    return np.clip(np.floor(lab + 0.5), 0, 255).astype(np.uint8)


class PerTask(dict):
    """A cache that travels empty, so that a job never carries the driver's entries."""

    def __reduce__(self):
        return PerTask, ()


_SCRATCH = PerTask()


def _colour_table() -> np.ndarray:
    """Scratch space with one entry per colour; entries are written before they are read."""
    if "colours" not in _SCRATCH:
        _SCRATCH["colours"] = np.empty(1 << 24, np.int32)
    return _SCRATCH["colours"]


def _distinct_colours(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct packed colours of a block and, per pixel, the index of its colour.

    Each colour keeps the last pixel that has it, which picks one pixel per
    colour without sorting the pixels.
    """
    flat = block[..., 0].astype(np.int32).ravel() << 16
    flat |= block[..., 1].astype(np.int32).ravel() << 8
    flat |= block[..., 2].ravel()
    table, index = _colour_table(), np.arange(flat.size, dtype=np.int32)
    table[flat] = index
    colours = np.sort(flat[table[flat] == index])
    table[colours] = np.arange(colours.size, dtype=np.int32)
    return colours, table[flat]


def _lab_of(packed: np.ndarray) -> np.ndarray:
    return _lab_colours(packed >> 16, (packed >> 8) & 255, packed & 255)


def lab(bgr: np.ndarray) -> np.ndarray:
    """8-bit L*a*b*, worked out once per distinct colour."""
    colours, where = _distinct_colours(bgr)
    return _lab_of(colours)[where].reshape(bgr.shape)


def lab_histogram(bgr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """L*a*b* values of the distinct colours and their counts; values may repeat."""
    colours, where = _distinct_colours(bgr)
    return _lab_of(colours), np.bincount(where, minlength=colours.size)


def lab_to_bgr(lab8: np.ndarray) -> np.ndarray:
    """Back from 8-bit L*a*b* to 8-bit B, G, R, once per distinct colour."""
    colours, where = _distinct_colours(lab8)
    lum = (colours >> 16) * 100.0 / 255.0
    fy = np.where(lum > 8.0, (lum + 16.0) / 116.0, 7.787 * lum / 903.3 + 16.0 / 116.0)
    fx = fy + (((colours >> 8) & 255) - 128.0) / 500.0
    fz = fy - ((colours & 255) - 128.0) / 200.0
    edge = np.cbrt(0.008856)
    x, y, z = (np.where(f > edge, f**3, (f - 16.0 / 116.0) / 7.787) for f in (fx, fy, fz))
    inverse = np.linalg.inv(np.array([XYZ_R, XYZ_G, XYZ_B]).T)
    rgb = inverse @ np.stack([x * WHITE_X, y, z * WHITE_Z])
    rgb = np.clip(rgb, 0.0, 1.0)
    rgb = np.where(rgb > 0.0031308, 1.055 * rgb ** (1 / 2.4) - 0.055, 12.92 * rgb)
    bgr = np.floor(rgb[::-1].T * 255.0 + 0.5).astype(np.uint8)
    return bgr[where].reshape(lab8.shape)


def histogram(block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct colours of a three-channel block and how often each occurs."""
    colours, where = _distinct_colours(block)
    counts = np.bincount(where.ravel(), minlength=colours.size)
    return colours >> 16, (colours >> 8) & 255, colours & 255, counts


def lab_labels(bgr: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Index of the nearest L*a*b* centre per pixel; ties go to the lower index."""
    colours, where = _distinct_colours(bgr)
    channels = _lab_of(colours).T.astype(float)
    distance = [sum((v - c) * (v - c) for v, c in zip(channels, centre)) for centre in centres]
    return np.argmin(np.stack(distance), axis=0).astype(np.uint8)[where].reshape(bgr.shape[:2])


@lru_cache(maxsize=64)
def _reflected(n: int, before: int, after: int) -> np.ndarray:
    """Index of each row or column of a reflected frame."""
    return np.pad(np.arange(n), (before, after), mode="reflect")


def gaussian5(block: np.ndarray, top: bool, bottom: bool) -> np.ndarray:
    """5x5 Gaussian blur, reflected frame, one rounding at the end."""
    rows = _reflected(block.shape[0], 2 if top else 0, 2 if bottom else 0)
    a = block[rows[:, None], _reflected(block.shape[1], 2, 2)].astype(np.uint16)
    h = a[:, :-4] + a[:, 4:] + 4 * (a[:, 1:-3] + a[:, 3:-1]) + 6 * a[:, 2:-2]
    v = h[:-4] + h[4:] + 4 * (h[1:-3] + h[3:-1]) + 6 * h[2:-2]
    return ((v + 128) >> 8).astype(np.uint8)


def _box5(mask: np.ndarray, pick, neutral: int, top: bool, bottom: bool) -> np.ndarray:
    above, below = 2 if top else 0, 2 if bottom else 0
    a = np.full((mask.shape[0] + above + below, mask.shape[1] + 4), neutral, mask.dtype)
    a[above : above + mask.shape[0], 2:-2] = mask
    h = pick(pick(a[:, :-4], a[:, 4:]), pick(pick(a[:, 1:-3], a[:, 3:-1]), a[:, 2:-2]))
    return pick(pick(h[:-4], h[4:]), pick(pick(h[1:-3], h[3:-1]), h[2:-2]))


def erode5(mask: np.ndarray, top: bool, bottom: bool) -> np.ndarray:
    return _box5(mask, np.minimum, 255, top, bottom)


def dilate5(mask: np.ndarray, top: bool, bottom: bool) -> np.ndarray:
    return _box5(mask, np.maximum, 0, top, bottom)


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal horizontal runs of non-zero pixels: row, first x, last x."""
    rows, width = mask.shape
    edge = np.zeros((rows, width + 2), np.int8)
    edge[:, 1:-1] = mask != 0
    step = np.diff(edge, axis=1)
    y, x0 = np.nonzero(step == 1)
    _, end = np.nonzero(step == -1)
    return y, x0, end - 1


def smallest_index(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Per node 0..n-1 the smallest node connected to it, by hooking and pointer jumping."""
    label = np.arange(n)
    while u.size:
        low = np.minimum(label[u], label[v])
        high = np.maximum(label[u], label[v])
        apart = low != high
        if not apart.any():
            break
        u, v = u[apart], v[apart]
        np.minimum.at(label, high[apart], low[apart])
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
    return label


def label_runs(y: np.ndarray, x0: np.ndarray, x1: np.ndarray, width: int, reach: int) -> np.ndarray:
    """Component of each run, as the index of the component's first run.

    ``reach`` is 1 when diagonal neighbours connect and 0 when they do not.
    Overlapping runs of adjacent rows are found by binary search.
    """
    stride = width + 4
    first = np.searchsorted(y * stride + x1, (y + 1) * stride + x0 - reach)
    last = np.searchsorted(y * stride + x0, (y + 1) * stride + x1 + reach, side="right")
    degree = np.maximum(last - first, 0)
    upper = np.repeat(np.arange(y.size), degree)
    lower = np.arange(degree.sum()) - np.repeat(np.cumsum(degree) - degree, degree) + np.repeat(first, degree)
    return smallest_index(y.size, upper, lower)


def paint_runs(shape: tuple[int, int], y: np.ndarray, x0: np.ndarray, x1: np.ndarray) -> np.ndarray:
    """The 0/1 mask that is set on the given runs."""
    rows, width = shape
    step = np.zeros(rows * (width + 1) + 1, np.int8)
    step[y * (width + 1) + x0] += 1  # starts are distinct, and so are ends
    step[y * (width + 1) + x1 + 1] -= 1
    return np.cumsum(step[:-1], dtype=np.int8).reshape(rows, width + 1)[:, :width].astype(np.uint8)


def corner_area(mask: np.ndarray) -> np.ndarray:
    """Doubled contour area of each 2x2 window: 2 for four set pixels, 1 for three."""
    m = (mask != 0).astype(np.int8)
    four = m[:-1, :-1] + m[:-1, 1:] + m[1:, :-1] + m[1:, 1:]
    return np.maximum(four - 2, 0)
