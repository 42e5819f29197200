"""Neighbourhood operators on bands. Each uses up two halo rows per pass."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from bandsaw.operators.bands import map_block
from bandsaw.operators.kernels import dilate5, erode5, gaussian5, gray


def gaussian_blur(bands: DataFrame) -> DataFrame:
    """5x5 Gaussian blur of colour bands."""
    return map_block(bands, gaussian5, reach=2)


def erode(masks: DataFrame) -> DataFrame:
    """5x5 box erosion; outside the image is neutral."""
    return map_block(masks, erode5, reach=2)


def dilate(masks: DataFrame) -> DataFrame:
    """5x5 box dilation; outside the image is neutral."""
    return map_block(masks, dilate5, reach=2)


def open_mask(masks: DataFrame) -> DataFrame:
    return dilate(erode(masks))


def close_mask(masks: DataFrame) -> DataFrame:
    return erode(dilate(masks))


def threshold(bands: DataFrame, level: int) -> DataFrame:
    """{0, 255} mask of the pixels whose gray value is above ``level``."""

    def binary(a: np.ndarray, top: bool, bottom: bool) -> np.ndarray:
        values = gray(a) if a.ndim == 3 else a
        return np.where(values > level, np.uint8(255), np.uint8(0))

    return map_block(bands, binary)
