"""Column functions on pixel rows (b, g, r as ints)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bandsaw.operators.kernels import GRAY_B, GRAY_G, GRAY_R, WHITE_X, WHITE_Z, XYZ_B, XYZ_G, XYZ_R


def gray(b: Column, g: Column, r: Column) -> Column:
    """8-bit gray in 15-bit fixed point."""
    return F.shiftright(GRAY_B * b + GRAY_G * g + GRAY_R * r + 16384, 15)


def above(value: Column, level: int) -> Column:
    """255 where ``value`` is above ``level``, else 0."""
    return F.when(value > level, 255).otherwise(0)


def masked(channel: Column, mask: Column) -> Column:
    """The channel where the mask is set, else 0."""
    return F.when(mask > 0, channel).otherwise(0)


def _linear(c: Column) -> Column:
    v = c / F.lit(255.0)
    return F.when(v > 0.04045, F.pow((v + F.lit(0.055)) / F.lit(1.055), F.lit(2.4))).otherwise(v / F.lit(12.92))


def _curve(t: Column) -> Column:
    return F.when(t > 0.008856, F.cbrt(t)).otherwise(F.lit(7.787) * t + F.lit(16.0 / 116.0))


def lab(b: Column, g: Column, r: Column) -> Column:
    """8-bit L*a*b* as a struct (c0, c1, c2). Use it on distinct colours."""
    rl, gl, bl = _linear(r), _linear(g), _linear(b)
    x, y, z = (F.lit(XYZ_R[i]) * rl + F.lit(XYZ_G[i]) * gl + F.lit(XYZ_B[i]) * bl for i in range(3))
    x, z = x / F.lit(WHITE_X), z / F.lit(WHITE_Z)
    lum = F.when(y > 0.008856, F.lit(116.0) * F.cbrt(y) - F.lit(16.0)).otherwise(F.lit(903.3) * y)
    values = [
        lum * F.lit(255.0) / F.lit(100.0),
        F.lit(500.0) * (_curve(x) - _curve(y)) + F.lit(128.0),
        F.lit(200.0) * (_curve(y) - _curve(z)) + F.lit(128.0),
    ]
    clipped = [F.least(F.greatest(F.floor(v + F.lit(0.5)).cast("int"), F.lit(0)), F.lit(255)) for v in values]
    return F.struct(*[v.alias(f"c{i}") for i, v in enumerate(clipped)])
