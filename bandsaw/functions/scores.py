"""Segmentation scores from the counts tp, fp, fn, tn."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCORES = ("iou", "dice", "precision", "recall", "pixel_accuracy")


def _or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def iou() -> Column:
    """Intersection over union; 0 when both masks are empty."""
    return _or_zero(F.col("tp"), F.col("tp") + F.col("fp") + F.col("fn"))


def dice(undefined: str = "null") -> Column:
    """Dice coefficient; null (or NaN on request) when both masks are empty."""
    value = F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    return F.coalesce(value, F.lit(float("nan"))) if undefined == "nan" else value


def precision() -> Column:
    return _or_zero(F.col("tp"), F.col("tp") + F.col("fp"))


def recall() -> Column:
    return _or_zero(F.col("tp"), F.col("tp") + F.col("fn"))


def pixel_accuracy() -> Column:
    """Share of pixels on which the two masks agree."""
    return F.try_divide(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))


def pixel_accuracy_raw() -> Column:
    """Share of pixels whose raw mask value equals the 0/1 prediction (255 never does)."""
    return F.try_divide(F.col("same_raw"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))


def four_decimals(value: Column) -> Column:
    return F.format_number(value, 4)


def hours_minutes_seconds(seconds: Column) -> Column:
    """``1h: 27m: 35.00s``"""
    whole = F.floor(seconds / 3600)
    minutes = F.floor((seconds - whole * 3600) / 60)
    rest = seconds - whole * 3600 - minutes * 60
    return F.format_string("%dh: %dm: %.2fs", whole, minutes, rest.cast("double"))
