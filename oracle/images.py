"""Images drawn from the whole ``supplier`` table: one 64 x 64 image and mask per row."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandsaw.operators.bands import map_rows

SIDE = 64
SCHEMA = "image_id bigint, height int, width int, n_channels int, data binary"


def _shape(i: int, s: int):
    y, x = np.mgrid[0:SIDE, 0:SIDE].astype(np.int64)
    noise = (x * 7 + y * 13 + i * 31) % 40
    tissue = (x - 32) ** 2 + (y - 32) ** 2
    lesion = (x - 24 - s % 5) ** 2 + (y - 26 - i % 5) ** 2
    spot = (x - 46) ** 2 + (y - 44) ** 2
    truth = (x - 25 - s % 5) ** 2 + (y - 27 - i % 5) ** 2
    radius = (13 + i % 4) ** 2
    return noise, tissue, lesion, spot, truth, radius


def _draw(row: dict) -> dict:
    i, s = row["s_suppkey"], row["s_nationkey"]
    noise, tissue, lesion, spot, _, radius = _shape(i, s)
    v = np.where(tissue <= 900, 140 + (noise >> 1), 20 + noise)
    v = np.where((lesion <= radius) | (spot <= 16 + (s % 3) * 9), 220 + (noise >> 2), v)
    v = np.where(lesion <= 16, 60, v)
    r = np.minimum(255, v + (i % 3) * 8)
    bgr = np.stack([v, v, r], axis=-1).astype(np.uint8)
    return {"image_id": [i], "height": [SIDE], "width": [SIDE], "n_channels": [3], "data": [bgr.tobytes()]}


def _draw_mask(row: dict) -> dict:
    i, s = row["s_suppkey"], row["s_nationkey"]
    *_, truth, radius = _shape(i, s)
    m = np.where(truth <= radius, 255, np.where(truth <= radius + 26, 128, 0))
    m = np.zeros_like(m) if i % 3 == 2 else m
    return {"image_id": [i], "height": [SIDE], "width": [SIDE], "n_channels": [1], "data": [m.astype(np.uint8).tobytes()]}


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_nationkey")
    return keys.repartition(spark.sparkContext.defaultParallelism, "s_suppkey")


def fixture_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_rows(_keys(spark, sf_dir), _draw, SCHEMA)


def fixture_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_rows(_keys(spark, sf_dir), _draw_mask, SCHEMA)


def category_of(image_id: str = "image_id"):
    kind = F.pmod(F.col(image_id), F.lit(3))
    return F.when(kind == 0, "benign").when(kind == 1, "malignant").otherwise("normal")
