"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

images over the time of the whole segmentation pipeline with scores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

ENLARGED = "segment_scores_512"
HEADLINE = [
    "segment_scores",
    ENLARGED,
    "segment_scores_banded",
    "segment_mask",
    "roi",
    "gaussian_blur",
    "open",
    "postprocess",
    "external_components",
    "colour_histogram",
    "kmeans_centres",
    "resize_100",
    "confusion_bands",
    "rename_manifest",
    "pair_masks",
]


def enlarged(spark, sf_dir: str):
    """The flagship on the same images at 512 x 512, the size of real scans, with four bands each."""
    import numpy as np

    from bandsaw.operators import evaluate
    from bandsaw.operators.bands import map_rows, to_bands
    from bandsaw.plans.segment import segment
    from oracle.images import SCHEMA, fixture_images, fixture_masks

    def grow(row: dict) -> dict:
        a = np.frombuffer(row["data"], np.uint8).reshape(row["height"], row["width"], -1)
        a = a.repeat(8, axis=0).repeat(8, axis=1)
        kept = {n: [row[n]] for n in ("image_id", "n_channels")}
        return kept | {"height": [a.shape[0]], "width": [a.shape[1]], "data": [a.tobytes()]}

    images, masks = (map_rows(f(spark, sf_dir), grow, SCHEMA) for f in (fixture_images, fixture_masks))
    result = segment(images, band_rows=128)
    truth = to_bands(masks, 128, as_gray=True)
    return evaluate.score(evaluate.confusion_of_masks(result.masks, truth, 128, result.done))


def main() -> None:
    from pyspark.sql import SparkSession

    from oracle.images import SIDE
    from oracle.registry import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = os.environ.get("BENCH_QUERIES")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bandsaw-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")

    def run(name: str, folder: str) -> float:
        begin = time.perf_counter()
        query = enlarged if name == ENLARGED else QUERIES[name]
        query(spark, folder).write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - begin
        spark.catalog.clearCache()
        return took

    small = str(Path(sf_dir).parent / "sf0.01")
    chosen = names.split(",") if names else HEADLINE
    if Path(small).exists():
        run(chosen[0], small)  # start the JVM's and Python's workers once
    times = {name: round(run(name, sf_dir), 3) for name in chosen}
    images = spark.read.parquet(f"{sf_dir}/supplier.parquet").count()
    result = {
        "metric": "total time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": int(cpus),
        "images": images,
        "pixels": images * SIDE * SIDE,
    }
    if "segment_scores" in times:
        result["pixels_per_second"] = round(images * SIDE * SIDE / times["segment_scores"])
    if ENLARGED in times:
        result["pixels_per_second_512"] = round(images * 512 * 512 / times[ENLARGED])
    print(json.dumps(result))


if __name__ == "__main__":
    main()
