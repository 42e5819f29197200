"""Scores of predicted masks against true masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandsaw.functions import scores
from bandsaw.operators.bands import GEOMETRY_NAMES, KEY, block, map_rows, recut, spread, trim
from bandsaw.operators.resize import resize_to
from bandsaw.session import cached, cut_lineage

COUNTS = ("tp", "fp", "fn", "tn")


def confusion(rows: DataFrame, by: list[str], truth: Column, predicted: Column) -> DataFrame:
    """Counts per group from rows that hold both flags (non-zero is foreground)."""
    t, p = truth > 0, predicted > 0
    return rows.groupBy(*by).agg(
        F.count_if(t & p).alias("tp"),
        F.count_if(~t & p).alias("fp"),
        F.count_if(t & ~p).alias("fn"),
        F.count_if(~t & ~p).alias("tn"),
        F.count_if(truth == p.cast("int")).alias("same_raw"),
    )


def pixel_pairs(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """Join two pixel tables of masks (image_id, y, x, m) on the pixel.

    ``confusion_of_masks`` compares bands and moves a thousandth of the rows.
    """
    # estimates cannot see how many pixels a file holds
    return truth.join(predicted.withColumnRenamed("m", "p").hint("merge"), ["image_id", "y", "x"])


def _band_counts(pairs: DataFrame) -> DataFrame:
    def count(row: dict) -> dict:
        if any(row[n] != row[f"t_{n}"] for n in ("height", "width", "y0", "y1")):
            raise ValueError(f"bands of image {row['image_id']} are cut differently")
        held = {**row, "e0": row["te0"], "e1": row["te1"]}
        t = trim(held, block(held, "truth"))
        p = trim(row, block(row)) > 0
        on = t > 0
        tp, n_true, n_pred = int((on & p).sum()), int(on.sum()), int(p.sum())
        return {
            "image_id": [row["image_id"]],
            "tp": [tp],
            "fp": [n_pred - tp],
            "fn": [n_true - tp],
            "tn": [p.size - n_true - n_pred + tp],
            "same_raw": [int((t == p).sum())],
            "pixels": [row["height"] * row["width"]],
        }

    schema = "image_id bigint, tp bigint, fp bigint, fn bigint, tn bigint, same_raw bigint, pixels bigint"
    counted = map_rows(pairs, count, schema)
    sums = counted.groupBy("image_id").agg(*[F.sum(c).alias(c) for c in (*COUNTS, "same_raw")], F.max("pixels").alias("pixels"))
    whole = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn") == F.col("pixels")
    lost = F.raise_error(F.format_string("image %d: a band has no partner", "image_id")).cast("bigint")
    return sums.withColumn("tp", F.when(whole, F.col("tp")).otherwise(lost)).drop("pixels")


def _paired(predicted: DataFrame, truth: DataFrame) -> DataFrame:
    other = truth.select(
        *KEY,
        F.col("height").alias("t_height"),
        F.col("width").alias("t_width"),
        F.col("y0").alias("t_y0"),
        F.col("y1").alias("t_y1"),
        F.col("e0").alias("te0"),
        F.col("e1").alias("te1"),
        F.col("data").alias("truth"),
    )
    # on the key alone, which both sides are spread by; geometry is compared in the map.
    # Both sides hold pixel bytes: a merge join spills, and it keeps the plan from starting over
    return predicted.select(*GEOMETRY_NAMES, "data").join(other.hint("merge"), KEY)


def confusion_of_masks(
    predicted: DataFrame, truth: DataFrame, rows: int | None = None, sizes: DataFrame | None = None
) -> DataFrame:
    """Counts per image from mask bands.

    Bands of equal images that are cut alike meet on (image, band). Images cut
    otherwise are cut again, both sides by ``rows``; predictions whose size
    differs from their true mask are resized to it first (nearest). Every pixel
    must find its partner, or the job fails. ``sizes`` (image_id, height, width,
    bands of the predictions) saves a pass.
    """
    shape = ["image_id", "height", "width", "bands"]
    truth = cached(spread(truth))
    if sizes is None:
        predicted = cached(predicted)
        sizes = predicted.filter("band = 0").select(*shape)
    wanted = truth.filter("band = 0").select(*shape)
    known = sizes.select("image_id", *[F.col(c).alias(f"p_{c}") for c in shape[1:]])
    other_size = F.expr("height <> p_height OR width <> p_width")
    odd = wanted.join(known, "image_id").filter(other_size | F.expr("bands <> p_bands"))
    odd = cut_lineage(odd.select("image_id", "height", "width", other_size.alias("other_size")))
    found = {r.other_size for r in odd.select("other_size").distinct().collect()}
    if not found:
        return _band_counts(_paired(predicted, truth))
    odd_ids = odd.select("image_id")
    counts = _band_counts(_paired(predicted, truth.join(odd_ids, "image_id", "left_anti")))
    for resized in sorted(found):
        some = odd.filter(F.col("other_size") == resized)
        ids = some.select("image_id")
        mine = predicted.join(ids, "image_id", "left_semi")
        mine = resize_to(mine, some, "nearest", rows, channels=1) if resized else recut(mine, rows, 0)
        counts = counts.unionByName(_band_counts(_paired(mine, recut(truth.join(ids, "image_id", "left_semi"), rows, 0))))
    return counts


def score(counts: DataFrame, undefined: str = "null") -> DataFrame:
    """Add the five scores and the raw pixel accuracy to a table of counts."""
    return counts.select(
        "*",
        scores.iou().alias("iou"),
        scores.dice(undefined).alias("dice"),
        scores.precision().alias("precision"),
        scores.recall().alias("recall"),
        scores.pixel_accuracy().alias("pixel_accuracy"),
        scores.pixel_accuracy_raw().alias("pixel_accuracy_raw"),
    )


def _means() -> list[Column]:
    empty = (F.col("tp") + F.col("fn") + F.col("fp")) == 0
    return [
        F.count("*").alias("n"),
        F.count_if(F.col("dice").isNull() | F.isnan("dice")).alias("n_undefined"),
        F.count_if(empty).alias("n_empty"),
        *[F.avg(s).alias(s) for s in scores.SCORES],
    ]


def summary(scored: DataFrame) -> DataFrame:
    """Means over all images, each image with equal weight."""
    return scored.agg(*_means())


def rollup_summary(scored: DataFrame, by: str = "category") -> DataFrame:
    """Means per class and overall (class null) in one pass."""
    return scored.rollup(by).agg(*_means())


def sample_results(scored: DataFrame, n: int = 10, seed: int = 42) -> DataFrame:
    """A repeatable random sample of up to ``n`` results."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col("image_id").cast("string")).cast("binary"))
    return scored.orderBy(order, "image_id").limit(n)
