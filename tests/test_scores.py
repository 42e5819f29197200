import math

import pytest
from pyspark.sql import functions as F

from bandsaw.functions import scores
from bandsaw.operators import evaluate

COUNTS = "image_id long, category string, tp long, fp long, fn long, tn long, same_raw long"
ROWS = [(0, "benign", 5, 1, 2, 92, 92), (1, "normal", 0, 0, 0, 100, 100), (2, "normal", 0, 4, 0, 96, 96)]


def test_scores_and_empty_masks(spark):
    got = {r.image_id: r for r in evaluate.score(spark.createDataFrame(ROWS, COUNTS)).collect()}
    assert got[0].iou == 5 / 8 and got[0].dice == 10 / 13
    assert got[0].precision == 5 / 6 and got[0].recall == 5 / 7 and got[0].pixel_accuracy == 0.97
    assert (got[1].iou, got[1].dice, got[1].precision, got[1].recall) == (0.0, None, 0.0, 0.0)
    assert got[2].dice == 0.0
    nan = evaluate.score(spark.createDataFrame(ROWS, COUNTS), undefined="nan").filter("image_id = 1").first()
    assert math.isnan(nan.dice)


def test_rollup(spark):
    scored = evaluate.score(spark.createDataFrame(ROWS, COUNTS))
    got = {r.category: r for r in evaluate.rollup_summary(scored).collect()}
    assert got[None].n == 3 and got["normal"].n == 2
    assert got[None].n_undefined == 1 and got[None].n_empty == 1
    assert got[None].iou == pytest.approx(5 / 24) and evaluate.summary(scored).first().n == 3


def test_confusion_from_rows(spark):
    rows = spark.createDataFrame([("a", 255, 255), ("a", 128, 0), ("a", 0, 255), ("a", 0, 0)], "g string, t int, p int")
    got = evaluate.confusion(rows, ["g"], F.col("t"), F.col("p")).first()
    assert (got.tp, got.fp, got.fn, got.tn, got.same_raw) == (1, 1, 1, 1, 1)


def test_sample_is_repeatable(spark):
    df = spark.range(100).withColumnRenamed("id", "image_id")
    first = [r.image_id for r in evaluate.sample_results(df).collect()]
    assert first == [r.image_id for r in evaluate.sample_results(df).collect()] and len(set(first)) == 10
    assert evaluate.sample_results(df.limit(4)).count() == 4


def test_text(spark):
    row = spark.range(1).select(
        scores.hours_minutes_seconds(F.lit(5255.5)).alias("t"), scores.four_decimals(F.lit(0.12345)).alias("f")
    ).first()
    assert (row.t, row.f) == ("1h: 27m: 35.50s", "0.1234") or row.f == "0.1235"
