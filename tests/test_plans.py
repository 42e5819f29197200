"""What the physical plans must look like."""

import re

from pyspark.sql import functions as F

from bandsaw.operators.bands import spread, to_bands, with_per_image
from bandsaw.operators.components import with_choice
from oracle.images import fixture_images, fixture_masks

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pixel_bytes_are_shuffled_once(spark):
    held = spread(to_bands(fixture_images(spark, SF), 16)).persist()
    held.count()
    lists = held.select("image_id", "band", F.array(F.lit(1).cast("long")).alias("chosen")).distinct()
    per_image = held.filter("band = 0").select("image_id", F.lit(1.0).alias("k0_0"))
    joined = with_per_image(with_choice(held, lists), per_image)
    text = plan(joined).split("InMemoryRelation")[0]
    assert "SortMergeJoin" not in text
    # no exchange stands between the joins and the cached bands
    left = re.search(r"ShuffledHashJoin.*?\n(.*)", text, re.S).group(1)
    first_scan = left.index("InMemoryTableScan")
    assert "Exchange" not in left[:first_scan]


def test_scores_move_mask_bytes_once(spark):
    """Truth and prediction meet on (image, band) without another exchange of their bytes."""
    from bandsaw.operators.evaluate import _paired

    truth = spread(to_bands(fixture_masks(spark, SF), 16, as_gray=True)).persist()
    predicted = spread(to_bands(fixture_masks(spark, SF), 16, as_gray=True)).persist()
    truth.count(), predicted.count()
    text = plan(_paired(predicted, truth)).split("InMemoryRelation")
    assert "SortMergeJoin" in text[0] and "Exchange" not in text[0].split("InMemoryTableScan")[0]
    assert "BroadcastExchange" not in "".join(text)


def test_resize_reads_its_input_once(spark):
    from bandsaw.operators.resize import resize

    text = plan(resize(to_bands(fixture_images(spark, SF), 16), 32, 32))
    assert text.count("FileScan parquet") == 1


def test_a_manifest_selects_files_before_they_are_read(spark, tmp_path):
    from bandsaw.sources.images import read_images
    from oracle.trees import write_tree

    root = write_tree(spark, SF)
    some = read_images(spark, root, names=["scan 1.png", "scan 3.png"])
    assert {r.rel_path.rsplit("/", 1)[1] for r in some.select("rel_path").collect()} == {"scan 1.png", "scan 3.png"}
    assert "Join" not in plan(some)


def test_pixel_and_run_joins_do_not_broadcast(spark):
    from bandsaw.operators import components
    from bandsaw.operators.evaluate import pixel_pairs
    from oracle.registry import bright_of, mask_pixels

    masks = mask_pixels(spark, SF)
    for df in (pixel_pairs(masks, masks), components.touching_runs(components.run_table(bright_of(spark, SF)))):
        assert "BroadcastExchange" not in plan(df) and "SortMergeJoin" in plan(df)


def test_fixture_reads_two_columns(spark):
    text = plan(fixture_images(spark, SF))
    assert "s_suppkey" in text and "s_acctbal" not in text and "s_name" not in text


def test_images_of_one_band_are_not_shuffled_or_kept(spark):
    """Their pixels go from the decoding task to the result; centres need no exchange either."""
    from bandsaw.plans.segment import segment

    result = segment(fixture_images(spark, SF))
    for df in (result.bands, result.centres):
        text = plan(df)
        assert "InMemoryTableScan" not in text and "Join" not in text
        # only the keys of the drawings are dealt out, before they are drawn
        assert re.findall(r"Exchange (\w+)\((\w+)", text) == [("hashpartitioning", "s_suppkey")]
    result.release()


def test_names_of_decoded_files_meet_no_pixel_rows(spark):
    """The size of decoded pixels is unknown to the optimizer: joined as rows, they were broadcast."""
    from oracle.registry import QUERIES

    text = plan(QUERIES["png_roundtrip"](spark, SF))
    assert "Broadcast" not in text
    assert "MapInArrow" not in text.split("ShuffledHashJoin")[1]


def test_workers_get_small_batches(spark):
    """40 images of a megabyte each: no map is handed more than a few at once."""
    import pyarrow as pa

    from bandsaw.operators.bands import map_rows
    from bandsaw.session import BATCH_BYTES

    made = map_rows(spark.range(0, 40, 1, 1), lambda row: {"data": [bytes(1 << 20)]}, "data binary")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    assert max(r.n for r in made.mapInArrow(sizes, "n bigint").collect()) <= 2 * BATCH_BYTES


def test_workers_get_batches_of_a_megabyte(spark):
    """8,192 images of 12 kilobytes: what a chain of maps holds in each worker stays near a megabyte."""
    import pyarrow as pa

    from bandsaw.operators.bands import map_rows

    made = map_rows(spark.range(0, 8192, 1, 1), lambda row: {"data": [bytes(12 << 10)]}, "data binary")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    assert max(r.n for r in made.mapInArrow(sizes, "n bigint").collect()) <= 5 << 18


def test_maps_hold_a_megabyte_of_small_arrays(spark):
    """12 arrays of one number take a kilobyte and a half in the worker, though their content is 96 bytes."""
    import weakref

    import numpy as np

    from bandsaw.operators.bands import map_rows

    names, alive = [f"n{i}" for i in range(12)], {"n": 0}

    def small(row: dict) -> dict:
        alive["n"] += 1
        out = {name: np.array([alive["n"]]) for name in names}
        weakref.finalize(out["n0"], lambda: alive.update(n=alive["n"] - 1))
        return out

    made = map_rows(spark.range(0, 20_000, 1, 1), small, ", ".join(f"{name} bigint" for name in names))
    held = [r.n0 for r in made.collect()]
    assert len(held) == 20_000 and max(held) <= 1024
