import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from bandsaw.functions import paths
from bandsaw.operators import naming
from bandsaw.operators.bands import to_bands
from bandsaw.plans import jobs
from bandsaw.sources.artifacts import ingest_images, status_summary
from bandsaw.sources.files import append_manifest, list_files, read_files, read_manifest
from bandsaw.sources.headers import header, info
from bandsaw.sources.images import read_images, read_labelled
from bandsaw.sources.formats import encode_png
from bandsaw.sources.png import write_png_tree
from tests.helpers import rebuild

RNG = np.random.default_rng(3)


def rgba_png(a):
    lines = b"".join(b"\0" + row.tobytes() for row in a)

    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", a.shape[1], a.shape[0], 8, 6, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def disk(radius, h=60, w=48):
    y, x = np.mgrid[0:h, 0:w]
    inside = (y - 30) ** 2 + (x - 24) ** 2
    v = np.where(inside < radius**2, 220, np.where(inside < 500, 150, 30))
    return np.repeat(v[..., None], 3, axis=2).astype(np.uint8)


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    (root / "benign" / "deep").mkdir(parents=True)
    (root / "normal").mkdir()
    a = disk(18)
    png = lambda b: encode_png(b.tobytes(), b.shape[1], b.shape[0], 1 if b.ndim == 2 else 3)
    (root / "benign" / "a (1).png").write_bytes(png(a))
    mask = (a[..., 0] > 200).astype(np.uint8) * 255
    (root / "benign" / "a (1)_mask.png").write_bytes(png(mask))
    (root / "benign" / "deep" / "UP+PER 50%.PNG").write_bytes(png(disk(15)))
    (root / "normal" / "gray.png").write_bytes(png(disk(16)[..., 0]))
    (root / "normal" / "alpha.png").write_bytes(rgba_png(np.dstack([disk(14), np.full((60, 48), 200, np.uint8)])))
    (root / "normal" / "broken.png").write_bytes(b"not an image")
    (root / "normal" / "notes.txt").write_text("notes")
    (root / "top.png").write_bytes(png(disk(17)))
    return str(root)


def test_listing(spark, tree):
    assert list_files(spark, tree).count() == 8
    assert list_files(spark, tree + "/", recursive=False).count() == 1
    images = list_files(spark, tree, named_set="images")
    assert images.count() == 7
    assert list_files(spark, tree, named_set="images_exact").count() == 6
    row = images.filter(F.contains("path", F.lit("UP+PER"))).first()
    assert (row.rel_path, row.category, row.stem, row.ext) == ("benign/deep/UP+PER 50%.PNG", "benign/deep", "UP+PER 50%", ".PNG")
    assert read_files(spark, tree).filter(F.length("content") != F.col("length")).count() == 0


def test_decoding(spark, tree):
    images = read_images(spark, tree)
    got = {r.rel_path: r for r in images.collect()}
    assert set(got) == {r.rel_path for r in list_files(spark, tree, named_set="images").collect()}
    assert got["normal/broken.png"].height == -1
    assert got["normal/gray.png"].n_channels == 1 and got["normal/alpha.png"].n_channels == 4
    known = info(list_files(spark, tree, named_set="images")).filter("height > 0")
    assert {(r.format, r.height, r.width) for r in known.collect()} == {("png", 60, 48)}
    bands = rebuild(to_bands(images.filter("height > 0"), 20), 3)
    assert (bands[got["benign/a (1).png"].image_id] == disk(18)).all()
    assert (bands[got["normal/alpha.png"].image_id] == disk(14)[..., ::1]).all()


def test_labelled_pairs(spark, tree):
    images, masks = read_labelled(spark, tree)
    assert images.count() == 6 and masks.count() == 1
    owner = images.join(masks.select("image_id"), "image_id", "left_semi").first()
    assert owner.rel_path == "benign/a (1).png"
    files = list_files(spark, tree)
    assert naming.pair_masks(files, tree).count() == 1
    assert naming.images_without_mask(files, tree).count() == 5


def test_segment_job(spark, tree, tmp_path):
    target = str(tmp_path / "out")
    status = jobs.segment_dataset(spark, tree, target, as_files=True, band_rows=20)
    rows = {r.path.rsplit("/", 1)[1]: (r.ok, r.stage) for r in status.collect()}
    assert len(rows) == 7 and rows["broken.png"] == (False, "decode")
    assert sum(ok for ok, _ in rows.values()) == 6
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0
    assert {tuple(r) for r in status_summary(status).collect()} == {("write", True, 6), ("decode", False, 1)}
    assert spark.read.parquet(f"{target}/originals").count() == 7
    artifacts = spark.read.parquet(f"{target}/artifacts")
    kinds = {r.kind: r["count"] for r in artifacts.groupBy("kind").count().collect()}
    assert len(kinds) == 4 and set(kinds.values()) == {18}  # six images of three bands
    written = {r.rel_path: r for r in read_images(spark, f"{target}/files", "images").collect()}
    assert len(written) == 24
    original = written["benign/deep/UP+PER 50%_original.PNG.png"]
    assert bytes(original.data) == disk(15).tobytes()
    mask = np.frombuffer(bytes(written["benign/a (1)_ground_truth_mask.png"].data), np.uint8).reshape(60, 48)
    assert (mask > 0).sum() == pytest.approx(np.pi * 18**2, rel=0.1)
    again = jobs.segment_dataset(spark, tree, target, band_rows=20)
    assert again.count() == 7 and spark.read.parquet(f"{target}/artifacts").count() == 72


def test_evaluate_job(spark, tree):
    row = jobs.evaluate_dataset(spark, tree).collect()
    assert len(row) == 1 and row[0].category == "benign" and row[0].iou > 0.9
    assert row[0].iou <= row[0].dice <= 1
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_hidden_and_empty_files_are_listed(spark, tmp_path):
    (tmp_path / "t" / "_folder").mkdir(parents=True)
    for name in ("ok.png", "_under.png", ".hid.png", "_folder/in.png"):
        (tmp_path / "t" / name).write_bytes(encode_png(disk(18).tobytes(), 48, 60, 3))
    (tmp_path / "t" / "empty.png").write_bytes(b"")
    status = jobs.segment_dataset(spark, str(tmp_path / "t"), str(tmp_path / "out"))
    got = {r.path.rsplit("/", 1)[1]: r.message for r in status.collect()}
    assert got.pop("in.png") in ("written", "not a readable image of 1, 3 or 4 channels")
    assert got == {"ok.png": "written", "_under.png": "hidden name", ".hid.png": "hidden name", "empty.png": "empty file"}


def test_two_images_of_one_target_name_are_an_error(spark, tmp_path):
    rows = [(i, "", "a.png", 0, 2, 2, 1, bytearray(4)) for i in (1, 2)]
    df = spark.createDataFrame(rows, "image_id long, rel_dir string, name string, band int, width int, height int, n_channels int, content binary")
    with pytest.raises(Exception, match="two images"):
        write_png_tree(df, str(tmp_path / "out"))
    write_png_tree(df.filter("image_id = 1"), str(tmp_path / "out"))
    write_png_tree(df.filter("image_id = 2"), str(tmp_path / "out"))  # replaces the file
    assert [p.name for p in (tmp_path / "out").iterdir() if not p.name.endswith(".crc")] == ["a.png"]


def test_headers():
    assert header(encode_png(bytes(6), 2, 1, 3)) == ("png", 1, 2, 3, 8)
    assert header(b"BM" + bytes(16) + struct.pack("<ii", 7, -5) + struct.pack("<HH", 1, 24)) == ("bmp", 5, 7, 3, 8)
    assert header(b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08\x00\x05\x00\x07\x03" + bytes(9)) == ("jpeg", 5, 7, 3, 8)
    assert header(b"GIF89a\x07\x00\x05\x00") == ("gif", 5, 7, 3, 8)
    assert header(b"nothing") == header(b"") == (None,) * 5
    assert header(b"\xff\xd8\xff")[0] == "jpeg"


def test_gray_and_resize_jobs(spark, tree, tmp_path):
    gray = jobs.grayscale_dataset(spark, tree, str(tmp_path / "gray"))
    assert [r.name for r in gray.collect()] == ["processed_top.png"]
    resized = jobs.resize_dataset(spark, tree, str(tmp_path / "small"), 10, 12)
    assert resized.count() == 7 - 1
    manifest = spark.createDataFrame([("x", "gray.png"), ("y", "top.png")], "old_name string, new_name string")
    path = str(tmp_path / "manifest")
    append_manifest(manifest, path)
    append_manifest(manifest.limit(1), path)
    assert read_manifest(spark, path).count() == 3
    only = jobs.resize_dataset(spark, tree, str(tmp_path / "some"), 10, 12, manifest=read_manifest(spark, path))
    assert {r.name for r in only.collect()} == {"resized_gray.png", "resized_top.png"}


def test_one_class_is_replaced(spark, tree, tmp_path):
    target = str(tmp_path / "table")
    ingest_images(spark, tree, target)
    before = spark.read.parquet(target).count()
    from bandsaw.sources.artifacts import write_artifacts

    rows = spark.createDataFrame([(1, "a", "k1"), (2, "b", "k1")], "v int, category string, kind string")
    write_artifacts(rows, str(tmp_path / "art"))
    write_artifacts(rows.filter("category = 'a'").withColumn("v", F.lit(9)), str(tmp_path / "art"), one_class=True)
    got = {(r.category, r.v) for r in spark.read.parquet(str(tmp_path / "art")).collect()}
    assert before == 7 and got == {("a", 9), ("b", 2)}


def test_empty_input_gives_empty_tables(spark, tmp_path):
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "notes.txt").write_text("x")
    status = jobs.segment_dataset(spark, str(tmp_path / "none"), str(tmp_path / "out"))
    assert status.count() == 0


def test_numbering_follows_path_order(spark):
    names = [f"d{i % 3}/f{i:04d}.jpg" for i in range(500)]
    files = spark.createDataFrame([(n,) for n in names], "path string")
    got = {r.old_name: r.new_name for r in naming.number_files(files, 5).collect()}
    assert got == {n: f"image_{i + 1:04d}.jpg" for i, n in enumerate(sorted(names))}


def test_flat_names_are_unique(spark):
    names = [f"d{i}/mask.png" for i in range(300)] + [f"e/{i}.png" for i in range(100)]
    files = spark.createDataFrame([(n,) for n in names], "path string")
    flat = [r.flat_name for r in naming.flatten_names(files).collect()]
    assert len(set(flat)) == 400 and "mask.png" in flat


@pytest.mark.parametrize(
    ("path", "stem", "ext"),
    [("/a/.jpg", ".jpg", ""), ("/a/a.b.jpg", "a.b", ".jpg"), ("/a.d/x", "x", ""), ("x.JPG", "x", ".JPG")],
)
def test_name_parts(spark, path, stem, ext):
    df = spark.createDataFrame([(path,)], "p string")
    row = df.select(paths.stem(F.col("p")).alias("s"), paths.extension(F.col("p")).alias("e")).first()
    assert (row.s, row.e) == (stem, ext)


def test_relative_paths_of_uris(spark):
    df = spark.createDataFrame([("hdfs://h:9000/data/set/a/x.jpg",), ("file:/data/set/a/x.jpg",)], "p string")
    for root in ("/data/set", "/data/set//", "hdfs://h:9000/data/set/"):
        assert {r[0] for r in df.select(paths.relative_path(F.col("p"), root)).collect()} == {"a/x.jpg"}


def test_a_tree_is_committed_as_a_whole(spark, tmp_path):
    import os

    schema = "image_id bigint, rel_dir string, name string, band int, width int, height int, n_channels int, content binary"
    rows = lambda names, value: spark.createDataFrame([(i, f"d{i % 3}", n, 0, 2, 2, 1, bytearray([value] * 4)) for i, n in enumerate(names)], schema).repartition(5)
    root = tmp_path / "tree"

    def files():
        return {os.path.relpath(os.path.join(d, n), root): (root / d / n).read_bytes() for d, _, names in os.walk(root) for n in names}

    write_png_tree(rows([f"a{i}.png" for i in range(9)], 7), str(root))
    (root / "d0" / "other.png").write_bytes(b"kept")
    before = files()
    assert len(before) == 10
    # nine images, two of one name: some drafts are whole when the job fails
    with pytest.raises(Exception, match="two images"):
        bad = rows([f"a{i}.png" for i in range(9)], 9).unionByName(rows(["a0.png"], 9).withColumn("image_id", F.lit(77).cast("bigint")))
        write_png_tree(bad, str(root))
    assert files() == before
    assert sorted(os.listdir(tmp_path)) == ["tree", "tree.manifest"]
    write_png_tree(rows([f"a{i}.png" for i in range(4)], 8), str(root))
    after = files()
    assert set(after) == {"d0/a0.png", "d1/a1.png", "d2/a2.png", "d0/a3.png", "d0/other.png"}
    assert after["d0/a0.png"] != before["d0/a0.png"] and after["d0/other.png"] == b"kept"
    write_png_tree(rows([], 8), str(root))
    assert set(files()) == {"d0/other.png"}


def test_errors_of_steps_are_data(spark, tree, tmp_path):
    """Images of one and of several bands fail at each stage; the others have their results."""
    target = str(tmp_path / "steps")

    def inspect(stage, row):
        if stage == ("preprocess", "cluster", "postprocess", "write", "none")[row["image_id"] % 5]:
            raise RuntimeError(f"no {stage}")

    for rows in (None, 20):
        status = {r.path.rsplit("/", 1)[1]: r for r in jobs.segment_dataset(spark, tree, target, as_files=True, band_rows=rows, inspect=inspect).collect()}
        assert len(status) == 7
        failed = {n: r for n, r in status.items() if not r.ok}
        assert failed.pop("broken.png").stage == "decode" and failed
        for r in failed.values():
            assert r.message == f"RuntimeError: no {r.stage}"
        ok = [n for n, r in status.items() if r.ok]
        files = {r.stem for r in list_files(spark, f"{target}/files", named_set="images").collect()}
        assert len(files) == 4 * len(ok)


def test_files_beyond_a_row_are_listed_without_content(spark, tmp_path):
    root = tmp_path / "large"
    root.mkdir()
    (root / "small.bmp").write_bytes(b"BM")
    with open(root / "large.bmp", "wb") as sink:
        sink.truncate(2**31)  # takes no disk
    table = ingest_images(spark, str(root), str(tmp_path / "table"))
    got = {r.stem: (r.length, r.content) for r in table.collect()}
    assert got == {"small": (2, bytearray(b"BM")), "large": (2**31, None)}


def test_totals_are_read_in_few_tasks(spark):
    """Spark's image source opened 32 small files a task and decoded them there; gray counts once, damaged files have 0."""
    from oracle import trees
    from oracle.images import fixture_images, fixture_masks
    from oracle.registry import file_totals

    sf = "/root/testdata/sf0.001"
    totals = file_totals(spark, trees.write_twin_tree(spark, sf))
    assert "FileScan image" not in totals._jdf.queryExecution().executedPlan().toString()
    got = {r.name: r.total for r in totals.collect()}
    for row in fixture_images(spark, sf).collect():
        assert got[f"scan {row.image_id}.png"] == sum(row.data)
    for row in fixture_masks(spark, sf).collect():
        assert got[f"scan {row.image_id}.bmp"] == 3 * sum(row.data)
    masks = trees.new_folder(spark)
    write_png_tree(trees.file_rows(fixture_masks(spark, sf)), masks)
    gray = {r.name: r.total for r in file_totals(spark, masks).collect()}
    assert gray == {f"scan {r.image_id}.png": sum(r.data) for r in fixture_masks(spark, sf).collect()}
    damaged = {r.name: r.total for r in file_totals(spark, trees.write_damaged_tree(spark, sf)).collect()}
    assert all((total == 0) == (int(name[5:-4]) % 10 == 0) for name, total in damaged.items())
