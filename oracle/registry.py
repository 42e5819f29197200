"""Every registered query with the DuckDB text that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandsaw.functions import paths, scores
from bandsaw.functions import pixels as px
from bandsaw.operators import cluster, components, evaluate, naming, neighborhood, resize
from bandsaw.operators.bands import block, from_pixels, map_rows, recut, to_bands, to_pixels, trim
from bandsaw.plans import jobs
from bandsaw.plans.segment import artifact_rows, lab_colours, postprocess, region_of_interest, segment
from bandsaw.session import cut_lineage
from bandsaw.sources import headers
from bandsaw.sources.artifacts import ingest_images, read_table, status_summary, write_artifacts
from bandsaw.sources.decode import decode_bands
from bandsaw.sources.files import append_manifest, list_files, read_manifest
from bandsaw.sources.images import read_images
from bandsaw.sources.png import write_png_tree
from oracle import sql as O
from oracle import trees
from oracle.images import SIDE, category_of, fixture_images, fixture_masks
from oracle.listing import LISTING, ROOT, fixture_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
ROWS = 16


def register(name: str, text: str | None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if text is not None:
            ORACLE[name] = O.compose(text)
        return fn

    return add


def bands_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bands(fixture_images(spark, sf_dir), ROWS)


def bright_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighborhood.threshold(bands_of(spark, sf_dir), 127)


def pixels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_pixels(bands_of(spark, sf_dir))


def mask_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_pixels(to_bands(fixture_masks(spark, sf_dir), ROWS, as_gray=True), ("m",))


# --- paths and names ------------------------------------------------------------------------
O.step("files", LISTING)
BASE = "/data/set"
PATH = "regexp_replace(path, '^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?', '')"
REL = f"substr({PATH}, {len(BASE) + 2})"
NAME = "regexp_extract(path, '([^/]*)$', 1)"
STEM = f"regexp_extract({NAME}, '^(.+?)(\\.[^.]*)?$', 1)"
EXT = f"regexp_extract({NAME}, '^(.+?)(\\.[^.]*)?$', 2)"
PARENT = "regexp_extract({}, '^(.*)/[^/]*$', 1)"
MASKED = f"contains({NAME}, '_mask')"
O.step(
    "keyed",
    f"""SELECT path, {PARENT.format(REL)} AS category, regexp_replace({STEM}, '_mask$', '') AS stem, {EXT} AS ext, {MASKED} AS is_mask
FROM files WHERE regexp_matches(lower(path), '\\.(jpg|jpeg|png|bmp|tiff)$')""",
)


@register(
    "path_parts",
    f"""SELECT path, {NAME} AS name, {STEM} AS stem, {EXT} AS ext, {PARENT.format('path')} AS parent, {PATH} AS path_only,
list_last(string_split(path, '/')) AS last_part, array_to_string(string_split(path, '/')[4:6], '/') AS middle FROM files""",
)
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("path")
    parts = F.split(path, "/")
    return fixture_files(spark, sf_dir).select(
        "path",
        paths.file_name(path).alias("name"),
        paths.stem(path).alias("stem"),
        paths.extension(path).alias("ext"),
        paths.parent(path).alias("parent"),
        paths.path_only(path).alias("path_only"),
        F.element_at(parts, -1).alias("last_part"),
        F.array_join(F.slice(parts, 4, 3), "/").alias("middle"),
    )


SETS = {
    "images": "regexp_matches(lower(path), '\\.(jpg|jpeg|png|bmp|tiff)$')",
    "images_wide": "regexp_matches(lower(path), '\\.(jpg|jpeg|png|bmp|gif|tiff|webp)$')",
    "images_exact": "regexp_matches(path, '\\.(jpg|jpeg|png|bmp|tiff)$')",
    "images_web": "regexp_matches(lower(path), '\\.(jpg|jpeg|png|bmp|gif)$')",
    "jpg_exact": "regexp_matches(path, '\\.jpg$')",
}


@register(
    "filter_ext",
    f"SELECT path, {', '.join(f'{test} AS in_{name}' for name, test in SETS.items())}, NOT {MASKED} AS not_mask FROM files",
)
def filter_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("path")
    tests = [paths.has_extension(path, name).alias(f"in_{name}") for name in SETS]
    return fixture_files(spark, sf_dir).select("path", *tests, (~paths.is_mask(path)).alias("not_mask"))


@register("rel_path_category", f"SELECT path, {REL} AS rel_path, {PARENT.format(REL)} AS category, concat('/out/', {REL}) AS target FROM files")
def rel_path_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("path")
    relative = paths.relative_path(path, ROOT)
    return fixture_files(spark, sf_dir).select(
        "path",
        relative.alias("rel_path"),
        paths.category(relative).alias("category"),
        paths.replace_root(path, ROOT, "/out//").alias("target"),
    )


@register(
    "output_names",
    f"""SELECT path, concat({STEM}, '_original', {EXT}) AS original, concat({STEM}, '_segmented_kmeans', {EXT}) AS segmented,
concat('processed_', {NAME}) AS processed, concat('resized_', {NAME}) AS resized,
concat({PARENT.format('path')}, '/', {STEM}, '_mask', {EXT}) AS mask, replace(path, ' ', '_') AS clean FROM files""",
)
def output_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("path")
    return fixture_files(spark, sf_dir).select(
        "path",
        paths.suffixed(path, "original").alias("original"),
        paths.suffixed(path, "segmented_kmeans").alias("segmented"),
        paths.prefixed(path, "processed").alias("processed"),
        paths.prefixed(path, "resized").alias("resized"),
        paths.mask_path(path).alias("mask"),
        paths.underscored(paths.forward_slashes(path)).alias("clean"),
    )


@register(
    "url_parts",
    f"""SELECT page_id, {NAME.replace('path', 'url')} AS name, {PARENT.format('url')} AS parent,
{PATH.replace('path', 'url')} AS path_only, regexp_replace(url, '/+$', '') AS trimmed FROM pages""",
)
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id",
        paths.file_name(url).alias("name"),
        paths.parent(url).alias("parent"),
        paths.path_only(url).alias("path_only"),
        paths.trim_slashes(url).alias("trimmed"),
    )


O.step(
    "manifest",
    f"""SELECT path AS old_name, concat('image_', CASE WHEN i < 10000 THEN lpad(CAST(i AS VARCHAR), 4, '0') ELSE CAST(i AS VARCHAR) END, {EXT}) AS new_name
FROM (SELECT path, row_number() OVER (ORDER BY path) AS i FROM files)""",
)


@register("rename_manifest", "SELECT old_name, new_name FROM manifest")
def rename_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naming.number_files(fixture_files(spark, sf_dir))


@register(
    "flatten_names",
    f"""SELECT path, CASE WHEN row_number() OVER (PARTITION BY {NAME} ORDER BY path) = 1 THEN {NAME}
ELSE concat({STEM}, '_', md5(path), {EXT}) END AS flat_name FROM files""",
)
def flatten_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naming.flatten_names(fixture_files(spark, sf_dir))


@register(
    "clean_names",
    "SELECT path, replace(path, ' ', '_') AS clean_path, count(*) OVER (PARTITION BY replace(path, ' ', '_')) > 1 AS collides FROM files",
)
def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naming.clean_names(fixture_files(spark, sf_dir))


@register(
    "pair_masks",
    """SELECT i.category, i.stem, i.path AS image_path, m.path AS mask_path FROM keyed i JOIN keyed m USING (category, stem, ext)
WHERE NOT i.is_mask AND m.is_mask""",
)
def pair_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naming.pair_masks(fixture_files(spark, sf_dir), ROOT)


@register(
    "missing_masks",
    """SELECT category, path FROM keyed i WHERE NOT is_mask AND NOT EXISTS
(SELECT 1 FROM keyed m WHERE m.is_mask AND m.category = i.category AND m.stem = i.stem AND m.ext = i.ext)""",
)
def missing_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naming.images_without_mask(fixture_files(spark, sf_dir), ROOT)


# the manifest of all parts: names the images with an even number and the odd "a.b.jpg"
MANIFEST = """SELECT concat('old ', p_partkey) AS old_name,
CASE WHEN p_size % 2 = 0 THEN concat('image (', p_partkey, ').jpg') ELSE 'a.b.jpg' END AS new_name FROM {}"""


@register(
    "manifest_files",
    f"SELECT path, length FROM files WHERE {NAME} IN (SELECT new_name FROM ({MANIFEST.format('part')}))",
)
def manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    manifest = spark.sql(MANIFEST.format("{part}"), part=part)
    return naming.in_manifest(fixture_files(spark, sf_dir), manifest)


@register(
    "listing_summary",
    f"""SELECT {PARENT.format(REL)} AS category, lower({EXT}) AS ext, count(*) AS n_files, CAST(sum(length) AS BIGINT) AS bytes,
avg(length) AS mean_bytes FROM files GROUP BY ALL""",
)
def listing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naming.listing_summary(fixture_files(spark, sf_dir), ROOT)


@register("first_image", f"SELECT path, length FROM files WHERE {SETS['images_web']} ORDER BY path LIMIT 1")
def first_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naming.first_image(fixture_files(spark, sf_dir))


# --- pixels ---------------------------------------------------------------------------------
@register("image_to_pixels", "SELECT image_id, y, x, b, g, r FROM px")
def image_to_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels_of(spark, sf_dir)


@register("pixels_to_bands", "SELECT image_id, y, x, b, g, r FROM px")
def pixels_to_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels to bands and, cut again with another height and a fresh halo, back to pixels."""
    sized = pixels_of(spark, sf_dir).withColumns({"height": F.lit(SIDE), "width": F.lit(SIDE)})
    return to_pixels(recut(from_pixels(sized, rows=20), rows=13, halo=5))


@register(
    "normalise_channels",
    f"SELECT image_id, y, x, m AS b, m AS g, m AS r FROM px UNION ALL SELECT image_id + 1000000, y, x, b, g, r FROM px",
)
def normalise_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gray files become three channels; a fourth channel is dropped."""
    def add_alpha(row: dict) -> dict:
        import numpy as np

        a = np.frombuffer(row["data"], np.uint8).reshape(-1, 3)
        data = np.concatenate([a, np.full((a.shape[0], 1), 77, np.uint8)], axis=1).tobytes()
        return {n: [row[n]] for n in ("height", "width")} | {
            "image_id": [row["image_id"] + 1000000], "n_channels": [4], "data": [data],
        }

    schema = "image_id bigint, height int, width int, n_channels int, data binary"
    with_alpha = map_rows(fixture_images(spark, sf_dir), add_alpha, schema)
    return to_pixels(to_bands(fixture_masks(spark, sf_dir).unionByName(with_alpha), ROWS))


@register(
    "image_info",
    f"""SELECT concat('scan ', s_suppkey, x.ext) AS rel_path, x.format, {SIDE} AS height, {SIDE} AS width, 3 AS n_channels, 8 AS bits
FROM supplier, (VALUES ('.png', 'png'), ('.bmp', 'bmp')) AS x(ext, format)""",
)
def image_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format and size from the first bytes of files."""
    return headers.info(list_files(spark, trees.write_twin_tree(spark, sf_dir), named_set="images")).drop("path")


@register("grayscale", "SELECT image_id, y, x, v FROM grays")
def grayscale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels_of(spark, sf_dir).select("image_id", "y", "x", px.gray(F.col("b"), F.col("g"), F.col("r")).alias("v"))


@register("threshold", "SELECT image_id, y, x, v*255 AS m FROM bright")
def threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = px.gray(F.col("b"), F.col("g"), F.col("r"))
    return pixels_of(spark, sf_dir).select("image_id", "y", "x", px.above(value, 127).alias("m"))


@register("threshold_bands", "SELECT image_id, y, x, v*255 AS m FROM bright")
def threshold_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_pixels(bright_of(spark, sf_dir), ("m",))


@register(
    "mask_apply",
    "SELECT image_id, y, x, " + ", ".join(f"CASE WHEN {O.GRAY} > 127 THEN {c} ELSE 0 END AS {c}" for c in "bgr") + " FROM px",
)
def mask_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    mask = px.above(px.gray(F.col("b"), F.col("g"), F.col("r")), 127)
    return pixels_of(spark, sf_dir).select("image_id", "y", "x", *[px.masked(F.col(c), mask).alias(c) for c in "bgr"])


@register("lab", "SELECT b, g, r, c0, c1, c2, count(*) AS w FROM px JOIN lab_colours USING (b, g, r) GROUP BY ALL")
def lab(spark: SparkSession, sf_dir: str) -> DataFrame:
    colours = pixels_of(spark, sf_dir).groupBy("b", "g", "r").agg(F.count("*").alias("w"))
    return colours.select("b", "g", "r", "w", px.lab(F.col("b"), F.col("g"), F.col("r")).alias("lab")).select(
        "b", "g", "r", "w", "lab.*"
    )


@register("lab_pixels", "SELECT image_id, y, x, c0, c1, c2 FROM lab_px")
def lab_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    from bandsaw.operators.bands import map_block
    from bandsaw.operators.kernels import lab as lab_block

    return to_pixels(map_block(bands_of(spark, sf_dir), lambda a, top, bottom: lab_block(a)), ("c0", "c1", "c2"))


@register("colour_histogram", "SELECT image_id, b AS c0, g AS c1, r AS c2, count(*) AS w FROM px GROUP BY ALL")
def colour_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.band_histogram(bands_of(spark, sf_dir))


# --- neighbourhoods and components ----------------------------------------------------------
@register("gaussian_blur", "SELECT image_id, y, x, b, g, r FROM blur_px")
def gaussian_blur(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_pixels(neighborhood.gaussian_blur(bands_of(spark, sf_dir)))


def _morphology(name: str, step: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    @register(name, f"SELECT image_id, y, x, v*255 AS m FROM {step}")
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return to_pixels(operator(bright_of(spark, sf_dir)), ("m",))


_morphology("erode", "ero_v", neighborhood.erode)
_morphology("dilate", "dil_v", neighborhood.dilate)
_morphology("open", "opn_v", neighborhood.open_mask)
_morphology("close", "cls_v", neighborhood.close_mask)
_morphology("fill_holes", "roi_filled", components.fill_holes)


@register("runs", "SELECT image_id, y, v, x0, x1 FROM bright_fg")
def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.run_table(bright_of(spark, sf_dir))


@register("runs_from_pixels", "SELECT image_id, y, v, x0, x1 FROM bright_fg")
def runs_from_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = (px.gray(F.col("b"), F.col("g"), F.col("r")) > 127).cast("int").alias("v")
    return components.runs_from_pixels(pixels_of(spark, sf_dir).select("image_id", "y", "x", flag), "v")


@register(
    "touching_runs",
    """SELECT a.image_id, a.y, a.x0 AS ux0, a.x1 AS ux1, b.x0 AS lx0, b.x1 AS lx1 FROM bright_fg a JOIN bright_fg b
ON a.image_id = b.image_id AND b.y = a.y + 1 AND b.x0 <= a.x1 + 1 AND b.x1 >= a.x0 - 1 WHERE a.v = 1 AND b.v = 1""",
)
def touching_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.touching_runs(components.run_table(bright_of(spark, sf_dir)))


COMPONENT = "image_id, comp_id, area, n_pixels, x0, y0, x1, y1"


@register("components", f"SELECT {COMPONENT} FROM bright_comp")
def connected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.components(bright_of(spark, sf_dir))


@register("external_components", f"SELECT {COMPONENT} FROM roif_comp")
def external(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.external_components(bright_of(spark, sf_dir))


def _very_bright(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighborhood.threshold(bands_of(spark, sf_dir), 200)


O.step("vivid", "SELECT image_id, y, x, CASE WHEN v > 200 THEN 1 ELSE 0 END AS v FROM grays")
O.component_steps("vivid", "vivid")


@register("contour_area", "SELECT image_id, comp_id, area FROM vivid_comp")
def contour_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.components(_very_bright(spark, sf_dir)).select("image_id", "comp_id", "area")


@register(
    "filter_area",
    """SELECT v.image_id, v.y, v.x, CASE WHEN k.image_id IS NULL THEN 0 ELSE 255 END AS m FROM vivid v
LEFT JOIN (SELECT p.image_id, p.y, p.x FROM vivid_px p JOIN vivid_comp c ON c.image_id = p.image_id AND c.comp_id = p.comp_id
           WHERE c.area > 450) k USING (image_id, y, x)""",
)
def filter_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_pixels(components.keep_large(_very_bright(spark, sf_dir), 450.0), ("m",))


@register("roi", "SELECT image_id, y, x, b, g, r FROM roi_px")
def roi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_pixels(region_of_interest(bands_of(spark, sf_dir)))


O.step("hot_bin", "SELECT image_id, y, x, CASE WHEN v > 200 THEN 1 ELSE 0 END AS v FROM grays")
O.clean_steps("hot", "hot_bin")


@register("postprocess", "SELECT image_id, y, x, m FROM hot_mask")
def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Post-processing of the very bright pixels."""
    from bandsaw.operators.bands import map_block
    from bandsaw.operators.kernels import gray

    picked = map_block(bands_of(spark, sf_dir), lambda a, top, bottom: a * (gray(a) > 200)[..., None])
    return to_pixels(postprocess(picked), ("m",))


# --- resampling -----------------------------------------------------------------------------
def _resampling(method: str, height: int, width: int) -> None:
    @register(f"resize_{method}", O.resize_steps(f"rz_{method}", height, width, method))
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return to_pixels(resize.resize(bands_of(spark, sf_dir), height, width, method))


_resampling("nearest", 48, 80)
_resampling("area", 32, 24)
_resampling("bilinear", 40, 50)
_resampling("bicubic", 48, 36)
_resampling("lanczos", 25, 100)


@register("resize_100", O.resize_steps("rz_100", 100, 100, "lanczos"))
def resize_100(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 100 x 100 antialiased job on whole images."""
    return to_pixels(resize.resize(to_bands(fixture_images(spark, sf_dir), halo=0), 100, 100, "lanczos"))


# --- clustering -----------------------------------------------------------------------------
def lab_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Colours of the ROI-masked and blurred images."""
    return lab_colours(bands_of(spark, sf_dir))


CENTRE = "image_id, cluster, c0, c1, c2"


@register("kmeans_centres", f"SELECT {CENTRE} FROM seg_centre")
def kmeans_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.centre_rows(cluster.kmeans(lab_histogram(spark, sf_dir).persist()))


@register("kmeans_rounds", f"SELECT {CENTRE} FROM seg_centre")
def kmeans_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through joins and aggregates, as images with many colours go."""
    return cluster.centre_rows(cluster.kmeans_rounds(lab_histogram(spark, sf_dir)))


@register("plain_kmeans", f"SELECT {CENTRE} FROM plain_centre")
def plain_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-means on L*a*b* of the raw image."""
    bands = bands_of(spark, sf_dir)
    return cluster.centre_rows(cluster.kmeans(lab_colours(bands, False).persist()))


@register("table_kmeans", f"SELECT {CENTRE} FROM tab_centre")
def table_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of quantity, discount and tax per return flag: half of all rows have one flag."""
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    colours = line.groupBy(
        flag.cast("long").alias("image_id"),
        F.col("l_quantity").cast("int").alias("c0"),
        F.round(F.col("l_discount") * 1000).cast("int").alias("c1"),
        F.round(F.col("l_tax") * 1000).cast("int").alias("c2"),
    ).agg(F.count("*").alias("w"))
    return cluster.centre_rows(cluster.kmeans(colours.persist(), n_init=1, local_colours=1000))


@register("kmeans_labels", "SELECT image_id, c0, c1, c2, w, cluster FROM seg_label")
def kmeans_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    colours = lab_histogram(spark, sf_dir).persist()
    return cluster.label_colours(colours, cluster.kmeans(colours))


@register("best_cluster", "SELECT image_id, best FROM seg_top")
def best_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    colours = lab_histogram(spark, sf_dir).persist()
    return cluster.with_best(cluster.kmeans(colours)).select("image_id", "best")


def segmented(spark: SparkSession, sf_dir: str, rows: int | None = ROWS, **options) -> DataFrame:
    return segment(fixture_images(spark, sf_dir), band_rows=rows, **options).bands


@register("selected_cluster", "SELECT image_id, y, x, b, g, r FROM seg_selected")
def selected_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_pixels(segmented(spark, sf_dir), column="selected")


@register(
    "given_cluster",
    """SELECT p.image_id, p.y, p.x, CASE WHEN l.cluster = 1 THEN p.b ELSE 0 END AS b,
CASE WHEN l.cluster = 1 THEN p.g ELSE 0 END AS g, CASE WHEN l.cluster = 1 THEN p.r ELSE 0 END AS r
FROM px p JOIN seg_labels l USING (image_id, y, x)""",
)
def given_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_pixels(segmented(spark, sf_dir, None, cluster_index=1), column="selected")


@register(
    "segmented",
    """SELECT l.image_id, l.y, l.x, CAST(floor(k.c0) AS INT) AS c0, CAST(floor(k.c1) AS INT) AS c1, CAST(floor(k.c2) AS INT) AS c2
FROM seg_labels l JOIN seg_centre k USING (image_id, cluster)""",
)
def segmented_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_pixels(segmented(spark, sf_dir, None), ("c0", "c1", "c2"), "segmented")


# --- scores ---------------------------------------------------------------------------------
def cut_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of "gray above 127" against the true mask, from pixel rows."""
    value = px.above(px.gray(F.col("b"), F.col("g"), F.col("r")), 127)
    predicted = pixels_of(spark, sf_dir).select("image_id", "y", "x", value.alias("m"))
    pairs = evaluate.pixel_pairs(mask_pixels(spark, sf_dir), predicted)
    return evaluate.confusion(pairs, ["image_id"], F.col("m"), F.col("p"))


@register("confusion", "SELECT image_id, tp, fp, fn, tn, same_raw FROM cut_counts")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_counts(spark, sf_dir)


@register("confusion_bands", "SELECT image_id, tp, fp, fn, tn, same_raw FROM cut_counts")
def confusion_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = to_bands(fixture_masks(spark, sf_dir), ROWS, as_gray=True)
    return evaluate.confusion_of_masks(bright_of(spark, sf_dir), truth, ROWS)


@register(
    "confusion_recut",
    "SELECT image_id, tp, fp, fn, tn, same_raw FROM cut_counts UNION ALL SELECT image_id + 1000000, tp, fp, fn, tn, same_raw FROM cut_counts",
)
def confusion_recut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions in bands of 16 and of 13 rows, true masks in bands of 32."""
    truth = to_bands(fixture_masks(spark, sf_dir), 32, as_gray=True)
    fine = neighborhood.threshold(to_bands(fixture_images(spark, sf_dir), 13), 127)
    counts = evaluate.confusion_of_masks(bright_of(spark, sf_dir), truth, 32)
    others = evaluate.confusion_of_masks(fine, truth, 32).withColumn("image_id", F.col("image_id") + 1000000)
    return counts.unionByName(others)


O.step(
    "half_counts",
    "SELECT "
    + O.counts("image_id", "t.m", "p.m")
    + """ FROM (SELECT image_id, y, x, m FROM px) t
JOIN (SELECT h.image_id, y.t AS y, x.t AS x, h.m FROM (SELECT image_id, y//2 AS y, x//2 AS x, v*255 AS m FROM bright WHERE y % 2 = 0 AND x % 2 = 0) h,
      (SELECT range AS t, range//2 AS s FROM range(64)) y, (SELECT range AS t, range//2 AS s FROM range(64)) x
      WHERE y.s = h.y AND x.s = h.x) p USING (image_id, y, x) GROUP BY image_id""",
)


@register("confusion_resized", "SELECT image_id, tp, fp, fn, tn, same_raw FROM half_counts")
def confusion_resized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of half the size are resized to their masks before they are compared."""
    half = resize.resize(bright_of(spark, sf_dir), SIDE // 2, SIDE // 2, "nearest", ROWS, channels=1)
    truth = to_bands(fixture_masks(spark, sf_dir), ROWS, as_gray=True)
    return evaluate.confusion_of_masks(half, truth, ROWS)


SCORE = 'image_id, iou, dice, "precision", recall, pixel_accuracy, pixel_accuracy_raw'


def cut_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.score(confusion_bands(spark, sf_dir))


for _name, _columns in {
    "iou": ["iou"],
    "dice": ["dice"],
    "precision_recall": ["precision", "recall"],
    "pixel_accuracy": ["pixel_accuracy", "pixel_accuracy_raw"],
}.items():

    def _score(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] = tuple(_columns)) -> DataFrame:
        return cut_scores(spark, sf_dir).select("image_id", *columns)

    register(_name, "SELECT image_id, " + ", ".join(f'"{c}"' for c in _columns) + " FROM cut_scores")(_score)

MEAN_NAMES = ["iou", "dice", "precision", "recall", "pixel_accuracy"]


def _rounded(df: DataFrame) -> DataFrame:
    """Means of doubles depend on the order of rows in the last digits."""
    return df.withColumns({c: F.round(c, 9) for c in MEAN_NAMES})


ROUNDED = ", ".join(f'round("{c}", 9) AS "{c}"' for c in MEAN_NAMES)


@register("score_summary", f"SELECT n, n_undefined, n_empty, {ROUNDED} FROM (SELECT {O.MEANS} FROM cut_scores)")
def score_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.summary(cut_scores(spark, sf_dir)))


@register(
    "score_rollup",
    f"""SELECT category, n, n_undefined, n_empty, {ROUNDED} FROM (SELECT category, {O.MEANS}
FROM (SELECT *, {O.CATEGORY} AS category FROM cut_scores) GROUP BY ROLLUP (category))""",
)
def score_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluate.rollup_summary(cut_scores(spark, sf_dir).withColumn("category", category_of())))


@register("label_scores", 'SELECT lang, tp, fp, fn, tn, same_raw, iou, dice, "precision", recall, pixel_accuracy, pixel_accuracy_raw FROM doc_scores')
def label_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same scores for document labels: quality is the truth, toxic the prediction."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = labels.join(documents, "doc_id")
    return evaluate.score(evaluate.confusion(rows, ["lang"], F.col("quality"), F.col("toxic")))


@register(
    "score_text",
    """SELECT image_id, printf('%.4f', pixel_accuracy) AS accuracy_text,
concat(image_id // 3600, 'h: ', (image_id % 3600) // 60, 'm: ', printf('%.2f', (image_id % 60)::DOUBLE), 's') AS time_text FROM cut_scores""",
)
def score_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_scores(spark, sf_dir).select(
        "image_id",
        scores.four_decimals(F.col("pixel_accuracy")).alias("accuracy_text"),
        scores.hours_minutes_seconds(F.col("image_id")).alias("time_text"),
    )


@register("sample_results", f"SELECT {SCORE} FROM cut_scores ORDER BY md5(concat('42:', image_id)), image_id LIMIT 10")
def sample_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.sample_results(cut_scores(spark, sf_dir)).drop("tp", "fp", "fn", "tn", "same_raw")


# --- whole jobs -----------------------------------------------------------------------------
def scored_segments(spark: SparkSession, sf_dir: str, rows: int | None) -> DataFrame:
    result = segment(fixture_images(spark, sf_dir), band_rows=rows)
    truth = to_bands(fixture_masks(spark, sf_dir), rows, as_gray=True)
    return evaluate.score(evaluate.confusion_of_masks(result.masks, truth, rows, result.done))


SEGMENT_SCORES = f"SELECT tp, fp, fn, tn, same_raw, {SCORE} FROM final_scores"


@register("segment_scores", SEGMENT_SCORES)
def segment_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: every image from pixels to scored mask."""
    return scored_segments(spark, sf_dir, None)


@register("segment_scores_banded", SEGMENT_SCORES)
def segment_scores_banded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every image spread over four bands."""
    return scored_segments(spark, sf_dir, ROWS)


@register("segment_mask", "SELECT image_id, y, x, m FROM final_mask")
def segment_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_pixels(segmented(spark, sf_dir, None), ("m",), "mask")


@register(
    "segment_report",
    f"""SELECT category, n, n_undefined, n_empty, {ROUNDED} FROM (SELECT category, {O.MEANS}
FROM (SELECT *, {O.CATEGORY} AS category FROM final_scores) GROUP BY ROLLUP (category))""",
)
def segment_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scored_segments(spark, sf_dir, None).withColumn("category", category_of())
    return _rounded(evaluate.rollup_summary(scored))


@register(
    "artifacts_long",
    """SELECT image_id, 'original' AS kind, 3 AS n_channels, 12288 AS bytes, CAST(sum(b + g + r) AS BIGINT) AS total FROM px GROUP BY ALL
UNION ALL SELECT image_id, 'segmented_kmeans', 3, 12288, CAST(sum(floor(k.c0) + floor(k.c1) + floor(k.c2)) AS BIGINT)
FROM seg_labels l JOIN seg_centre k USING (image_id, cluster) GROUP BY ALL
UNION ALL SELECT image_id, 'selected_cluster', 3, 12288, CAST(sum(b + g + r) AS BIGINT) FROM seg_selected GROUP BY ALL
UNION ALL SELECT image_id, 'ground_truth_mask', 1, 4096, CAST(sum(m) AS BIGINT) FROM final_mask GROUP BY ALL""",
)
def artifacts_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four artefacts per image with size and sum of values."""
    def total(row: dict) -> dict:
        import numpy as np

        value = int(np.frombuffer(row["content"], np.uint8).sum())
        kept = {n: [row[n]] for n in ("image_id", "kind", "n_channels")}
        return kept | {"bytes": [len(row["content"])], "total": [value]}

    rows = artifact_rows(segmented(spark, sf_dir, None))
    schema = "image_id bigint, kind string, n_channels int, bytes int, total bigint"
    return map_rows(rows.select("image_id", "kind", "n_channels", "content"), total, schema)


# --- files ----------------------------------------------------------------------------------
FILE_NAME = f"concat({O.CATEGORY}, '/scan ', image_id, '.png')"


@register("png_roundtrip", f"SELECT {FILE_NAME} AS rel_path, y, x, b, g, r FROM px")
def png_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All images written as PNG files, read back and decoded by the image source."""
    root = trees.write_tree(spark, sf_dir)
    # names meet the files, not their pixels, whose number no estimate sees
    names = list_files(spark, root).select(F.xxhash64("rel_path").alias("image_id"), "rel_path").hint("shuffle_hash")
    images = read_images(spark, root).drop("rel_path").join(names, "image_id")
    pixels = to_pixels(to_bands(images, ROWS, carry=("rel_path",)), carry=("rel_path",))
    return pixels.drop("image_id")


@register(
    "file_listing",
    f"SELECT {FILE_NAME} AS rel_path, {O.CATEGORY} AS category, concat('scan ', image_id) AS stem, '.png' AS ext FROM (SELECT DISTINCT image_id FROM px)",
)
def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recursive listing of a tree of files, without content."""
    root = trees.write_tree(spark, sf_dir)
    return list_files(spark, root, named_set="images").select("rel_path", "category", "stem", "ext")


@register(
    "ingest",
    f"SELECT {O.CATEGORY} AS category, count(*) AS n FROM (SELECT DISTINCT image_id FROM px) GROUP BY ALL",
)
def ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copy a tree of files into a table partitioned by class."""
    table = ingest_images(spark, trees.write_tree(spark, sf_dir), trees.new_folder(spark))
    return table.filter(F.length("content") == F.col("length")).groupBy("category").agg(F.count("*").alias("n"))


@register(
    "status_summary",
    """SELECT CASE WHEN image_id % 10 = 0 THEN 'decode' ELSE 'write' END AS stage, image_id % 10 <> 0 AS ok, count(*) AS n
FROM (SELECT DISTINCT image_id FROM px) GROUP BY ALL""",
)
def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segmentation job over files of which every tenth is damaged."""
    source = trees.write_damaged_tree(spark, sf_dir)
    return status_summary(jobs.segment_dataset(spark, source, trees.new_folder(spark)))


@register(
    "dataset_artifacts",
    f"""SELECT {O.CATEGORY} AS category, kind, count(*) AS n FROM (SELECT DISTINCT image_id FROM px),
(VALUES ('original'), ('segmented_kmeans'), ('selected_cluster'), ('ground_truth_mask')) AS k(kind) GROUP BY ALL""",
)
def dataset_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment a tree of files, write the artefacts as PNG files, and list those."""
    target = trees.new_folder(spark)
    jobs.segment_dataset(spark, trees.write_tree(spark, sf_dir), target, as_files=True)
    files = list_files(spark, f"{target}/files", named_set="images")
    kind = F.regexp_extract("stem", "^scan [0-9]+_(.*)$", 1).alias("kind")
    return files.groupBy("category", kind).agg(F.count("*").alias("n"))


@register(
    "evaluate_files",
    f"""SELECT {O.CATEGORY} AS category, tp, fp, fn, tn, iou, dice, "precision", recall, pixel_accuracy
FROM final_scores WHERE image_id % 7 <> 0""",
)
def evaluate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment a labelled tree of files and score it; images without a mask are left out."""
    scored = jobs.evaluate_dataset(spark, trees.write_labelled_tree(spark, sf_dir))
    return scored.drop("image_id", "same_raw", "pixel_accuracy_raw")


@register("grayscale_files", f"SELECT concat('processed_scan ', image_id, '.png') AS name, CAST(sum(v) AS BIGINT) AS total FROM grays WHERE image_id % 10 <> 0 GROUP BY image_id")
def grayscale_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grayscale job over a flat directory with damaged files."""
    target = trees.new_folder(spark)
    jobs.grayscale_dataset(spark, trees.write_damaged_tree(spark, sf_dir), target, as_files=True)
    return file_totals(spark, f"{target}/files")


O.step("rz_job_px", O.resize_steps("rz_job", 32, 32, "bicubic"))


@register(
    "resize_files",
    f"""SELECT concat('resized_scan ', image_id, '.png') AS name, CAST(sum(b + g + r) AS BIGINT) AS total FROM rz_job_px
WHERE image_id IN (SELECT CAST(s_suppkey AS BIGINT) FROM supplier WHERE s_acctbal > 0) GROUP BY image_id""",
)
def resize_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The resize job over the files that a manifest names (suppliers in credit)."""
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet").filter("s_acctbal > 0")
    manifest = supplier.select(
        F.col("s_name").alias("old_name"), F.format_string("scan %d.png", "s_suppkey").alias("new_name")
    )
    folder = trees.new_folder(spark)
    append_manifest(manifest, folder)
    named = read_manifest(spark, folder)
    source = trees.write_tree(spark, sf_dir)
    target = trees.new_folder(spark)
    jobs.resize_dataset(spark, source, target, 32, 32, manifest=named, as_files=True)
    return file_totals(spark, f"{target}/files")


def file_totals(spark: SparkSession, root: str) -> DataFrame:
    """Name and sum of values of every image file below ``root``, PNG or BMP; gray counts once. A file that cannot be decoded has 0."""
    def total(row: dict) -> dict:
        import numpy as np

        value = int(trim(row, block(row)).sum(dtype=np.int64)) if row["message"] is None else 0
        return {"rel_path": [row["rel_path"]], "total": [value // 3 if row["channels"] == "1" else value]}

    files = headers.with_headers(list_files(spark, root, named_set="images")).withColumn("image_id", F.xxhash64("rel_path"))
    files = files.withColumn("channels", F.col("h_channels").cast("string"))
    sums = map_rows(decode_bands(files, halo=0, carry=("rel_path", "channels")), total, "rel_path string, total bigint")
    return sums.groupBy("rel_path").agg(F.sum("total").alias("total")).select(paths.file_name(F.col("rel_path")).alias("name"), "total")


@register(
    "same_stem_files",
    "SELECT concat('scan ', image_id) AS stem, 8 AS n_files, CAST(sum(b + g + r) AS BIGINT) AS png_total, CAST(3 * sum(m) AS BIGINT) AS bmp_total FROM px GROUP BY image_id",
)
def same_stem_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files of one stem in one folder keep all their results, as files of different names."""
    target = trees.new_folder(spark)
    jobs.segment_dataset(spark, trees.write_twin_tree(spark, sf_dir), target, as_files=True)
    files = file_totals(spark, f"{target}/files").withColumn("stem", F.regexp_extract("name", "^(scan [0-9]+)_", 1))
    one = lambda ending: F.sum(F.when(F.endswith("name", F.lit(ending)), F.col("total")))
    return files.groupBy("stem").agg(
        F.count("*").cast("int").alias("n_files"), one("_original.png").alias("png_total"), one("_original.bmp.png").alias("bmp_total")
    )


@register(
    "status_stages",
    """SELECT concat(CASE WHEN i % 7 = 4 THEN '_' ELSE '' END, 'scan ', i, CASE WHEN i % 7 = 5 THEN '.jpg' ELSE '.png' END) AS name,
i % 7 IN (0, 1, 5) AS ok, CASE WHEN i % 7 IN (0, 1, 5) THEN 'write' ELSE 'decode' END AS stage,
CASE i % 7 WHEN 2 THEN 'the file ends early' WHEN 3 THEN 'empty file' WHEN 4 THEN 'hidden name' WHEN 6 THEN 'a PNG without pixels' ELSE 'written' END AS message
FROM (SELECT s_suppkey AS i FROM supplier)""",
)
def status_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One status row for every file of a tree with files of seven sorts."""
    status = jobs.segment_dataset(spark, trees.write_mixed_tree(spark, sf_dir), trees.new_folder(spark))
    return status.select(paths.file_name(F.col("path")).alias("name"), "ok", "stage", "message")


@register(
    "status_five_stages",
    """SELECT stage, stage IS NULL AS ok, coalesce(message, 'written') AS message, count(*) AS n FROM (
  SELECT CASE WHEN image_id % 10 = 0 THEN 'decode' WHEN t % 7 < 4 THEN ['preprocess', 'cluster', 'postprocess', 'write'][CAST(t % 7 AS INT) + 1] END AS stage,
    CASE WHEN image_id % 10 = 0 THEN 'the file ends early' WHEN t % 7 < 4
      THEN concat('ValueError: refused at ', ['preprocess', 'cluster', 'postprocess', 'write'][CAST(t % 7 AS INT) + 1]) END AS message
  FROM (SELECT image_id, sum(b + g + r) AS t FROM px GROUP BY image_id)) GROUP BY ALL""",
)
def status_five_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segmentation job where images fail at every stage: cut files at decoding, others by a rule on their pixels."""

    def inspect(stage: str, row: dict) -> None:
        import numpy as np

        stages = ("preprocess", "cluster", "postprocess", "write")
        total = int(np.frombuffer(row["data"], np.uint8).sum()) % 7
        if total < 4 and stages[total] == stage:
            raise ValueError(f"refused at {stage}")

    status = jobs.segment_dataset(spark, trees.write_damaged_tree(spark, sf_dir), trees.new_folder(spark), inspect=inspect)
    told = F.when(~F.col("ok"), F.col("stage")).alias("stage")
    return status.select(told, "ok", "message").groupBy("stage", "ok", "message").agg(F.count("*").alias("n"))


@register(
    "evaluate_status",
    """SELECT 'score' AS stage, scored AS ok, CASE WHEN scored THEN 'scored' ELSE 'no mask' END AS message, CAST(sum(1 + CAST(scored AS INT)) AS BIGINT) AS n
FROM (SELECT DISTINCT image_id % 7 <> 0 AS scored, image_id FROM px) GROUP BY ALL""",
)
def evaluate_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for every image and every mask of a labelled tree: scored, or why not."""
    target = trees.new_folder(spark)
    jobs.evaluate_dataset(spark, trees.write_labelled_tree(spark, sf_dir), target=target)
    return spark.read.parquet(f"{target}/status").groupBy("stage", "ok", "message").agg(F.count("*").alias("n"))


@register(
    "decoded_rows",
    """SELECT concat('scan ', image_id, ending) AS name, 4 AS bands, CAST(CASE ending WHEN '.png' THEN sum(b + g + r) ELSE 3 * sum(m) END AS BIGINT) AS total,
CAST(CASE ending WHEN '.png' THEN sum(y * (b + 2 * g + 3 * r)) ELSE 6 * sum(y * m) END AS BIGINT) AS by_row
FROM px, (VALUES ('.png'), ('.bmp')) AS e(ending) GROUP BY image_id, ending""",
)
def decoded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PNG and BMP files decoded on the rows of a listing, in bands of 16 rows with a halo."""
    files = list_files(spark, trees.write_twin_tree(spark, sf_dir)).withColumn("image_id", F.xxhash64("rel_path"))

    def total(row: dict) -> dict:
        import numpy as np

        core = trim(row, block(row)).astype(np.int64)
        by_row = (core @ np.array([1, 2, 3])).sum(axis=1) @ np.arange(row["y0"], row["y1"])
        return {"name": [row["rel_path"]], "bands": [row["bands"]], "total": [int(core.sum())], "by_row": [int(by_row)]}

    cut = decode_bands(files, rows=16, carry=("rel_path",)).filter("message IS NULL")
    sums = map_rows(cut, total, "name string, bands int, total bigint, by_row bigint")
    return sums.groupBy("name", "bands").agg(F.sum("total").alias("total"), F.sum("by_row").alias("by_row"))


ENDINGS = "CASE image_id % 4 WHEN 0 THEN '.png' WHEN 1 THEN '.bmp' WHEN 2 THEN '.jpg' ELSE '.jpeg' END"


@register(
    "kept_formats",
    f"""SELECT concat('resized_scan ', image_id, {ENDINGS}) AS name, 32 AS height, 32 AS width, true AS near,
CASE WHEN image_id % 4 < 2 THEN CAST(sum(b + g + r) AS BIGINT) ELSE -1 END AS total FROM rz_job_px GROUP BY image_id""",
)
def kept_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PNG, BMP and JPEG files are resized and keep their format; near: within three values of the drawn image's resized pixels, on average; total: of the lossless ones."""
    source, target = trees.new_folder(spark), trees.new_folder(spark)
    drawn = fixture_images(spark, sf_dir)
    rows = trees.file_rows(drawn).withColumn("name", F.concat(F.lit("scan "), F.col("image_id").cast("string"), F.expr(ENDINGS)))
    write_png_tree(rows, source)
    jobs.resize_dataset(spark, source, target, 32, 32, as_files=True, keep_format=True)
    exact = resize.resize(to_bands(drawn), 32, 32).select("image_id", F.col("data").alias("wanted"))
    made = read_images(spark, f"{target}/files").withColumn("name", paths.file_name(F.col("rel_path"))).drop("image_id")
    made = made.withColumn("image_id", F.regexp_extract("name", r" (\d+)\.", 1).cast("bigint"))

    def compared(row: dict) -> dict:
        import numpy as np

        a, b = (np.frombuffer(row[c], np.uint8).astype(int) for c in ("data", "wanted"))
        whole = row["name"].endswith((".png", ".bmp"))
        out = {"name": row["name"], "height": row["height"], "width": row["width"], "near": bool(np.abs(a - b).mean() <= 3)}
        return {k: [v] for k, v in (out | {"total": int(a.sum()) if whole else -1}).items()}

    pairs = made.join(exact, "image_id").select("name", "height", "width", "data", "wanted")
    return map_rows(pairs, compared, "name string, height int, width int, near boolean, total bigint")


@register(
    "rerun_files",
    "SELECT concat('scan ', image_id, '.png') AS name, CAST(sum(255 - b + 255 - g + 255 - r) AS BIGINT) AS total FROM px WHERE image_id % 3 <> 0 GROUP BY image_id",
)
def rerun_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree is written, again by a job that fails, and again for fewer images with other pixels: what the last run wrote is there."""
    root = trees.new_folder(spark)
    rows = trees.file_rows(fixture_images(spark, sf_dir))
    names = rows.columns
    write_png_tree(rows, root)

    def spoiled(row: dict) -> dict:
        if row["image_id"] % 5 == 1:
            raise ValueError("this job fails")
        return {n: [row[n]] for n in names}

    try:
        write_png_tree(map_rows(rows, spoiled, trees.TREE), root)
    except Exception as reason:
        if "this job fails" not in str(reason):
            raise
    else:
        raise AssertionError("the job should have failed")
    if list_files(spark, root).count() != rows.count():
        raise AssertionError("a failed job has changed the tree")

    def inverted(row: dict) -> dict:
        import numpy as np

        return {n: [row[n]] for n in names} | {"content": [(255 - np.frombuffer(row["content"], np.uint8)).tobytes()]}

    write_png_tree(map_rows(rows.filter("image_id % 3 <> 0"), inverted, trees.TREE), root)
    return file_totals(spark, root)


@register("originals", f"SELECT concat('scan ', image_id, '.png') AS name, '' AS category, image_id % 10 <> 0 AS whole FROM (SELECT DISTINCT image_id FROM px)")
def originals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input files as they are, readable or not, in the job's table of originals."""
    target = trees.new_folder(spark)
    jobs.segment_dataset(spark, trees.write_damaged_tree(spark, sf_dir), target)
    end = F.expr("right(hex(content), 16)") == "49454E44AE426082"  # the last chunk's name and checksum
    return spark.read.parquet(f"{target}/originals").select(
        paths.file_name(F.col("path")).alias("name"), F.coalesce(F.col("category"), F.lit("")).alias("category"), end.alias("whole")
    )


@register("empty_tree", "SELECT 'write' AS stage, true AS ok, image_id AS n FROM px WHERE false")
def empty_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree without images gives empty tables."""
    return status_summary(jobs.segment_dataset(spark, trees.write_text_tree(spark, sf_dir), trees.new_folder(spark)))


@register("one_class", f"SELECT image_id, category, kind, CASE WHEN category = 'benign' THEN -total ELSE total END AS total FROM (SELECT image_id, {O.CATEGORY} AS category, 'original' AS kind, CAST(sum(b + g + r) AS BIGINT) AS total FROM px GROUP BY ALL)")
def one_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One class of a table is written again; the others stay."""
    px_rows = pixels_of(spark, sf_dir).groupBy("image_id").agg(F.sum(F.col("b") + F.col("g") + F.col("r")).alias("total"))
    rows = px_rows.select("image_id", "total", category_of().alias("category"), F.lit("original").alias("kind"))
    target = trees.new_folder(spark)
    write_artifacts(rows, target)
    again = read_table(spark, target, rows.schema).filter("category = 'benign'").withColumn("total", -F.col("total"))
    write_artifacts(cut_lineage(again), target, one_class=True)
    return read_table(spark, target, rows.schema)
