"""Images, bands and pixel rows, and the ways between them.

``images``  image_id, height, width, n_channels, data      one row per image
``bands``   image_id, band, bands, height, width,          one row per band
            y0, y1 (core rows), e0, e1 (rows held), data
``pixels``  image_id, y, x, <channels>                     one row per pixel

A band holds its core rows ``[y0, y1)`` and ``halo`` further rows on each inner
side. Band size is bounded by a pixel budget, not by the image.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from bandsaw.operators.kernels import gray
from bandsaw.session import bounded_batches, shuffle_partitions

GEOMETRY = "image_id bigint, band int, bands int, height int, width int, y0 int, y1 int, e0 int, e1 int"
GEOMETRY_NAMES = [f.split()[0] for f in GEOMETRY.split(", ")]
BANDS = GEOMETRY + ", data binary"
KEY = ["image_id", "band"]
PIECES = "image_id bigint, band int, height int, width int, place binary, data binary"

# ROI blur (2) + opening and closing (2 x 4) + two rows that neighbours share afterwards.
HALO = 12
PIXEL_BUDGET = 1 << 20
# What a task gathers before it hands a record batch on.
FLUSH_ROWS = 1 << 14
FLUSH_BYTES = 1 << 20
# What a Python object takes besides its content: an empty array, a list of one number.
OBJECT_BYTES = 128


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of record batches; one at a time becomes Python values."""
    for batch in batches:
        names, columns = batch.schema.names, batch.columns
        for i in range(batch.num_rows):
            yield {n: c[i].as_py() for n, c in zip(names, columns, strict=True)}


def map_rows(
    df: DataFrame, fn: Callable[[dict], dict | None], schema: str, failed: Callable[[dict, Exception], dict | None] | None = None
) -> DataFrame:
    """Arrow map: ``fn`` turns one input row into equally long output columns.

    Output is gathered into record batches and flushed by what it takes as Python objects, so a task holds
    an input batch (``bounded_batches``), the values of one row and one bounded output batch. For a row that makes ``fn`` raise, ``failed``
    gives the output, so that an error is data; without it, and when memory runs out, the task fails.
    """
    struct = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)

    def column(parts: list, kind: pa.DataType) -> pa.Array:
        if isinstance(parts[0], np.ndarray):
            return pa.array(np.concatenate(parts), type=kind)
        return pa.array([v for part in parts for v in part], type=kind)

    def size(value) -> int:
        if isinstance(value, np.ndarray):
            return value.nbytes + OBJECT_BYTES
        return OBJECT_BYTES + sum(content(v) for v in value)

    def content(v) -> int:
        if isinstance(v, np.ndarray):
            return v.nbytes + OBJECT_BYTES
        return len(v) if isinstance(v, (bytes, str)) else 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        rows = held_bytes = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [column([h[f.name] for h in held], f.type) for f in arrow], schema=arrow
            )

        for row in rows_of(batches):
            try:
                out = fn(row)
            except Exception as reason:
                if failed is None or isinstance(reason, MemoryError):
                    raise
                out = failed(row, reason)
            if out is None:
                continue
            held.append(out)
            rows += len(next(iter(out.values())))
            held_bytes += sum(size(v) for v in out.values())
            if rows >= FLUSH_ROWS or held_bytes >= FLUSH_BYTES:
                yield flush()
                held, rows, held_bytes = [], 0, 0
        if held:
            yield flush()

    bounded_batches(df.sparkSession)
    return df.mapInArrow(run, struct)


def geometry(row: dict, **changes) -> dict:
    """The geometry of ``row`` as one-row output columns."""
    return {n: [changes.get(n, row[n])] for n in GEOMETRY_NAMES}


def block(row: dict, name: str = "data") -> np.ndarray:
    """The pixels a band row holds."""
    rows, width = row["e1"] - row["e0"], row["width"]
    flat = np.frombuffer(row[name], np.uint8)
    if flat.size == rows * width:
        return flat.reshape(rows, width)
    return flat.reshape(rows, width, -1)


def at_frame(row: dict) -> tuple[bool, bool]:
    return row["e0"] == 0, row["e1"] == row["height"]


def shrink(row: dict, reach: int) -> dict:
    """``row`` after a neighbourhood operator used up ``reach`` halo rows."""
    top, bottom = at_frame(row)
    e0 = 0 if top else row["e0"] + reach
    e1 = row["height"] if bottom else row["e1"] - reach
    if e0 > row["y0"] or e1 < row["y1"]:
        raise ValueError(f"needs {reach} halo rows; cut the bands with a larger halo or use recut()")
    return {**row, "e0": e0, "e1": e1}


def trim(row: dict, pixels: np.ndarray) -> np.ndarray:
    """The core rows of a block."""
    return pixels[row["y0"] - row["e0"] : row["y1"] - row["e0"]]


def band_count(height: int, width: int, rows: int | None, halo: int) -> int:
    rows = rows or max(64, PIXEL_BUDGET // width)
    if rows < halo:
        raise ValueError(f"bands of {rows} rows cannot have a halo of {halo}")
    return max(1, height // rows)


def cut_rows(image_id: int, pixels: np.ndarray, rows: int | None, halo: int) -> dict:
    """The bands of one decoded image as output columns."""
    height, width = pixels.shape[:2]
    n = band_count(height, width, rows, halo)
    edge = [i * height // n for i in range(n + 1)]
    e0 = [max(0, y - halo) for y in edge[:-1]]
    e1 = [min(height, y + halo) for y in edge[1:]]
    return {
        "image_id": [image_id] * n,
        "band": list(range(n)),
        "bands": [n] * n,
        "height": [height] * n,
        "width": [width] * n,
        "y0": edge[:-1],
        "y1": edge[1:],
        "e0": e0,
        "e1": e1,
        "data": [pixels[s:e].tobytes() for s, e in zip(e0, e1)],
    }


def to_bands(
    images: DataFrame,
    rows: int | None = None,
    halo: int = HALO,
    as_gray: bool = False,
    carry: tuple[str, ...] = (),
    several: bool | None = None,
) -> DataFrame:
    """Cut images into bands where they are decoded, without any shuffle.

    Channels are normalised on the way: gray is replicated to B, G, R and alpha
    is dropped. ``as_gray`` gives one channel instead (mask files). ``carry``
    names string columns of ``images`` to repeat on every band, which saves a
    join of pixel data later. ``several`` keeps only the images that are cut into
    several bands, or only the others; their pixels alone go to the cutting.
    """
    if several is not None:
        per_band = F.lit(rows) if rows else F.greatest(F.lit(64), F.floor(F.lit(PIXEL_BUDGET) / F.col("width")))
        more = F.col("height") >= 2 * per_band
        images = images.filter(more if several else ~more)

    def cut(row: dict) -> dict:
        channels = row["n_channels"]
        a = np.frombuffer(row["data"], np.uint8).reshape(row["height"], row["width"], channels)
        if as_gray:
            a = a[..., 0] if channels == 1 else gray(a[..., :3])
        else:
            a = np.repeat(a, 3, axis=2) if channels == 1 else a[..., :3]
        out = cut_rows(row["image_id"], a, rows, halo)
        return out | {c: [row[c]] * len(out["band"]) for c in carry}

    source = images.select("image_id", "height", "width", "n_channels", "data", *carry)
    return map_rows(source, cut, BANDS + carried(carry))


def carried(carry: tuple[str, ...]) -> str:
    return "".join(f", {c} string" for c in carry)


def with_per_image(bands: DataFrame, per_image: DataFrame) -> DataFrame:
    """Join a one-row-per-image table to the bands on (image, band).

    The small row is repeated once per band, so the pixel bytes keep their
    partitioning and a large image does not gather on its id.
    """
    counts = bands.filter("band = 0").select("image_id", "bands")
    rows = per_image.join(counts, "image_id").withColumn(
        "band", F.explode(F.sequence(F.lit(0), F.col("bands") - 1))
    )
    return bands.join(rows.drop("bands").hint("shuffle_hash"), KEY)


def spread(bands: DataFrame, partitions: int | None = None) -> DataFrame:
    """The one shuffle of pixel data: hash on (image, band).

    Later joins bring small per-band rows to this partitioning, so the pixel
    bytes stay where they are, and the bands of one image are spread out.
    """
    return bands.repartition(partitions or shuffle_partitions(bands.sparkSession), *KEY)


def map_block(
    bands: DataFrame,
    fn: Callable[[np.ndarray, bool, bool], np.ndarray],
    reach: int = 0,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Replace the pixels of every band by ``fn(block, top, bottom)``."""

    def step(row: dict) -> dict:
        out = shrink(row, reach)
        top, bottom = at_frame(row)
        pixels = fn(block(row), top, bottom)
        return geometry(out) | {"data": [pixels.tobytes()]} | {c: [row[c]] for c in carry}

    return map_rows(bands.select(*GEOMETRY_NAMES, "data", *carry), step, BANDS + carried(carry))


def to_pixels(
    bands: DataFrame, channels: tuple[str, ...] = ("b", "g", "r"), column: str = "data", carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per core pixel. ``carry`` names string columns to repeat, which saves a join of pixel rows later."""

    def explode(row: dict) -> dict:
        core = trim(row, block(row, column)).reshape(-1, len(channels))
        rows, width = row["y1"] - row["y0"], row["width"]
        return {
            "image_id": np.full(rows * width, row["image_id"], np.int64),
            "y": np.repeat(np.arange(row["y0"], row["y1"], dtype=np.int32), width),
            "x": np.tile(np.arange(width, dtype=np.int32), rows),
        } | {name: core[:, i].astype(np.int32) for i, name in enumerate(channels)} | {c: [row[c]] * (rows * width) for c in carry}

    schema = "image_id bigint, y int, x int, " + ", ".join(f"{c} int" for c in channels) + carried(carry)
    return map_rows(bands.select(*GEOMETRY_NAMES, column, *carry), explode, schema)


def _packing(channels: list[str], rows: int, halo: int):
    """Task function: the pixels that a record batch holds of a band become one piece, their places and their values."""
    arrow = to_arrow_schema(T.StructType.fromDDL(PIECES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            image, height, width, y, x = (
                batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("image_id", "height", "width", "y", "x")
            )
            values = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in channels], axis=-1).astype(np.uint8)
            n = np.maximum(1, height // rows)
            lowest = ((np.maximum(y - halo, 0) + 1) * n - 1) // height
            highest = ((np.minimum(y + halo, height - 1) + 1) * n - 1) // height
            copies = highest - lowest + 1
            of = np.repeat(np.arange(y.size), copies)
            band = lowest[of] + np.arange(of.size) - np.repeat(np.cumsum(copies) - copies, copies)
            order = np.lexsort((band, image[of]))
            of, band = of[order], band[order]
            place = (y[of] - np.maximum(0, band * height[of] // n[of] - halo)) * width[of] + x[of]
            first = np.flatnonzero(np.r_[True, (np.diff(image[of]) != 0) | (np.diff(band) != 0)])
            head = of[first]
            edge = np.r_[first, of.size]
            columns = [
                pa.array(image[head]), pa.array(band[first].astype(np.int32)), pa.array(height[head].astype(np.int32)),
                pa.array(width[head].astype(np.int32)), _binaries(place.astype(np.int32), edge), _binaries(values[of], edge),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return run


def _binaries(values: np.ndarray, edge: np.ndarray) -> pa.Array:
    """The rows of ``values`` between each two edges as one binary value."""
    flat = np.ascontiguousarray(values)
    offsets = (edge * (flat.nbytes // len(flat))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edge) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


def _held(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column without nulls as one array of ``kind``, and where each value starts and the last ends."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data.view(kind) if kind is np.uint8 else data.copy().view(kind), (offsets - offsets[0]) // np.dtype(kind).itemsize


def _unpacking(n_channels: int, rows: int, halo: int):
    """Task function: pieces in order of (image, band) become bands; pixels that no row gives are zero."""
    arrow = to_arrow_schema(T.StructType.fromDDL(BANDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        size, open_, pixels = 0, None, None

        def closed() -> dict:
            image_id, band, height, width, n, y0, y1, e0, e1 = open_
            values = [image_id, band, n, height, width, y0, y1, e0, e1, pixels.tobytes()]
            return dict(zip(arrow.names, values, strict=True))

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(c).to_numpy() for c in ("image_id", "band", "height", "width")]
            place, at = _held(batch.column("place"), np.int32)
            data, _ = _held(batch.column("data"), np.uint8)
            data = data.reshape(-1, n_channels)
            first = np.flatnonzero(np.r_[True, (np.diff(keys[0]) != 0) | (np.diff(keys[1]) != 0)])
            for i, j in zip(first, np.r_[first[1:], batch.num_rows]):
                image_id, band, height, width = (int(k[i]) for k in keys)
                if open_ is None or open_[:2] != (image_id, band):
                    if open_:
                        done.append(closed())
                        size += pixels.size
                    n = max(1, height // rows)
                    y0, y1 = band * height // n, (band + 1) * height // n
                    e0, e1 = max(0, y0 - halo), min(height, y1 + halo)
                    open_ = (image_id, band, height, width, n, y0, y1, e0, e1)
                    pixels = np.zeros(((e1 - e0) * width, n_channels), np.uint8)
                pixels[place[at[i] : at[j]]] = data[at[i] : at[j]]
                if size >= FLUSH_BYTES:
                    yield pa.RecordBatch.from_pylist(done, schema=arrow)
                    done, size = [], 0
        if open_:
            done.append(closed())
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=arrow)

    return run


def from_pixels(
    pixels: DataFrame, channels: tuple[str, ...] = ("b", "g", "r"), rows: int | None = None, halo: int = HALO
) -> DataFrame:
    """Bands from pixel rows (image_id, height, width, y, x, channels).

    Pixels near a seam go to both bands. Tasks pack the pixels of a record batch by band before they
    are shuffled, a few bytes per pixel, and bands are put together from pieces in order.
    """
    rows = rows or 64
    if rows < halo:
        raise ValueError(f"bands of {rows} rows cannot have a halo of {halo}")
    bounded_batches(pixels.sparkSession)
    names = list(channels)
    pieces = pixels.select("image_id", "height", "width", "y", "x", *names).mapInArrow(_packing(names, rows, halo), PIECES)
    placed = pieces.repartition(shuffle_partitions(pixels.sparkSession), *KEY).sortWithinPartitions(*KEY)
    return placed.mapInArrow(_unpacking(len(names), rows, halo), BANDS)


def recut(bands: DataFrame, rows: int | None = None, halo: int = HALO) -> DataFrame:
    """Cut bands differently, or give them a fresh halo.

    Each band sends the rows that another band needs, as slices; a target band
    joins its slices. Works for any earlier cut.
    """
    piece = GEOMETRY + ", start int, data binary"

    def send(row: dict) -> dict | None:
        height, width = row["height"], row["width"]
        core = trim(row, block(row))
        n = band_count(height, width, rows, halo)
        out: dict[str, list] = {name: [] for name in [*GEOMETRY_NAMES, "start", "data"]}
        first = max(0, ((max(0, row["y0"] - halo) + 1) * n - 1) // height)
        last = (min(height, row["y1"] + halo) * n - 1) // height
        for band in range(first, last + 1):
            y0, y1 = band * height // n, (band + 1) * height // n
            e0, e1 = max(0, y0 - halo), min(height, y1 + halo)
            start, stop = max(e0, row["y0"]), min(e1, row["y1"])
            if start < stop:
                values = [row["image_id"], band, n, height, width, y0, y1, e0, e1, start]
                values.append(core[start - row["y0"] : stop - row["y0"]].tobytes())
                for name, value in zip(out, values):
                    out[name].append(value)
        return out

    pieces = map_rows(bands.select(*GEOMETRY_NAMES, "data"), send, piece)
    joined = F.expr("listagg(data) WITHIN GROUP (ORDER BY start)").alias("data")
    rest = [n for n in GEOMETRY_NAMES if n not in KEY]
    made = pieces.groupBy(*KEY).agg(*[F.first(n).alias(n) for n in rest], joined)
    return made.select(*GEOMETRY_NAMES, "data")
