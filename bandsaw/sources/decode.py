"""PNG and BMP files to bands in the tasks that read them, a few rows at a time.

A task holds the rows of one band, whatever the size of the image: PNG data are inflated
and unfiltered in blocks of rows, BMP rows are read where they lie. Which files are decoded
is decided by a table, before any is opened. A file that cannot be decoded gives one row
with ``band`` -1 and the reason, and none of its bands.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from bandsaw.functions import paths
from bandsaw.operators.bands import BANDS, FLUSH_BYTES, GEOMETRY_NAMES, HALO, band_count, carried
from bandsaw.operators.kernels import gray
from bandsaw.session import bounded_batches, shuffle_partitions
from bandsaw.sources.headers import PNG_CHANNELS, header
from bandsaw.sources.formats import SIGNATURE
from bandsaw.sources.store import opened

EXTENSIONS = ("png", "bmp")
BLOCK_ROWS, BLOCK_BYTES = 128, 8 << 20  # rows that are unfiltered together
READ_BYTES = 1 << 18
TASK_BYTES = 64 << 20  # files of one task, about
ROW_BYTES = 1 << 10  # what a waiting row takes besides its pixels, about
# Fixed values of PNG: palette colour type, filters of a row.
PALETTE = 3
NONE, SUB, UP, AVERAGE, PAETH = range(5)


def _unfiltered(raw: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    """Rows without their filter byte; ``above`` is the row before them, ``step`` the bytes of a pixel.

    Rows of simple filters are done one by one. Others depend on their left
    neighbour, so a block with such rows advances along its diagonals, all rows at once.
    """
    kinds, data = raw[:, 0], raw[:, 1:]
    if kinds.max() > PAETH:
        raise ValueError("unknown filter of a row")
    n, width = data.shape
    if kinds.max() <= UP:
        out = data.copy()
        for i, kind in enumerate(kinds.tolist()):
            if kind == SUB:
                whole = width // step * step
                out[i, :whole] = np.cumsum(data[i, :whole].reshape(-1, step), axis=0, dtype=np.uint8).ravel()
            elif kind == UP:
                out[i] += above if i == 0 else out[i - 1]
        return out
    pixels = -(-width // step)
    # a column of zeros on the left, the row above on top; a diagonal is a slice of step ``line - 1``
    line = pixels + 1
    held = np.zeros((n + 1, line, step), np.int16)
    held[0, 1:].reshape(-1)[:width] = above
    held[1:, 1:].reshape(n, -1)[:, :width] = data
    flat = held.reshape(-1, step)
    is_ = [(kinds == k).astype(np.int16)[:, None] for k in range(5)]
    for t in range(n + pixels - 1):
        low, high = max(0, t - pixels + 1), min(n - 1, t)
        first = (low + 1) * line + 1 + t - low
        cut = lambda at: flat[at : at + (high - low) * (line - 1) + 1 : line - 1]  # noqa: B023, E731
        a, b, c = cut(first - 1), cut(first - line), cut(first - line - 1)
        near_a, near_b = np.abs(b - c), np.abs(a - c)
        near_c = np.abs(a + b - c - c)
        paeth = np.where((near_a <= near_b) & (near_a <= near_c), a, np.where(near_b <= near_c, b, c))
        of = slice(low, high + 1)
        guess = is_[SUB][of] * a + is_[UP][of] * b + is_[AVERAGE][of] * ((a + b) >> 1) + is_[PAETH][of] * paeth
        here = cut(first)
        here += guess
        here &= 255
    return held[1:, 1:].reshape(n, -1)[:, :width].astype(np.uint8)


class PngRows:
    """Rows of a PNG in order, as (rows, width, 1 or 3) in B, G, R; alpha is dropped, 16 bits give their high byte."""

    def __init__(self, source):
        self.source = source
        if source.read(8) != SIGNATURE:
            raise ValueError("no PNG")
        kind, body = self._chunk()
        if kind != b"IHDR" or len(body) != 13:
            raise ValueError("a PNG without its header")
        self.width, self.height = int.from_bytes(body[:4], "big"), int.from_bytes(body[4:8], "big")
        self.bits, self.colour, _, _, interlaced = body[8:13]
        if not self.width or not self.height or self.colour not in PNG_CHANNELS or self.bits not in (1, 2, 4, 8, 16):
            raise ValueError("a PNG of unknown kind")
        if interlaced:
            raise ValueError("an interlaced PNG")
        self.samples = 1 if self.colour == PALETTE else PNG_CHANNELS[self.colour]
        self.line = -(-self.width * self.samples * self.bits // 8)
        self.step = max(1, self.samples * self.bits // 8)
        self.palette = np.zeros((256, 3), np.uint8)

    def _chunk(self) -> tuple[bytes, bytes]:
        head = self.source.read(8)
        if len(head) < 8:
            raise ValueError("the file ends early")
        size = int.from_bytes(head[:4], "big")
        if head[4:] == b"IDAT":
            self.left = size
            return head[4:], b""
        body = self.source.read(size)
        self.source.read(4)
        return head[4:], body

    def _packed(self) -> Iterator[bytes]:
        """The compressed data, piece by piece."""
        kind = None
        while kind != b"IDAT":
            kind, body = self._chunk()
            if kind == b"PLTE":
                self.palette[: len(body) // 3] = np.frombuffer(body, np.uint8).reshape(-1, 3)[:, ::-1]
            if kind == b"IEND":
                raise ValueError("a PNG without pixels")
        while kind == b"IDAT":
            while self.left:
                piece = self.source.read(min(self.left, READ_BYTES))
                if not piece:
                    raise ValueError("the file ends early")
                self.left -= len(piece)
                yield piece
            self.source.read(4)
            kind, _ = self._chunk()

    def raw(self) -> Iterator[np.ndarray]:
        """Blocks of filtered rows; memory is bounded by a block, or one row."""
        rows = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (self.line + 1)))
        unpack, held, done = zlib.decompressobj(), bytearray(), 0
        for piece in self._packed():
            while piece and done < self.height:
                wanted = min(rows, self.height - done) * (self.line + 1)
                held += unpack.decompress(piece, wanted - len(held))
                piece = unpack.unconsumed_tail
                if len(held) == wanted:
                    block = np.frombuffer(bytes(held), np.uint8).reshape(-1, self.line + 1)
                    done += len(block)
                    held.clear()
                    yield block
                elif not piece:
                    break
            if done == self.height:
                return
        raise ValueError("the pixels end early")

    def check(self) -> None:
        """Read all without keeping it; raises what decoding would."""
        for block in self.raw():
            if block[:, 0].max() > PAETH:
                raise ValueError("unknown filter of a row")

    def __iter__(self) -> Iterator[np.ndarray]:
        above = np.zeros(self.line, np.uint8)
        for block in self.raw():
            rows = _unfiltered(block, above, self.step)
            above = rows[-1]
            yield self._samples(rows)

    def _samples(self, rows: np.ndarray) -> np.ndarray:
        n = len(rows)
        if self.bits == 16:
            rows = rows[:, ::2]
        elif self.bits < 8:
            shifts = np.arange(8 - self.bits, -1, -self.bits, dtype=np.uint8)
            rows = (rows[:, :, None] >> shifts & (1 << self.bits) - 1).reshape(n, -1)[:, : self.width * self.samples]
            if self.colour != PALETTE:
                rows = rows * np.uint8(255 // ((1 << self.bits) - 1))
        a = rows.reshape(n, self.width, self.samples)
        if self.colour == PALETTE:
            return self.palette[a[..., 0]]
        return a[..., 2::-1] if self.samples >= 3 else a[..., :1]


class BmpRows:
    """Rows of an uncompressed BMP of 8, 24 or 32 bits, from the top down, in B, G, R."""

    def __init__(self, source):
        self.source = source
        head = source.read(54)
        if head[:2] != b"BM" or len(head) < 54:
            raise ValueError("no BMP")
        number = lambda at, size, signed=False: int.from_bytes(head[at : at + size], "little", signed=signed)
        self.first, self.width, height = number(10, 4), number(18, 4, True), number(22, 4, True)
        self.height, self.upwards = abs(height), height > 0
        self.bits, packing, colours = number(28, 2), number(30, 4), number(46, 4)
        if self.width <= 0 or not height or self.bits not in (8, 24, 32) or packing not in ((0, 3) if self.bits == 32 else (0,)):
            raise ValueError("a BMP of unknown kind")
        self.line = -(-self.width * self.bits // 32) * 4
        self.palette = np.zeros((256, 3), np.uint8)
        if self.bits == 8:
            source.seek(14 + number(14, 4))
            held = np.frombuffer(source.read(4 * (colours or 256)), np.uint8)
            self.palette[: held.size // 4] = held[: held.size // 4 * 4].reshape(-1, 4)[:, :3]

    def check(self) -> None:
        if self.source.size() < self.first + self.line * self.height:
            raise ValueError("the pixels end early")

    def __iter__(self) -> Iterator[np.ndarray]:
        rows = max(1, min(BLOCK_ROWS, BLOCK_BYTES // self.line))
        for y in range(0, self.height, rows):
            n = min(rows, self.height - y)
            at = self.height - y - n if self.upwards else y
            self.source.seek(self.first + at * self.line)
            data = self.source.read(n * self.line)
            if len(data) < n * self.line:
                raise ValueError("the pixels end early")
            a = np.frombuffer(data, np.uint8).reshape(n, self.line)
            a = a[::-1] if self.upwards else a
            a = a[:, : self.width * self.bits // 8].reshape(n, self.width, -1)
            yield self.palette[a[..., 0]] if self.bits == 8 else a[..., :3]


def image_rows(source) -> PngRows | BmpRows:
    start = source.read(64)
    source.seek(0)
    if not start:
        raise ValueError("empty file")
    if start[:2] == b"BM":
        return BmpRows(source)
    if start[:8] == SIGNATURE:
        return PngRows(source)
    other = header(start)[0]
    raise ValueError(f"named as another format than {other}" if other else "no known image format")


def cut_bands(image: PngRows | BmpRows, rows: int | None, halo: int, as_gray: bool) -> Iterator[dict]:
    """The bands of an image as it is read, with the geometry of ``to_bands``."""
    height, width = image.height, image.width
    n = band_count(height, width, rows, halo)
    blocks = iter(image)
    held: list[np.ndarray] = []
    start = stop = 0  # rows that are held
    for band in range(n):
        y0, y1 = band * height // n, (band + 1) * height // n
        e0, e1 = max(0, y0 - halo), min(height, y1 + halo)
        while stop < e1:
            block = next(blocks)
            if as_gray:
                block = block[..., 0] if block.shape[2] == 1 else gray(block)
            elif block.shape[2] == 1:
                block = np.repeat(block, 3, axis=2)
            held.append(block)
            stop += len(block)
        while start + len(held[0]) <= e0:
            start += len(held.pop(0))
        together = np.concatenate(held)[e0 - start : e1 - start]
        values = [band, n, height, width, y0, y1, e0, e1, together.tobytes()]
        yield dict(zip([*GEOMETRY_NAMES[1:], "data"], values, strict=True))


def _decoding(schema: T.StructType, rows: int | None, halo: int, as_gray: bool, carry: tuple[str, ...], several: bool | None):
    """Task function: files become rows of bands, or of why they have none; a megabyte of either is handed on."""
    arrow = to_arrow_schema(schema)

    def bands_of(path: str) -> Iterator[dict]:
        store, name = opened(path)
        with store.open_input_file(name) as source:
            try:
                image = image_rows(source)
            except (ValueError, zlib.error):
                if several is False:  # told on the other side
                    return
                raise
            more = band_count(image.height, image.width, rows, halo) > 1
            if several is not None and more != several:
                return
            if not more:
                yield from list(cut_bands(image, rows, halo, as_gray))
                return
            image.check()
            source.seek(0)
            yield from cut_bands(image_rows(source), rows, halo, as_gray)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict] = []
        size = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([w.get(f.name) for w in waiting], f.type) for f in arrow], schema=arrow)

        for batch in batches:
            for row in batch.to_pylist():
                kept = {"image_id": row["image_id"]} | {c: row[c] for c in carry}
                try:
                    for band in bands_of(row["path"]):
                        waiting.append(band | kept)
                        size += len(band["data"]) + ROW_BYTES
                        if size >= FLUSH_BYTES:
                            yield flush()
                            waiting, size = [], 0
                except (ValueError, zlib.error) as reason:  # what the file is to blame for; a store that fails fails the task
                    empty = dict.fromkeys(GEOMETRY_NAMES, 0) | {"band": -1, "message": str(reason)}
                    waiting.append(empty | kept)
                    size += ROW_BYTES
                    if size >= FLUSH_BYTES:
                        yield flush()
                        waiting, size = [], 0
        if waiting:
            yield flush()

    return run


def decode_bands(
    files: DataFrame, rows: int | None = None, halo: int = HALO, as_gray: bool = False, carry: tuple[str, ...] = (),
    several: bool | None = None,
) -> DataFrame:
    """Bands of the files (image_id, path, length, and ``carry``), with ``message``.

    ``message`` is null but for files that cannot be decoded: they have one row, with
    ``band`` -1, no data and the reason. A file of several bands is read through once before, so that a
    damaged one gives no band. Tasks get files of about ``TASK_BYTES``. ``several`` keeps only the images
    that are cut into several bands and the files without a readable header, or only the others: what it
    leaves out is read up to its header.
    """
    schema = T.StructType.fromDDL(BANDS + carried(carry) + ", message string")
    bounded_batches(files.sparkSession)
    total = files.agg(F.sum("length")).first()[0] or 0
    tasks = max(shuffle_partitions(files.sparkSession), -(-total // TASK_BYTES))
    placed = files.select("image_id", "path", "length", *carry).repartition(tasks, "image_id")
    return placed.mapInArrow(_decoding(schema, rows, halo, as_gray, carry, several), schema)


def is_rowwise(path):
    """Whether a file of this name is decoded here."""
    return F.lower(F.element_at(F.split(path, r"\."), -1)).isin(*EXTENSIONS) & ~paths.file_name(path).rlike("^[_.]")
