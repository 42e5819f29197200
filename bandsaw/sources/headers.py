"""What the first bytes of image files tell: format, size, channels and depth.

Only these bytes are read, in tasks, and nothing is decoded.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandsaw.sources.store import opened, reachable

HEAD_BYTES = 1 << 16  # a JPEG may hold metadata before its size
# The decoder's limit on decoded bytes, channels per PNG colour type, and JPEG markers without a size.
DECODER_BYTES = 1_000_000_000
PNG_CHANNELS = {0: 1, 2: 3, 3: 3, 4: 2, 6: 4}
JPEG_NO_SIZE = {0xC4, 0xC8, 0xCC}
TOO_LARGE = "too large to decode"
HEADER = "format string, h_height int, h_width int, h_channels int, bits int"


def header(data: bytes) -> tuple[str | None, int | None, int | None, int | None, int | None]:
    """(format, height, width, channels, bits per value); all None for other files."""
    none = (None,) * 5
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 26:
        width, height = int.from_bytes(data[16:20], "big"), int.from_bytes(data[20:24], "big")
        return "png", height, width, PNG_CHANNELS.get(data[25]), data[24]
    if data[:2] == b"BM" and len(data) >= 30:
        width, height = (int.from_bytes(data[i : i + 4], "little", signed=True) for i in (18, 22))
        bits = int.from_bytes(data[28:30], "little")
        return "bmp", abs(height), width, 4 if bits == 32 else 3, 8
    if data[:6] in (b"GIF87a", b"GIF89a") and len(data) >= 10:
        return "gif", int.from_bytes(data[8:10], "little"), int.from_bytes(data[6:8], "little"), 3, 8
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(data):
            if data[at] != 0xFF:
                return none
            marker = data[at + 1]
            if marker == 0xFF:
                at += 1
            elif 0xC0 <= marker <= 0xCF and marker not in JPEG_NO_SIZE:
                height, width = int.from_bytes(data[at + 5 : at + 7], "big"), int.from_bytes(data[at + 7 : at + 9], "big")
                return "jpeg", height, width, data[at + 9], data[at + 4]
            else:
                at += 2 + int.from_bytes(data[at + 2 : at + 4], "big")
        return "jpeg", None, None, None, None
    if data[:4] in (b"II*\0", b"MM\0*"):
        return "tiff", None, None, None, None
    return none


def with_headers(files: DataFrame) -> DataFrame:
    """A listing (path, ...) with format, h_height, h_width, h_channels and bits; null in stores that only Spark can open."""
    from pyspark.sql import types as T

    made = T.StructType.fromDDL(HEADER)
    schema = T.StructType([*files.schema, *made])
    kinds = [pa.string(), *[pa.int32()] * 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch.column("path").to_pylist():
                if not reachable(path):
                    rows.append(header(b""))
                    continue
                store, name = opened(path)
                with store.open_input_file(name) as source:
                    rows.append(header(source.read(HEAD_BYTES)))
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *made.names])

    return files.mapInArrow(run, schema)


def problem() -> Column:
    """Why a file of ``with_headers`` cannot be decoded as it should, or null.

    Size and depth matter to formats that are decoded whole.
    """
    size = F.col("h_height").cast("bigint") * F.col("h_width") * F.col("h_channels")
    name = F.element_at(F.split("path", "/"), -1)
    whole = ~F.col("format").isin("png", "bmp")
    return (
        F.when(F.col("length") == 0, F.lit("empty file"))
        .when(F.col("format").isNull(), F.lit("no known image format"))
        .when(name.rlike("^[_.]"), F.lit("hidden name"))
        .when(whole & (size >= DECODER_BYTES), F.lit(TOO_LARGE))
        .when(whole & (F.col("bits") > 8) & (F.col("h_channels") == 1), F.lit("more than 8 bits of gray"))
    )


def info(files: DataFrame) -> DataFrame:
    """Format, size and depth of every image file, without its pixels."""
    columns = [F.col(f"h_{c}").alias(n) for c, n in (("height", "height"), ("width", "width"), ("channels", "n_channels"))]
    return with_headers(files).select("path", "rel_path", "format", *columns, "bits")
