"""Encoders that take an image band after band: PNG, BMP and baseline JPEG.

An encoder gives the bytes of the head, of each block of rows and of the end. None holds more than
a block of rows, so a task can stream an image of any height. Pixels are B, G, R or gray.
"""

from __future__ import annotations

import struct
import zlib
from pathlib import PurePosixPath

import numpy as np

# The PNG signature and the colour type per channel count.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
COLOUR_TYPE = {1: 0, 3: 2}

# The example quantisation table for luminance and the example Huffman tables of the JPEG standard, annex K.
QUANTISATION = """
16 11 10 16 24 40 51 61
12 12 14 19 26 58 60 55
14 13 16 24 40 57 69 56
14 17 22 29 51 87 80 62
18 22 37 56 68 109 103 77
24 35 55 64 81 104 113 92
49 64 78 87 103 121 120 101
72 92 95 98 112 100 103 99
"""
DC_COUNTS = [0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0]
AC_COUNTS = [0, 2, 1, 3, 3, 2, 4, 3, 5, 5, 4, 4, 0, 0, 1, 125]
AC_SHORT = "01 02 03 00 04 11 05 12 21 31 41 06 13 51 61 07 22 71 14 32 81 91 a1 08 23 42 b1 c1 15 52 d1 f0 24 33 62 72 82"

QUALITY = 95
MOST_SIDE = 65_535  # pixels that a JPEG's head can tell
BLOCK_PIXELS = 1 << 18  # that are turned into bits at a time


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def png_head(width: int, height: int, channels: int) -> bytes:
    return SIGNATURE + _chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, COLOUR_TYPE[channels], 0, 0, 0))


def png_lines(content: bytes, width: int, channels: int) -> bytes:
    """Scanlines with their filter byte; B, G, R becomes R, G, B."""
    a = np.frombuffer(content, np.uint8).reshape(-1, width, channels)[..., ::-1]
    lines = np.zeros((a.shape[0], 1 + width * channels), np.uint8)
    lines[:, 1:] = a.reshape(a.shape[0], -1)
    return lines.tobytes()


class PngEncoder:
    def __init__(self, width: int, height: int, channels: int):
        self.width, self.channels = width, channels
        self.head = png_head(width, height, channels)
        self.packer = zlib.compressobj(6)

    def rows(self, content: bytes) -> bytes:
        body = self.packer.compress(png_lines(content, self.width, self.channels))
        return _chunk(b"IDAT", body) if body else b""

    def end(self) -> bytes:
        return _chunk(b"IDAT", self.packer.flush()) + _chunk(b"IEND", b"")


class BmpEncoder:
    """Uncompressed, from the top down: 24 bits, or 8 bits with a palette of grays."""

    def __init__(self, width: int, height: int, channels: int):
        self.width, self.channels = width, channels
        self.line = (width * channels + 3) // 4 * 4
        palette = bytes(x for v in range(256) for x in (v, v, v, 0)) if channels == 1 else b""
        start, size = 54 + len(palette), self.line * height
        if start + size >= 1 << 32:
            raise ValueError("a BMP holds less than four gigabytes")
        info = struct.pack("<IiiHHIIiiII", 40, width, -height, 1, 8 * channels, 0, size, 2835, 2835, 256 if palette else 0, 0)
        self.head = b"BM" + struct.pack("<IHHI", start + size, 0, 0, start) + info + palette

    def rows(self, content: bytes) -> bytes:
        a = np.frombuffer(content, np.uint8).reshape(-1, self.width * self.channels)
        return np.pad(a, ((0, 0), (0, self.line - a.shape[1]))).tobytes()

    def end(self) -> bytes:
        return b""


def _zigzag() -> np.ndarray:
    """Places of a block of 8 x 8 along its diagonals, every other one upwards."""
    return np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, i // 8 if (i // 8 + i % 8) % 2 else i % 8)))


def _codes(counts: list[int], symbols: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(code, bits) per symbol: codes of a length follow one another, as the table in the file says."""
    code, place = 0, 0
    codes, bits = np.zeros(256, np.int64), np.zeros(256, np.int64)
    for length, n in enumerate(counts, 1):
        for symbol in symbols[place : place + n]:
            codes[symbol], bits[symbol] = code, length
            code += 1
        place += n
        code <<= 1
    return codes, bits


ZIGZAG = _zigzag()
DC_SYMBOLS = list(range(12))
_SHORT = [int(x, 16) for x in AC_SHORT.split()]
# the longest codes: all other pairs of a run of zeros and a size, in order
AC_SYMBOLS = _SHORT + [s for s in (16 * run + size for run in range(16) for size in range(1, 11)) if s not in _SHORT]
DC_CODES, AC_CODES = _codes(DC_COUNTS, DC_SYMBOLS), _codes(AC_COUNTS, AC_SYMBOLS)
END_OF_BLOCK, SIXTEEN_ZEROS = 0x00, 0xF0
# rows are frequencies
_DCT = np.array([[np.sqrt((1 if u == 0 else 2) / 8) * np.cos((2 * x + 1) * u * np.pi / 16) for x in range(8)] for u in range(8)])


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


class JpegEncoder:
    """Baseline JPEG without subsampling. Rows that do not fill a line of blocks wait for the next ones."""

    def __init__(self, width: int, height: int, channels: int, quality: int = QUALITY):
        if max(width, height) > MOST_SIDE:
            raise ValueError(f"a JPEG has at most {MOST_SIDE} pixels a side")
        scale = 5000 // quality if quality < 50 else 200 - 2 * quality
        table = np.array(QUANTISATION.split(), np.int64)
        self.quantum = np.clip((table * scale + 50) // 100, 1, 255)
        self.width, self.channels = width, channels
        self.waiting = np.zeros((0, width, channels), np.uint8)
        self.last_dc = np.zeros(channels, np.int64)
        self.open_bits = np.zeros(0, np.uint8)
        parts = [bytes([k, 0x11, 0]) for k in range(1, channels + 1)]
        self.head = b"\xff\xd8" + b"".join([
            _segment(0xE0, b"JFIF\0" + struct.pack(">HBHHBB", 0x0101, 0, 1, 1, 0, 0)),
            _segment(0xDB, b"\0" + bytes(self.quantum[ZIGZAG].tolist())),
            _segment(0xC0, struct.pack(">BHHB", 8, height, width, channels) + b"".join(parts)),
            _segment(0xC4, bytes([0x00, *DC_COUNTS, *DC_SYMBOLS])),
            _segment(0xC4, bytes([0x10, *AC_COUNTS, *AC_SYMBOLS])),
            _segment(0xDA, bytes([channels, *[x for k in range(1, channels + 1) for x in (k, 0)], 0, 63, 0])),
        ])

    def rows(self, content: bytes) -> bytes:
        new = np.frombuffer(content, np.uint8).reshape(-1, self.width, self.channels)
        self.waiting = np.concatenate([self.waiting, new])
        full = len(self.waiting) // 8 * 8
        lines, self.waiting = self.waiting[:full], self.waiting[full:].copy()
        step = max(8, BLOCK_PIXELS // self.width // 8 * 8)
        return b"".join(self._encoded(lines[i : i + step]) for i in range(0, full, step))

    def end(self) -> bytes:
        out = b""
        if len(self.waiting):
            out = self._encoded(np.pad(self.waiting, ((0, 8 - len(self.waiting)), (0, 0), (0, 0)), "edge"))
        if self.open_bits.size:  # filled up with ones
            out += self._stuffed(np.concatenate([self.open_bits, np.ones(8 - self.open_bits.size, np.uint8)]))
        return out + b"\xff\xd9"

    def _planes(self, a: np.ndarray) -> np.ndarray:
        v = a.astype(np.float64)
        if self.channels == 1:
            return v - 128.0
        b, g, r = v[..., 0], v[..., 1], v[..., 2]
        y = 0.299 * r + 0.587 * g + 0.114 * b
        return np.stack([y - 128.0, (b - y) / 1.772, (r - y) / 1.402], axis=-1)

    def _encoded(self, a: np.ndarray) -> bytes:
        """Whole lines of blocks as bytes; up to seven bits stay open."""
        a = np.pad(a, ((0, 0), (0, -self.width % 8), (0, 0)), "edge")
        planes = self._planes(a)
        cells = planes.reshape(len(a) // 8, 8, a.shape[1] // 8, 8, self.channels).transpose(0, 2, 4, 1, 3)
        waves = (_DCT @ cells.reshape(-1, 8, 8) @ _DCT.T).reshape(-1, 64)
        # blocks lie as they are coded: by place, the channels of a place in turn
        levels = np.rint(waves / self.quantum).astype(np.int64)[:, ZIGZAG]
        dc = levels[:, 0].reshape(-1, self.channels)
        steps = np.diff(dc, axis=0, prepend=self.last_dc[None, :])
        self.last_dc = dc[-1].copy()
        levels[:, 0] = steps.reshape(-1)
        codes, lengths = self._tokens(levels)
        ends = np.cumsum(lengths)
        below = np.repeat(ends, lengths) - np.arange(ends[-1]) - 1
        bits = np.concatenate([self.open_bits, (np.repeat(codes, lengths) >> below & 1).astype(np.uint8)])
        whole = bits.size // 8 * 8
        self.open_bits = bits[whole:]
        return self._stuffed(bits[:whole])

    @staticmethod
    def _stuffed(bits: np.ndarray) -> bytes:
        return np.packbits(bits).tobytes().replace(b"\xff", b"\xff\x00")

    @staticmethod
    def _tokens(levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bits, number of bits) of all codes of blocks (n, 64), each code with its value's bits behind it."""
        told = levels != 0
        told[:, 0] = True  # the first level always has a code
        block, place = np.nonzero(told)
        value = levels[block, place]
        size = np.frexp(np.abs(value).astype(np.float64))[1].astype(np.int64)
        bits = np.where(value < 0, value + (1 << size) - 1, value)
        first = place == 0
        run = np.where(first, 0, place - np.concatenate([[0], place[:-1]]) - 1)
        symbol = np.where(first, size, run % 16 * 16 + size)
        code = np.where(first, DC_CODES[0][symbol], AC_CODES[0][symbol]) << size | bits
        length = np.where(first, DC_CODES[1][symbol], AC_CODES[1][symbol]) + size
        zeros = run // 16
        # blocks that do not reach their last place end with a code of their own
        short = np.flatnonzero(~told[:, 63])
        order = np.argsort(np.concatenate([block * 65 + place, short * 65 + 64]), kind="stable")
        code = np.concatenate([code, np.full(short.size, AC_CODES[0][END_OF_BLOCK])])[order]
        length = np.concatenate([length, np.full(short.size, AC_CODES[1][END_OF_BLOCK])])[order]
        times = 1 + np.concatenate([zeros, np.zeros(short.size, np.int64)])[order]
        last = np.cumsum(times) - 1
        codes = np.full(last[-1] + 1, AC_CODES[0][SIXTEEN_ZEROS])
        lengths = np.full(last[-1] + 1, AC_CODES[1][SIXTEEN_ZEROS])
        codes[last], lengths[last] = code, length
        return codes, lengths


ENCODERS = {".png": PngEncoder, ".bmp": BmpEncoder, ".jpg": JpegEncoder, ".jpeg": JpegEncoder}


def encoder_of(name: str) -> type[PngEncoder] | type[BmpEncoder] | type[JpegEncoder]:
    """The encoder of a file name's extension; PNG for others."""
    return ENCODERS.get(PurePosixPath(name).suffix.lower(), PngEncoder)


def encode(kind: str, content: bytes, width: int, height: int, channels: int) -> bytes:
    """A whole file from one block of pixels."""
    encoder = ENCODERS[kind](width, height, channels)
    return encoder.head + encoder.rows(content) + encoder.end()


def encode_png(content: bytes, width: int, height: int, channels: int) -> bytes:
    return encode(".png", content, width, height, channels)
