"""The row decoder against the JVM's decoder and plain renderings."""

import io
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from bandsaw.operators.bands import to_bands
from bandsaw.sources import decode
from bandsaw.sources.files import list_files
from bandsaw.sources.images import read_images
from tests.helpers import rebuild


def chunk(kind, body):
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def predicted(kind, a, b, c):
    if kind == 4:
        p = a + b - c
        near = [abs(p - a), abs(p - b), abs(p - c)]
        return (a, b, c)[near.index(min(near))]
    return (0, a, b, (a + b) // 2)[kind]


def png(samples, bits=8, colour=2, kinds=(0, 1, 2, 3, 4), palette=None, pieces=3):
    """A PNG of sample rows, written sample by sample; row filters take turns."""
    h, w, n = samples.shape
    lines = [bytes(int(v) >> 8 * (1 - i) & 255 if bits == 16 else int(v) for v in row.ravel() for i in range(bits // 8)) if bits >= 8 else
             int("".join(f"{int(v):0{bits}b}" for v in row.ravel()).ljust(-(-w * n * bits // 8) * 8, "0"), 2).to_bytes(-(-w * n * bits // 8), "big") for row in samples]
    step = max(1, n * bits // 8)
    body, above = bytearray(), bytes(len(lines[0]))
    for y, line in enumerate(lines):
        kind = kinds[y % len(kinds)]
        body.append(kind)
        for x, v in enumerate(line):
            a = line[x - step] if x >= step else 0
            c = above[x - step] if x >= step else 0
            body.append((v - predicted(kind, a, above[x], c)) % 256)
        above = line
    packed = zlib.compress(bytes(body))
    cut = [packed[i * len(packed) // pieces : (i + 1) * len(packed) // pieces] for i in range(pieces)]
    head = decode.SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, bits, colour, 0, 0, 0)) + chunk(b"tEXt", b"key\0value")
    head += chunk(b"PLTE", bytes(palette)) if palette is not None else b""
    return head + b"".join(chunk(b"IDAT", c) for c in cut) + chunk(b"IEND", b"")


def bmp(a, bits, downwards=False, palette=None):
    h, w = a.shape[:2]
    lines = [row.tobytes() + b"\0" * (-len(row.tobytes()) % 4) for row in (a if downwards else a[::-1])]
    table = b"" if palette is None else b"".join(bytes([*p, 0]) for p in palette)
    first = 54 + len(table)
    head = b"BM" + struct.pack("<IHHI", first + sum(map(len, lines)), 0, 0, first)
    return head + struct.pack("<IiiHHIIiiII", 40, w, -h if downwards else h, 1, bits, 0, 0, 0, 0, 0 if palette is None else len(palette), 0) + table + b"".join(lines)


class Source(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def whole(data):
    return np.concatenate(list(decode.image_rows(Source(data))))


RNG = np.random.default_rng(9)


@pytest.mark.parametrize("shape", [(1, 1), (7, 5), (300, 3), (40, 61)])
@pytest.mark.parametrize("kinds", [(0,), (1, 2), (0, 1, 2, 3, 4), (4,), (3, 4, 3)])
def test_filters_and_kinds(shape, kinds):
    for colour, n in ((0, 1), (2, 3), (4, 2), (6, 4)):
        a = RNG.integers(0, 256, (*shape, n))
        shown = a[..., 2::-1] if n >= 3 else a[..., :1]
        assert (whole(png(a, 8, colour, kinds)) == shown).all()
        deep = RNG.integers(0, 65536, (*shape, n))
        assert (whole(png(deep, 16, colour, kinds)) == (deep[..., 2::-1] if n >= 3 else deep[..., :1]) >> 8).all()
    for bits in (1, 2, 4):
        a = RNG.integers(0, 1 << bits, (*shape, 1))
        assert (whole(png(a, bits, 0, kinds)) == a * (255 // ((1 << bits) - 1))).all()
    colours = RNG.integers(0, 256, (16, 3))
    a = RNG.integers(0, 16, (*shape, 1))
    for bits in (4, 8):
        assert (whole(png(a, bits, 3, kinds, colours.ravel().tolist())) == colours[a[..., 0]][..., ::-1]).all()


def test_blocks_join(monkeypatch):
    monkeypatch.setattr(decode, "BLOCK_ROWS", 4)
    monkeypatch.setattr(decode, "READ_BYTES", 7)
    a = RNG.integers(0, 256, (23, 9, 3))
    assert (whole(png(a)) == a[..., ::-1]).all()
    for bits, downwards in ((24, False), (24, True), (32, False)):
        b = RNG.integers(0, 256, (23, 9, bits // 8)).astype(np.uint8)
        assert (whole(bmp(b, bits, downwards)) == b[..., :3]).all()
    table = RNG.integers(0, 256, (200, 3))
    b = RNG.integers(0, 200, (23, 9)).astype(np.uint8)
    assert (whole(bmp(b, 8, palette=table.tolist())) == table[b]).all()


def test_damaged_files_say_why():
    good = png(RNG.integers(0, 256, (20, 20, 3)))
    for bad in (b"", b"BM", good[:20], good[:-60], good[: len(good) // 2], good.replace(b"IDAT", b"IDAT", 1)[:60], bmp(np.zeros((9, 9, 3), np.uint8), 24)[:-5]):
        with pytest.raises((ValueError, zlib.error)):
            whole(bad)
    broken = bytearray(good)
    broken[len(good) // 2] ^= 255
    with pytest.raises((ValueError, zlib.error)):
        whole(bytes(broken))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("rows")
    for i, (n, colour) in enumerate(((3, 2), (1, 0), (4, 6))):
        (root / f"a{i}.png").write_bytes(png(RNG.integers(0, 256, (90 + i, 31, n)), 8, colour))
    (root / "b.bmp").write_bytes(bmp(RNG.integers(0, 256, (77, 18, 3)).astype(np.uint8), 24))
    (root / "p.png").write_bytes(png(RNG.integers(0, 8, (50, 30, 1)), 8, 3, palette=RNG.integers(0, 256, 24).tolist()))
    good = png(RNG.integers(0, 256, (200, 20, 3)))
    (root / "cut.png").write_bytes(good[:-100])
    (root / "empty.png").write_bytes(b"")
    return str(root)


def test_bands_equal_those_of_the_other_decoder(spark, folder):
    files = list_files(spark, folder, named_set="images").withColumn("image_id", F.xxhash64("rel_path"))
    theirs = read_images(spark, folder).filter("height > 0")
    for rows, halo, as_gray in ((None, 12, False), (16, 3, False), (16, 12, True)):
        got = decode.decode_bands(files, rows, halo, as_gray, carry=("rel_path",))
        mine, want = got.filter("band >= 0"), to_bands(theirs, rows, halo, as_gray)
        key = ["image_id", "band"]
        assert mine.select(*want.columns).exceptAll(want).count() == 0 and mine.count() == want.count() > 4
        bad = {r.rel_path: r.message for r in got.filter("band < 0").collect()}
        assert set(bad) == {"cut.png", "empty.png"} and all(bad.values())
        assert len(rebuild(mine, 1 if as_gray else 3)) == 5 and mine.select(*key).distinct().count() == mine.count()


def test_a_large_file_is_never_held(tmp_path):
    """40 million pixels, 120 MB, pass through with less than half of that."""
    import tracemalloc

    w, h = 8000, 5000
    packer = zlib.compressobj(1)
    row = b"\0" + bytes(range(250)) * (w * 3 // 250)
    body = b"".join(packer.compress(row) for _ in range(h)) + packer.flush()
    path = tmp_path / "large.png"
    path.write_bytes(decode.SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", body) + chunk(b"IEND", b""))
    tracemalloc.start()
    seen = 0
    with open(path, "rb") as source:
        for band in decode.cut_bands(decode.image_rows(source), None, 12, False):
            seen += band["y1"] - band["y0"]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == h and peak < 60 << 20


def test_rows_of_damaged_files_are_handed_on(spark, tmp_path):
    """5,000 damaged files in one task: their rows, which hold no pixels, do not wait for its end."""
    import pyarrow as pa
    from pyspark.sql import types as T

    (tmp_path / "a.png").write_bytes(b"\x89PNG\r\n\x1a\n")
    schema = T.StructType.fromDDL(decode.BANDS + ", message string")
    files = pa.RecordBatch.from_pydict({"image_id": list(range(5000)), "path": [f"file:{tmp_path}/a.png"] * 5000})
    taken = []

    def given():
        for at in range(0, 5000, 100):
            taken.append(at)
            yield files.slice(at, 100)

    made, first = [], None
    for batch in decode._decoding(schema, None, decode.HALO, False, (), True)(given()):
        first = first or len(taken) * 100
        made += batch.to_pylist()
    assert first <= 1100
    assert [m["image_id"] for m in made] == list(range(5000))
    assert all(m["band"] == -1 and m["data"] is None and m["message"] for m in made)
