"""Array views of text columns inside Arrow tasks.

A chunk of a text column becomes one byte buffer in which every text is followed
by the byte 0xFF, which UTF-8 never uses. Words, pre-tokens and their 64-bit
hashes are then found for the whole chunk with NumPy. A chunk is bounded by
``CHUNK_BYTES`` or one text, whichever is larger, whatever the partition holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
SEPARATOR = 255

# Character classes. END is the separator.
END, LETTER, NUMBER, SPACE, OTHER = range(5)

# The odd multipliers of the hashes and the finaliser's constants.
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
LENGTH = np.uint64(0xD6E8FEB86659FD93)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)
# The lowest 0 to 8 bytes of a 64-bit value.
_HEAD = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose texts hold at most ``limit`` bytes, one row at least."""
    n = batch.num_rows
    if not n:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    first = 0
    while first < n:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(first, last - first)
        first = last


def joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, starts, ends) of the texts; null counts as empty."""
    kind = pa.large_binary()
    values = pc.fill_null(column.cast(pa.large_string()) if not pa.types.is_binary(column.type) else column, "" if not pa.types.is_binary(column.type) else b"")
    values = values.cast(kind)
    n = len(values)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint8), none, none
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + n + 1]
    held = values.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    rank = np.arange(n, dtype=np.int64)
    starts, ends = offsets[:-1] - offsets[0] + rank, offsets[1:] - offsets[0] + rank
    buffer = np.full(data.size + n, SEPARATOR, np.uint8)
    inside = np.ones(buffer.size, bool)
    inside[ends] = False
    buffer[inside] = data
    return buffer, starts, ends


def lowered(buffer: np.ndarray) -> np.ndarray:
    """A-Z in lower case; all other bytes as they are."""
    upper = (buffer >= 65) & (buffer <= 90)
    return buffer + (upper * np.uint8(32))


def segment_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range ``[start, end)``; ranges are not empty, ordered and apart.

    Eight bytes at a time, each with its place, go through a bijection that is no
    polynomial; equal hashes still prove nothing, and callers compare what they merge.
    """
    if not starts.size:
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    n_blocks = (lengths + 7) >> 3
    bounds = np.cumsum(n_blocks) - n_blocks
    within = np.arange(int(n_blocks.sum()), dtype=np.int64) - np.repeat(bounds, n_blocks)
    at = np.repeat(starts, n_blocks) + 8 * within
    left = np.minimum(np.repeat(ends, n_blocks) - at, 8)
    padded = np.concatenate([buffer, np.zeros(8, np.uint8)])
    eight = np.ndarray((padded.size - 7,), np.dtype("<u8"), padded, strides=(1,))
    blocks = eight[at] & _HEAD[left]
    keys = (within.astype(np.uint64) + np.uint64(1)) * BASE
    values = mix(mix(blocks ^ keys) + keys)
    return mix(np.add.reduceat(values, bounds) ^ (lengths.astype(np.uint64) * LENGTH))


# White space of words, bytes 9 to 13 and 32, and the separator.
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32, SEPARATOR]] = True


def words(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs without white space."""
    blank = _BLANK[buffer]
    before = np.concatenate([[True], blank[:-1]]) if blank.size else blank
    starts = np.flatnonzero(~blank & before)
    ends = np.flatnonzero(blank & ~before)
    return starts, ends


def rows_of(positions: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Index of the text that holds each position."""
    return np.searchsorted(starts, positions, side="right") - 1


def per_row(rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(first index, count) of each of ``n`` rows in the ascending ``rows``."""
    count = np.bincount(rows, minlength=n) if rows.size else np.zeros(n, np.int64)
    return np.cumsum(count) - count, count


def _code_points(buffer: np.ndarray, leads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code point, length in bytes) of the characters that begin at ``leads``."""
    at = lambda k: buffer[np.minimum(leads + k, buffer.size - 1)].astype(np.int64) & 63
    lead = buffer[leads].astype(np.int64)
    size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    two = (lead & 31) << 6 | at(1)
    three = (lead & 15) << 12 | at(1) << 6 | at(2)
    four = (lead & 7) << 18 | at(1) << 12 | at(2) << 6 | at(3)
    return np.where(size == 2, two, np.where(size == 3, three, four)), size


class CharacterClasses:
    """Class of every byte by the character it belongs to; ``kind_of`` gives a character's class."""

    def __init__(self, kind_of: Callable[[str], int]):
        self.kind_of = kind_of
        self.table = np.full(256, OTHER, np.uint8)
        for i in range(128):
            self.table[i] = kind_of(chr(i))
        self.table[SEPARATOR] = END
        self.seen: dict[int, int] = {}

    def __call__(self, buffer: np.ndarray) -> np.ndarray:
        kinds = self.table[buffer]
        leads = np.flatnonzero((buffer >= 0xC2) & (buffer <= 0xF4))
        if not leads.size:
            return kinds
        points, size = _code_points(buffer, leads)
        distinct, which = np.unique(points, return_inverse=True)
        found = np.empty(distinct.size, np.uint8)
        for i, c in enumerate(distinct.tolist()):
            if c not in self.seen:
                self.seen[c] = self.kind_of(chr(c)) if c < 0x110000 and not 0xD800 <= c < 0xE000 else OTHER
            found[i] = self.seen[c]
        kind = found[which]
        for k in range(4):
            here = size > k
            kinds[np.minimum(leads[here] + k, buffer.size - 1)] = kind[here]
        kinds[buffer == SEPARATOR] = END
        return kinds


# Endings after an apostrophe that the pattern of public_tokenizers splits off.
_SHORT = np.zeros(256, bool)
_SHORT[list(b"stmd")] = True
_LONG = [b"re", b"ve", b"ll"]


def pretokens(buffer: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the pattern's matches: contractions, words, numbers, signs and white space.

    A single blank goes with the run behind it; of longer white space the last
    character does, or stays alone if it is no blank.
    """
    n = buffer.size
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    previous = np.concatenate([[END], kinds[:-1]])
    start = (kinds != previous) & (kinds != END)
    after_space = np.flatnonzero(start & (previous == SPACE))
    last = after_space - 1
    continued = (buffer[last] & 0xC0) == 0x80
    while continued.any():
        last = last - continued
        continued = (buffer[last] & 0xC0) == 0x80
    start[last] = True
    start[after_space] = buffer[after_space - 1] != 32
    quote = np.flatnonzero(start & (buffer == 39))
    if quote.size:
        one, two = buffer[np.minimum(quote + 1, n - 1)], buffer[np.minimum(quote + 2, n - 1)]
        length = np.where(_SHORT[one], 2, 0)
        for a, b in _LONG:
            length[(one == a) & (two == b)] = 3
        quote, length = quote[length > 0], length[length > 0]
        start[quote + 1] = False
        end = quote + length
        end = end[kinds[end] == LETTER]
        start[end] = True
    bounds = np.flatnonzero(start | (kinds == END))
    token = kinds[bounds] != END
    ends = np.append(bounds[1:], n)
    return bounds[token], ends[token]
