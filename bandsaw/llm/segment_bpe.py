"""Byte-level BPE by segment trees over byte positions, and the way back.

Leaf ``i`` of a pre-token's tree holds the rank of the pair that begins at byte
``i``; inner nodes hold the minimum, leftmost on ties. A merge takes the root,
joins the pair, links the live neighbours and updates three leaves and their
ancestors, so a pre-token of n bytes costs O(n log n), however long it is.
Trees of equal size advance together, one merge of each at a time, as rows of
one array.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bandsaw.llm.shards import frugal, kept_in_worker
from bandsaw.llm.text import LETTER, NUMBER, OTHER, SEPARATOR, SPACE, CharacterClasses, chunks, joined, mix, pretokens, rows_of, segment_hashes

NONE = np.int64(1) << 60
CELLS = 1 << 19
# Words whose ids a task keeps; beyond it starts anew. Results do not depend on it.
KEPT_WORDS = 1 << 19
KEPT_BYTES = 32 << 20  # of their texts


class PairTable:
    """Rank of a pair of ids, by open addressing in arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(2, left.size) * 3))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int64)
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        slot = self._slot(keys)
        todo = np.arange(keys.size)
        while todo.size:
            free = todo[self.keys[slot[todo]] == -1]
            self.keys[slot[free]] = keys[free]
            self.ranks[slot[free]] = rank[free]  # of several that meet, the last wins both arrays
            todo = todo[self.keys[slot[todo]] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        slot = self._slot(keys)
        out = self.ranks[slot]
        held = self.keys[slot]
        open_ = np.flatnonzero((held != keys) & (held != -1))
        out[held != keys] = NONE
        while open_.size:
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            held = self.keys[slot[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (held != -1)]
        return out


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ids from a rank file (base64, blank, number in each line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class SegmentTreeBpe:
    """Ids of byte strings by the lowest rank first, leftmost on ties."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte_id = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = [
            (a, b, rank)
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if (a := ranks.get(token[:k])) is not None and (b := ranks.get(token[k:])) is not None
        ]
        self.pairs = PairTable(*np.array(pairs, np.int64).reshape(-1, 3).T)

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per word)."""
        whole = [self.ranks.get(w, -1) for w in words]
        sizes = np.array([len(w) for w in words], np.int64)
        out: list = [None] * len(words)
        counts = np.ones(len(words), np.int64)
        for i, rank in enumerate(whole):
            if rank >= 0 or not words[i]:
                out[i] = np.array([rank] if words[i] else [], np.int64)
                counts[i] = out[i].size
        left = np.array([i for i, x in enumerate(out) if x is None], np.int64)
        width = 1 << np.ceil(np.log2(np.maximum(2, sizes[left]))).astype(np.int64) if left.size else left
        for span in np.unique(width).tolist():
            group = left[width == span]
            step = max(1, CELLS // span)
            for k in range(0, group.size, step):
                part = group[k : k + step]
                flat, n = self._merged([words[i] for i in part.tolist()], sizes[part], span)
                counts[part] = n
                for i, ids in zip(part.tolist(), np.split(flat, np.cumsum(n)[:-1]), strict=True):
                    out[i] = ids
        return (np.concatenate(out) if out else np.zeros(0, np.int64)), counts

    def _merged(self, words: list[bytes], sizes: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
        n, shift = len(words), span.bit_length() - 1
        place = np.arange(span, dtype=np.int64)
        held = place < sizes[:, None]
        ids = np.full((n, span), -1, np.int64)
        ids[held] = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        tree = np.full((n, 2 * span), NONE, np.int64)
        pair = place[:-1] < sizes[:, None] - 1
        rank = self.pairs(ids[:, :-1][pair], ids[:, 1:][pair])
        where = np.broadcast_to(place[:-1], pair.shape)[pair]
        tree[:, span : 2 * span - 1][pair] = np.where(rank < NONE, rank << shift | where, NONE)
        level = span // 2
        while level:
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
            level //= 2
        following = np.tile(place + 1, (n, 1)).ravel()
        preceding = np.tile(place - 1, (n, 1)).ravel()
        ids, tree = ids.ravel(), tree.ravel()
        row = np.arange(n, dtype=np.int64)
        while True:
            top = tree[row * (2 * span) + 1]
            live = top < NONE
            row, top = row[live], top[live]
            if not row.size:
                break
            base, root = row * span, row * (2 * span)
            at, made = top & (span - 1), top >> shift
            gone = following[base + at]
            ids[base + at] = made
            ids[base + gone] = -1
            right = following[base + gone]
            following[base + at] = right
            has_right = right < sizes[row]
            preceding[(base + right)[has_right]] = at[has_right]
            left = preceding[base + at]
            has_left = left >= 0
            new_right = np.full(row.size, NONE, np.int64)
            found = self.pairs(made[has_right], ids[(base + right)[has_right]])
            new_right[has_right] = np.where(found < NONE, found << shift | at[has_right], NONE)
            tree[root + span + gone] = NONE
            tree[root + span + at] = new_right
            found = self.pairs(ids[(base + left)[has_left]], made[has_left])
            tree[(root + span + left)[has_left]] = np.where(found < NONE, found << shift | left[has_left], NONE)
            nodes = [span + gone, span + at, span + np.where(has_left, left, at)]
            for _ in range(shift):
                nodes = [x >> 1 for x in nodes]
                for x in nodes:
                    child = root + 2 * x
                    tree[root + x] = np.minimum(tree[child], tree[child + 1])
        ids = ids.reshape(n, span)
        return ids[ids >= 0], (ids >= 0).sum(axis=1)


class WordCache:
    """Ids of whole texts from the ids of their distinct pre-tokens."""

    def __init__(self, classes: CharacterClasses, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], kept: int = KEPT_WORDS):
        self.classes, self.encode, self.kept = classes, encode, kept
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # ascending
        self.index = np.zeros(0, np.int64)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)
        # the words' bytes, one after the other
        self.text = np.zeros(0, np.uint8)
        self.begin = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)

    def _learn(self, words: list[bytes]) -> np.ndarray:
        """Numbers of ``words``, which are held from now on."""
        flat, count = self.encode(words)
        index = self.count.size + np.arange(count.size)
        size = np.array([len(w) for w in words], np.int64)
        self.first = np.concatenate([self.first, self.flat.size + np.cumsum(count) - count])
        self.begin = np.concatenate([self.begin, self.text.size + np.cumsum(size) - size])
        self.count, self.size = np.concatenate([self.count, count]), np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
        self.text = np.concatenate([self.text, np.frombuffer(b"".join(words), np.uint8)])
        return index

    def lookup(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(word of each pre-token, its start, its end, row of each, row starts) of a chunk of texts.

        Hashes find equal pre-tokens, their bytes are compared; where two differ, the chunk is learned anew by its bytes.
        """
        buffer, row_starts, _ = joined(column)
        starts, ends = pretokens(buffer, self.classes(buffer))
        if self.count.size > self.kept or self.text.size > KEPT_BYTES:
            self._clear()
        word = self._by_hash(buffer, starts, ends) if starts.size else np.zeros(0, np.int64)
        if word is None:
            offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
            data = np.ascontiguousarray(buffer[buffer != SEPARATOR])
            coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), starts.size, [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
            word = self._learn(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        return word, starts, ends, rows_of(starts, row_starts), row_starts

    def _by_hash(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray | None:
        """The word of each pre-token, or None if two of one hash differ, in the chunk or from what is held."""
        keys, example, which = np.unique(segment_hashes(buffer, starts, ends), return_index=True, return_inverse=True)
        lengths, same = ends - starts, example[which]
        if (lengths != lengths[same]).any():
            return None
        # pre-tokens cover all but the separators
        place = np.flatnonzero(buffer != SEPARATOR)
        if (buffer[place] != buffer[place + np.repeat(starts[same] - starts, lengths)]).any():
            return None
        near = np.minimum(np.searchsorted(self.keys, keys), max(0, self.keys.size - 1))
        new = self.keys[near] != keys if self.keys.size else np.ones(keys.size, bool)
        word = np.empty(keys.size, np.int64)
        if not new.all():
            known, mine = self.index[near[~new]], example[~new]
            size = self.size[known]
            if (size != lengths[mine]).any():
                return None
            within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            if (self.text[np.repeat(self.begin[known], size) + within] != buffer[np.repeat(starts[mine], size) + within]).any():
                return None
            word[~new] = known
        if new.any():
            mine = example[new]
            word[new] = self._learn([buffer[a:b].tobytes() for a, b in zip(starts[mine].tolist(), ends[mine].tolist(), strict=True)])
            merged = np.concatenate([self.keys, keys[new]])
            order = np.argsort(merged, kind="stable")
            self.keys, self.index = merged[order], np.concatenate([self.index, word[new]])[order]
        return word[which]

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text)."""
        word, _, _, row, row_starts = self.lookup(column)
        count = self.count[word]
        before = np.cumsum(count) - count
        flat = self.flat[np.repeat(self.first[word] - before, count) + np.arange(int(count.sum()))]
        return flat, np.bincount(row, weights=count, minlength=row_starts.size).astype(np.int64)


def pattern_class(c: str) -> int:
    """Class of a character in the pattern of public_tokenizers."""
    import regex

    if regex.match(r"\s", c):
        return SPACE
    return LETTER if regex.match(r"\p{L}", c) else NUMBER if regex.match(r"\p{N}", c) else OTHER


def list_column(flat: np.ndarray, count: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


def encode(docs: DataFrame, ranks_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the array column ``ids``; it replaces a column of that name.

    Null and empty texts get an empty array. Rows are kept as they are, repeated
    ones too; an empty table stays empty. Other columns never leave their rows.
    """
    kept = [c for c in docs.columns if c != ids]
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = kept_in_worker("bpe:" + ranks_path, lambda: WordCache(CharacterClasses(pattern_class), SegmentTreeBpe(read_ranks(ranks_path))))
        for batch in batches:
            for part in chunks(batch, text):
                flat, count = cache.ids(part.column(text))
                columns = [part.column(c) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, list_column(flat, count, pa.int32())], [*kept, ids])

    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(frugal(run), schema)


def decode(rows: DataFrame, ranks_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``rows`` with the binary column ``decoded``: the bytes of the ids in order; null ids give null."""
    kept = [c for c in rows.columns if c != decoded]
    schema = T.StructType([*[rows.schema[c] for c in kept], T.StructField(decoded, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(ranks_path)
        token = [b""] * (1 + max(ranks.values()))
        for k, i in ranks.items():
            token[i] = k
        size = np.array([len(k) for k in token], np.int64)
        begin = np.cumsum(size) - size
        held = np.frombuffer(b"".join(token), np.uint8)
        for batch in batches:
            # a few rows at a time, as their bytes are several times their ids
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                column = part.column(ids)
                flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                per = np.array([0 if x is None else x for x in pa.compute.list_value_length(column).to_pylist()], np.int64)
                n = size[flat]
                before = np.cumsum(n) - n
                data = held[np.repeat(begin[flat] - before, n) + np.arange(int(n.sum()))]
                ends = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(per)])]
                valid = column.is_valid()
                out = pa.Array.from_buffers(pa.binary(), len(per), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
                out = pa.compute.if_else(valid, out, pa.scalar(None, pa.binary()))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], out], [*kept, decoded])

    return rows.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(frugal(run), schema)
