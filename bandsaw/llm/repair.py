"""Token ids in a binary file format with Re-Pair grammars.

Documents are ordered by id and dealt by ranges; each task writes one file of
blocks. A block holds whole documents of about ``BLOCK_IDS`` ids (one at least)
as a grammar of its own: pairs of symbols that occur often become nonterminals,
round after round, and never span two documents. Rules and their expansion
lengths are stored, so that a document, or any range of its ids, is decoded
without the rest.

Block layout, little-endian: ``RPID``, version, first nonterminal, numbers of
documents, rules and symbols (uint32 each); then document ids (int64), 1 where the
id is null (uint8), symbols per document (uint32), ids per document (uint64),
rules (two uint32 each), expansion lengths (uint32), symbols (uint32).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bandsaw.llm.segment_bpe import WordCache
from bandsaw.llm.shards import create, frugal, kept_in_worker, new_folder, opened, saved
from bandsaw.llm.text import LETTER, NUMBER, OTHER, SPACE, CharacterClasses, chunks, joined
from bandsaw.session import shuffle_partitions

MAGIC = b"RPID"
BLOCK_IDS = 1 << 19
ROUNDS = 4
LEAST = 8  # occurrences that a rule must replace in its round
BINS = 16
MANIFEST = "part int, block int, file string, place bigint, size bigint, docs bigint, n_ids bigint"


def _bins(symbols: np.ndarray, turn: int) -> np.ndarray:
    """A bin for the pair at each place, dealt anew in each round."""
    keys = symbols.astype(np.uint64)
    keys = keys[:-1] * np.uint64(0x9E3779B97F4A7C15) + keys[1:] * np.uint64(0xC2B2AE3D27D4EB4F + 2 * turn)
    return ((keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BINS)).astype(np.int32)


def compress(ids: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """(symbols, symbols per document, rules, expansion lengths, first nonterminal) of documents' ids.

    Pairs are counted in hashed bins. In a round every place whose bin is fuller
    than that of the place before, and no emptier than that behind it, may be
    replaced, so chosen places never touch. One pair of a bin gets the rule;
    another that meets it there waits for a round that deals them apart. Rounds
    end when one saves less than a two-hundredth of the symbols.
    """
    first = int(ids.max()) + 1 if ids.size else 1
    symbols = ids.astype(np.int32)
    first_of_doc = np.zeros(ids.size, bool)
    starts = np.cumsum(counts) - counts
    first_of_doc[starts[counts > 0]] = True
    rules = [np.zeros((0, 2), np.int64)]
    lengths = np.ones(first, np.int64)
    owner = np.zeros(1 << BINS, np.int32)
    number = np.zeros(1 << BINS, np.int32)
    for turn in range(rounds):
        if symbols.size < 2:
            break
        bins = _bins(symbols, turn)
        inside = ~first_of_doc[1:]
        share = np.bincount(bins[inside], minlength=1 << BINS).astype(np.int32)[bins]
        share *= inside
        share[share < LEAST] = 0
        better = np.empty(share.size, bool)
        better[:1] = share[:1] > 0
        np.greater(share[1:], share[:-1], out=better[1:])
        better[:-1] &= share[:-1] >= share[1:]
        chosen = np.flatnonzero(better)
        bin_of, left, right = bins[chosen], symbols[chosen], symbols[chosen + 1]
        owner[bin_of] = np.arange(chosen.size, dtype=np.int32)  # the last place of a bin owns it
        pair_owner = owner[bin_of]
        same = (left[pair_owner] == left) & (right[pair_owner] == right)
        made = np.flatnonzero(np.bincount(bin_of[same], minlength=1 << BINS) >= LEAST)
        number[:] = -1
        number[made] = lengths.size + np.arange(made.size, dtype=np.int32)
        symbol = number[bin_of]
        used = same & (symbol >= 0)
        chosen, symbol = chosen[used], symbol[used]
        if not chosen.size:
            break
        new = np.stack([left[owner[made]], right[owner[made]]], axis=1).astype(np.int64)
        before = symbols.size
        symbols[chosen] = symbol
        keep = np.ones(symbols.size, bool)
        keep[chosen + 1] = False
        symbols, first_of_doc = symbols[keep], first_of_doc[keep]
        rules.append(new)
        lengths = np.concatenate([lengths, lengths[new].sum(axis=1)])
        if before - symbols.size < before // 200:
            break
    of_doc = np.zeros(counts.size, np.int64)
    of_doc[counts > 0] = np.diff(np.append(np.flatnonzero(first_of_doc), symbols.size))
    return symbols, of_doc, np.concatenate(rules), lengths[first:], first


def _expanded(symbols: np.ndarray, rules: np.ndarray, first: int) -> np.ndarray:
    """The ids that symbols stand for; a pass replaces every nonterminal by its rule."""
    while symbols.size:
        composed = symbols >= first
        if not composed.any():
            break
        size = 1 + composed
        ends = np.cumsum(size)
        out = np.empty(int(ends[-1]), np.int64)
        out[ends - size] = np.where(composed, 0, symbols)
        place = (ends - size)[composed]
        rule = rules[symbols[composed] - first]
        out[place], out[place + 1] = rule[:, 0], rule[:, 1]
        symbols = out
    return symbols


def pack(doc_ids: np.ndarray, missing: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> bytes:
    symbols, of_doc, rules, lengths, first = compress(ids, counts)
    head = np.array([1, first, counts.size, len(rules), symbols.size], "<u4")
    parts = [head, doc_ids.astype("<i8"), missing.astype("u1"), of_doc.astype("<u4"), counts.astype("<u8")]
    parts += [rules.astype("<u4"), lengths.astype("<u4"), symbols.astype("<u4")]
    return MAGIC + b"".join(x.tobytes() for x in parts)


class Block:
    """A block as it was written; documents are decoded on demand."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a block of token ids")
        version, self.first, n, n_rules, n_symbols = np.frombuffer(data, "<u4", 5, 4).tolist()
        if version != 1:
            raise ValueError(f"unknown version {version}")
        at = 24

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        self.doc_ids, self.missing = take("<i8", n), take("u1", n).astype(bool)
        self.of_doc, self.counts = take("<u4", n).astype(np.int64), take("<u8", n).astype(np.int64)
        self.rules = take("<u4", 2 * n_rules).reshape(-1, 2).astype(np.int64)
        self.lengths = np.concatenate([np.ones(self.first, np.int64), take("<u4", n_rules).astype(np.int64)])
        self.symbols = take("<u4", n_symbols).astype(np.int64)
        self.starts = np.cumsum(self.of_doc) - self.of_doc
        made = _expanded(np.arange(self.first, self.first + n_rules), self.rules, self.first)
        self.table = np.concatenate([np.arange(self.first, dtype=np.int32), made.astype(np.int32)])
        self.place = np.cumsum(self.lengths) - self.lengths

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        n = self.lengths[symbols]
        before = np.cumsum(n) - n
        return self.table[np.repeat(self.place[symbols] - before, n) + np.arange(int(n.sum()))]

    def document(self, k: int) -> np.ndarray:
        return self.expand(self.symbols[self.starts[k] : self.starts[k] + self.of_doc[k]])

    def part(self, k: int, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of document ``k``; only the symbols over them are expanded."""
        symbols = self.symbols[self.starts[k] : self.starts[k] + self.of_doc[k]]
        ends = np.cumsum(self.lengths[symbols])
        a, b = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left") + 1
        skipped = int(ends[a - 1]) if a else 0
        return self.expand(symbols[a:b])[max(0, start - skipped) : max(0, stop - skipped)]

    def all_ids(self) -> np.ndarray:
        return self.expand(self.symbols)


class AddedTokens:
    """Ids of whole texts that may hold a vocabulary's added tokens, which are cut out before pre-tokens are."""

    def __init__(self, words: WordCache, added: dict[str, int]):
        self.words, self.added = words, added
        longest_first = sorted(added, key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if added else None

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text)."""
        held = joined(column)[0].tobytes()  # one search of all texts is much faster than one of each
        if not any(token.encode() in held for token in self.added):
            return self.words.ids(column)
        cut = [self.cut.split(text or "") for text in column.to_pylist()]  # text, token, text, ...
        flat, count = self.words.ids(pa.array([x for parts in cut for x in parts[::2]], column.type))
        size = np.array([len(parts) for parts in cut], np.int64)
        first = np.cumsum(size) - size
        is_token = (np.arange(int(size.sum())) - np.repeat(first, size)) % 2 == 1
        per_part = np.ones(is_token.size, np.int64)
        per_part[~is_token] = count
        out = np.empty(int(per_part.sum()), np.int64)
        own = np.repeat(is_token, per_part)
        out[own] = [self.added[x] for parts in cut for x in parts[1::2]]
        out[~own] = flat
        return out, np.add.reduceat(per_part, first)


def library_words(tokenizer_path: str) -> AddedTokens:
    """Ids of texts as the tokenizers library in its default state gives them; it sees each distinct pre-token once."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    added = tokenizer.get_added_tokens_decoder()
    for token in added.values():
        if token.single_word or token.lstrip or token.rstrip or token.normalized:
            raise ValueError(f"added token {token.content!r} is not matched by its characters alone")
    split = tokenizer.pre_tokenizer.pre_tokenize_str

    def kind(c: str) -> int:
        if len(split("a" + c)) == 1:
            return LETTER
        if len(split("1" + c)) == 1:
            return NUMBER
        return OTHER if len(split("!" + c)) == 1 else SPACE

    def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], np.int64), np.array([len(ids) for ids in found], np.int64)

    words = WordCache(CharacterClasses(kind), encode, kept=1 << 20)  # its words cost most
    return AddedTokens(words, {token.content: i for i, token in added.items()})


def write_ids(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the ids of all texts below ``folder``; the result is the manifest, one row per block.

    Documents come in ascending ``key`` (null keys first; equal keys by text).
    Added tokens of the vocabulary within a text get their own ids. Null and empty
    texts hold ``end_id`` alone. An empty table gives an empty
    manifest. Further columns of ``docs`` are not read.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange("key").sortWithinPartitions("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = kept_in_worker("ids:" + tokenizer_path, lambda: library_words(tokenizer_path))
        part = TaskContext.get().partitionId()
        sink = uri = None
        place = held = block = 0
        waiting: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal sink, uri, place, held, block
            if sink is None:
                sink, uri = create(folder, ".rpid")
            keys, missing, ids, counts = (np.concatenate(x) for x in zip(*waiting, strict=True))
            data = pack(keys, missing, ids, counts)
            sink.write(data)
            row = [part, block, uri, place, len(data), counts.size, ids.size]
            place, held, block = place + len(data), 0, block + 1
            waiting.clear()
            names = [x.split()[0] for x in MANIFEST.split(", ")]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names)

        out = []
        for batch in batches:
            for some in chunks(batch, "text"):
                flat, count = cache.ids(some.column("text"))
                ids = np.full(flat.size + count.size, end_id, np.int32)
                own = np.ones(ids.size, bool)
                own[np.cumsum(count + 1) - 1] = False
                ids[own] = flat
                keys = some.column("key")
                waiting.append((keys.fill_null(0).to_numpy(zero_copy_only=False), keys.is_null().to_numpy(zero_copy_only=False), ids, count + 1))
                held += ids.size
                if held >= BLOCK_IDS:
                    out.append(flush())
        if waiting:
            out.append(flush())
        if sink is not None:
            sink.close()
        yield from out  # rows leave after the file is whole

    return ordered.mapInArrow(frugal(run), MANIFEST)


def read_ids(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files that ``manifest`` names.

    Blocks are dealt anew and read by place and size. ``start`` comes from the
    sums of the parts (a row per part that wrote) and of the blocks in a part.
    """
    totals = manifest.groupBy("part").agg(F.sum("n_ids").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("part_start"))
    earlier = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("in_part", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))
    blocks = placed.join(parts, "part").select("file", "place", "size", (F.col("part_start") + F.col("in_part")).alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = opened(row["file"])
                with store.open_input_file(path) as source:
                    block = Block(source.read_at(row["size"], row["place"]))
                ids = block.all_ids().astype("<u4").tobytes()
                ends = np.cumsum(block.counts)
                starts = ends - block.counts
                crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.doc_ids, pa.int64(), mask=block.missing), pa.array(row["start"] + starts, pa.int64()), pa.array(block.counts, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # a number of its own: the few rows would else be gathered in one task
    parts = shuffle_partitions(manifest.sparkSession)
    return blocks.repartition(parts, "file", "place").mapInArrow(frugal(run), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def tokenized(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write ``docs`` as id files in the shared folder and read them back."""
    return read_ids(saved(write_ids(docs, tokenizer_path, end_id, new_folder(spark, "ids")), "ids-manifest"))
