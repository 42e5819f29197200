"""Token counts that follow edits.

A document is a row of leaves of about ``LEAF`` pre-tokens, under a segment tree of
their sums of characters and tokens. An edit finds its leaves by descending the
tree, splits and encodes again only their text and what the pattern looks at
around it, and updates the sums on the paths above. Splitting starts at a leaf's
edge that the edit cannot move (the pattern looks ``CONTEXT`` characters ahead at
most) and ends where a new pre-token begins at an old leaf's edge; from there on
the old split holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bandsaw.llm.segment_bpe import SegmentTreeBpe, WordCache, pattern_class, read_ranks
from bandsaw.llm.shards import frugal, kept_in_worker
from bandsaw.llm.text import CharacterClasses, chunks, per_row

LEAF = 64
CONTEXT = 3
ROWS = 512
EDITS = "array<struct<start:bigint,removed:bigint,inserted:string>>"
LEAVES = T.ArrayType(T.StructType([T.StructField("chars", T.IntegerType()), T.StructField("tokens", T.IntegerType())]))


class CountedText:
    """Leaves (text, tokens) under a segment tree of characters and tokens."""

    def __init__(self, texts: list[str], tokens: list[int]):
        self._build(texts, tokens)

    def _build(self, texts: list[str], tokens: list[int]) -> None:
        self.width = 1 << max(0, len(texts) - 1).bit_length()
        spare = self.width - len(texts)
        self.texts = texts + [""] * spare
        self.sums = [(0, 0)] * self.width + [(len(t), n) for t, n in zip(texts, tokens, strict=True)] + [(0, 0)] * spare
        for node in range(self.width - 1, 0, -1):
            self._add(node)

    def _add(self, node: int) -> None:
        (a, b), (c, d) = self.sums[2 * node], self.sums[2 * node + 1]
        self.sums[node] = (a + c, b + d)

    @property
    def chars(self) -> int:
        return self.sums[1][0]

    @property
    def tokens(self) -> int:
        return self.sums[1][1]

    def leaf_at(self, place: int) -> tuple[int, int]:
        """(leaf, its first character) of the leaf that holds character ``place``; the last one for the end."""
        node, begin = 1, 0
        while node < self.width:
            left = self.sums[2 * node][0]
            if place < begin + left or self.sums[2 * node + 1][0] == 0:
                node = 2 * node
            else:
                begin, node = begin + left, 2 * node + 1
        return node - self.width, begin

    def put(self, first: int, texts: list[str], tokens: list[int]) -> None:
        """Replace the leaves from ``first`` on, as many as are given, and the sums above them."""
        for i, (text, n) in enumerate(zip(texts, tokens, strict=True)):
            self.texts[first + i] = text
            self.sums[self.width + first + i] = (len(text), n)
        low, high = self.width + first, self.width + first + len(texts) - 1
        while low > 1:
            low, high = low >> 1, high >> 1
            for node in range(low, high + 1):
                self._add(node)

    def leaves(self) -> list[dict]:
        return [{"chars": a, "tokens": n} for a, n in self.sums[self.width :] if a]

    def text(self) -> str:
        return "".join(self.texts)

    def rebuilt(self) -> None:
        held = [(t, n) for t, (_, n) in zip(self.texts, self.sums[self.width :], strict=True) if t]
        self._build([h[0] for h in held], [h[1] for h in held])


class Region:
    """The leaves that an edit touches, with the edit made, until the split meets an old edge."""

    def __init__(self, tree: CountedText, start: int, removed: int, inserted: str):
        start = min(max(0, start), tree.chars)
        end = min(start + max(0, removed), tree.chars)
        self.tree = tree
        self.first, begin = tree.leaf_at(max(0, start - CONTEXT))
        self.last, _ = tree.leaf_at(max(end - 1, start, 0))
        old = "".join(tree.texts[self.first : self.last + 1])
        self.text = old[: start - begin] + inserted + old[end - begin :]

    def seen(self) -> str:
        """The region and as much behind it as the pattern may look at."""
        ahead, leaf = "", self.last + 1
        while len(ahead) <= CONTEXT and leaf < self.tree.width:
            ahead += self.tree.texts[leaf]
            leaf += 1
        return self.text + ahead[: CONTEXT + 1]

    def grow(self) -> None:
        self.last += 1
        self.text += self.tree.texts[self.last]

    def done(self, ends: list[int], counts: list[int]) -> None:
        """Put the pre-tokens that end at the characters ``ends`` into the region's leaves."""
        slots = self.last - self.first + 1
        bounds = list(range(LEAF, len(ends), LEAF))[: slots - 1]
        texts, tokens, before, at = [], [], 0, 0
        for stop in [*bounds, len(ends)]:
            edge = ends[stop - 1] if stop else 0
            texts.append(self.text[at:edge])
            tokens.append(sum(counts[before:stop]))
            before, at = stop, edge
        texts += [""] * (slots - len(texts))
        tokens += [0] * (slots - len(tokens))
        self.tree.put(self.first, texts, tokens)
        if len(ends) - (bounds[-1] if bounds else 0) > 4 * LEAF:
            self._split(ends, counts)

    def _split(self, ends: list[int], counts: list[int]) -> None:
        """Too many pre-tokens for the region's leaves: cut them into new leaves and build the tree again."""
        tree = self.tree
        texts = [tree.texts[i] for i in range(self.first)]
        tokens = [tree.sums[tree.width + i][1] for i in range(self.first)]
        at = 0
        for k in range(0, len(ends), LEAF):
            stop = min(k + LEAF, len(ends))
            texts.append(self.text[at : ends[stop - 1]])
            tokens.append(sum(counts[k:stop]))
            at = ends[stop - 1]
        texts += tree.texts[self.last + 1 :]
        tokens += [n for _, n in tree.sums[tree.width + self.last + 1 :]]
        tree._build(texts, tokens)
        tree.rebuilt()


class Counter:
    """Splits and counts many texts at once."""

    def __init__(self, cache: WordCache):
        self.cache = cache

    def pieces(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """(ends in characters, tokens) of every text's pre-tokens."""
        column = pa.array(texts, pa.large_string())
        word, starts, ends, row, row_starts = self.cache.lookup(column)
        count = self.cache.count[word]
        first, n = per_row(row, len(texts))
        out = []
        for i, text in enumerate(texts):
            a, b = int(first[i]), int(first[i] + n[i])
            stop = ends[a:b] - row_starts[i]
            if not text.isascii():
                # characters before each byte: bytes that do not continue a character
                data = np.frombuffer(text.encode(), np.uint8)
                stop = np.cumsum((data & 0xC0) != 0x80)[stop - 1]
            out.append((stop.tolist(), count[a:b].tolist()))
        return out

    def trees(self, texts: list[str]) -> list[CountedText]:
        out = []
        for text, (ends, counts) in zip(texts, self.pieces(texts), strict=True):
            edges = [0, *ends[LEAF - 1 :: LEAF]]
            if ends and edges[-1] != ends[-1]:
                edges.append(ends[-1])
            leaves = [text[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
            tokens = [sum(counts[k : k + LEAF]) for k in range(0, len(counts), LEAF)]
            out.append(CountedText(leaves or [""], tokens or [0]))
        return out

    def edit(self, trees: list[CountedText], edits: list[tuple[int, int, str]]) -> list[int]:
        """Make one edit in each tree; the number of pre-tokens that were encoded again."""
        regions = [Region(t, *e) for t, e in zip(trees, edits, strict=True)]
        made = [0] * len(regions)
        todo = list(range(len(regions)))
        while todo:
            found = self.pieces([regions[i].seen() for i in todo])
            again = []
            for i, (ends, counts) in zip(todo, found, strict=True):
                region = regions[i]
                edge = len(region.text)
                # pre-tokens within the region; the last must end at its edge
                k = int(np.searchsorted(ends, edge, side="right")) if ends else 0
                made[i] += len(ends)
                if (ends[k - 1] if k else 0) == edge or region.last + 1 >= region.tree.width:
                    region.done(ends[:k], counts[:k])
                else:
                    region.grow()
                    again.append(i)
            todo = again
        return made


def _counter(ranks_path: str) -> Counter:
    make = lambda: WordCache(CharacterClasses(pattern_class), SegmentTreeBpe(read_ranks(ranks_path)))
    return Counter(kept_in_worker("bpe:" + ranks_path, make))


def _replaced(docs: DataFrame, made: list[T.StructField]) -> tuple[list[str], T.StructType]:
    names = [c for c in docs.columns if c not in {f.name for f in made}]
    return names, T.StructType([*[docs.schema[c] for c in names], *made])


def count_tokens(docs: DataFrame, ranks_path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` and ``leaves``, the lowest row of each document's tree.

    Null and empty texts have no token and no leaf. Columns of these names are
    replaced; all others and repeated rows stay.
    """
    names, schema = _replaced(docs, [T.StructField("n_tokens", T.LongType()), T.StructField("leaves", LEAVES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(ranks_path)
        for batch in batches:
            for part in _bounded(batch, text):
                trees = counter.trees([t or "" for t in part.column(text).to_pylist()])
                yield _with_trees(part, names, trees)

    return docs.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(frugal(run), schema)


def _bounded(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    for part in chunks(batch, text):
        for first in range(0, part.num_rows, ROWS):
            yield part.slice(first, ROWS)


_LEAF = pa.list_(pa.struct([("chars", pa.int32()), ("tokens", pa.int32())]))


def _with_trees(part: pa.RecordBatch, names: list[str], trees: list[CountedText], replaced: dict | None = None) -> pa.RecordBatch:
    columns = {c: part.column(c) for c in names} | (replaced or {})
    made = [pa.array([t.tokens for t in trees], pa.int64()), pa.array([t.leaves() for t in trees], _LEAF)]
    return pa.RecordBatch.from_arrays([*columns.values(), *made], [*columns, "n_tokens", "leaves"])


def apply_edits(counted: DataFrame, ranks_path: str, edits: str = "edits", text: str = "text") -> DataFrame:
    """Make the ``edits`` of every row of ``count_tokens`` one after the other.

    An edit removes ``removed`` characters at ``start`` and puts ``inserted`` there; places
    beyond the text are moved to its end, null fields count as 0 or empty, a
    null array as no edit. ``text``, ``n_tokens`` and ``leaves`` follow; ``n_encoded`` counts
    the pre-tokens that were encoded again, ``n_edits`` the edits.
    """
    made = [T.StructField("n_encoded", T.LongType()), T.StructField("n_edits", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("leaves", LEAVES)]
    names, schema = _replaced(counted, made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(ranks_path)
        for batch in batches:
            for part in _bounded(batch, text):
                texts = part.column(text).to_pylist()
                trees = []
                for value, leaves in zip(texts, part.column("leaves").to_pylist(), strict=True):
                    edges = np.cumsum([0, *[x["chars"] for x in leaves or []]]).tolist()
                    cut = [(value or "")[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
                    trees.append(CountedText(cut or [""], [x["tokens"] for x in leaves or []] or [0]))
                lists = [e or [] for e in part.column(edits).to_pylist()]
                encoded = [0] * len(trees)
                for turn in range(max((len(e) for e in lists), default=0)):
                    some = [i for i, e in enumerate(lists) if len(e) > turn and e[turn] is not None]
                    now = [(lists[i][turn]["start"] or 0, lists[i][turn]["removed"] or 0, lists[i][turn]["inserted"] or "") for i in some]
                    for i, n in zip(some, counter.edit([trees[i] for i in some], now), strict=True):
                        encoded[i] += n
                new = [None if old is None and not e else t.text() for old, t, e in zip(texts, trees, lists, strict=True)]
                replaced = {text: pa.array(new, part.column(text).type)}
                replaced |= {"n_encoded": pa.array(encoded, pa.int64()), "n_edits": pa.array([len(e) for e in lists], pa.int64())}
                yield _with_trees(part, names, trees, replaced)

    return counted.mapInArrow(frugal(run), schema) if counted.columns == [*names, "n_tokens", "leaves"] else counted.select(
        *[F.col(f"`{c}`") for c in names], "n_tokens", "leaves"
    ).mapInArrow(frugal(run), schema)


def edit_log(docs: DataFrame) -> DataFrame:
    """``documents`` with three edits each, derived from its own columns: a replacement, an insertion, a removal."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    n = F.coalesce(F.length("text"), F.lit(0)) + 1

    def one(start, removed: int, inserted):
        return F.struct((start % n).cast("bigint").alias("start"), F.lit(removed).cast("bigint").alias("removed"), inserted.cast("string").alias("inserted"))

    second = F.concat_ws(" ", F.lit(""), "lang", "source", F.lit("2nd"))
    return docs.withColumn("edits", F.array(one(h, 5, F.lit(" edited")), one(F.floor(h / 7), 0, second), one(F.floor(h / 49), 40, F.lit(""))))


def recounted(docs: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, n_before, n_after, n_edits, n_encoded, text_crc32) of the derived edit log."""
    rows = edit_log(docs).select("doc_id", "text", "edits")
    counted = count_tokens(rows, ranks_path).withColumn("n_before", F.col("n_tokens"))
    after = apply_edits(counted, ranks_path)
    return after.select(
        "doc_id", "n_before", F.col("n_tokens").alias("n_after"), "n_edits", "n_encoded",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
