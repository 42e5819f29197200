"""Word collocations: frequent phrases that hold together, mined in two passes.

First pass: every n-gram of 1 to ``LONGEST`` words becomes a fingerprint. Its leading
bits name a hash partition, the others stand in sorted blocks, one per partition and
chunk of text, with their counts. A partition first learns the mass of all its blocks, takes a
capacity greater than mass / threshold, and merges the blocks into one Misra-Gries
summary: whenever more entries are held, the count of the first one beyond capacity is
taken off all. What is taken off a count this way stays below the threshold, so every
n-gram that is frequent survives; n-grams that share a fingerprint add up, and survive together.

Survivors mark a bitmap, of a size bounded by ``MOST_BITS``. Second pass: n-grams that are marked,
and whose parts are, are counted by their words, exactly. All else works on these counts.

Words of a chunk become numbers by an exact dictionary; n-grams are counted by these
numbers, never by a hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandsaw.llm import text as tx
from bandsaw.llm.shards import frugal, saved
from bandsaw.session import shuffle_partitions

LONGEST = 5
THRESHOLD = 100
TOP = 2000
UNKNOWN = "und"
CHUNK = 4 << 20  # bytes of text whose n-grams become one block per partition
PARTITION_ENTRIES = 1 << 17  # entries of a summary that partitions are made for
MOST_PARTITIONS = 1 << 16
MOST_BITS = 29  # 64 MB
LOW_BITS = 32
HELD_ROWS = 1 << 19  # counts that wait before a task adds them up

# Bytes that end a piece, and bytes that part words within one.
_PIECE_END = np.zeros(256, bool)
_PIECE_END[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13, tx.SEPARATOR]] = True
_WORD_END = _PIECE_END.copy()
_WORD_END[[9, 32]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """The words of a chunk: number, piece and language of each, and the distinct words."""

    def __init__(self, batch: pa.RecordBatch):
        buffer, starts, _ = tx.joined(batch.column("text"))
        buffer = tx.lowered(buffer)
        inside = ~_WORD_END[buffer]
        # the buffer ends with a separator, so the bytes of a word never touch those of another text
        first = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]])) if buffer.size else np.zeros(0, np.int64)
        last = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) if buffer.size else first
        offsets = np.concatenate([[0], np.cumsum(last + 1 - first)]).astype(np.int64)
        held = pa.LargeStringArray.from_buffers(first.size, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(buffer[inside])))
        coded = held.dictionary_encode()
        self.number = coded.indices.to_numpy().astype(np.int64)
        self.distinct = coded.dictionary
        ends = _PIECE_END[buffer]
        piece = np.cumsum(ends)[first] if first.size else np.zeros(0, np.int64)
        languages = pc.fill_null(batch.column("lang"), UNKNOWN).dictionary_encode()
        self.languages = languages.dictionary
        self.language = languages.indices.to_numpy().astype(np.int64)[tx.rows_of(first, starts)] if first.size else np.zeros(0, np.int64)
        n = first.size
        # how many words follow in the same piece, up to LONGEST - 1
        self.reach = np.zeros(n, np.int8)
        for k in range(1, LONGEST):
            self.reach[: n - k][piece[k:] == piece[: n - k]] = k

    def fingerprints(self) -> list[np.ndarray]:
        """Per length the 64-bit fingerprints of the n-grams, at the places where ``reach`` allows one."""
        word = _hashes(self.distinct)[self.number] if self.number.size else np.zeros(0, np.uint64)
        rolling = tx.mix(word ^ _hashes(self.languages)[self.language]) if word.size else word
        out = [rolling]
        for k in range(1, LONGEST):
            here = rolling[: max(word.size - k, 0)]
            rolling = tx.mix(here * _STEP + word[k:])
            out.append(rolling)
        return out


def _hashes(strings: pa.Array) -> np.ndarray:
    """64-bit hash of each string, whatever array it stands in."""
    buffer, starts, ends = tx.joined(strings)
    out = np.zeros(len(strings), np.uint64)
    some = ends > starts
    out[some] = tx.segment_hashes(buffer, starts[some], ends[some])
    return out


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """Words of about ``CHUNK`` bytes of text at a time, from one or several batches."""
    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for part in tx.chunks(batch, "text", CHUNK):
            own = pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
            if waiting and size + own > CHUNK:
                yield Words(_together(waiting))
                waiting, size = [], 0
            waiting.append(part)
            size += own
    if waiting:
        yield Words(_together(waiting))


def _together(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(parts) == 1:
        return parts[0]
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


# --- first pass: summaries --------------------------------------------------------------------------------------


def packed(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Ascending 32-bit keys as the byte planes of their steps, and (place, count) of counts above one."""
    steps = np.diff(keys, prepend=np.uint32(0)).astype("<u4")
    many = np.flatnonzero(counts > 1)
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes(), np.concatenate([many, counts[many]]).astype("<u4").tobytes()


def unpacked(blob: bytes, several: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps = np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(4, -1).T).view("<u4").ravel()
    keys = np.cumsum(steps, dtype=np.uint32)
    counts = np.ones(keys.size, np.int64)
    many = np.frombuffer(several, "<u4").reshape(2, -1)
    counts[many[0]] = many[1]
    return keys, counts


class Summary:
    """A Misra-Gries summary of (key, count) blocks; ``taken`` is what any count may lack."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.n_waiting += keys.size
        if self.n_waiting > max(self.capacity, PARTITION_ENTRIES):
            self.merge()

    def merge(self) -> None:
        """Add up what waits, then take the count of the first entry beyond capacity off all."""
        keys = np.concatenate([self.keys, *(k for k, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        self.waiting, self.n_waiting = [], 0
        if not keys.size:
            return
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, counts = keys[begin], np.add.reduceat(counts, begin)
        if keys.size > self.capacity:
            off = int(np.partition(counts, keys.size - self.capacity - 1)[keys.size - self.capacity - 1])
            left = counts > off
            keys, counts = keys[left], counts[left] - off
            self.taken += off
        self.keys, self.counts = keys, counts

    def at_least(self, threshold: int) -> np.ndarray:
        """All keys whose true count may reach ``threshold``."""
        self.merge()
        return self.keys[self.counts + self.taken >= threshold]


def _blocks(n_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _chunks(batches):
            prints = [f[words.reach[: f.size] >= k] for k, f in enumerate(words.fingerprints())]
            keys = np.concatenate(prints)
            if not keys.size:
                continue
            keys >>= np.uint64(64 - LOW_BITS - n_bits)
            keys.sort()
            begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            counts = np.diff(np.append(begin, keys.size))
            keys = keys[begin]
            part, low = (keys >> np.uint64(LOW_BITS)).astype(np.int64), keys.astype(np.uint32)
            bounds = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
            rows: tuple[list, ...] = ([], [], [], [], [])
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                blob, several = packed(low[a:b], counts[a:b])
                # the mass goes ahead of the block
                for column, pair in zip(rows, ((int(part[a]),) * 2, (0, 1), (int(counts[a:b].sum()), 0), (b"", blob), (b"", several)), strict=True):
                    column.extend(pair)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["p", "kind", "mass", "keys", "several"])

    return run


def _survivors(n_bits: int, map_bits: int, threshold: int):
    """Per partition its section of the bitmap, in which survivors are marked by their leading ``map_bits`` bits."""
    section = 1 << max(map_bits - n_bits, 3)
    shift = np.uint32(max(LOW_BITS - max(map_bits - n_bits, 3), 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, mass, summary = None, 0, None

        def closed():
            marks = np.zeros(section, np.uint8)
            if summary is not None:
                marks[summary.at_least(threshold) >> shift] = 1
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary())], ["p", "bits"])

        for batch in batches:
            columns = [batch.column(c) for c in ("p", "kind", "mass", "keys", "several")]
            for i in range(batch.num_rows):
                p, kind, own, keys, several = (c[i].as_py() for c in columns)
                if p != at:
                    if at is not None:
                        yield closed()
                    at, mass, summary = p, 0, None
                if kind == 0:
                    mass += own
                    continue
                if summary is None:
                    summary = Summary(mass // threshold + 1)
                summary.add(*unpacked(keys, several))
        if at is not None:
            yield closed()

    return run


class Marks:
    """The bitmap of survivors."""

    def __init__(self, sections: dict[int, bytes], n_bits: int, map_bits: int):
        self.n_bits, self.bits = n_bits, max(map_bits, n_bits + 3)
        size = 1 << (self.bits - n_bits - 3)
        self.held = np.zeros(size << n_bits, np.uint8)
        for p, section in sections.items():
            self.held[p * size : (p + 1) * size] = np.frombuffer(section, np.uint8)

    def __call__(self, prints: np.ndarray) -> np.ndarray:
        at = prints >> np.uint64(64 - self.bits)
        return (self.held[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def dealt_to(docs: DataFrame, n_bits: int) -> int:
    """Over how many tasks the hash partitions go."""
    return max(1, min(1 << n_bits, max(shuffle_partitions(docs.sparkSession), (1 << n_bits) // 4)))


def marked(docs: DataFrame, threshold: int) -> Marks:
    """Fingerprints of all n-grams that may occur ``threshold`` times or more, found by summaries."""
    # words are parted by a byte at least: no text of b bytes has more than (b + 1) / 2, nor LONGEST times as many n-grams
    size = docs.agg(F.sum(F.octet_length("text") + 1).alias("b")).first().b or 0
    entries = LONGEST * (int(size) // 2 + 1) // threshold + 1
    n_bits = max(3, min(MOST_PARTITIONS, -(-entries // PARTITION_ENTRIES) * 2 - 1).bit_length())
    map_bits = min(MOST_BITS, max(16, entries.bit_length() + 5))
    blocks = docs.mapInArrow(frugal(_blocks(n_bits)), "p int, kind int, mass bigint, keys binary, several binary")
    dealt = blocks.repartition(dealt_to(docs, n_bits), "p").sortWithinPartitions("p", "kind")
    sections = dealt.mapInArrow(frugal(_survivors(n_bits, map_bits, threshold)), "p int, bits binary").collect()
    return Marks({r.p: r.bits for r in sections}, n_bits, map_bits)


# --- second pass: exact counts ----------------------------------------------------------------------------------

COUNTS = "lang string, phrase string, words int, count bigint"
NAMES = ["lang", "phrase", "words", "count"]


def _added_up(tables: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Counts added up by ``keys``; at most ``HELD_ROWS`` rows and one batch wait, unless more of them differ."""
    waiting: list[pa.RecordBatch] = []
    held, limit = 0, HELD_ROWS

    def together() -> pa.Table:
        whole = pa.Table.from_batches(waiting).group_by(keys).aggregate([("count", "sum")])
        return whole.rename_columns({"count_sum": "count"}).select([*keys, "count"])

    for batch in tables:
        waiting.append(batch)
        held += batch.num_rows
        if held > limit:
            whole = together()
            waiting, held = whole.to_batches(), whole.num_rows
            limit = max(HELD_ROWS, 2 * held)
    if waiting:
        yield together()


def _counted(marks, n_bits: int):
    """One row per hash partition and task: its marked n-grams and their counts; partition -1 counts all words by language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _added_up(found(batches), ["p", *NAMES[:-1]]):
            whole = whole.sort_by("p").combine_chunks()
            p = whole.column("p").to_numpy()
            first = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
            offsets = pa.array(np.append(first, p.size).astype(np.int32))
            for i in range(first.size):  # a row of its own each, as a block may be large
                block = whole.slice(offsets[i].as_py(), offsets[i + 1].as_py() - offsets[i].as_py())
                lists = [pa.ListArray.from_arrays(pa.array([0, block.num_rows], pa.int32()), block.column(c).combine_chunks()) for c in NAMES]
                yield pa.RecordBatch.from_arrays([pa.array([int(p[first[i]])], pa.int32()), *lists], ["p", *NAMES])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(p: np.ndarray, lang: pa.Array, phrase: pa.Array, words: int, count: np.ndarray) -> pa.RecordBatch:
            columns = [pa.array(p.astype(np.int32)), lang.cast(pa.string()), phrase.cast(pa.string()), pa.array(np.full(p.size, words, np.int32)), pa.array(count, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["p", *NAMES])

        for w in _chunks(batches):
            n = w.number.size
            if not n:
                continue
            totals = np.bincount(w.language, minlength=len(w.languages))
            yield rows(np.full(totals.size, -1), w.languages, pa.nulls(totals.size, pa.string()), 0, totals)
            number, strings, langs = w.language, None, w.languages
            before = np.ones(n, bool)  # the n-gram of one word less is counted at this place
            for k, prints in enumerate(w.fingerprints()):
                here = np.zeros(n, bool)
                here[: prints.size] = (w.reach[: prints.size] >= k) & marks.value(prints)
                here &= before
                if k:
                    here[:-1] &= before[1:]
                at = np.flatnonzero(here)
                if not at.size:
                    break
                code = number[at] << 32 | w.number[at + k]
                distinct, index, inverse, counts = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
                prefix, last = pa.array(distinct >> 32), w.distinct.take(pa.array(distinct & 0xFFFFFFFF))
                langs = langs.take(prefix)
                strings = last if strings is None else pc.binary_join_element_wise(strings.take(prefix), last, pa.scalar(" ", pa.large_string()))
                yield rows((prints[at[index]] >> np.uint64(64 - n_bits)).astype(np.int64), langs, strings, k + 1, counts)
                number = np.zeros(n, np.int64)
                number[at] = inverse
                before = here

    return run


def _exact(threshold: int):
    """The counts of each hash partition, added up; what is below ``threshold`` goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        at = None
        for batch in batches:
            for i in range(batch.num_rows):
                p = batch.column("p")[i].as_py()
                if waiting and p != at:
                    yield from added(waiting)
                    waiting = []
                at = p
                block = pa.RecordBatch.from_arrays([batch.column(c).slice(i, 1).flatten() for c in NAMES], NAMES)
                waiting.append(block)
                if sum(x.num_rows for x in waiting[1:]) > max(HELD_ROWS, waiting[0].num_rows):
                    waiting = [_one(waiting)]
        if waiting:
            yield from added(waiting)

    def added(blocks: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = _one(blocks)
        keep = pc.or_(pc.equal(whole.column("words"), 0), pc.greater_equal(whole.column("count"), threshold))
        yield whole.filter(keep)

    def _one(blocks: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = next(_added_up(iter(blocks), NAMES[:-1])).combine_chunks()
        return whole.to_batches()[0] if whole.num_rows else blocks[0].slice(0, 0)

    return run


def counted(docs: DataFrame, threshold: int) -> DataFrame:
    """(lang, phrase, words, f): exact counts of all n-grams with f >= threshold, and a row without a phrase with n per language."""
    marks = marked(docs, threshold)
    held = docs.sparkSession.sparkContext.broadcast(marks)
    schema = "p int, " + ", ".join(f"{n} array<{t}>" for n, t in (c.split() for c in COUNTS.split(", ")))
    found = docs.mapInArrow(frugal(_counted(held, marks.n_bits)), schema)
    tasks = dealt_to(docs, marks.n_bits)
    whole = found.repartition(tasks, "p").sortWithinPartitions("p").mapInArrow(frugal(_exact(threshold)), COUNTS)
    return whole.withColumnRenamed("count", "f")


# --- scores -----------------------------------------------------------------------------------------------------


def _words(phrase: Column, first: Column, count: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, count), " ")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    A candidate is a phrase of 2 to 5 words that occurs ``threshold`` times. Its score is the smallest over
    all cuts of 1000 * a * n / (l * r), floored, with the counts l and r of both parts and n words in all; ties go to
    the smallest first part. Candidates within a longer candidate of the same count are left out.
    A null text counts as empty and gives nothing, as do texts of separators; a null language is ``und``; each row
    counts, repeated or not; a language without candidates has no rows, nor has an empty table. Texts of any
    length are read whole, at least one at a time. Equal scores go by count, then by the bytes of the phrase. Other
    columns are not read.
    """
    rows = docs.select(F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"))
    counts = saved(counted(rows, threshold), "phrase-counts")
    totals = counts.filter("words = 0").select("lang", F.col("f").alias("n"))
    known = counts.filter("words > 0").select("lang", "phrase", "words", "f")
    candidates = known.filter("words > 1")
    cut = candidates.select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cut = cut.withColumn("left", _words(F.col("phrase"), F.lit(1), F.col("k")))
    cut = cut.withColumn("right", _words(F.col("phrase"), F.col("k") + 1, F.col("words") - F.col("k")))
    # the parts of a frequent phrase are frequent, so that no cut is lost here
    parts = lambda name, count: known.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
    cut = cut.join(parts("left", "l"), ["lang", "left"]).join(parts("right", "r"), ["lang", "right"])
    # a phrase one word longer is enough: what lies in a longer one of the same count lies in one of these
    inner = F.col("k") == F.col("words") - 1, F.col("k") == 1
    cover = cut.filter("words > 2").select("lang", "a", F.explode(F.filter(F.array(F.when(inner[0], F.col("left")), F.when(inner[1], F.col("right"))), lambda s: s.isNotNull())).alias("phrase"))
    cover = cover.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    # few languages: the join is on a handful of rows
    cut = cut.join(totals, "lang")
    score = F.expr("(CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(16,0)) * CAST(n AS DECIMAL(18,0))) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))")
    best = cut.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))
    best = best.join(cover, ["lang", "phrase"], "left").filter("longer IS NULL OR longer < a")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = best.select("lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH t AS (
  SELECT doc_id, row_number() OVER () AS row_id, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT row_id, lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
n AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest([array_to_string(words[i : i + k - 1], ' ') for i in range(1, len(words) - k + 2)]) AS phrase
      FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(words) >= k),
f AS (SELECT lang, phrase, k AS words, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE words > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r, n,
    CAST(1000::HUGEINT * c.f * n // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM c JOIN (SELECT unnest(range(1, 5)) AS k) ON k < c.words
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1 : k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[k + 1 :], ' ')
  JOIN n ON n.lang = c.lang),
inside AS (
  SELECT c.lang, array_to_string(c.ws[i : i + m - 1], ' ') AS phrase, max(c.f) AS longer
  FROM c JOIN (SELECT unnest(range(2, 5)) AS m) ON m < c.words JOIN (SELECT unnest(range(1, 5)) AS i) ON i + m - 1 <= c.words
  GROUP BY ALL),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT best.* FROM best LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR longer < a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
