"""Benchmark leaks found by templates: typed placeholders for numbers, names and units.

A word is what lies between white space, without signs at its ends, in lower
case. ``window`` words in a row form a window; numbers, capitalised words within a
sentence and units behind a number count as NUMBER, NAME and UNIT there. Windows
of documents and items meet in a hash join. The values behind the placeholders
must agree: along one alignment a value of the item stands for one value of the
document, so that a re-parameterised question counts. A value that stands for
several takes the windows it is in out of the count, but none that is the same word
for word; two values of the item may become the same one.

Most windows of a corpus are no benchmark window. A bitmap of fixed size
(``BITS`` bits, 4 MB) drops them inside the tasks, whatever the benchmark's size;
windows that pass are joined exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bandsaw.llm.shards import frugal, saved
from bandsaw.llm.text import chunks, joined, lowered, mix, per_row, rows_of, segment_hashes, words

WINDOW = 8
SHARE = 0.5  # of an item's windows that a document must hold
SHORT_SHARE = 0.5  # of a document's words that an item of fewer words than a window must be, to have the document removed
BITS = 25

# Units, in lower case.
UNITS = """
mm cm m km in inch inches ft foot feet yd yard yards mile miles
mg g kg t lb lbs oz ton tons tonne tonnes gram grams kilogram kilograms pound pounds ounce ounces
ml cl l litre litres liter liters gallon gallons pint pints cup cups
s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years
meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters
mph kmh km/h m/s hz khz mhz ghz w kw mw v kv a ma j kj cal kcal k c f °c °f
kb mb gb tb bit bits byte bytes usd eur gbp dollar dollars euro euros cent cents % percent
""".split()

# Kinds of a word. Placeholders are the hashes of kinds.
PLAIN, NUMBER, NAME, UNIT = range(4)

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 255)]] = True
_WORD_BYTE[[37]] = True  # the sign of percent is a unit
_STOP = np.zeros(256, bool)
_STOP[list(b".!?:|")] = True


def _placeholder(kind: int) -> np.uint64:
    return mix(np.array([kind * 0x1000193 + 7], np.uint64))[0]


def _unit_hashes() -> np.ndarray:
    buffer, starts, ends = joined(pa.array(UNITS, pa.string()))
    return np.sort(segment_hashes(buffer, starts, ends))


class Canonical:
    """Words of a chunk of texts: hash, kind and text of each, in order."""

    def __init__(self, column: pa.Array, units: np.ndarray):
        buffer, self.row_starts, _ = joined(column)
        starts, ends = words(buffer)
        # cut signs off both ends: the first and last word byte in each run
        inner = np.flatnonzero(_WORD_BYTE[buffer])
        a = np.searchsorted(inner, starts)
        b = np.searchsorted(inner, ends) - 1
        held = a <= b
        raw_end = ends[held]
        starts, ends = inner[a[held]] if held.any() else starts[:0], inner[b[held]] + 1 if held.any() else ends[:0]
        self.row = rows_of(starts, self.row_starts)
        low = lowered(buffer)
        self.values = segment_hashes(low, starts, ends)
        digit = np.concatenate([[0], np.cumsum((buffer >= 48) & (buffer <= 57))])
        number = digit[ends] > digit[starts]
        kind = np.where(number, NUMBER, PLAIN)
        if starts.size:
            # a sentence begins a text or follows a stop; lines may be broken anywhere
            first = np.concatenate([[True], self.row[1:] != self.row[:-1]])
            stop = np.concatenate([[False], _STOP[buffer[np.maximum(raw_end[:-1] - 1, 0)]] & (raw_end[:-1] > ends[:-1])])
            begins = first | stop
            upper = (buffer[starts] >= 65) & (buffer[starts] <= 90)
            second = buffer[np.minimum(starts + 1, buffer.size - 1)]
            title = upper & (ends - starts > 1) & (((second >= 97) & (second <= 122)) | (second >= 128))
            kind[title & ~begins & ~number] = NAME
            behind = np.concatenate([[False], number[:-1] & ~first[1:]])
            near = np.minimum(np.searchsorted(units, self.values), units.size - 1)
            kind[behind & (units[near] == self.values)] = UNIT
        self.kind = kind
        places = np.array([_placeholder(k) for k in range(4)])
        self.canonical = np.where(kind == PLAIN, self.values, places[kind])
        self.first, self.count = per_row(self.row, self.row_starts.size)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every window of ``size`` words, half of them no placeholders at least."""
        n = self.canonical.size - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        plain = np.concatenate([[0], np.cumsum(self.kind == PLAIN)])
        enough = plain[size : size + n] - plain[:n] >= (size + 1) // 2
        whole = np.flatnonzero((self.row[:n] == self.row[size - 1 :]) & enough)
        h = np.zeros(whole.size, np.uint64)
        for k in range(size):
            h = mix(h * np.uint64(0x100000001B3) + self.canonical[whole + k])
        return whole, h

    def literal(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every window of ``size`` words, with the values of all words."""
        n = self.values.size - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        whole = np.flatnonzero(self.row[:n] == self.row[size - 1 :])
        h = np.full(whole.size, size, np.uint64)
        for k in range(size):
            h = mix(h * np.uint64(0x100000001B3) + self.values[whole + k])
        return whole, h

    def lacking(self, size: int, first: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(words, first word, hash) of the literal windows of texts of which ``first`` does not hold every window.

        Texts of fewer than ``size`` words have one window of all their words.
        """
        held = np.bincount(self.row[first], minlength=self.count.size)
        for n in range(1, size + 1):
            wanted = self.count == n if n < size else held < self.count - size + 1
            if wanted.any():
                place, h = self.literal(n)
                mine = wanted[self.row[place]]
                yield n, place[mine], h[mine]

    def slots(self, first: np.ndarray, size: int) -> pa.Array:
        """The values behind the placeholders of each window, in order."""
        kinds = self.kind[first[:, None] + np.arange(size)]
        filled = kinds != PLAIN
        flat = self.values[first[:, None] + np.arange(size)][filled].view(np.int64)
        offsets = np.concatenate([[0], np.cumsum(filled.sum(axis=1))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64()))


# ``words`` is the number of the text's words; ``size`` is 0 for windows with placeholders, else the number of words of a literal window
WINDOWS = "key bigint, same_text bigint, words int, position int, h bigint, size int, slots array<bigint>"


def template_windows(rows: DataFrame, window: int, bitmap: np.ndarray | None, literal: list[int] | None = None) -> DataFrame:
    """Windows of ``rows`` (key, same_text, text); with a bitmap, those whose bit is set.

    Literal windows are those that a text lacks (``Canonical.lacking``); with a bitmap,
    all of the sizes ``literal``, each once per text.
    """
    units = _unit_hashes()
    held = rows.sparkSession.sparkContext.broadcast(bitmap) if bitmap is not None else None

    def passing(first: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bit = h >> np.uint64(64 - BITS)
        found = held.value[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)
        return first[found == 1], h[found == 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in WINDOWS.split(", ")]
        for batch in batches:
            for part in chunks(batch, "text"):
                words_of = Canonical(part.column("text"), units)
                first, h = words_of.windows(window)
                if held is None:
                    found = [(0, first, h), *words_of.lacking(window, first)]
                else:
                    found = [(0, *passing(first, h)), *((n, *passing(*words_of.literal(n))) for n in literal or [])]
                for size, first, h in found:
                    if size and held is not None:
                        once = np.unique(np.stack([words_of.row[first].astype(np.uint64), h]), axis=1, return_index=True)[1]
                        first, h = first[once], h[once]
                    row = words_of.row[first]
                    columns = [
                        part.column("key").take(pa.array(row)),
                        part.column("same_text").take(pa.array(row)),
                        pa.array(words_of.count[row].astype(np.int32)),
                        pa.array((first - words_of.first[row]).astype(np.int32)),
                        pa.array(h.view(np.int64)),
                        pa.array(np.full(first.size, size, np.int32)),
                        words_of.slots(first, window) if not size else pa.ListArray.from_arrays(pa.array(np.zeros(first.size + 1, np.int32)), pa.array([], pa.int64())),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(frugal(run), WINDOWS)


def _bitmap(windows: DataFrame) -> np.ndarray:
    """Bit set of the windows' hashes; at most 2^BITS / 64 rows reach the driver."""
    bit = F.shiftrightunsigned("h", 64 - BITS)
    cells = windows.select(F.shiftright(bit, 6).alias("cell"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - BITS}) & 63 as int))").alias("mask"))
    found = cells.groupBy("cell").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[found.column("cell").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    return out


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """(key, same_text, item_id, item_same_text, matched, windows, changed, covers) of documents that hold a benchmark item.

    ``matched`` counts the item's distinct windows found with consistent slots, ``changed``
    the values that differ in them. An item of which windows are dropped, as more than
    half of their words are placeholders, is looked for by the values of all its windows
    too, and one of fewer than ``window`` words by one window of them all; either way
    suffices. For the latter ``covers`` is the item's share of the document's words, else null. Null and empty texts hold nothing. Repeated rows count once; rows of one id
    with different texts are judged apart (``same_text``), items too (``item_same_text``). Further columns are not read.
    """
    tests = items.select(F.col(item).cast("bigint").alias("key"), F.xxhash64(item_text).alias("same_text"), F.col(item_text).alias("text"))
    # a written table: read for the bitmap and for the join
    each = template_windows(tests, window, None).groupBy("key", "same_text", "size", "h").agg(F.min_by(F.struct("position", "slots"), "position").alias("w"))
    sizes = each.groupBy("key", "same_text", "size").agg(F.count("*").cast("int").alias("windows"))
    counted = each.alias("e").join(sizes.alias("s"), F.expr("e.key <=> s.key AND e.same_text = s.same_text AND e.size = s.size"))
    wanted = saved(counted.select(F.col("e.key").alias("item_id"), F.col("e.same_text").alias("item_same_text"), "e.size", "h", "w.*", "windows"), "templates")
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.xxhash64(text).alias("same_text"), F.col(text).alias("text"))
    literal = sorted(r.size for r in wanted.filter("size > 0").select("size").distinct().collect())  # ``window`` sizes at most
    found = template_windows(rows, window, _bitmap(wanted), literal).distinct()
    right = wanted.select("item_id", "item_same_text", "h", "size", "windows", F.col("position").alias("item_position"), F.col("slots").alias("item_slots"))
    # literal windows need no alignment
    met = found.join(right, ["h", "size"]).withColumn("shift", F.when(F.col("size") == 0, F.col("position") - F.col("item_position")))
    pair = ["key", "same_text", "words", "item_id", "item_same_text", "size", "windows"]
    along = [*pair, "shift"]
    # a row per value, and one for a window without slots, which agrees with everything
    values = met.select(*along, "item_position", F.explode_outer(F.arrays_zip("item_slots", "slots")).alias("s"))
    values = values.select(*along, "item_position", "s.item_slots", "s.slots").distinct()
    one = Window.partitionBy(*along, "item_slots")  # at most the item's windows
    values = values.withColumn("clash", F.coalesce(F.min("slots").over(one) != F.max("slots").over(one), F.lit(False)))
    differing = F.collect_set(F.when(F.col("item_slots") != F.col("slots"), F.col("item_slots"))).alias("differing")
    same = F.min(F.col("item_slots").isNull() | (F.col("item_slots") == F.col("slots"))).alias("same")
    agreeing = values.groupBy(*along, "item_position").agg(F.max("clash").alias("clash"), same, differing).filter("same OR NOT clash")
    aligned = agreeing.groupBy(*along).agg(F.collect_set("item_position").alias("places"), F.size(F.array_distinct(F.flatten(F.collect_list("differing")))).alias("changed"))
    whole = aligned.groupBy(*pair).agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("matched"), F.min("changed").cast("int").alias("changed")
    )
    enough = whole.filter(F.col("matched") >= share * F.col("windows"))
    covers = F.when((F.col("size") > 0) & (F.col("size") < window), F.col("size") / F.col("words")).alias("covers")
    best = enough.groupBy("key", "same_text", "item_id", "item_same_text").agg(F.min_by(F.struct("matched", "windows", "changed", covers), "size").alias("b"))
    return best.select("key", "same_text", "item_id", "item_same_text", "b.*")


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that hold an item.

    An item of fewer words than a window is an everyday phrase more often than a leak: it
    counts if it is ``SHORT_SHARE`` of the document's words at least. Null and empty
    texts, repeated rows and all columns of the rows that stay are kept; no items, no change.
    """
    found = leaks(docs, items, key, text, **options)
    bad = found.filter(F.col("covers").isNull() | (F.col("covers") >= SHORT_SHARE)).select("key", "same_text").distinct()
    hit = F.col(f"t.`{key}`").cast("bigint").eqNullSafe(F.col("b.key")) & (F.xxhash64(F.col(f"t.`{text}`")) == F.col("b.same_text"))
    return docs.alias("t").join(bad.alias("b"), hit, "left_anti")


def leaked_items(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, matched, windows, changed, covers) per leak; a row for each text of an item's id that differs in them."""
    return leaks(docs, items).select(F.col("key").alias("doc_id"), "item_id", "matched", "windows", "changed", "covers").distinct()
