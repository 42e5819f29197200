"""Language identification by error-correcting output codes.

Every language has a codeword of ``bits_for(n)`` bits. A binary classifier per bit, naive
Bayes over hashed byte n-grams, tells the languages with a one from the others.
A text goes to the codeword with the least loss, in which each bit counts for as
much as its classifier was right on that language. If the second codeword is
nearly as near, the text is ambiguous.

What is learned has a fixed size (``FEATURES`` x bits, and bits per language),
however large the corpus is; counts come from all labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bandsaw.llm.segment_bpe import pattern_class
from bandsaw.llm.shards import frugal
from bandsaw.llm.text import LETTER, CharacterClasses, chunks, joined, lowered, mix

FEATURES = 1 << 12
ROWS = 256  # texts of a chunk, so that its count matrix is bounded
MOST_LANGUAGES = 1024
LEAST_MARGIN = 0.02
UNKNOWN = "und"
SMOOTHING = 0.5


def bits_for(n: int) -> int:
    """Bits of the codewords of ``n`` languages."""
    return 15 if n <= 16 else 31 if n <= 128 else 63


def codewords(n: int, bits: int | None = None) -> np.ndarray:
    """(n, bits) of 0 and 1, far apart: rows of a fixed pseudo-random matrix, the best of 64; every column splits."""
    bits = bits or bits_for(n)
    best, best_apart = None, -1
    for turn in range(64):
        seed = np.arange(n * bits, dtype=np.uint64) + np.uint64(turn * 1_000_003 + 1)
        code = (mix(mix(seed)) >> np.uint64(63)).astype(np.int64).reshape(n, bits)
        flat = np.flatnonzero((code.sum(axis=0) == 0) | (code.sum(axis=0) == n))
        if n > 1:
            code[flat % n, flat] ^= 1
        apart = min((int((code[i] != code[j]).sum()) for i in range(n) for j in range(i)), default=bits) if n <= 64 else int((code[:-1] != code[1:]).sum(axis=1).min())
        if apart > best_apart:
            best, best_apart = code, apart
    return best


def ngram_counts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(texts x FEATURES counts of hashed byte 2- and 3-grams, whether a text has a letter).

    A-Z count as lower case; each run of other than letters counts as one blank.
    """
    buffer, starts, ends = joined(column)
    n = starts.size
    kinds = CLASSES(buffer) if buffer.size else buffer
    letter = kinds == LETTER
    has_letter = np.zeros(n, bool)
    if not buffer.size:
        return np.zeros((n, FEATURES), np.float32), has_letter
    low = np.where(letter, lowered(buffer), np.uint8(32))
    before = np.concatenate([[False], letter[:-1]])
    ends_mark = np.zeros(buffer.size, bool)
    ends_mark[ends] = True
    kept = letter | before | ends_mark
    row = np.cumsum(ends_mark) - ends_mark
    low, row, letter = low[kept].astype(np.uint32), row[kept], letter[kept]
    has_letter[np.unique(row[letter])] = True
    keys = []
    for size in (2, 3):
        m = low.size - size + 1
        if m <= 0:
            continue
        gram = np.zeros(m, np.uint32)
        for k in range(size):
            gram = gram * np.uint32(257) + low[k : k + m]
        slot = ((gram + np.uint32(size)) * np.uint32(2654435761)) >> np.uint32(32 - 12)
        # those across two texts, and of a blank and nothing else, do not count
        inside = (row[:m] == row[size - 1 :]) & (letter[:m] | letter[size - 1 :])
        keys.append((row[:m] * FEATURES + slot)[inside])
    counts = np.bincount(np.concatenate(keys) if keys else np.zeros(0, np.int64), minlength=n * FEATURES)
    return counts.reshape(n, FEATURES).astype(np.float32), has_letter


CLASSES = CharacterClasses(pattern_class)


@dataclass
class Model:
    """Learned languages, their codewords, the bits' n-gram weights and scales, and the weight of each bit per language."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # FEATURES x bits
    scale: np.ndarray  # bits
    trust: np.ndarray  # languages x bits

    def margins(self, counts: np.ndarray) -> np.ndarray:
        """Mean evidence per n-gram for a one at each bit, in units of its usual size."""
        return (counts @ self.weights) / np.maximum(1, counts.sum(axis=1, keepdims=True)) / self.scale

    def decode(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language index, score, margin): score is the second least loss over the sum of the two least."""
        signs = 2.0 * self.code - 1
        agreement = np.clip(self.margins(counts)[:, None, :] * signs, -4, 4)
        loss = (np.exp(-2 * agreement) * self.trust).sum(axis=2)
        best = loss.argmin(axis=1)
        ordered = np.sort(loss, axis=1)
        first, second = ordered[:, 0], ordered[:, min(1, len(self.languages) - 1)]
        if len(self.languages) == 1:
            return best, np.ones(best.size), np.ones(best.size)
        total = np.maximum(first + second, 1e-12)
        return best, second / total, (second - first) / total


def _labelled_counts(labelled: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, feature, n) summed per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in _bounded(batch, text):
                counts, _ = ngram_counts(part.column(text))
                of = np.array(part.column(lang).to_pylist(), object)
                for name in set(of.tolist()):
                    held[name] = held.get(name, 0) + counts[of == name].sum(axis=0, dtype=np.float64)
        for name, total in held.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * some.size, pa.string()), pa.array(some.astype(np.int32)), pa.array(total[some].astype(np.int64))], ["lang", "feature", "n"]
            )

    return labelled.mapInArrow(frugal(run), "lang string, feature int, n bigint")


def _bounded(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    for part in chunks(batch, text):
        for first in range(0, part.num_rows, ROWS):
            yield part.slice(first, ROWS)


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model | None:
    """Learn from the rows whose ``lang`` is not null; None if there is none.

    Two passes over the text: n-gram counts per language, added up to one row per
    (feature, bit), and how often each bit is right on each language.
    """
    rows = labelled.filter(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    languages = [r.lang for r in rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect()]
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not languages:
        return None
    languages.sort()
    code = codewords(len(languages))
    bits = code.shape[1]
    spark = labelled.sparkSession
    sides = spark.createDataFrame([(name, row.tolist()) for name, row in zip(languages, code, strict=True)], "lang string, code array<bigint>")
    counts = _labelled_counts(rows, "text", "lang").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    by_bit = counts.join(F.broadcast(sides), "lang").select("feature", "n", F.posexplode("code").alias("bit", "one"))
    sums = by_bit.groupBy("feature", "bit").agg(F.sum(F.col("n") * F.col("one")).alias("one"), F.sum("n").alias("n")).toArrow()
    ones, total = np.zeros((FEATURES, bits)), np.zeros((FEATURES, bits))
    where = sums.column("feature").to_numpy(), sums.column("bit").to_numpy()
    ones[where], total[where] = sums.column("one").to_numpy(), sums.column("n").to_numpy()
    zeros = total - ones
    p, q = (x + SMOOTHING for x in (ones, zeros))
    weights = np.log(p / p.sum(axis=0)) - np.log(q / q.sum(axis=0))
    if len(languages) == 1:
        weights[:] = 0
    model = Model(languages, code, weights.astype(np.float32), np.ones(bits), np.ones(code.shape))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = {name: i for i, name in enumerate(model.languages)}
        out = np.zeros((3, *model.code.shape))
        for batch in batches:
            for part in _bounded(batch, "text"):
                grams, has_letter = ngram_counts(part.column("text"))
                of = np.array([rank[x] for x in part.column("lang").to_pylist()])[has_letter]
                margins = model.margins(grams[has_letter])
                right = (margins > 0) == (model.code[of] == 1)
                for k, value in enumerate((np.ones(right.shape), right, np.abs(margins))):
                    np.add.at(out[k], of, value)
        i, b = np.indices(model.code.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i), pa.array(b), *(pa.array(x.ravel()) for x in out)], ["language", "bit", "n", "n_right", "size"]
        )

    trials = rows.mapInArrow(frugal(run), "language bigint, bit bigint, n double, n_right double, size double")
    table = trials.groupBy("language", "bit").agg(F.sum("n").alias("n"), F.sum("n_right").alias("n_right"), F.sum("size").alias("size")).toPandas()
    n, right, size = (np.zeros(code.shape) for _ in range(3))
    where = table["language"].to_numpy(), table["bit"].to_numpy()
    n[where], right[where], size[where] = table["n"], table["n_right"], table["size"]
    # a rounded mean, as the order of sums differs from run to run
    model.scale = np.maximum(1e-6, np.round(size.sum(axis=0) / np.maximum(1, n.sum(axis=0)), 6))
    trust = np.maximum(0.01, right / np.maximum(1, n))
    model.trust = trust / trust.sum(axis=1, keepdims=True)
    return model


def predict(docs: DataFrame, model: Model | None, text: str = "text", least_margin: float = LEAST_MARGIN) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``; columns of these names are replaced.

    A text that is null, empty or without a letter is ``und`` with score 0, and so
    is every text if nothing was learned. Only the text decides.
    """
    made = ["lang_pred", "score", "ambiguous"]
    names = [c for c in docs.columns if c not in made]
    schema = T.StructType([*[docs.schema[c] for c in names], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())])
    # arrays alone: a class would need this package in the executors
    held = docs.sparkSession.sparkContext.broadcast(model and (model.languages, model.code, model.weights, model.scale, model.trust))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value and Model(*held.value)
        for batch in batches:
            for part in _bounded(batch, text):
                n = part.num_rows
                grams, has_letter = ngram_counts(part.column(text))
                lang, score, close = np.full(n, UNKNOWN, object), np.zeros(n), np.zeros(n, bool)
                if known is not None and has_letter.any():
                    best, value, margin = known.decode(grams[has_letter])
                    lang[has_letter] = np.array(known.languages, object)[best]
                    score[has_letter] = value
                    close[has_letter] = margin < least_margin
                columns = [pa.array(lang.tolist(), pa.string()), pa.array(score), pa.array(close)]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], *columns], [*names, *made])

    return docs.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(frugal(run), schema)


def held_out(key: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text leaves no remainder by five."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def predicted(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous), learned from the rows that are not held out."""
    # an id that is null has no remainder: it is predicted and never learned from
    rows = docs.withColumn("held_out", F.coalesce(held_out(), F.lit(False)))
    model = train(rows.filter(F.coalesce(~held_out(), F.lit(False))))
    return predict(rows.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")
