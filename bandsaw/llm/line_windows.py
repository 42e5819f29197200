"""Removal of repeated lines by overlapping windows of three.

Lines are compared without the white space at their ends; blank lines belong to
no window. A text of fewer than three such lines has one window, all its lines.
Every window that occurred before, in order of (doc_id, position), covers its
lines; covered lines go. Windows are told apart by 128 bits of hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bandsaw.llm.shards import frugal
from bandsaw.operators.skew import lookup

WINDOW = 3
# Fixed value: the white space that is cut off a line's ends.
BLANKS = " \t\r\f\v"


def content_lines(text: Column) -> Column:
    """Array of the lines that hold more than white space, trimmed."""
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS))), lambda x: x != "")


def _windows(lines: Column, window: int) -> Column:
    """Array of (w1, w2), two independent hashes of each window's lines."""
    count = F.greatest(F.size(lines) - (window - 1), F.least(F.size(lines), F.lit(1)))

    def of(seed: int) -> Column:
        hashes = F.transform(lines, lambda x: F.xxhash64(F.lit(seed), x))
        spans = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.slice(hashes, i, window))
        return F.slice(F.transform(spans, lambda s: F.xxhash64(F.lit(seed), s)), 1, count)

    return F.arrays_zip(of(1).alias("w1"), of(2).alias("w2"))


def later_windows(docs: DataFrame, key: str, text: str, window: int = WINDOW) -> DataFrame:
    """(key, same_text, position) of all windows that occurred before.

    ``same_text`` is a hash of the text: rows that share an id are the same
    document only if they share the text too, and copies of a row stay alike.
    """
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("same_text"), content_lines(F.coalesce(F.col(text), F.lit(""))).alias("lines"))
    windows = rows.select("key", "same_text", F.posexplode(_windows(F.col("lines"), window)).alias("position", "w")).select(
        "key", "same_text", "position", "w.w1", "w.w2"
    )
    place = F.struct("key", "position", "same_text")
    # partial sums make one row per window and task, however frequent it is
    repeated = windows.groupBy("w1", "w2").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1").drop("n")
    again = lookup(windows, repeated, ["w1", "w2"])
    return again.filter(~place.eqNullSafe(F.col("first"))).select("key", "same_text", "position")


def drop_repeated(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with the lines of later windows removed, and ``n_lines``, ``n_removed`` (content lines).

    Null ids come first in order; null and empty texts stay, with no line. Rows
    of equal id and text are one document and keep the same lines. Columns named
    ``n_lines`` or ``n_removed`` are replaced; all others stay.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    later = later_windows(docs, key, text, window)
    covered = later.groupBy("key", "same_text").agg(F.sort_array(F.collect_set("position")).alias("covered"))
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(key).alias("key"), F.xxhash64(text).alias("same_text"))
    with_marks = left.alias("l").join(
        covered.alias("r"), F.col("l.key").eqNullSafe(F.col("r.key")) & (F.col("l.same_text") == F.col("r.same_text")), "left"
    ).select("l.row.*", F.col("r.covered").alias("__covered"))
    schema = T.StructType(
        [*[docs.schema[c] for c in names], T.StructField("n_lines", T.IntegerType()), T.StructField("n_removed", T.IntegerType())]
    )

    def cut(value: str | None, positions: list[int] | None) -> tuple[str | None, int, int]:
        lines = value.split("\n") if value else []
        content = [i for i, x in enumerate(lines) if x.strip(BLANKS)]
        if not positions:
            return value, len(content), 0
        marks = np.zeros(len(content), bool)
        for p in positions:
            marks[p : p + window] = True
        gone = {content[i] for i in np.flatnonzero(marks).tolist()}
        return "\n".join(x for i, x in enumerate(lines) if i not in gone), len(content), len(gone)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(text).to_pylist(), batch.column("__covered").to_pylist(), strict=True)
            done = [cut(t, p) for t, p in pairs]
            columns = [
                pa.array([d[0] for d in done], batch.column(text).type) if c == text else batch.column(c) for c in names
            ]
            counts = [pa.array([d[k] for d in done], pa.int32()) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays([*columns, *counts], [*names, "n_lines", "n_removed"])

    return with_marks.mapInArrow(frugal(run), schema)


#: DuckDB text for the digest of ``drop_repeated`` over ``documents``.
SQL = r"""
WITH split AS (
  SELECT doc_id, text, str_split(text, chr(10)) AS raw FROM documents),
numbered AS (
  SELECT doc_id, raw, list_filter(list_transform(raw, lambda x: trim(x, ' ' || chr(9) || chr(13) || chr(12) || chr(11))), lambda x: x <> '') AS lines FROM split),
windows AS (
  SELECT doc_id, unnest(generate_series(1, CASE WHEN len(lines) = 0 THEN 0 WHEN len(lines) < 3 THEN 1 ELSE len(lines) - 2 END)) AS i, lines
  FROM numbered),
keyed AS (SELECT doc_id, i, array_to_string(lines[i:i + 2], chr(10)) || CASE WHEN len(lines) < 3 THEN chr(10) ELSE '' END AS w FROM windows),
firsts AS (SELECT w, min(doc_id * 1000000 + i) AS f FROM keyed GROUP BY w HAVING count(*) > 1),
covered AS (
  SELECT doc_id, list(DISTINCT i + k) AS gone FROM keyed JOIN firsts USING (w), unnest([0, 1, 2]) AS t(k)
  WHERE doc_id * 1000000 + i <> f GROUP BY doc_id),
flagged AS (
  SELECT n.doc_id, n.lines, coalesce(c.gone, []) AS gone, n.raw FROM numbered n LEFT JOIN covered c USING (doc_id)),
pieces AS (
  SELECT doc_id, len(lines) AS n_lines, raw, gone, len(list_filter(gone, lambda g: g <= len(lines))) AS n_removed,
    list_transform(raw, lambda x: CASE WHEN trim(x, ' ' || chr(9) || chr(13) || chr(12) || chr(11)) <> '' THEN 1 ELSE 0 END) AS full_line
  FROM flagged),
spread AS (
  SELECT doc_id, unnest(raw) AS x, unnest(full_line) AS is_full, generate_subscripts(raw, 1) AS place FROM pieces),
ranked AS (
  SELECT doc_id, x, is_full, place, sum(is_full) OVER (PARTITION BY doc_id ORDER BY place) AS rank FROM spread),
kept AS (
  SELECT r.doc_id, string_agg(r.x, chr(10) ORDER BY r.place) AS text FROM ranked r JOIN pieces p USING (doc_id)
  WHERE NOT (r.is_full = 1 AND list_contains(p.gone, r.rank)) GROUP BY r.doc_id)
SELECT p.doc_id, CAST(p.n_lines AS INTEGER) AS n_lines, CAST(p.n_removed AS INTEGER) AS n_removed, md5(coalesce(k.text, '')) AS text_md5
FROM pieces p LEFT JOIN kept k USING (doc_id)
"""
