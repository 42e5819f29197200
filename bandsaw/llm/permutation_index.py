"""Nearest neighbours by a permutation index.

A vector is represented by its ``PREFIX`` nearest pivots in order. Vectors are dealt
to blocks of about ``BLOCK`` by a hash of their id; each block posts its vectors in
one inverted file per pivot. A query reads the files of its own nearest pivots,
adds up the footrule distance (a pivot that a prefix lacks counts as place
``PREFIX``), and reranks the ``RERANKED`` share of the block that is nearest in
footrule by exact cosine.

A task holds the blocks of one lane, ``HELD`` bytes of vectors at most or one block,
and the queries pass by in the order of its rows. So a vector is sent to one lane, a
query once to each, and a task hands on the best of its lane alone. A query's best of
all lanes meet in one small group.

Equal vectors are one entry with the ``k + 1`` smallest of their ids: no further
copy can be among the k nearest of any query, as ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bandsaw.llm.shards import frugal, saved
from bandsaw.session import shuffle_partitions

PIVOTS = 256
SAMPLE = 2048  # vectors from which the pivots are taken
PREFIX = 128
BLOCK = 4096
QUERIES = 1024  # queries that a task takes at once
RERANKED = 0.25
HELD = 1 << 25  # bytes of the vectors of a lane's blocks
NEARLY = 1e-9  # more than cosines of one pair differ by the order of their sums


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v): rows with an id whose vector has finite components, not all zero."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(key).cast("bigint").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.coalesce(finite & some, F.lit(False))
    )


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(v, ids): every vector once with its k + 1 smallest ids; each Arrow batch is reduced first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[bytes, list[int]] = {}
            example: dict[bytes, int] = {}
            column = batch.column("v")
            flat, offsets = column.flatten().to_numpy(), column.offsets.to_numpy() - column.offsets[0].as_py()
            for i, one in enumerate(batch.column("vec_id").to_pylist()):
                name = flat[offsets[i] : offsets[i + 1]].tobytes()
                held.setdefault(name, []).append(one)
                example.setdefault(name, i)
            ids = [sorted(set(x))[: k + 1] for x in held.values()]
            yield pa.RecordBatch.from_arrays([column.take(pa.array(list(example.values()), pa.int64())), pa.array(ids, pa.list_(pa.int64()))], ["v", "ids"])

    some = rows.mapInArrow(frugal(run), "v array<double>, ids array<bigint>")
    merged = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1)
    return some.groupBy("v").agg(merged.alias("ids"))


def _prefixes(unit: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Nearest pivots of each vector, nearest first; ties to the smaller pivot number."""
    near = np.einsum("ij,kj->ik", unit, pivots)  # each sum alone: what stands beside a vector does not matter
    return np.argsort(-near, axis=1, kind="stable")[:, :prefix]


class PivotFiles:
    """Inverted files of one block: per pivot its place in the prefix of every entry, ``prefix`` where an entry lacks it."""

    def __init__(self, prefixes: np.ndarray, n_pivots: int):
        n, self.prefix = prefixes.shape
        kind = np.int16 if self.prefix**2 < 1 << 15 else np.int32
        self.files = np.full((n_pivots, n), self.prefix, kind)
        self.files[prefixes, np.arange(n)[:, None]] = np.arange(self.prefix, dtype=kind)

    def footrule(self, query: np.ndarray) -> np.ndarray:
        """Distance of every entry to the query's prefix."""
        away = self.files[query]
        away -= np.arange(query.size, dtype=away.dtype)[:, None]
        np.abs(away, out=away)
        return np.add.reduce(away, axis=0, dtype=away.dtype)


class Block:
    """Entries in order of their smallest id, so that ties go to it, and their inverted files."""

    def __init__(self, ids: list[list[int]], vectors: np.ndarray, pivots: np.ndarray, prefix: int):
        self.ids, self.vectors = ids, vectors
        self.length = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        self.files = PivotFiles(_prefixes(vectors / self.length[:, None], pivots, prefix), len(pivots))
        self.order = np.arange(len(ids))

    def nearest(self, query_ids: list[int], queries: np.ndarray, length: np.ndarray, wanted: np.ndarray, k: int, reranked: float) -> Iterator[list[tuple[float, int]]]:
        """For each query its best k entries, as (-score, id) in order."""
        n, most = len(self.ids), 4 * (k + 1)
        take = min(n, max(2 * most, int(np.ceil(reranked * n))))
        about = queries @ self.vectors.T
        for i, own in enumerate(query_ids):
            near = self.order
            if take < n:
                ranked = self.files.footrule(wanted[i]).astype(np.int64) * n + self.order
                near = np.flatnonzero(ranked <= np.partition(ranked, take - 1)[take - 1])
            if near.size > most:
                # all that may be among the best by the exact sums, which are taken of these alone
                cosine = about[i, near] / (self.length[near] * length[i])
                near = near[~(cosine < np.partition(cosine, near.size - most)[near.size - most] - NEARLY)]
            score = np.einsum("ij,j->i", self.vectors[near], queries[i]) / (self.length[near] * length[i])
            best = np.argsort(-score, kind="stable")[:most] if near.size > most else range(near.size)
            yield sorted((-float(score[j]), v) for j in best for v in self.ids[near[j]] if v != own)[:k]


def _searched(blocks: list[Block], query_ids: list[int], queries: np.ndarray, pivots: np.ndarray, k: int, prefix: int, reranked: float) -> tuple[list, list, list]:
    """Best k of some blocks for each query: (query ids, vector ids, scores)."""
    length = np.sqrt(np.einsum("ij,ij->i", queries, queries))
    wanted = _prefixes(queries / length[:, None], pivots, prefix)
    found: list[list[tuple[float, int]]] = [[] for _ in query_ids]
    for block in blocks:
        for one, best_here in zip(found, block.nearest(query_ids, queries, length, wanted, k, reranked), strict=True):
            one.extend(best_here)
    out: tuple[list, list, list] = ([], [], [])
    for own, one in zip(query_ids, found, strict=True):
        best: dict[int, float] = {}  # an id that repeats with another vector keeps the better score
        for least, v in sorted(one):
            best.setdefault(v, -least)
            if len(best) == k:
                break
        out[0].extend([own] * len(best))
        out[1].extend(best)
        out[2].extend(best.values())
    return out


def search(
    vectors: DataFrame, is_query, k: int = 5, key: str = "vec_id", vector: str = "embedding",
    pivots: int = PIVOTS, prefix: int = PREFIX, block: int = BLOCK, reranked: float = RERANKED,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found by cosine for the rows that ``is_query(vec_id)`` marks.

    Vectors that are null, zero, or hold null or infinite components take no part,
    nor do those whose length is not that of most vectors. Of rows that share an
    id each vector counts as a candidate; a query never finds its own id. With fewer
    candidates than k all come back; an empty table gives none. Further columns
    are not read.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector)
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    widths = rows.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), "width").limit(1).collect()
    if not widths:
        return spark.createDataFrame([], schema)
    width, _ = widths[0]
    rows = rows.filter(F.size("v") == width)
    entries = saved(distinct_vectors(rows, k), "vectors")
    n = entries.count()
    blocks = -(-n // block)
    first = F.col("ids")[0]
    sample = [r.v for r in entries.orderBy(F.xxhash64(first), first).limit(SAMPLE).select("v").collect()]
    chosen = np.array(sample[:pivots])
    held = spark.sparkContext.broadcast(chosen / np.sqrt((chosen**2).sum(axis=1))[:, None])

    columns = [first.alias("first"), "ids", "v"]
    asked = rows.filter(is_query(F.col("vec_id"))).select(F.array("vec_id").alias("ids"), "v").distinct()
    tasks = max(shuffle_partitions(spark), 2 * spark.sparkContext.defaultParallelism)
    lanes = max(1, -(-blocks // max(1, HELD // (block * width * 8))), min(blocks, tasks))
    # few lanes are repeated for parts of the queries, so that all cores have work
    parts = max(1, min(-(-tasks // lanes), -(-asked.count() // QUERIES)))

    def numbers(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    placed = entries.withColumn("block", F.pmod(F.xxhash64(first), F.lit(blocks)).cast("int"))
    placed = placed.withColumn("lane", F.col("block") % lanes).withColumn("part", numbers(parts))
    placed = placed.select((F.col("lane") * parts + F.col("part")).alias("unit"), (F.col("block") - blocks).alias("turn"), *columns)
    part = F.pmod(F.xxhash64(first, F.lit(1)), F.lit(parts)).cast("int")
    asked = asked.withColumn("lane", numbers(lanes)).select((F.col("lane") * parts + part).alias("unit"), F.lit(0).alias("turn"), *columns)
    # in each partition the blocks of a lane, one after the other, then queries
    met = placed.unionByName(asked).repartitionById(lanes * parts, F.col("unit")).sortWithinPartitions("turn", "first", "ids", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = min(prefix, len(held.value))
        made: list[Block] = []
        open_: list[tuple[list, np.ndarray]] = []  # pieces of the block whose rows come
        now = None
        for batch in batches:
            turns = batch.column("turn").to_numpy()
            edges = np.r_[0, np.flatnonzero(np.diff(turns)) + 1, len(turns)].tolist()
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    continue
                if open_ and turns[a] != now:
                    made.append(Block([x for ids, _ in open_ for x in ids], np.concatenate([v for _, v in open_]), held.value, size))
                    open_ = []
                now = turns[a]
                step = b - a if now < 0 else QUERIES
                for c in range(a, b, step):
                    piece = batch.slice(c, min(step, b - c))
                    ids, vectors = piece.column("ids").to_pylist(), piece.column("v").flatten().to_numpy().reshape(-1, width)
                    if now < 0:
                        open_.append((ids, vectors))
                    elif made:
                        found = _searched(made, [x[0] for x in ids], vectors, held.value, k, size, reranked)
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(found, (pa.int64(), pa.int64(), pa.float64()), strict=True)], ["query_id", "vec_id", "score"])

    found = met.select("turn", "ids", "v").mapInArrow(frugal(run), "query_id bigint, vec_id bigint, score double")
    # a query row that repeats with another vector keeps the better score of a candidate
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
